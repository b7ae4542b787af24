"""Queries of problem 6: mixed timestamp formats and time zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators.timestamps import format_mixture, normalise_timestamps, parse_values
from quernstone.session import materialize, table

_FIELDS = {
    "creation_date": "meta.creation_date",
    "latest_run": "latest_run",
    "doc_date": "doc_date",
    "first_seen": "first_seen",
}


def _fields():
    return {name: F.col(path) for name, path in _FIELDS.items()}


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that differ from their normal form and denote one date or moment."""
    out = normalise_timestamps(table(spark, sf_dir, "catalog_docs"), "id", _fields(), "source")
    return (
        out.where("status = 'ok' and utc_value <> raw")
        .select(F.col("rec_key").alias("id"), "field", "utc_value")
        .distinct()
    )


def p6_format_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source and field: the mixture of formats found by EM."""
    parsed = materialize(parse_values(table(spark, sf_dir, "catalog_docs"), "id", _fields(), "source"), "ts")
    return format_mixture(parsed).groupBy(F.col("src").alias("source"), "field", "format").agg(
        F.sum("n").alias("values"), F.round(F.max("share"), 6).alias("share")
    )


def queries() -> dict:
    return {"p6_found": p6_found, "p6_format_shares": p6_format_shares}


def oracle_sql() -> dict[str, str]:
    return {}
