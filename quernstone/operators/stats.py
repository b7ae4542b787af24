"""Aggregates over the catalogue, its runs and its sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_dimensions(df: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """``dimension, value, n``: counts by each dimension in one pass (grouping sets)."""
    wide = df.select(*[c.cast("string").alias(f"d{i}") for i, c in enumerate(dims.values())])
    cols = [F.col(f"d{i}") for i in range(len(dims))]
    got = wide.groupingSets([[c] for c in cols], *cols).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    full = (1 << len(dims)) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dims):
        mask = full ^ (1 << (len(dims) - 1 - i))
        name = F.when(F.col("g") == mask, d).otherwise(name)
        value = F.when(F.col("g") == mask, F.col(f"d{i}")).otherwise(value)
    return got.select(name.alias("dimension"), value.alias("value"), "n")


def dense_histogram(df: DataFrame, measures: dict[str, Column], low: int = 0, high: int = 10) -> DataFrame:
    """``measure, score, n`` for every score of the range, empty ones too; nulls do not count."""
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("int").alias("score")) for n, c in measures.items()])
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").where("score is not null").groupBy("measure", "score").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("score")).withColumn("measure", F.explode(F.array(*[F.lit(n) for n in measures])))
    return frame.join(counts, ["measure", "score"], "left").select("measure", "score", F.coalesce("n", F.lit(0)).alias("n"))


def share(condition: Column, digits: int = 1) -> Column:
    """Percentage of rows that meet a condition, rounded half to even."""
    return F.bround(100 * F.avg(F.coalesce(condition, F.lit(False)).cast("double")), digits)


def source_runs(runs: DataFrame) -> DataFrame:
    """Per source: rows seen, downloads, mean and best score."""
    return runs.groupBy("source").agg(
        F.count(F.lit(1)).alias("found"),
        F.sum(F.coalesce(F.col("downloaded"), F.lit(False)).cast("long")).alias("downloaded"),
        F.bround(F.avg("score"), 1).alias("mean_score"),
        F.max("score").alias("max_score"),
    )


def fertility(runs: DataFrame) -> DataFrame:
    """Per source: distinct runs, rows seen, downloads and downloads per run."""
    got = runs.groupBy("source").agg(
        F.countDistinct("run_date").alias("runs"),
        F.count(F.lit(1)).alias("seen"),
        F.sum(F.coalesce(F.col("downloaded"), F.lit(False)).cast("long")).alias("downloads"),
    )
    return got.withColumn("per_run", F.bround(F.col("downloads") / F.greatest("runs", F.lit(1)), 2))


def with_defaults(left: DataFrame, counts: DataFrame, on: str, zero: list[str]) -> DataFrame:
    """Left join of counts to a dimension; missing counts are 0."""
    return left.join(counts, on, "left").fillna(0, zero)


def bars(df: DataFrame, label: str, n: str) -> DataFrame:
    """Shares of the total, empty rows dropped."""
    total = df.agg(F.sum(n)).scalar()
    return df.where(F.col(n) > 0).select(label, n, F.bround(100 * F.col(n) / total, 1).alias("percent"))
