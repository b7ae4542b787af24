"""Upserts, history and change detection for catalogue tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.text import nonblank


def run_history(runs: DataFrame, key: str = "id", run: str = "run_date", arrival: str = "received_at") -> DataFrame:
    """One row per record and run: a run delivered again replaces the one before.

    The row that arrived last stays; rows equal in everything are one.
    """
    others = [c for c in runs.columns if c not in (key, run, arrival)]
    got = runs.groupBy(key, run).agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(arrival, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in others])).alias("__last"), F.max(arrival).alias(arrival))
    return got.select(key, run, "__last.*", arrival)


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The last row of each key in ``order``."""
    w = Window.partitionBy(key).orderBy(*[c.desc() for c in order])
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def merge_records(catalog: DataFrame, report: DataFrame, archived: DataFrame | None = None, overrides: DataFrame | None = None, extras: tuple[str, ...] = ()) -> DataFrame:
    """Catalogue after a report: ``id`` and the fields of both, by rule.

    ``report`` has one row per record of one run: ``id, run_date, source, url,
    score, read_score, doc_type, doc_date, lang, downloaded, saved_as, title``.
    Scores of the run replace the initial and latest ones; the final score,
    type, bibliographic fields only if the new value says something; download
    marks and titles are set once and stay; archived records do not come back;
    overrides come last. Applying one report twice changes nothing.
    ``recit_de_lutte``, ``collected_date`` and the other bibliographic fields
    are merged where the catalogue has them; ``extras`` are fields that a new
    value replaces as a whole (structs too) and a missing one leaves.
    """
    new = report if archived is None else report.join(archived.select("id").distinct(), "id", "left_anti")
    fresh_cols = set(new.columns)
    n = new.select("id", *[F.col(c).alias(f"n_{c}") for c in new.columns if c != "id"])
    got = catalog.join(n, "id", "full_outer")
    hit = F.col("n_run_date").isNotNull()
    keep = lambda old, fresh: F.coalesce(nonblank(F.col(fresh)), F.col(old), F.lit(""))
    was = F.coalesce(F.col("downloaded"), F.lit(False))
    now = F.coalesce(F.col("n_downloaded"), F.lit(False))
    initial = F.coalesce(F.when(hit, F.col("n_score")), F.col("score_initial"), F.col("latest_score"))
    final = F.coalesce("n_read_score", "score_final")
    more = [(keep(c, f"n_{c}") if c in fresh_cols else F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("editeur", "doi", "isbn", "hal_id") if c in catalog.columns]
    if "recit_de_lutte" in catalog.columns:
        told = [F.col("n_recit_de_lutte")] if "recit_de_lutte" in fresh_cols else []
        more.append(F.coalesce(*told, F.col("recit_de_lutte"), F.lit(False)).alias("recit_de_lutte"))
    if "collected_date" in catalog.columns:
        more.append(F.coalesce("n_run_date", "collected_date").alias("collected_date"))
    more += [(F.coalesce(F.col(f"n_{c}"), F.col(c)) if c in fresh_cols else F.col(c)).alias(c) for c in extras]
    out = got.select(
        "id",
        F.coalesce("url", "n_url").alias("url"),
        F.coalesce("source", "n_source").alias("source"),
        F.coalesce("first_seen", "n_run_date").alias("first_seen"),
        F.coalesce("n_run_date", "latest_run").alias("latest_run"),
        initial.alias("score_initial"),
        F.coalesce(F.when(hit, F.col("n_score")), F.col("latest_score")).alias("latest_score"),
        final.alias("score_final"),
        F.coalesce("n_doc_type", "doc_type", F.lit("autre")).alias("doc_type"),
        keep("doc_date", "n_doc_date").alias("doc_date"),
        keep("lang", "n_lang").alias("lang"),
        (was | now).alias("downloaded"),
        F.when(~was & now, F.col("n_saved_as")).otherwise(F.col("saved_as")).alias("saved_as"),
        F.when(nonblank(F.col("title")).isNull() & now, F.coalesce(F.col("n_title"), F.col("title"))).otherwise(F.col("title")).alias("title"),
        *more,
    )
    return _overridden(out, overrides)


def _overridden(out: DataFrame, overrides: DataFrame | None) -> DataFrame:
    if overrides is not None:
        o = overrides.select("id", F.col("score").alias("o_score"))
        out = out.join(o, "id", "left").withColumn("score_final", F.coalesce("o_score", "score_final")).drop("o_score")
    return out


def move_to_archive(catalog: DataFrame, archive: DataFrame, cold: Column) -> tuple[DataFrame, DataFrame]:
    """``(catalogue, archive)`` after moving cold records; a second move moves nothing."""
    marked = catalog.withColumn("__cold", F.coalesce(cold, F.lit(False)))
    moved = marked.where("__cold").drop("__cold").join(archive.select("id"), "id", "left_anti")
    return marked.where("not __cold").drop("__cold"), archive.unionByName(moved, allowMissingColumns=True)


def fill_from_local(remote: DataFrame, local: DataFrame, fields: list[str]) -> DataFrame:
    """Remote records; blank ``fields`` are taken from the local copy, local-only records are dropped."""
    l = local.select("id", *[F.col(f).alias(f"l_{f}") for f in fields])  # noqa: E741
    kinds = dict(remote.dtypes)
    value = lambda c: nonblank(F.col(c)) if kinds[c.removeprefix("l_")] == "string" else F.col(c)
    out = remote.join(l, "id", "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(value(f), value(f"l_{f}"), F.col(f)))
    return out.drop(*[f"l_{f}" for f in fields])


def fingerprint(*fields: Column) -> Column:
    """Hash of the visible fields; nulls and texts stay apart."""
    return F.md5(F.to_json(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(fields)]), {"ignoreNullFields": "false"}))


def change_dates(current: DataFrame, before: DataFrame, today: str) -> DataFrame:
    """``id, hash, lastmod``: the former date where the hash is the same, else today."""
    b = before.select("id", F.col("hash").alias("old_hash"), F.col("lastmod").alias("old"))
    same = F.col("old_hash").eqNullSafe(F.col("hash"))
    return current.join(b, "id", "left").select("id", "hash", F.when(same & F.col("old").isNotNull(), F.col("old")).otherwise(F.lit(today)).alias("lastmod"))


def merge_candidates(existing: DataFrame, found: DataFrame) -> DataFrame:
    """``url, seen_count, first_seen, last_seen, found_from``: upsert by url.

    ``existing`` has these columns; ``found`` has ``url, doc_id, page, day``.
    Each sighting counts, but a place (document, page) is listed once.
    """
    f = found.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("lo"), F.max("day").alias("hi"), F.collect_set(F.struct("doc_id", "page")).alias("places"))
    got = existing.join(f, "url", "full_outer")
    none = F.expr("cast(array() as array<struct<doc_id: string, page: int>>)")
    return got.select(
        "url",
        (F.coalesce("seen_count", F.lit(0)) + F.coalesce("n", F.lit(0))).cast("int").alias("seen_count"),
        F.coalesce("first_seen", "lo").alias("first_seen"),
        F.greatest(F.coalesce("hi", "last_seen"), F.coalesce("last_seen", "hi")).alias("last_seen"),
        F.array_sort(F.array_union(F.coalesce("found_from", none), F.coalesce("places", none))).alias("found_from"),
    )
