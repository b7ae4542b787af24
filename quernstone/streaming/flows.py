"""Structured Streaming forms of the stateful operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators import catalog
from quernstone.operators.throttle import LOW_RUNS, LOW_YIELD, MAX_DAYS
from quernstone.sources.sinks import write_swapped


def windowed_counts(events: DataFrame, ts: str, key: str, value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and key; rows later than ``late`` are dropped by the watermark in a stream."""
    df = events.withWatermark(ts, late) if events.isStreaming else events
    got = df.groupBy(F.window(ts, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return got.select(F.col("w.start").alias("start"), key, "n", "total")


def first_arrivals(stream: DataFrame, digest: str, ts: str, horizon: str = "7 days") -> DataFrame:
    """Rows whose content was not seen within ``horizon``: exact duplicates go."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([digest])


def fetch_state(stream: DataFrame, base_days: int = 7) -> DataFrame:
    """``label, failures, low_runs, interval_days`` after each batch of fetches.

    ``stream`` has ``label, at, ok, found``. State per source is three
    integers. Rows of a batch are folded in order of ``at``; order between
    batches is that of arrival.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        failures, low, days = state.get if state.exists else (0, 0, base_days)
        rows = pd.concat(list(batches), ignore_index=True).sort_values("at", kind="stable")
        for ok, found in zip(rows["ok"], rows["found"], strict=True):
            failures, low, days = step(failures, low, days, bool(ok), 0 if pd.isna(found) else int(found), base_days)
        state.update((failures, low, days))
        yield pd.DataFrame({"label": [key[0]], "failures": [failures], "low_runs": [low], "interval_days": [days]})

    kind = "failures int, low_runs int, interval_days int"
    return stream.groupBy("label").applyInPandasWithState(update, f"label string, {kind}", kind, "update", "NoTimeout")


def step(failures: int, low: int, days: int, ok: bool, found: int, base: int) -> tuple[int, int, int]:
    """State of a source after one fetch."""
    if not ok:
        return failures + 1, low, days
    if found >= LOW_YIELD:
        return 0, 0, base
    low += 1
    return 0, low, min(max(days, 1) * 2, MAX_DAYS) if low >= LOW_RUNS else days


def upsert_catalogue(reports: DataFrame, path: str, checkpoint: str):
    """Merge each batch of report rows into the catalogue table at ``path``.

    A batch is merged as a whole and swapped in; a batch that is delivered
    again changes nothing, since merging twice equals merging once.
    """
    spark = reports.sparkSession

    def merge(batch: DataFrame, _: int) -> None:
        last = catalog.latest_per_key(batch, "id", [F.col("run_date")])
        write_swapped(catalog.merge_records(spark.read.parquet(path), last), path)

    return reports.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
