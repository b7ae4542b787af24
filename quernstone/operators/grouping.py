"""Grouped processing without one Python call per group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def map_key_runs(
    df: DataFrame,
    key: str,
    fn: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame | None],
    schema: str,
    partitions: int | None = None,
) -> DataFrame:
    """Call ``fn`` on batches that hold only whole groups of ``key``.

    Rows are hash-partitioned and sorted by ``key``; ``fn`` gets a frame of
    complete groups and the offsets where each begins (with the end added), so
    that thousands of small groups cost one call. A group that spans several
    Arrow batches is carried over; callers keep groups bounded by splitting
    hot keys before (see ``split_hot``).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf[key].to_numpy()
            last = int(np.flatnonzero(k == k[-1])[0])
            if last == 0 and held and held[-1][key].iloc[-1] == k[-1]:
                held.append(pdf)
                continue
            head = pd.concat([*held, pdf.iloc[:last]], ignore_index=True) if held or last else None
            if head is not None and len(head):
                out = fn(head, _bounds(head[key].to_numpy()))
                if out is not None and len(out):
                    yield out
            held = [pdf.iloc[last:]]
        if held:
            rest = pd.concat(held, ignore_index=True)
            out = fn(rest, _bounds(rest[key].to_numpy()))
            if out is not None and len(out):
                yield out

    parted = df.repartition(partitions, key) if partitions else df.repartition(key)
    return parted.sortWithinPartitions(key).mapInPandas(run, schema)


def _bounds(k: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])


def split_hot(df: DataFrame, key: str, ident: str, limit: int) -> DataFrame:
    """Spread keys with more than ``limit`` rows over tiles of bounded size.

    Adds ``tile`` and ``side``. A key with ``n`` rows is cut into
    ``s = ceil(n / limit)`` slots by a hash of ``ident``; a row goes to the
    tiles of its slot with every slot, so that each pair of rows of the key
    meets in exactly one tile: pairs within one slot where ``side`` is 0 for
    all, pairs across two slots where ``side`` differs.
    """
    from pyspark.sql import functions as F

    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    s = F.coalesce(F.ceil(F.col("__n") / F.lit(limit)), F.lit(1)).cast("int")
    out = df.join(hot, key, "left").withColumn("__s", s).withColumn("__r", F.pmod(F.xxhash64(F.lit(17), ident), F.col("__s")).cast("int"))
    out = out.withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("__s") - 1)))
    lo, hi = F.least("__r", "__j"), F.greatest("__r", "__j")
    tile = F.when(F.col("__s") == 1, F.col(key)).otherwise(F.xxhash64(key, lo, hi))
    return out.withColumn("tile", tile).withColumn("side", F.when((lo < hi) & (F.col("__r") == hi), 1).otherwise(0)).drop("__n", "__s", "__r", "__j")


def run_pairs(bounds: np.ndarray, side: np.ndarray, most: int = 60_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``i < j`` inside the runs, a block at a time; only across the sides where a run has two.

    ``side`` rises inside each run.
    """
    sizes = np.diff(bounds)
    crossed = np.maximum.reduceat(side, bounds[:-1]) > 0
    for s in np.unique(sizes[(sizes > 1) & (sizes <= 48)]):
        i, j = np.triu_indices(int(s), 1)
        starts, cross = bounds[:-1][sizes == s], crossed[sizes == s]
        step = max(1, most // len(i))
        for c in range(0, len(starts), step):
            x, y = (starts[c : c + step, None] + i).ravel(), (starts[c : c + step, None] + j).ravel()
            ok = ~np.repeat(cross[c : c + step], len(i)) | (side[x] != side[y])
            yield x[ok], y[ok]
    for g in np.flatnonzero(sizes > 48):
        lo, hi = int(bounds[g]), int(bounds[g + 1])
        first = lo + int(np.searchsorted(side[lo:hi], 1)) if crossed[g] else lo
        wide = max(1, most // int(sizes[g]))
        for a in range(lo, first if crossed[g] else hi, wide):
            x = np.arange(a, min(a + wide, first if crossed[g] else hi))
            y = np.arange(first if crossed[g] else a, hi)
            x, y = np.repeat(x, len(y)), np.tile(y, len(x))
            yield x[y > x], y[y > x]
