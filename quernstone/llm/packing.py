"""Filling containers of fixed capacity with texts (problem 7).

Non-negative least squares on the histogram of lengths: shallow combinations
of lengths that fill a window below the capacity are enumerated, their repeat
counts are solved against the histogram and rounded down; what is left is
packed greedily, best fit first, length by length. Planning sees only the
histogram (at most ``capacity`` numbers); items find their slot by their rank
among the items of their length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.session import materialize


def combinations(hist: np.ndarray, capacity: int, window: int, most: int = 120_000, lengths: int = 500) -> np.ndarray:
    """Rows of one to three lengths (0 for none) that sum to ``capacity - window`` or more.

    All single lengths and pairs in the window; triples with two of the
    ``lengths`` most frequent lengths and the longest third that still fits.
    """
    present = np.flatnonzero(hist > 0)
    present = present[present > 0]
    if not len(present):
        return np.empty((0, 3), np.int64)
    rows = [np.stack([s := present[present >= capacity - window], np.zeros_like(s), np.zeros_like(s)], 1)]
    for w in range(window + 1):
        b = capacity - w - present
        ok = (b > 0) & (b <= present)
        ok[ok] = hist[b[ok]] > 0
        rows.append(np.stack([present[ok], b[ok], np.zeros(ok.sum(), np.int64)], 1))
    top = np.sort(present[np.argsort(-hist[present], kind="stable")][:lengths])
    i, j = np.triu_indices(len(top))
    a, b = top[j], top[i]
    rest = capacity - a - b
    at = np.searchsorted(present, np.minimum(rest, b), side="right") - 1
    c = np.where(at >= 0, present[np.maximum(at, 0)], 0)
    ok = (rest > 0) & (at >= 0) & (c >= rest - window)
    rows.append(np.stack([a[ok], b[ok], c[ok]], 1))
    out = np.unique(np.concatenate(rows), axis=0)
    if len(out) > most:
        fill = out.sum(1)
        out = out[np.lexsort((*out.T, -fill))[:most]]
    return out


def solve_counts(combos: np.ndarray, hist: np.ndarray, rounds: int = 300) -> np.ndarray:
    """``x >= 0`` that minimises ``|A x - hist|``: accelerated projected gradient."""
    n, dim = len(combos), len(hist)
    col = np.repeat(np.arange(n), 3)
    row = combos.ravel()
    keep = row > 0
    col, row = col[keep], row[keep]
    h = hist / max(hist.sum(), 1)
    forward = lambda x: np.bincount(row, x[col], dim)
    back = lambda r: np.bincount(col, r[row], n)
    v = np.ones(n)
    for _ in range(15):
        v = back(forward(v))
        v /= np.linalg.norm(v)
    step = 1.0 / max(float(np.linalg.norm(back(forward(v)))), 1e-12)
    x = np.zeros(n)
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(forward(y) - h), 0.0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x * hist.sum()


class Plan:
    """Groups of equally filled containers, and each length's way into them.

    ``lengths``, ``start`` (rank within the length), ``container`` (of the
    first item) and ``each`` (items of the length in one container) are
    parallel arrays, sorted by length and rank.
    """

    def __init__(self, groups: list[tuple[dict[int, int], int]]):
        rows, used, at = [], defaultdict(int), 0
        for pattern, count in groups:
            for length, each in sorted(pattern.items()):
                rows.append((length, used[length], at, each))
                used[length] += each * count
            at += count
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.lengths, self.start, self.container, self.each = table.T.copy()
        self.n_containers = at

    def place(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        big = int(max(self.start.max(initial=0), rank.max(initial=0))) + 1
        at = np.searchsorted(self.lengths * big + self.start, length * big + rank, side="right") - 1
        return self.container[at] + (rank - self.start[at]) // self.each[at]


def plan(hist: np.ndarray, capacity: int, window: int | None = None) -> Plan:
    """Plan for ``hist[length]`` items of each length up to ``capacity``."""
    hist = hist.astype(np.int64).copy()
    window = max(1, capacity // 256) if window is None else window
    groups: list[tuple[dict[int, int], int]] = []
    spaces: list[int] = []
    open_at: dict[int, list[tuple[dict[int, int], int]]] = {}

    def keep_open(space: int, pattern: dict[int, int], count: int) -> None:
        if space <= 0:
            groups.append((pattern, count))
            return
        if space not in open_at:
            insort(spaces, space)
            open_at[space] = []
        open_at[space].append((pattern, count))

    combos = combinations(hist, capacity, window)
    if len(combos):
        x = np.floor(solve_counts(combos, hist.astype(float)) + 1e-6).astype(np.int64)
        for k in np.argsort(-x, kind="stable"):
            if x[k] <= 0:
                break
            pattern: dict[int, int] = defaultdict(int)
            for length in combos[k]:
                if length:
                    pattern[int(length)] += 1
            n = min([int(x[k]), *(int(hist[length]) // m for length, m in pattern.items())])
            if n > 0:
                for length, m in pattern.items():
                    hist[length] -= n * m
                keep_open(capacity - sum(a * m for a, m in pattern.items()), dict(pattern), n)
    for length in range(capacity, 0, -1):
        left = int(hist[length])
        while left:
            i = bisect_left(spaces, length)
            if i == len(spaces):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    keep_open(capacity - each * length, {length: each}, full)
                if rest:
                    keep_open(capacity - rest * length, {length: rest}, 1)
                left = 0
                continue
            space = spaces[i]
            pattern, count = open_at[space].pop()
            if not open_at[space]:
                del open_at[space]
                spaces.pop(i)
            each = space // length
            n, more = divmod(left, each)
            take = min(count, n)
            if take:
                keep_open(space - each * length, {**pattern, length: pattern.get(length, 0) + each}, take)
                left -= take * each
            if count > take:
                if take == n and more:
                    keep_open(space - more * length, {**pattern, length: pattern.get(length, 0) + more}, 1)
                    left -= more
                    take += 1
                if count > take:
                    keep_open(space, pattern, count - take)
    for space in spaces:
        groups.extend(open_at[space])
    return Plan(groups)


def pack(sizes: DataFrame, specs: list[tuple[str, int]], key: str = "doc_id", size: str = "n_tokens", slices: int = 64) -> DataFrame:
    """``spec_name, container_id, key, piece_no, token_start, n_tokens``.

    ``specs`` are (name, capacity), a few. An item above the capacity is cut
    into pieces of exactly the capacity and one rest; no other item is split.
    Items of size 0 or null need no space and lie in container 0. Repeated
    keys are items of their own. Ranks within a length are counted per slice
    of the key's hash and added up, so a length that a third of all items
    share is ranked in ``slices`` groups.
    """
    specs = [(n, int(c)) for n, c in specs if c and c > 0]
    kinds = dict(sizes.dtypes)
    if not specs:
        return sizes.sparkSession.createDataFrame([], f"spec_name string, container_id bigint, {key} {kinds[key]}, piece_no int, token_start bigint, n_tokens int")
    caps = F.explode(F.array(*[F.struct(F.lit(i).alias("spec"), F.lit(c).alias("cap")) for i, (_, c) in enumerate(specs)]))
    n = F.coalesce(F.col(size), F.lit(0))
    items = (
        sizes.select(F.col(key).alias("k"), n.alias("n"))
        .select("k", "n", caps.alias("s"))
        .select("k", "n", "s.spec", "s.cap", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / F.col("s.cap")).cast("int") - 1, F.lit(0)))).alias("piece"))
        .select("k", "spec", "piece", (F.col("piece").cast("bigint") * F.col("cap")).alias("first"), F.least(F.col("n") - F.col("piece").cast("bigint") * F.col("cap"), F.col("cap")).cast("int").alias("len"))
        .withColumn("slice", F.pmod(F.xxhash64("k", "piece"), F.lit(slices)).cast("int"))
    )
    counts = items.groupBy("spec", "len", "slice").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "pack")
    hist_rows = counts.groupBy("spec", "len").agg(F.sum("n").alias("n")).toPandas()  # at most the sum of the capacities
    plans = []
    for i, (_, cap) in enumerate(specs):
        part = hist_rows[hist_rows["spec"] == i]
        hist = np.zeros(cap + 1, np.int64)
        hist[part["len"].to_numpy(int)] = part["n"].to_numpy()
        hist[0] = 0
        plans.append(plan(hist, cap))
    before = Window.partitionBy("spec", "len").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("spec", "len", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(Window.partitionBy("spec", "len", "slice").orderBy("k", "piece"))
    ranked = items.withColumn("rn", local).join(offsets, ["spec", "len", "slice"]).select("k", "spec", "piece", "first", "len", (F.col("offset") + F.col("rn") - 1).alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros(len(pdf), np.int64)
            for s, p in enumerate(plans):
                at = np.flatnonzero((pdf["spec"].to_numpy() == s) & (pdf["len"].to_numpy() > 0))
                if len(at):
                    out[at] = p.place(pdf["len"].to_numpy(np.int64)[at], pdf["rank"].to_numpy(np.int64)[at])
            yield pd.DataFrame({"spec": pdf["spec"], "container_id": out, "k": pdf["k"], "piece_no": pdf["piece"], "token_start": pdf["first"], "n_tokens": pdf["len"]})

    placed = ranked.mapInPandas(place, f"spec int, container_id bigint, k {kinds[key]}, piece_no int, token_start bigint, n_tokens int")
    names = F.element_at(F.array(*[F.lit(n) for n, _ in specs]), F.col("spec") + 1)
    return placed.select(names.alias("spec_name"), "container_id", F.col("k").alias(key), "piece_no", "token_start", "n_tokens")


def summary(packed: DataFrame, specs: list[tuple[str, int]]) -> DataFrame:
    """Per spec: containers, items, tokens and the share of unused space."""
    caps = F.create_map(*[F.lit(x) for n, c in specs for x in (n, int(c))])
    per = packed.groupBy("spec_name", "container_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("items"))
    total = per.groupBy("spec_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return total.withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * caps[F.col("spec_name")]), 6))
