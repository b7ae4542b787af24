"""Mixing sources to target weights (problem 8).

Min-cost flow for overlapping sources. Equal texts are one document that all
their sources own; documents are counted by membership pattern (the sources of
a mix that own them). Token capacity flows from patterns to source quotas,
using a document again costs the more the oftener; documents are then selected
in a seeded order so that each flow is met to within a document, and what is
missing is filled up with documents that still fit.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.session import materialize


class Network:
    """Min-cost flow by successive shortest paths with potentials (small graphs)."""

    def __init__(self) -> None:
        self.arcs: list[list[int]] = []  # head, capacity, cost
        self.out: dict[object, list[int]] = defaultdict(list)

    def arc(self, a: object, b: object, capacity: int, cost: int = 0) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def flow(self, k: int) -> int:
        return self.arcs[k + 1][1]

    def run(self, s: object, t: object) -> int:
        pot: dict[object, int] = defaultdict(int)
        total = 0
        while True:
            dist: dict[object, int] = {s: 0}
            via: dict[object, int] = {}
            heap = [(0, 0, s)]
            n = 0
            done = set()
            while heap:
                d, _, u = heapq.heappop(heap)
                if u in done:
                    continue
                done.add(u)
                for k in self.out[u]:
                    v, cap, cost = self.arcs[k]
                    if cap > 0 and (nd := d + cost + pot[u] - pot[v]) < dist.get(v, 1 << 62):
                        dist[v] = nd
                        via[v] = k
                        n += 1
                        heapq.heappush(heap, (nd, n, v))
            if t not in dist:
                return total
            for u, d in dist.items():
                pot[u] += d
            push, u = 1 << 62, t
            while u != s:
                push = min(push, self.arcs[via[u]][1])
                u = self.arcs[via[u] ^ 1][0]
            u = t
            while u != s:
                self.arcs[via[u]][1] -= push
                self.arcs[via[u] ^ 1][1] += push
                u = self.arcs[via[u] ^ 1][0]
            total += push


def route(tokens: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: int | None = None) -> tuple[int, dict[tuple[tuple[str, ...], str], int]]:
    """``(total, flow per (pattern, source))`` for one mix.

    ``tokens`` holds the tokens of each pattern. Sources that own no token
    cannot reach any share; the others keep their proportions. Without
    ``total`` the largest one is taken at which every quota can be met within
    the repeat caps.
    """
    tokens = {p: int(n) for p, n in tokens.items() if n > 0}
    own = {s for p in tokens for s in p}
    live = {s: w for s, w in shares.items() if s in own and w > 0 and repeats.get(s, 1) > 0}
    norm = sum(live.values())
    if not norm:
        return 0, {}
    live = {s: w / norm for s, w in live.items()}

    def solve(size: int) -> tuple[bool, dict]:
        net = Network()
        want = {s: int(size * w) for s, w in live.items()}
        arcs = {}
        for p, n in tokens.items():
            most = max((repeats.get(s, 1) for s in p if s in live), default=0)
            for r in range(most):
                net.arc("source", ("p", p), n, r * r)
            for s in p:
                if s in live:
                    arcs[p, s] = net.arc(("p", p), ("s", s), n * repeats.get(s, 1))
        for s, q in want.items():
            net.arc(("s", s), "sink", q)
        met = net.run("source", "sink")
        return met >= sum(want.values()), {k: net.flow(a) for k, a in arcs.items() if net.flow(a)}

    hi = min(int(sum(n * repeats.get(s, 1) for p, n in tokens.items() if s in p) / w) for s, w in live.items())
    hi = min(hi, sum(n * max(repeats.get(s, 1) for s in p if s in live) for p, n in tokens.items() if any(s in live for s in p)))
    if total is not None:
        hi = min(hi, int(total))
    ok, flows = solve(hi)
    if ok:
        return hi, flows
    lo = 0
    best: tuple[int, dict] = (0, {})
    while hi - lo > max(1, hi // 100_000):
        mid = (lo + hi) // 2
        ok, flows = solve(mid)
        if ok:
            lo, best = mid, (mid, flows)
        else:
            hi = mid
    return best


def mix_sources(
    docs: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: str = "n_tokens",
    digest: str = "digest",
    seed: int = 0,
    buckets: int = 1024,
    fill_ins: int = 400,
) -> tuple[DataFrame, DataFrame]:
    """``(selection, report)`` for every mix in ``targets``.

    ``selection``: ``mix_name, source, key, n_tokens, uses``; ``key`` is the
    smallest key of the documents with that text. ``report``: ``mix_name,
    source, target_share, max_repeats, quota_tokens, tokens, share, documents,
    max_uses``. Texts without tokens and documents without source take no
    part. ``targets`` is small (one row per mix and source); patterns of
    membership are the only thing that reaches the driver, as sums.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    goal = targets.select("mix_name", "source", "target_share", "max_repeats").where("mix_name is not null and source is not null").dropDuplicates(["mix_name", "source"]).orderBy("mix_name", "source").collect()
    mixes: dict[str, list] = defaultdict(list)
    for r in goal:
        mixes[r["mix_name"]].append(r)
    named = sorted({r["source"] for r in goal})
    owned = docs.where(F.col(source).isin(named) & (F.col(size) > 0)) if named else docs.limit(0)
    # The members of each text, aggregated map-side; a set holds at most the sources of the targets.
    texts = owned.groupBy(digest).agg(F.min(key).alias("k"), F.max(size).alias("n"), F.array_sort(F.collect_set(source)).alias("owners"))
    texts = materialize(texts.select("k", "n", "owners", F.xxhash64(F.lit(seed), digest).alias("h")), "mix")
    combos = texts.groupBy("owners").agg(F.sum("n").alias("n")).collect()
    plans = []
    reports = []
    for m, rows in mixes.items():
        members = {r["source"] for r in rows}
        tokens: dict[tuple[str, ...], int] = defaultdict(int)
        for c in combos:
            p = tuple(s for s in c["owners"] if s in members)
            if p:
                tokens[p] += int(c["n"])
        shares = {r["source"]: float(r["target_share"] or 0) for r in rows}
        repeats = {r["source"]: int(r["max_repeats"] or 0) for r in rows}
        total, flows = route(tokens, shares, repeats)
        at: dict[tuple[str, ...], int] = defaultdict(int)
        quota: dict[str, int] = defaultdict(int)
        for (p, s), f in sorted(flows.items()):
            plans.append((m, list(p), s, tokens[p], at[p], at[p] + f, f, repeats[s]))
            at[p] += f
            quota[s] += f
        for r in rows:
            reports.append((m, r["source"], shares[r["source"]], repeats[r["source"]], quota[r["source"]]))
    plan = spark.createDataFrame(plans, "mix_name string, pattern array<string>, source string, pool bigint, lo bigint, hi bigint, flow bigint, cap int")
    # mixes are few: every text is listed under those that name one of its owners
    lists = F.array(*[F.struct(F.lit(m).alias("mix_name"), F.array(*[F.lit(r["source"]) for r in rows]).alias("members")) for m, rows in mixes.items()])
    in_mix = texts.select("*", F.explode(lists if mixes else F.expr("cast(array() as array<struct<mix_name: string, members: array<string>>>)")).alias("m")).select("*", "m.*").withColumn("pattern", F.array_intersect("owners", "members")).where("size(pattern) > 0").select("mix_name", "pattern", "k", "n", "h")
    in_mix = in_mix.withColumn("b", F.pmod("h", F.lit(buckets)).cast("int"))
    sums = in_mix.groupBy("mix_name", "pattern", "b").agg(F.sum("n").alias("t"))
    before = Window.partitionBy("mix_name", "pattern").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("mix_name", "pattern", "b", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    local = Window.partitionBy("mix_name", "pattern", "b").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = in_mix.withColumn("inner", F.coalesce(F.sum("n").over(local), F.lit(0))).join(base, ["mix_name", "pattern", "b"]).withColumn("p", F.col("base") + F.col("inner"))
    on = placed.join(plan, ["mix_name", "pattern"])
    uses = F.greatest(F.floor((F.col("hi") - F.col("p") - F.col("n")) / F.col("pool")) - F.ceil((F.col("lo") - F.col("p")) / F.col("pool")) + 1, F.lit(0)).cast("int")
    chosen = materialize(on.withColumn("uses", uses).select("mix_name", "pattern", "source", "k", "n", "h", "uses", "cap", "flow"), "mix")
    got = chosen.groupBy("mix_name", "source").agg(F.sum(F.col("n") * F.col("uses")).alias("t")).collect()
    quotas = {(m, s): q for m, s, _, _, q in reports}
    short = {(r["mix_name"], r["source"]): quotas[r["mix_name"], r["source"]] - int(r["t"]) for r in got}
    gaps = spark.createDataFrame([(m, s, g) for (m, s), g in short.items() if g > 0] or [], "mix_name string, source string, gap bigint")
    # A document's uses over all its sources stay within the cap of each.
    spent = chosen.groupBy("mix_name", "k").agg(F.sum("uses").alias("spent"))
    free = chosen.join(F.broadcast(gaps), ["mix_name", "source"]).join(spent, ["mix_name", "k"]).where("n < 2 * gap and spent < cap")
    rank = F.row_number().over(Window.partitionBy("mix_name", "source", "size_class").orderBy("h", "k"))
    offers = free.withColumn("size_class", F.floor(F.log2(F.col("n").cast("double")))).withColumn("rn", rank).where(F.col("rn") <= fill_ins // 10)
    extra = []
    left = dict(short)
    taken: dict[tuple[str, object], int] = defaultdict(int)
    listed = sorted(offers.collect(), key=lambda r: (r["mix_name"], r["source"], -r["n"], r["h"]))  # at most fill_ins / 10 per size class and flow
    for r in listed:
        at = (r["mix_name"], r["source"])
        if r["n"] <= left[at] and r["spent"] + taken[r["mix_name"], r["k"]] < r["cap"]:
            left[at] -= r["n"]
            taken[r["mix_name"], r["k"]] += 1
            extra.append((r["mix_name"], r["source"], r["k"], r["n"], 1))
    for r in reversed(listed):  # one use beyond the quota where that comes closer to it
        at = (r["mix_name"], r["source"])
        if left[at] < r["n"] < 2 * left[at] and r["spent"] + taken[r["mix_name"], r["k"]] < r["cap"]:
            left[at] -= r["n"]
            taken[r["mix_name"], r["k"]] += 1
            extra.append((r["mix_name"], r["source"], r["k"], r["n"], 1))
    more = spark.createDataFrame(extra, f"mix_name string, source string, k {kind}, n int, uses int")
    selection = (
        chosen.where("uses > 0").select("mix_name", "source", "k", F.col("n").cast("int").alias("n"), "uses").unionByName(more)
        .groupBy("mix_name", "source", "k").agg(F.max("n").alias("n_tokens"), F.sum("uses").cast("int").alias("uses"))
        .withColumnRenamed("k", key)
    )
    asked = spark.createDataFrame(reports, "mix_name string, source string, target_share double, max_repeats int, quota_tokens bigint")
    per = selection.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens").cast("bigint") * F.col("uses")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("uses").alias("max_uses"))
    whole = Window.partitionBy("mix_name")
    report = asked.join(per, ["mix_name", "source"], "left").fillna(0, ["tokens", "documents", "max_uses"]).withColumn("all", F.sum("tokens").over(whole))
    report = report.withColumn("share", F.when(F.col("all") > 0, F.round(F.col("tokens") / F.col("all"), 6)).otherwise(0.0)).drop("all")
    return selection, report
