"""Exact duplicates, exact Jaccard near-duplicates, canonical records."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.grouping import map_key_runs, run_pairs, split_hot
from quernstone.session import materialize, release


def clusters(df: DataFrame, key: str, digest: Column) -> DataFrame:
    """``digest, n, canonical``: groups of two or more equal records.

    Members are not gathered; ``exact_duplicates`` has them one per row.
    """
    return df.groupBy(digest.alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("canonical")).where("n > 1 and digest is not null")


def exact_duplicates(df: DataFrame, key: str, digest: Column) -> DataFrame:
    """``key, canonical, rank, n``: every member of a group; the first to arrive is canonical.

    Members are sorted over ranges of (digest, key) and ranked inside each
    range; ranges before it are added up, so a content that a third of all
    records share is ranked in as many tasks as it fills.
    """
    got = df.select(F.col(key), digest.alias("digest")).where("digest is not null")
    groups = clusters(got, key, F.col("digest")).select("digest", "n", "canonical")
    ranged = got.join(groups, "digest").repartitionByRange("digest", key).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "dup")
    before = Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("digest", "part").agg(F.count(F.lit(1)).alias("c")).withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0))).select("digest", "part", "offset")
    local = F.row_number().over(Window.partitionBy("digest", "part").orderBy(key))
    return ranged.withColumn("local", local).join(offsets, ["digest", "part"]).select(key, "canonical", (F.col("offset") + F.col("local")).cast("int").alias("rank"), "n")


def duplicate_report(df: DataFrame, digest: Column, size: Column) -> DataFrame:
    """Totals: records, distinct contents, duplicates, groups, bytes that could be saved."""
    per = df.groupBy(digest.alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("size"))
    return per.agg(
        F.sum("n").alias("records"),
        F.count(F.lit(1)).alias("contents"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        F.count_if(F.col("n") > 1).alias("groups"),
        F.sum((F.col("n") - 1) * F.col("size")).cast("bigint").alias("bytes_saved"),
    )


def _word_hashes(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mixed 64-bit hashes of all words of a batch, and how many each list has."""
    n = np.array([len(x) for x in lists], np.int64)
    codes, words = pd.factorize(np.concatenate(lists))
    return pd.util.hash_array(np.asarray(words, dtype=object), categorize=False)[codes], n


def _mixed(h: np.ndarray) -> np.ndarray:
    """Scrambled again (splitmix64), so that sums tell sets apart."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _set_digest(words: np.ndarray) -> bytes:
    return hashlib.blake2b("\0".join(sorted(words)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _part_keys(lists: list[np.ndarray], threshold: float) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of each set, of which two sets at ``threshold`` share one, and its parity bitmap.

    In a band of sizes two such sets differ in no more than ``d`` words. The
    vocabulary is cut into ``d + 1`` parts by hash; at least one part holds the
    same words of both, and a key tells what a set holds of a part. A set is
    cut as its own band and as the one below ask, since a partner may be that
    much smaller. Bands without any difference have no keys: their sets are equal.
    """
    h, n = _word_hashes(lists)
    row = np.repeat(np.arange(len(n)), n)
    own = np.floor(np.log(n) / np.log(1 / threshold) + 1e-9).astype(np.int64)
    sums, place = _mixed(h), _mixed(h ^ np.uint64(0x5851F42D4C957F2D))
    sig = np.zeros(len(n), np.uint64)
    np.bitwise_xor.at(sig, row, np.uint64(1) << (h >> np.uint64(58)))
    keys: list[list[np.ndarray]] = [[] for _ in n]
    for down in (0, 1):
        band = own - down
        widest = np.floor((1 / threshold) ** (band + 1.0) * (1 + 1e-9))
        parts = np.where(band >= 0, np.floor(widest * (1 - threshold) / threshold + 1e-9), 0).astype(np.int64) + 1
        start = np.concatenate([[0], np.cumsum(parts)])
        at = start[:-1][row] + (place % parts[row].astype(np.uint64)).astype(np.int64)
        held = np.zeros(start[-1], np.uint64)
        np.add.at(held, at, sums)
        number = np.arange(start[-1]) - np.repeat(start[:-1], parts)
        held = _mixed(held ^ _mixed((np.repeat(band, parts) * 1_000_003 + number + 1).astype(np.uint64)))
        for i in np.flatnonzero(parts > 1):
            keys[i].append(held[start[i] : start[i + 1]])
    return [np.concatenate(k).view(np.int64) if k else np.empty(0, np.int64) for k in keys], sig.view(np.int64)


def jaccard_pairs(df: DataFrame, key: str, tokens: str, threshold: float, limit: int = 2000) -> DataFrame:
    """``a, b, similarity`` of all pairs of different token sets at ``threshold`` or above.

    Exact filtering by parts (see ``_part_keys``): only sets that hold the same
    words of one part meet; bitmaps of 64 bits bound what they differ in, and
    only the words of pairs that pass are looked up and intersected, in blocks
    (see ``_verified``). What is shuffled is a few numbers a record, not its words. Keys of more than
    ``limit`` records are cut into tiles. Records with equal sets are one
    representative (the smallest key) and are not paired with each other;
    ``jaccard_members`` tells who they are.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    least = threshold - 1e-9
    words = df.select(F.col(key).alias("k"), F.col(tokens).alias("ts")).where((F.size(tokens) > 0) & F.col(key).isNotNull())

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                lists = list(pdf["ts"])
                keys, sig = _part_keys(lists, least)
                yield pd.DataFrame({"k": pdf["k"], "dg": [_set_digest(x) for x in lists], "n": [len(x) for x in lists], "sig": sig, "keys": keys})

    described = words.mapInPandas(describe, f"k {kind}, dg binary, n int, sig bigint, keys array<bigint>")
    reps = described.groupBy("dg").agg(F.min("k").alias("k"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
    reps = materialize(reps.where(F.size("keys") > 0).drop("dg"), "jac")
    rows = reps.select("k", "n", "sig", F.explode("keys").alias("key"))
    # rows per bucket of keys: an array of fixed size tells where keys may be crowded
    bucket = F.pmod("key", F.lit(1 << 16))
    counts = rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c")).toPandas()
    usual = float(counts["c"].median()) if len(counts) else 0.0
    crowded = [int(b) for b in counts["b"][counts["c"] > limit + 2 * usual]]
    tiles = rows.withColumn("tile", F.col("key")).withColumn("side", F.lit(0))
    if crowded:
        hot = spark.createDataFrame([(b,) for b in crowded], "b bigint")
        tiles = tiles.withColumn("b", bucket).join(F.broadcast(hot), "b", "left_anti").drop("b")
        tiles = tiles.unionByName(split_hot(rows.withColumn("b", bucket).join(F.broadcast(hot), "b", "left_semi").drop("b"), "key", "k", limit))

    def match(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame | None:
        sizes = np.diff(bounds)
        pdf = pdf[np.repeat(sizes > 1, sizes)]
        if not len(pdf):
            return None
        pdf = pdf.sort_values(["tile", "side"], kind="stable")
        tile = pdf["tile"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(tile[1:] != tile[:-1]) + 1, [len(tile)]])
        n, sig, k = pdf["n"].to_numpy(np.int64), pdf["sig"].to_numpy(np.int64).view(np.uint64), pdf["k"].to_numpy()
        found = []
        for i, j in run_pairs(bounds, pdf["side"].to_numpy(np.int8)):
            ok = np.bitwise_count(sig[i] ^ sig[j]) <= (1 - least) / (1 + least) * (n[i] + n[j]) + 1e-9
            ok &= np.minimum(n[i], n[j]) >= least * np.maximum(n[i], n[j]) - 1e-9
            if ok.any():
                found.append(pd.DataFrame({"x": k[i[ok]], "y": k[j[ok]]}))
        return pd.concat(found).drop_duplicates() if found else None

    pairs = map_key_runs(tiles.select("tile", "side", "k", "n", "sig"), "tile", match, f"x {kind}, y {kind}")
    cand = materialize(pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "jac")
    release(reps)
    need = cand.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    sets = materialize(_among(words, need, "k").join(need, "k", "left_semi"), "jac")
    return _verified(cand, sets, least, kind)


def _verified(cand: DataFrame, sets: DataFrame, least: float, kind: str, words: int = 100_000, pairs: int = 250_000) -> DataFrame:
    """``a, b, similarity`` of the pairs ``cand`` whose ``sets`` (``k, ts``) are at ``least`` or above.

    Long texts of one small vocabulary are all near each other, and words that
    travelled with each pair would grow with the square of the records. So
    records are cut into buckets by hash, pairs into blocks of two buckets; a
    set goes once to each block in which it has a pair. Buckets hold about
    ``words`` words, blocks no more than some ``pairs`` pairs.
    """
    held = sets.agg(F.sum(F.size("ts"))).first()[0] or 0
    cut = max(1, math.ceil(held / words), math.ceil(math.sqrt(cand.count() / pairs)))
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(cut))
    asked = cand.select((F.least(bucket("a"), bucket("b")) * cut + F.greatest(bucket("a"), bucket("b"))).alias("block"), "a", "b")
    ends = asked.select("block", F.explode(F.array("a", "b")).alias("k")).distinct()
    given = ends.join(sets, "k").select("block", F.col("k").alias("a"), F.col("k").alias("b"), "ts")
    rows = given.unionByName(asked.withColumn("ts", F.lit(None).cast("array<string>")))

    def meet(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        own = pdf["ts"].notna().to_numpy()
        recs, ask = pdf.loc[own, ["block", "a", "ts"]], pdf.loc[~own, ["block", "a", "b"]]
        lists = list(recs["ts"])
        n = np.array([len(x) for x in lists], np.int64)
        start = np.concatenate([[0], np.cumsum(n)])
        codes, known = pd.factorize(np.concatenate(lists))
        at = recs[["block", "a"]].assign(at=np.arange(len(recs)))
        i, j = (ask[["block", c]].merge(at, left_on=["block", c], right_on=["block", "a"], how="left")["at"].to_numpy(np.int64) for c in ("a", "b"))
        order = np.argsort(i, kind="stable")
        i, j, common = i[order], j[order], np.empty(len(i), np.int64)
        mark = np.zeros(len(known), np.int64)
        for lo, hi in itertools.pairwise(np.concatenate([[0], np.flatnonzero(i[1:] != i[:-1]) + 1, [len(i)]])):
            mine, others = codes[start[i[lo]] : start[i[lo] + 1]], j[lo:hi]
            first = np.concatenate([[0], np.cumsum(n[others])])
            each = np.repeat(start[others] - first[:-1], n[others]) + np.arange(first[-1])
            mark[mine] = 1
            common[lo:hi] = np.add.reduceat(mark[codes[each]], first[:-1])
            mark[mine] = 0
        similarity = common / (n[i] + n[j] - common)
        found = similarity >= least
        return pd.DataFrame({"a": ask["a"].to_numpy()[order][found], "b": ask["b"].to_numpy()[order][found], "similarity": similarity[found]})

    return map_key_runs(rows, "block", meet, f"a {kind}, b {kind}, similarity double")


def _among(df: DataFrame, need: DataFrame, key: str, bits: int = 23) -> DataFrame:
    """Rows whose key may be in ``need``, by a bitmap of fixed size, so that others are not shuffled."""
    bit = lambda: F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    got = need.select((bit() + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("g")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()
    kept = np.zeros((1 << bits) // 8, np.uint8)
    for r in got:  # positions and buckets count from 1
        kept[(r["g"] - 1) * 4096 : r["g"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)

    @F.pandas_udf("boolean")
    def seen(p: pd.Series) -> pd.Series:
        at = p.to_numpy()
        return pd.Series((kept[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    return df.where(seen(bit()))


def jaccard_members(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """``key, rep``: the representative of each record's token set."""
    sets = df.select(F.col(key).alias("k"), F.col(tokens).alias("ts")).where(F.size(tokens) > 0)
    reps = sets.groupBy("ts").agg(F.min("k").alias("rep"))
    return sets.join(reps, "ts").select(F.col("k").alias(key), "rep")


def nearest_earlier(pairs: DataFrame) -> DataFrame:
    """For each ``b`` the earlier ``a`` of the highest similarity, the first on ties."""
    w = Window.partitionBy("b").orderBy(F.desc("similarity"), "a")
    return pairs.withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("b").alias("record"), F.col("a").alias("duplicate_of"), "similarity")


def _short_size(least: float, most: int = 128) -> int:
    """Sets up to this size have no more than ``most`` subsets that a partner may share."""
    for size in itertools.count(1):
        if sum(math.comb(size, out) for out in range(size - math.ceil(least * size - 1e-9) + 1)) > most or size == 200:
            return size - 1


def _subset_keys(lists: list[np.ndarray], least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``row, size, key``: every subset of a set that a partner may share, for sets of one size at a time.

    A partner has at least ``least`` of the larger set's words, so only the
    subsets with few words left out count.
    """
    h, n = _word_hashes(lists)
    h, start = _mixed(h), np.concatenate([[0], np.cumsum(n)])
    for size in np.unique(n):
        rows = np.flatnonzero(n == size)
        words = h[start[:-1][rows, None] + np.arange(size)]
        total = words.sum(axis=1, dtype=np.uint64)
        for out in range(int(size) - math.ceil(least * size - 1e-9) + 1):
            for gone in itertools.combinations(range(int(size)), out):
                kept = total - words[:, gone].sum(axis=1, dtype=np.uint64)
                yield rows, np.full(len(rows), size - out), _mixed(kept ^ np.uint64(size - out)).view(np.int64)


def best_title_match(left: DataFrame, right: DataFrame, key: str, ref: str, tokens: str, least: float) -> DataFrame:
    """``key, ref, ratio``: for each left record the right one with the most similar words.

    The ratio is common words over the larger set; ties go to the smallest
    ``ref``. Equal sets are one row on either side. Short sets meet by their
    subsets: for each subset that a right set may share, only the smallest
    ``ref`` of each size is kept, so that titles which differ in a word make no
    pairs among each other; the common words of the best pair are one of the
    subsets. Longer sets must share one of the left record's rarest words (prefix
    filter).
    """
    kinds = {"k": left.schema[key].dataType.simpleString(), "r": right.schema[ref].dataType.simpleString()}

    def digests(df: DataFrame, ident: str, name: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame({name: pdf[name], "dg": [_set_digest(x) for x in pdf["w"]], "w": pdf["w"]})

        rows = df.select(F.col(ident).alias(name), F.array_distinct(tokens).alias("w")).where((F.size(tokens) > 0) & F.col(ident).isNotNull())
        return rows.mapInPandas(run, f"{name} {kinds[name]}, dg binary, w array<string>")

    every = materialize(digests(left, key, "k"), "fuzzy")
    a = every.groupBy("dg").agg(F.first("w").alias("w")).withColumn("k", F.xxhash64("dg"))
    b = materialize(digests(right, ref, "r").groupBy("dg").agg(F.min("r").alias("r"), F.first("w").alias("w")), "fuzzy")
    met = materialize(a.join(b.select("dg", "r"), "dg", "left"), "fuzzy")
    rest = met.where("r is null").select("k", "w")
    equal = met.where("r is not null").select("k", "r", F.lit(1.0).alias("ratio"))
    top = F.min(F.struct((-F.col("ratio")).alias("o"), "r")).alias("m")
    short = _short_size(least)
    found = _short_match(rest, b, least, short, kinds["r"]).unionByName(_long_match(rest, b, least, short)).groupBy("k").agg(top)
    best = equal.unionByName(found.select("k", "m.r", (-F.col("m.o")).alias("ratio"))).withColumnRenamed("k", "h")
    rows = every.select("k", F.xxhash64("dg").alias("h")).join(best, "h").groupBy("k").agg(top)
    return rows.select(F.col("k").alias(key), F.col("m.r").alias(ref), F.round(-F.col("m.o"), 6).alias("ratio"))


def _short_match(a: DataFrame, b: DataFrame, least: float, short: int, kind: str) -> DataFrame:
    """``k, r, ratio``: for each left set and each subset of it the best right sets; both of at most ``short`` words."""

    def subsets(df: DataFrame, name: str, kind: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    ident, size = pdf[name].to_numpy(), pdf["w"].map(len).to_numpy()
                    for row, c, sub in _subset_keys(list(pdf["w"]), least):
                        yield pd.DataFrame({name: ident[row], "n": size[row], "c": c, "sub": sub})

        return df.where(F.size("w") <= short).select(name, "w").mapInPandas(run, f"{name} {kind}, n int, c int, sub bigint")

    right = subsets(b, "r", kind).groupBy("sub", F.col("n").alias("m")).agg(F.min("r").alias("r"))
    met = subsets(a, "k", "bigint").join(right, "sub").withColumn("ratio", F.col("c") / F.greatest("n", "m"))
    return met.where(F.col("ratio") >= least).select("k", "r", "ratio")


def _long_match(a: DataFrame, b: DataFrame, least: float, short: int) -> DataFrame:
    """``k, r, ratio`` of pairs of which one set has more than ``short`` words."""
    a, b = (d.where(F.size("w") >= least * (short + 1) - 1e-9) for d in (a, b))
    a, b = a.select("k", F.col("w").alias("ta")), b.select("r", F.col("w").alias("tb"))
    df_ = b.select(F.explode("tb").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    rare = (
        a.select("k", F.explode("ta").alias("t")).join(df_, "t", "left").fillna(0, ["df"]).groupBy("k")
        .agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
        .select("k", F.size("o").alias("n"), F.explode(F.slice("o", F.lit(1), (F.size("o") - F.ceil(F.lit(least) * F.size("o") - 1e-9) + 1).cast("int"))).alias("s"))
        .select("k", "n", "s.t")
    )
    words = b.select("r", F.size("tb").alias("m"), F.explode("tb").alias("t"))
    cand = rare.join(words, "t").where((F.greatest("n", "m") > short) & (F.least("n", "m") >= least * F.greatest("n", "m") - 1e-9)).select("k", "r").distinct()
    shared = cand.join(a, "k").join(b, "r").withColumn("ratio", F.size(F.array_intersect("ta", "tb")) / F.greatest(F.size("ta"), F.size("tb")))
    return shared.where(F.col("ratio") >= least).select("k", "r", "ratio")
