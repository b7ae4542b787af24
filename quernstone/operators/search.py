"""Inverted index and search."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import fold, index_tokens


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """``term, key, tf``: the inverted index. Write it partitioned by a hash of the term."""
    return df.select(key, F.explode(index_tokens(F.col(text))).alias("term")).groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(index: DataFrame) -> DataFrame:
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def top_terms(index: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` terms in most documents (a report)."""
    return document_frequency(index).orderBy(F.desc("df"), "term").limit(k)


def search_all(index: DataFrame, key: str, terms: list[str], k: int = 20) -> DataFrame:
    """Documents that hold every term, by summed frequency; the best ``k``.

    A term asked twice counts twice. An unknown term gives no document.
    """
    asked = Counter(terms)
    if not asked:
        return index.select(key, F.col("tf").cast("bigint").alias("score")).limit(0)
    weight = F.create_map(*[F.lit(x) for t, n in asked.items() for x in (t, n)])
    got = index.where(F.col("term").isin(list(asked))).groupBy(key).agg(F.sum(F.col("tf") * weight[F.col("term")]).alias("score"), F.count(F.lit(1)).alias("found"))
    return got.where(F.col("found") == len(asked)).orderBy(F.desc("score"), key).limit(k).select(key, "score")


def search_any(df: DataFrame, key: str, text: str, terms: list[str], k: int = 20) -> DataFrame:
    """Documents that hold any term as a substring, by the number of terms; the best ``k``."""
    hay = fold(F.coalesce(F.col(text), F.lit("")))
    found = sum((F.contains(hay, F.lit(t)).cast("int") for t in terms), F.lit(0))
    return df.select(key, found.alias("hits")).where("hits > 0").orderBy(F.desc("hits"), key).limit(k)


def suggestions(df: DataFrame, sources: list[tuple[str, str]], prefix: str, k: int = 10) -> DataFrame:
    """``term, origin``: prefix matches, then substring matches, first origin wins; the best ``k``.

    ``sources`` are (column, origin) in their order of precedence.
    """
    parts = F.array(*[F.struct(F.lit(i).alias("o"), F.lit(name).alias("origin"), F.trim(F.col(c)).alias("term")) for i, (c, name) in enumerate(sources)])
    terms = df.select(F.explode(parts).alias("s")).select("s.*").where("term is not null and term <> ''").withColumn("form", fold(F.col("term")))
    one = terms.groupBy("form").agg(F.min(F.struct("o", "term", "origin")).alias("s")).select("form", "s.*")
    p = fold(F.lit(prefix))
    rank = F.when(F.startswith(F.col("form"), p), 0).when(F.contains(F.col("form"), p), 1)
    return one.withColumn("rank", rank).where("rank is not null").orderBy("rank", "o", "form").limit(k).select("term", "origin", "rank")
