"""Visually identical text with different characters (problem 3)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from quernstone.llm.skeleton import canonical, skeleton


@pandas_udf(StringType())
def skeleton_udf(s: pd.Series) -> pd.Series:
    return s.map(skeleton, na_action="ignore")


@pandas_udf(StringType())
def canonical_udf(s: pd.Series) -> pd.Series:
    return s.map(canonical, na_action="ignore")


def lookalike_forms(df: DataFrame, key: str, text: str, field: str) -> DataFrame:
    """``field, key, text, skeleton, skel_hash`` of every row with a text.

    Null and empty texts look like nothing and are left out; repeated rows stay.
    """
    return (
        df.select(F.lit(field).alias("field"), F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
        .where("text is not null and text <> ''")
        .withColumn("skeleton", skeleton_udf("text"))
        .withColumn("skel_hash", F.xxhash64("field", "skeleton"))
    )


def lookalike_classes(forms: DataFrame) -> DataFrame:
    """One row per record: ``field, key, canonical, class_id, n_forms``.

    ``class_id`` and ``canonical`` are equal for texts that look the same (the
    form of the smallest of them stands for all), ``n_forms`` counts the
    different spellings in characters of the class. A text that is stored in one
    form only has ``n_forms`` 1. The count is taken over distinct forms, which
    are aggregated before the shuffle, so a text copied a million times is one
    row there.
    """
    counts = forms.select("field", "skeleton", "skel_hash", "text").distinct().groupBy("field", "skel_hash", "skeleton").agg(F.count(F.lit(1)).alias("n_forms"), F.min("text").alias("first"))
    counts = counts.withColumn("canonical", canonical_udf("first")).drop("first")
    return forms.join(counts, ["field", "skel_hash", "skeleton"]).select(
        "field", "key", "canonical", F.hex("skel_hash").alias("class_id"), "n_forms"
    )


def lookalike_pairs(forms: DataFrame) -> DataFrame:
    """``field, key_a, key_b``: rows that look the same but differ in characters.

    Only skeletons with two forms or more take part. Their different forms are
    joined with each other; the rows of each form are attached to its pairs
    afterwards, so copies of one form never meet each other, however many
    there are. Pairs come once, ``key_a < key_b`` as strings.
    """
    by = ["field", "skel_hash", "skeleton"]
    distinct = forms.select(*by, "text").distinct()
    a, b = distinct.withColumnRenamed("text", "text_a"), distinct.withColumnRenamed("text", "text_b")
    unlike = a.join(b, by).where("text_a <> text_b").select("field", "text_a", "text_b")
    rows = lambda x: forms.select("field", F.col("key").alias(f"key_{x}"), F.col("text").alias(f"text_{x}"))
    got = unlike.join(rows("a"), ["field", "text_a"]).join(rows("b"), ["field", "text_b"])
    return got.where("key_a < key_b").select("field", "key_a", "key_b").distinct()
