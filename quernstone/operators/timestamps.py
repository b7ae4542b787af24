"""Mixed timestamp formats: expectation-maximisation over formats per source.

Every value contributes a likelihood under each format that can read it
(``functions.dateparse``). Most values allow one reading; those that allow
several (``200504232117`` is a compact time or an epoch in milliseconds) are
decided by the mixture of formats of their source and field, estimated by EM
from all values of that source. Values whose best posterior stays under
``min_posterior`` are marked ambiguous and get no value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.dateparse import FORMATS, readings
from quernstone.session import materialize

#: Number of values a format can spell per year; a reading is the likelier the fewer there are.
_DENSITY = {f: 3.15e7 for f in FORMATS} | {"iso_month": 12, "year": 1, "month_year": 12, "name_month": 12, "compact8": 365, "compact8_day_first": 365, "compact12": 525600, "epoch_ms": 3.15e10, "epoch_us": 3.15e13}

#: EM stops after so many rounds; counts that every format has from the start.
_ROUNDS, _PRIOR = 50, 0.1


def parse_values(
    df: DataFrame, key: str, fields: dict[str, Column], source: str, zone: str = "Europe/Paris", day_first: bool | None = True
) -> DataFrame:
    """``key, source, field, raw, sig, values``: every value with its readings."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("raw")) for n, c in fields.items()])
    long = (
        df.select(F.col(key).cast("string").alias("rec_key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"), F.explode(pairs).alias("p"))
        .select("rec_key", "src", "p.field", "p.raw")
        .where("raw is not null and trim(raw) <> ''")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, list[str]]] = {}
        for pdf in batches:
            sig, vals = [], []
            for raw in pdf["raw"]:
                hit = known.get(raw)
                if hit is None:
                    r = readings(raw, zone, day_first)
                    hit = ("|".join(f for f, _ in r), [v for _, v in r])
                    if len(known) > 200_000:
                        known.clear()
                    known[raw] = hit
                sig.append(hit[0])
                vals.append(hit[1])
            yield pdf.assign(sig=sig, vals=vals)

    return long.mapInPandas(run, "rec_key string, src string, field string, raw string, sig string, vals array<string>")


def _em(pdf: pd.DataFrame) -> pd.DataFrame:
    """EM for one source: its rows are counts of (field, signature)."""
    out = []
    for field, part in pdf.groupby("field", sort=True):
        sigs = [s.split("|") for s in part["sig"]]
        n = part["n"].to_numpy(float)
        names = sorted({f for s in sigs for f in s})
        at = {f: i for i, f in enumerate(names)}
        like = np.zeros((len(sigs), len(names)))
        for i, s in enumerate(sigs):
            for f in s:
                like[i, at[f]] = 1.0 / _DENSITY[f]
        pi = np.full(len(names), 1.0 / len(names))
        post = like
        for _ in range(_ROUNDS):
            post = like * pi
            post /= post.sum(1, keepdims=True)
            new = (post * n[:, None]).sum(0) + _PRIOR
            new /= new.sum()
            done = np.abs(new - pi).max() < 1e-9
            pi = new
            if done:
                break
        for i, s in enumerate(sigs):
            p = [post[i, at[f]] for f in s]
            b = int(np.argmax(p))
            out.append((part["src"].iloc[0], field, "|".join(s), b, s[b], float(p[b]), float(pi[at[s[b]]]), int(n[i])))
    return pd.DataFrame(out, columns=["src", "field", "sig", "pick", "format", "posterior", "share", "n"])


def format_mixture(parsed: DataFrame) -> DataFrame:
    """The chosen reading of each (source, field, signature) with its posterior."""
    counts = parsed.where("sig <> ''").groupBy("src", "field", "sig").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("src").applyInPandas(
        _em, "src string, field string, sig string, pick int, format string, posterior double, share double, n bigint"
    )


def normalise_timestamps(
    df: DataFrame,
    key: str,
    fields: dict[str, Column],
    source: str,
    zone: str = "Europe/Paris",
    day_first: bool | None = True,
    min_posterior: float = 0.8,
) -> DataFrame:
    """``rec_key, source, field, raw, utc_value, format, posterior, status``.

    One row per value that is neither null nor blank. ``status`` is ``ok``,
    ``ambiguous`` (no reading reaches ``min_posterior``; ``utc_value`` null) or
    ``unreadable`` (range, approximate, impossible or unknown; ``utc_value``
    null). Null keys are kept, a null source counts as the source ``''``,
    repeated rows are each answered, an empty table gives an empty result.
    Other columns of ``df`` are not looked at, whatever their names.
    """
    parsed = materialize(parse_values(df, key, fields, source, zone, day_first), "ts")
    verdict = format_mixture(parsed)
    joined = parsed.join(verdict.select("src", "field", "sig", "pick", "format", "posterior"), ["src", "field", "sig"], "left")
    sure = F.col("posterior") >= min_posterior
    return joined.select(
        "rec_key",
        F.col("src").alias("source"),
        "field",
        "raw",
        F.when(sure, F.expr("try_element_at(vals, pick + 1)")).alias("utc_value"),
        F.when(F.col("sig") != "", F.col("format")).alias("format"),
        F.coalesce("posterior", F.lit(0.0)).alias("posterior"),
        F.when(F.col("sig") == "", "unreadable").when(sure, "ok").otherwise("ambiguous").alias("status"),
    )
