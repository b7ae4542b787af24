"""Quality audits: each gives an array of issue names per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import nonblank


def _issues(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in checks]))


def real_length(text: Column) -> Column:
    """Characters without urls."""
    return F.length(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"https?://\S+", "")))


def summary_issues(summary: Column, title: Column) -> Column:
    s, t = F.coalesce(summary, F.lit("")), F.trim(F.coalesce(title, F.lit("")))
    flat = lambda c, n: F.lower(F.regexp_replace(F.substring(c, 1, n), r"\s+", " "))
    repeats = (F.length(t) >= 15) & F.startswith(flat(s, 35), flat(t, 25))
    letters = F.length(F.regexp_replace(s, r"[^\p{L}]", "")) / F.greatest(F.length(s), F.lit(1))
    url = F.contains(s, F.lit("http://")) | F.contains(s, F.lit("https://"))
    return F.when(F.trim(s) == "", F.array(F.lit("empty"))).otherwise(
        _issues((url, "raw_url"), (F.regexp(s, F.lit(r"(?i)Extrait\s*:|Voir le document")), "extract_mark"), (repeats, "repeats_title"), ((letters < 0.55) & (F.length(s) > 100), "noise"), (real_length(s) < 80, "too_short"))
    )


def date_issues(doc_date: Column, title: Column, collected: Column, year_now: int) -> Column:
    d = F.trim(F.coalesce(doc_date, F.lit("")))
    ranged = F.regexp(d, F.lit(r"^\d{4}-\d{4}$"))
    formed = F.regexp(d, F.lit(r"^\d{4}(-\d{2}(-\d{2})?)?$"))
    year = F.when(ranged | formed, F.substring(d, 1, 4).cast("int"))
    seen = F.nullif(F.regexp_extract(F.coalesce(collected, F.lit("")), r"^(\d{4})", 1), F.lit("")).cast("int")
    named = F.transform(F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(r"\b(1[5-9]\d\d|20\d\d)\b"), F.lit(1)), lambda y: y.cast("int"))
    far = F.exists(named, lambda y: F.abs(y - year) >= 3)
    return F.when(d == "", F.array(F.lit("empty"))).when(~ranged & ~formed, F.array(F.lit("format"))).otherwise(
        _issues((ranged, "range"), (year > year_now, "future"), (year < 1800, "very_old"), (seen.isNotNull() & (year > seen), "after_collection"), (far, "title_year"))
    )


# Capitals that are no shouting, and print formats that should not be in a title.
ACRONYMS = ["CIRAD", "NDDL", "UBPC", "ANAP", "EZLN", "VALCOM", "OACA", "AMAP", "FIAN", "GRAIN", "IIED"]
FORMAT_RESIDUE = r"(?i)\b(cahier|page\s*par\s*page|fil\b|to[\s_]read|to[\s_]print|NB\b|[0-9]+p\b|x[0-9]+\b|booklet|livret\s+A[456])"


def title_issues(title: Column) -> Column:
    """Format residue, author in brackets, cut off, capitals, odd signs, bare language version, series in lower case, length."""
    t = F.trim(F.coalesce(title, F.lit("")))
    words = F.split(t, r"\s+")
    words = F.transform(F.slice(words, F.lit(2), F.size(words)), lambda w: F.regexp_replace(w, r"^[^\p{L}]+|[^\p{L}0-9]+$", ""))
    loud = F.exists(words, lambda w: F.regexp(w, F.lit(r"^\p{Lu}{4,}$")) & ~w.isin(ACRONYMS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        _issues(
            (F.regexp(t, F.lit(FORMAT_RESIDUE)), "format_residue"),
            (F.regexp(t, F.lit(r"\([\p{Lu}][\p{Ll}]+\s+[\p{Lu}][\p{Ll}]+\)$")), "author_in_title"),
            (F.endswith(t, F.lit("...")) | F.endswith(t, F.lit("…")), "cut_off"),
            (loud, "capitals"),
            (F.regexp(t, F.lit(r"[_\[\]{}<>|\\]")), "odd_signs"),
            (F.regexp(t, F.lit(r"(?iu)^— version (lituanienne|italienne|anglaise|espagnole)$")), "bare_version"),
            (F.regexp(t, F.lit(r"^Mini-Manuel\s+[a-z]")), "series_lower_case"),
            (F.length(t) > 90, "long"),
        )
    )


def retry_fields(summary: Column, plain: Column) -> Column:
    """Fields of an enrichment that should be asked for again."""
    return _issues(((F.trim(F.coalesce(summary, F.lit(""))) == "") | (real_length(summary) < 80) | F.regexp(F.coalesce(summary, F.lit("")), F.lit("https?://")), "summary"), (nonblank(plain).isNull(), "en_clair"))


def date_confidence(stored: Column, found: Column) -> Column:
    """How far a stored and a newly found date agree."""
    a, b = F.coalesce(stored, F.lit("")), F.coalesce(found, F.lit(""))
    return F.when((a == "") & (b == ""), "none").when(a == b, "high").when((a == "") | (b == ""), "low").when(F.substring(a, 1, 4) == F.substring(b, 1, 4), "medium").otherwise("conflict")


def candidate_confidence(candidate: Column, from_text: Column, blob: Column) -> Column:
    """Trust in a date candidate by the years named in the record's own texts.

    ``conflict`` where another year, three off or more, is named; ``high``
    where the year is named; ``medium`` where the candidate was read out of the
    texts; ``low`` for one of the file's data alone; ``none`` without any.
    """
    year = F.nullif(F.substring(F.coalesce(candidate, F.lit("")), 1, 4), F.lit("")).try_cast("int")
    named = F.transform(F.regexp_extract_all(F.coalesce(blob, F.lit("")), F.lit(r"\b(1[5-9]\d\d|20\d\d)\b"), F.lit(1)), lambda y: y.cast("int"))
    return (
        F.when(year.isNull(), "none")
        .when(F.exists(named, lambda y: F.abs(y - year) >= 3), "conflict")
        .when(F.exists(named, lambda y: y == year), "high")
        .when(F.coalesce(from_text, F.lit("")) == candidate, "medium")
        .otherwise("low")
    )


def counts(df: DataFrame, issues: str = "issues") -> DataFrame:
    return df.select(F.explode(issues).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


def set_differences(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """``key`` and a flag per set, for the keys that are not in all of them."""
    out = None
    for name, df in sets.items():
        part = df.select(key).distinct().withColumn(name, F.lit(True))
        out = part if out is None else out.join(part, key, "full_outer")
    flags = [F.coalesce(F.col(n), F.lit(False)).alias(n) for n in sets]
    missing = F.lit(False)
    for n in sets:
        missing = missing | ~F.coalesce(F.col(n), F.lit(False))
    return out.where(missing).select(key, *flags)
