"""Derived columns and predicates of catalogue records: scores, periods, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import nonblank

# Formats that count as documents.
DOCUMENT_FORMATS = ["pdf", "epub", "txt", "odt"]


def record_id(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 8)


def alternative_id(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 8)


def host(url: Column) -> Column:
    """Lower-case host without port and user; null for a malformed url."""
    return nonblank(F.lower(F.regexp_extract(F.trim(url), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)))


def netloc(url: Column) -> Column:
    return nonblank(F.lower(F.regexp_extract(F.trim(url), r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]+)", 1)))


def path_extension(url: Column) -> Column:
    path = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    return F.lower(F.regexp_extract(F.regexp_replace(path, r"/+$", ""), r"\.([A-Za-z0-9]{2,4})$", 1))


def effective_score(final: Column, initial: Column, latest: Column) -> Column:
    """The final score, else the initial one, else the latest; 0 without any."""
    return F.coalesce(final, initial, latest, F.lit(0)).cast("int")


def score_label(score: Column) -> Column:
    return F.when(score >= 9, "essentiel").when(score >= 7, "important").when(score >= 5, "utile").when(score >= 3, "marginal").otherwise("faible")


def decade(text: Column) -> Column:
    """Decade of the first four digits between 1400 and 2100, ``inconnu`` without any.

    Windows slide digit by digit and ignore word bounds.
    """
    s = F.coalesce(text, F.lit(""))
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 3, F.lit(1))), lambda i: F.substring(s, i, F.lit(4)))
    years = F.filter(F.transform(F.filter(windows, lambda w: F.regexp(w, F.lit("^[0-9]{4}$"))), lambda w: w.cast("int")), lambda y: (y >= 1400) & (y <= 2100))
    first = F.get(years, F.lit(0))
    return F.when(first.isNull(), "inconnu").otherwise(F.concat((F.floor(first / 10) * 10).cast("string"), F.lit("s")))


def document_year(text: Column) -> Column:
    """First year from 1500 to 2099 that stands by itself, else null."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"\b(1[5-9]\d\d|20\d\d)\b", 1), F.lit("")).cast("int")


def is_document(fmt: Column, url: Column) -> Column:
    return F.coalesce(F.lower(fmt).isin(DOCUMENT_FORMATS), F.lit(False)) | F.coalesce(path_extension(url).isin(DOCUMENT_FORMATS), F.lit(False))


def enrichment_failed(error: Column, summary: Column) -> Column:
    """An error was stored, or there is a summary without content."""
    return error.isNotNull() | (summary.isNotNull() & (F.trim(summary) == ""))


def publishable(id_: Column, final: Column, initial: Column, latest: Column, fmt: Column, url: Column, error: Column, summary: Column, excluded: list[str] = (), threshold: int = 4) -> Column:
    """The one definition of what may be shown; every query uses it."""
    keep = ~id_.isin(list(excluded)) if excluded else F.lit(True)
    lost = enrichment_failed(error, summary) & final.isNull()
    return keep & ~lost & is_document(fmt, url) & (effective_score(final, initial, latest) >= threshold)


def of_record(fn, **extra) -> Column:
    """Apply :func:`publishable` or :func:`effective_score` to the usual columns."""
    if fn is effective_score:
        return fn(F.col("score_final"), F.col("score_initial"), F.col("latest_score"))
    return fn(F.col("id"), F.col("score_final"), F.col("score_initial"), F.col("latest_score"), F.col("format"), F.col("url"), F.col("enrichment.error"), F.col("enrichment.summary"), **extra)


def archivable(final: Column, initial: Column, downloaded: Column, source: Column, noisy: list[str]) -> Column:
    """Cold records: scored low at first, never read nor downloaded, from a noisy source."""
    return (F.coalesce(initial, F.lit(0)) <= 2) & final.isNull() & ~F.coalesce(downloaded, F.lit(False)) & source.isin(noisy)


def run_timestamp(run: Column) -> Column:
    """Time of a run string ``yyyy-MM-dd_HH-mm``; null for other notations."""
    return F.try_to_timestamp(F.when(F.regexp(run, F.lit(r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}$")), run), F.lit("yyyy-MM-dd_HH-mm"))
