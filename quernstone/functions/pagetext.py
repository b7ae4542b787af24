"""Addresses, page noise, cover pages and stand-in summaries."""

from __future__ import annotations

import html
from urllib.parse import quote, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def _encoded(url: str, safe: str) -> str:
    try:
        p = urlsplit(url.strip())
    except ValueError:
        return url
    return urlunsplit((p.scheme, p.netloc, quote(p.path, safe=safe), quote(p.query, safe=safe + "=&?+"), p.fragment))


@pandas_udf(StringType())
def encode_url(s: pd.Series) -> pd.Series:
    """Path and query percent-encoded; what is encoded already stays so."""
    return s.map(lambda u: _encoded(u, "/%:@!$&'()*+,;=~-._"), na_action="ignore")


@pandas_udf(StringType())
def encode_url_twice(s: pd.Series) -> pd.Series:
    """The same, but a percent sign counts as a character to encode."""
    return s.map(lambda u: _encoded(u, "/:@!$&'()*+,;=~-._"), na_action="ignore")


@pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def display_title(title: Column, link_text: Column, filename: Column, id_: Column) -> Column:
    """Title, else link text, else the file name made readable, else the id."""
    from quernstone.functions.titles import humanized
    from quernstone.functions.text import nonblank

    return F.coalesce(unescape(nonblank(title)), unescape(nonblank(link_text)), nonblank(humanized(filename)), id_)


# Lines that repositories and libraries put on pages.
NOISE_LINES = r"(?i)^(public\s+disclosure\s+authorized|digitized by\s+google.*|google|internet\s+archive|hal\s+id\s*:.*|submitted on\s+\d.*|https?://hal\..*|retrieved on\s+\d.*|(©|copyright|all\s+rights\s+reserved|tous\s+droits\s+réservés)\b.*|[\s\-_=*·•]{5,})$"

# Phrases of a repository's own cover sheet.
BANNER = ["hal is a multi-disciplinary open access archive", "l'archive ouverte pluridisciplinaire", "destinée au dépôt et à la diffusion de documents"]


def denoise(text: Column, title: Column) -> Column:
    """Text without noise lines, repetitions of the title and a head of short lines.

    The head are up to six lines at the beginning that have six words or less,
    an address, or the title; it ends with the first other line.
    """
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))
    name = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    words = lambda x: F.size(F.split(x, r"\s+"))
    shown = F.filter(lines, lambda x: x != "")
    head = F.slice(shown, 1, 6)
    plain = lambda x: ~((F.length(x) < 80) & ((words(x) <= 6) | (F.lower(x) == name) | F.contains(x, F.lit("http://")) | F.contains(x, F.lit("https://"))))
    first = F.array_position(F.transform(head, plain), True)
    start = F.when(F.size(shown) <= 2, 0).when(first > 0, first - 1).otherwise(F.size(head))
    body = F.slice(shown, (start + 1).cast("int"), F.size(shown))
    keep = F.filter(body, lambda x: ~F.regexp(x, F.lit(NOISE_LINES)) & ~((F.lower(x) == name) & (F.length(x) < 80)))
    return F.array_join(keep, "\n")


def is_cover(text: Column) -> Column:
    """A page with two lines of five words or less, or little text in such lines."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: F.size(F.split(x, r"\s+")) >= 5)
    return (F.size(lines) <= 2) | (F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x)) < 120)


def banner_only(text: Column, most: int = 2000) -> Column:
    """Nothing but the cover sheet of a repository, or no text."""
    t = F.lower(F.coalesce(text, F.lit("")))
    marked = F.contains(t, F.lit(BANNER[0])) | F.contains(t, F.lit(BANNER[1])) | F.contains(t, F.lit(BANNER[2]))
    return (t == "") | (marked & (F.length(F.trim(t)) <= most))


def readable(text: Column, least: int = 200) -> Column:
    """Long enough to be read, page marks not counted."""
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) >= least) & (F.length(F.trim(F.regexp_replace(t, r"\[p\.\d+\]", ""))) >= least)


def stub_summary(text: Column, lines: int = 5, most: int = 500) -> Column:
    """The first long lines of a text, as a stand-in for a summary."""
    long = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 40)
    return F.substring(F.array_join(F.slice(long, 1, lines), " "), 1, most)
