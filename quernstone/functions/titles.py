"""Editorial titles: choice of the best source, and cleaning by small word tables.

A title is cut into text and bracketed pieces; parts of brackets that name a
print format go, by looking their plain form up in a table. Typography and
series names come after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import lit_array, nonblank

# What authoring tools leave in a title, wherever it stands.
TOOLS = ["microsoft word", "untitled", "openoffice", "libreoffice", "indesign"]

# Names of report series that stand in the place of a title.
SERIES = ["world bank document", "public disclosure", "working paper", "technical note", "technical report", "thematic note note", "thematic guidance note", "discussion paper", "policy brief"]

# Extensions of layout and office files.
LAYOUT_FILES = ["pmd", "qxd", "odt", "doc", "indd", "docx"]

# Print formats (lower case, blanks between words).
FORMATS = [
    "pdf", "page par page", "pageparpage", "cahier", "à lire", "à lire sur écran", "à lire sur l écran", "sur écran", "sur l écran", "to read", "à imprimer", "to print",
    "livret", "livret a", "brochure", "booklet", "version page par page", "version légère", "version light", "version recto verso", "version cahier",
    "fil", "nb", "noir et blanc", "recto verso", "double face",
]

#: Sizes: pages, paper, pages on paper, copies on paper.
_SIZE = r"^(livret )?((\d+ ?(pp?|pages?))( ?a[3-6]?)?|x\d+ ?a[3-6]|a[3-6])$"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def plain_form(c: Column) -> Column:
    """Lower case with single blanks for everything between words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[\s_’'\-]+", " "))


def is_format(c: Column) -> Column:
    return _let(plain_form(c), lambda p: p.isin(FORMATS) | F.regexp(p, F.lit(_SIZE)))


def humanized(filename: Column) -> Column:
    """File name as a title: no extension, blanks for ``_`` and ``-``."""
    return F.trim(F.translate(F.regexp_replace(F.coalesce(filename, F.lit("")), r"(?i)\.[a-z0-9]+$", ""), "_-", "  "))


def meaningless_title(title: Column, filename: Column) -> Column:
    """A title that says nothing: file name, single word, code."""
    c = F.trim(F.coalesce(title, F.lit("")))
    stem = F.regexp_replace(F.coalesce(filename, F.lit("")), r"(?i)\.[a-z0-9]{2,4}$", "")
    words = F.filter(F.split(c, r"[\s\-—:·]+"), lambda w: F.length(w) > 2)
    return (
        (F.length(c) < 4)
        | F.regexp(c, F.lit(r"(?i)\.(pdf|doc|docx|odt|cdr|indd|qxd|pub|txt)$"))
        | (F.contains(c, F.lit("_")) & ~F.contains(c, F.lit(" ")))
        | ((F.length(stem) > 0) & (F.lower(c) == F.lower(stem)))
        | (F.size(words) < 2)
    )


def of_a_tool(title: Column) -> Column:
    """A title that a program or a report series gave, not an author."""
    low = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"\s+", " ")
    words = F.concat(F.lit(" "), F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    named = F.exists(lit_array(TOOLS), lambda t: F.contains(low, t)) | F.exists(lit_array([f" {x} " for x in SERIES]), lambda t: F.contains(words, t))
    return named | F.regexp(low, F.lit(rf"\.({'|'.join(LAYOUT_FILES)})(?![\p{{L}}\p{{N}}_])")) | F.regexp(words, F.lit(r" (\d+p ?a[3-6]|8pp|a[3456]) "))


def _brackets(t: Column, author: Column) -> Column:
    """Brackets without their parts that name formats; one that names the known author goes."""

    def clean(piece: Column, last: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        kept = F.filter(F.transform(F.split(inner, ","), lambda p: F.trim(p)), lambda p: ~is_format(p))
        person = last & nonblank(author).isNotNull() & F.regexp(inner, F.lit(r"^\p{Lu}\p{Ll}+(\s+\p{Lu}\p{Ll}+)+$"))
        whole = F.startswith(piece, F.lit("(")) & F.endswith(piece, F.lit(")")) & (F.length(piece) > 2)
        return F.when(~whole, piece).when(person | (F.size(kept) == 0), "").otherwise(F.concat(F.lit("("), F.array_join(kept, ", "), F.lit(")")))

    each = lambda ps: F.array_join(F.transform(ps, lambda p, i: clean(p, i == F.size(ps) - 1)), "")
    return F.trim(_let(F.filter(F.split(t, r"(?=\()|(?<=\))"), lambda p: p != ""), each))


def _without_format_end(t: Column) -> Column:
    """A format that ends a title without brackets: pages, pages on paper, NB, fil."""

    def shorter(words: Column) -> Column:
        n = F.size(words)
        end = lambda k: plain_form(F.array_join(F.slice(words, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), " "))
        sized = lambda k: (n > k) & F.regexp(end(k), F.lit(r"^\d+ ?(pp?|pages? a[3-6]|pp? ?a[3-6])$"))
        cut = F.when(sized(3), 3).when(sized(2), 2).when(sized(1) | ((n > 1) & end(1).isin("nb", "fil")), 1).otherwise(0)
        return F.array_join(F.slice(words, F.lit(1), n - cut), " ")

    return _let(F.split(t, r"\s+"), shorter)


def _series(t: Column, generic: Column) -> Column:
    """Titles of the series *Mini-Manuel* in one notation."""
    head = F.when(generic & F.regexp(t, F.lit(r"(?i)^manuel\s+\S")), r"(?i)^manuel\s+")
    rest = F.when(F.regexp(t, F.lit(r"(?i)^mini[-\s]manuel\s*[:\-]?\s*\S")), F.regexp_replace(t, r"(?i)^mini[-\s]manuel\s*[:\-]?\s*", "")).when(head.isNotNull(), F.regexp_replace(t, r"(?i)^manuel\s+", ""))
    return F.when(rest.isNotNull(), F.concat(F.lit("Mini-Manuel : "), F.upper(F.substring(rest, 1, 1)), F.substring(rest, F.lit(2), F.length(rest)))).otherwise(t)


def normalize_title(link_text: Column, pdf_title: Column, filename: Column, author: Column | None = None) -> Column:
    """Editorial title; '' if no source gives one.

    The PDF title wins if it is neither a tool's nor meaningless, then the link
    text unless it names the series only, then a merely meaningless PDF title,
    then the file name. A title that is nothing but a format falls back to the
    file name.
    """
    author = F.lit(None).cast("string") if author is None else author
    link = nonblank(link_text)
    only_series = F.coalesce(F.regexp(link, F.lit(r"(?i)^mini[-\s]manuel$")), F.lit(False))
    named = F.coalesce(F.regexp(link, F.lit(r"(?i)mini[-\s]manuel")) & ~F.regexp(link, F.lit(r"(?i)mini[-\s]manuel.{3,}")), F.lit(False))
    by_name = nonblank(humanized(filename))
    usable = F.when(~of_a_tool(pdf_title), nonblank(pdf_title))
    best = _let(usable, lambda pdf: F.coalesce(F.when(~meaningless_title(pdf, filename), pdf), F.when(~only_series, link), pdf, by_name, F.lit("")))
    best = _let(best, lambda b: F.when(is_format(b), F.when(~is_format(by_name), by_name)).otherwise(b))
    t = _without_format_end(_brackets(F.regexp_replace(F.trim(best), r"^[·•]\s*", ""), author))
    for rule, becomes in ((r"\s+-\s+", " — "), (r"(\S):\s", "$1 : "), (r"\s{2,}", " "), (r"\s*\.\.\.\s*$", "")):
        t = F.regexp_replace(t, rule, becomes)
    return F.coalesce(F.trim(_let(t, lambda x: _series(x, named))), F.lit(""))
