"""Text columns: folding, tokens, fingerprints, escaping, excerpts.

Every function takes and returns a ``Column`` of built-in expressions, so the
work stays inside code generation. Java regular expressions need ``(?U)`` for
Unicode ``\\w`` and ``(?iu)`` for Unicode case folding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the bare letters they fold to.
_MARKED = "àáâãäåāăąçćčďèéêëēėęěìíîïīįñńňòóôõöøōřśšťùúûüūůýÿžźżάέήίόύώ"
_BARE__ = "aaaaaaaaacccdeeeeeeeeiiiiiinnnooooooorsstuuuuuuyyzzzαεηιουω"

# Words left out of the index, by language (accents removed).
STOPWORDS = {
    "fr": "le la les un une des du de au aux et ou ni mais donc car or que qui quoi dont ce cet cette ces il elle ils elles nous vous leur leurs son sa ses mon ma mes ton ta tes pour par sur sous dans avec sans vers chez pas ne plus moins tres tout tous toute toutes etre avoir fait faire ete est sont etait etaient sera serait comme aussi ainsi",
    "en": "the a an and or but if of to in on at by for with from as is are was were be been being has have had do does did this that these those it its they them their we our you your he his she her i me my not no so than then there here what which who whom whose how why when where all any some such also only more less very can could would should may might must will shall",
    "es": "el los las una unos unas y o pero que como para por con sin sobre entre hacia hasta desde es son esta estan ser estar fue fueron ha han su sus este estos estas ese esa eso esos esas lo le les se yo tu ella nosotros vosotros ellos ellas muy mas todo todos toda todas no ni si tambien tampoco",
    "corpus": "page pages pdf doc document documents titre ref",
}


def stopwords() -> list[str]:
    return sorted({w for line in STOPWORDS.values() for w in line.split()})


def lit_array(items: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in items])


def nonblank(c: Column) -> Column:
    """The text without blanks at its ends; null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def fold(c: Column) -> Column:
    """Lower case without accents; combining marks are dropped, ligatures kept."""
    return F.translate(F.regexp_replace(F.lower(c), r"\p{Mn}+", ""), _MARKED, _BARE__)


def index_tokens(c: Column) -> Column:
    """Tokens of the inverted index: letters only, three or more, no stop words; repeats stay."""
    words = F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit(r"[a-zß-öø-ÿ]{3,}"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(stopwords()))


def fingerprint_tokens(c: Column, least: int = 5, most: int | None = None) -> Column:
    """Distinct words of ``least`` letters or more in alphabetical order; only the first ``most`` if that is given."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0))
    found = F.array_sort(F.array_distinct(F.filter(words, lambda w: F.length(w) >= least)))
    return found if most is None else F.slice(found, 1, most)


def match_form(c: Column) -> Column:
    """Form in which quotations are looked up: folded, no punctuation, no line-end hyphens."""
    t = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[«»“”]", "")
    t = F.regexp_replace(F.translate(t, "’‘", "''"), r"-\s*\n\s*", "")
    t = F.regexp_replace(fold(t), r"[^\p{L}\p{N}_]+", " ")
    return F.trim(t)


def strip_html(c: Column, most: int = 400) -> Column:
    """Tags become blanks, white space is collapsed, the result is cut."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", " "), r"\s+", " ")
    return F.substring(F.trim(plain), 1, most)


def first_sentence(c: Column, most: int = 300) -> Column:
    """Up to the first separator found, tried in the order ``. ``, ``! ``, ``? ``."""
    t = F.trim(F.coalesce(c, F.lit("")))
    out = t
    for sep in ("? ", "! ", ". "):
        out = F.when(F.contains(t, F.lit(sep)), F.concat(F.substring_index(t, sep, 1), F.lit(sep.strip()))).otherwise(out)
    return F.substring(out, 1, most)


def short_text(*choices: Column, most: int = 280) -> Column:
    """The first choice that is not blank, cut with an ellipsis."""
    t = F.coalesce(*[nonblank(c) for c in choices], F.lit(""))
    return F.when(F.length(t) > most, F.concat(F.rtrim(F.substring(t, 1, most)), F.lit("…"))).otherwise(t)


def haystack(*parts: Column) -> Column:
    """Lower-case text of several parts, blanks left out, for keyword search."""
    return F.lower(F.concat_ws(" ", *[nonblank(p) for p in parts]))


def hits(hay: Column, keywords: list[str]) -> Column:
    """The keywords that occur in ``hay`` as substrings, in their order."""
    return F.filter(lit_array([k.lower() for k in keywords if k]), lambda k: F.contains(hay, k))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays of distinct items over their union; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either > 0, both / either).otherwise(F.lit(0.0))


def xml_escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def bib_escape(c: Column) -> Column:
    out = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit(""))
    return F.trim(F.regexp_replace(F.translate(out, "{}", "()"), r"\s*\n\s*", " "))


def mark_terms(c: Column, terms: list[str]) -> Column:
    """Wrap each occurrence of a term in ``<mark>``, whatever its case."""
    safe = [t for t in sorted({t.strip() for t in terms}, key=len, reverse=True) if t]
    if not safe:
        return c
    pattern = "|".join("".join("\\" + x if x in r"\.[]{}()*+-?^$|/" else x for x in t) for t in safe)
    return F.regexp_replace(c, f"(?iu)({pattern})", "<mark>$1</mark>")
