"""Pages, quotations, references and footnotes in long texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import fold, match_form

# Headings of the references (lower case, no accents).
HEADINGS = [
    "bibliographie", "references", "references bibliographiques", "cited works", "works cited", "source", "sources",
    "oeuvre citee", "oeuvres citees", "œuvre citee", "œuvres citees", "ouvrage cite", "ouvrages cites", "bibliografia", "referencias", "obras citadas",
]

_MARK = r"\[p\.(\d+)\]"


def pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, page_no, text``: a row per page marked ``[p.N]``; text before the first mark is page 0.

    Pages without any text are kept with an empty one.
    """
    parts = F.split(F.concat(F.lit("[p.0]"), F.col(text)), r"(?=\[p\.\d+\])")
    rows = df.where(F.col(text).isNotNull()).select(key, F.posexplode(parts).alias("pos", "part")).where("part <> ''")
    no = F.regexp_extract("part", _MARK, 1).cast("int")
    got = rows.select(key, "pos", no.alias("page_no"), F.trim(F.regexp_replace("part", r"^\[p\.\d+\]", "")).alias("text"))
    return got.where("page_no > 0 or text <> ''").select(key, "page_no", "text")


def quote_probe(quote: Column) -> Column:
    """First words of a quotation that must be found if it is not there as a whole.

    70 % of the words, four at least; null for quotations under four words.
    """
    words = F.split(match_form(quote), " ")
    n = F.size(words)
    return F.when(n >= 4, F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(4), F.floor(n * 7 / 10).cast("int"))), " "))


def verify_quotes(quotes: DataFrame, texts: DataFrame, key: str, quote: str, on: str, text: str) -> DataFrame:
    """``key, verified, how``: whether each quotation stands in its document.

    ``how`` is ``exact``, ``partial`` (its first words) or null. Documents are
    matched page by page and joined by ``on``; several texts of one record are
    all tried. Quotations without document stay unverified.
    """
    q = quotes.select(key, on, match_form(F.col(quote)).alias("m"), quote_probe(F.col(quote)).alias("probe"))
    t = texts.select(on, match_form(F.col(text)).alias("body"))
    found = q.join(t, on, "left").groupBy(key).agg(
        F.max(F.coalesce((F.col("m") != "") & F.contains("body", F.col("m")), F.lit(False))).alias("exact"),
        F.max(F.coalesce(F.contains("body", F.col("probe")), F.lit(False))).alias("partial"),
    )
    return found.select(key, (F.col("exact") | F.col("partial")).alias("verified"), F.when(F.col("exact"), "exact").when(F.col("partial"), "partial").alias("how"))


def quote_pages(quotes: DataFrame, page_rows: DataFrame, key: str, quote: str, on: str) -> DataFrame:
    """``key, page_no``: the first page on which a quotation stands as a whole."""
    q = quotes.select(key, on, match_form(F.col(quote)).alias("m")).where("m <> ''")
    p = page_rows.select(on, "page_no", match_form(F.col("text")).alias("body"))
    return q.join(p, on).where(F.contains("body", F.col("m"))).groupBy(key).agg(F.min("page_no").alias("page_no"))


def quote_category(stored: Column, found: Column, has_text: Column) -> Column:
    """Outcome of a second look at a quotation."""
    was, now = F.coalesce(stored, F.lit(False)), F.coalesce(found, F.lit(False))
    return F.when(~has_text, "text missing").when(was & now, "confirmed").when(was & ~now, "regression").when(~was & now, "newly verified").otherwise("never verified")


def references(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, ref_no, raw, year, title, page``: entries ``[n] title, year, p. N.`` at the end of a text."""
    line = r"(?m)^\[(\d+)\] (.+)$"
    rows = df.where(F.col(text).isNotNull()).select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit(line), F.lit(0))).alias("l"))
    no, raw = F.regexp_extract("l", line, 1).cast("int"), F.trim(F.regexp_extract("l", line, 2))
    year = F.nullif(F.regexp_extract(raw, r"\b(1[5-9]\d\d|20\d\d)\b", 1), F.lit("")).cast("int")
    title = F.trim(F.regexp_extract(raw, r"^(.*?),\s+(?:1[5-9]\d\d|20\d\d)\b", 1))
    page = F.nullif(F.regexp_extract(raw, r"\bp\.\s*(\d+)", 1), F.lit("")).cast("int")
    return rows.select(key, no.alias("ref_no"), raw.alias("raw"), year.alias("year"), title.alias("title"), page.alias("page")).where("year is not null")


def bibliography_page(page_rows: DataFrame, key: str, least: int = 5) -> DataFrame:
    """``key, page_no, how``: where the references begin.

    The last page with a heading such as *Bibliographie*, else the page of the
    last third with most years, if it has ``least``.
    """
    lines = F.transform(F.split(fold(F.col("text")), r"\n"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r" ?: ?$", "")))
    years = F.size(F.regexp_extract_all("text", F.lit(r"\b(1[5-9]\d\d|20\d\d)\b"), F.lit(0)))
    p = page_rows.select(key, "page_no", F.exists(lines, lambda x: x.isin(HEADINGS)).alias("headed"), years.alias("years"))
    last = p.groupBy(key).agg(F.max("page_no").alias("last"))
    scored = p.join(last, key)
    late = F.col("page_no") > F.floor(F.col("last") * 2 / 3)
    got = scored.groupBy(key).agg(
        F.max(F.when(F.col("headed"), F.col("page_no"))).alias("by_heading"),
        F.max_by("page_no", F.when(late & (F.col("years") >= least), F.struct("years", (-F.col("page_no")).alias("first")))).alias("by_years"),
    )
    return got.where("by_heading is not null or by_years is not null").select(key, F.coalesce("by_heading", "by_years").alias("page_no"), F.when(F.col("by_heading").isNotNull(), "heading").otherwise("years").alias("how"))


def footnote_links(page_rows: DataFrame, key: str) -> DataFrame:
    """``key, page_no, kind, target``: urls and DOIs in footnotes.

    Lines that begin with a superscript or a number, and in the lower half of a
    page any line.
    """
    lines = F.split("text", r"\n")
    rows = page_rows.select(key, "page_no", F.size(lines).alias("n"), F.posexplode(lines).alias("i", "line"))
    mark = F.regexp("line", F.lit(r"^\s*(?:[¹²³⁴⁵⁶⁷⁸⁹⁰]+|\d{1,3}[.)]?)\s+\S"))
    near = rows.where(mark | (F.col("i") >= F.floor(F.col("n") / 2)))
    urls = F.regexp_extract_all("line", F.lit(r"https?://[^\s)\"'<>\]]+"), F.lit(0))
    dois = F.regexp_extract_all("line", F.lit(r"\b10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"), F.lit(0))
    tidy = lambda a: F.transform(a, lambda x: F.regexp_replace(x, r"[.,);]+$", ""))
    hits = F.concat(F.transform(tidy(urls), lambda x: F.struct(F.lit("url").alias("kind"), x.alias("target"))), F.transform(tidy(dois), lambda x: F.struct(F.lit("doi").alias("kind"), F.concat(F.lit("https://doi.org/"), x).alias("target"))))
    return near.select(key, "page_no", F.explode(hits).alias("h")).select(key, "page_no", "h.*").distinct()


def year_evidence(text: Column, words: str = "publi|édit|edit|impr|paru|copyright|©", around: int = 30) -> Column:
    """Excerpts of a text with a keyword close to a year."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?iu)[^\n]{{0,{around}}}(?:{words})[^\n]{{0,{around}}}\b(?:1[5-9]|20)\d\d\b"), F.lit(0))
