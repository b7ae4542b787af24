"""Exports and writers: bibliographies, feeds, sitemaps, published catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import bib_escape, nonblank, xml_escape


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"  {name} = {{"), value, F.lit("}")))


def bibtex(id_: Column, title: Column, author: Column, year: Column, url: Column, doi: Column, isbn: Column, note: Column, keywords: Column, kind: Column | None = None) -> Column:
    """One entry; empty fields are left out and years are never guessed."""
    text = lambda c: nonblank(bib_escape(c))
    lines = F.concat_ws(",\n", _field("title", F.coalesce(text(title), F.lit("Sans titre"))), _field("author", text(author)), _field("year", nonblank(year)), _field("url", nonblank(url)), _field("doi", nonblank(doi)), _field("isbn", nonblank(isbn)), _field("abstract", text(note)), _field("keywords", nonblank(keywords)))
    return F.concat(F.lit("@"), kind if kind is not None else F.lit("misc"), F.lit("{"), id_, F.lit(",\n"), lines, F.lit("\n}"))


def ris(title: Column, author: Column, year: Column, url: Column, doi: Column, note: Column, keywords: Column) -> Column:
    line = lambda tag, c: F.when(nonblank(c).isNotNull(), F.concat(F.lit(f"{tag}  - "), F.trim(c)))
    words = F.array_join(F.transform(F.coalesce(keywords, F.array().cast("array<string>")), lambda k: F.concat(F.lit("KW  - "), k)), "\n")
    return F.concat_ws("\n", F.lit("TY  - GEN"), F.concat(F.lit("TI  - "), F.coalesce(nonblank(title), F.lit("Sans titre"))), line("AU", author), line("PY", year), line("UR", url), line("DO", doi), line("AB", note), F.nullif(words, F.lit("")), F.lit("ER  - "))


def csl_json(id_: Column, title: Column, author: Column, year: Column, url: Column, doi: Column) -> Column:
    """A CSL item as JSON; the last word of an author is the family name."""
    a = nonblank(author)
    person = F.struct(F.nullif(F.regexp_extract(a, r"^(.*) (\S+)$", 1), F.lit("")).alias("given"), F.nullif(F.regexp_extract(a, r"^(.*) (\S+)$", 2), F.lit("")).alias("family"), F.when(~F.contains(a, F.lit(" ")), a).alias("literal"))
    issued = F.when(nonblank(year).isNotNull(), F.struct(F.array(F.array(F.substring(year, 1, 4).try_cast("int"))).alias("date-parts")))
    return F.to_json(F.struct(id_.alias("id"), F.lit("document").alias("type"), F.coalesce(nonblank(title), F.lit("Sans titre")).alias("title"), nonblank(url).alias("URL"), F.when(a.isNotNull(), F.array(person)).alias("author"), issued.alias("issued"), nonblank(doi).alias("DOI")))


def rss_item(title: Column, url: Column, note: Column, day: Column) -> Column:
    """RSS item; ``day`` is a timestamp, written as RFC 822."""
    tag = lambda n, c: F.concat(F.lit(f"<{n}>"), xml_escape(c), F.lit(f"</{n}>"))
    return F.concat(F.lit("<item>"), tag("title", title), tag("link", url), tag("description", note), F.coalesce(F.concat(F.lit("<pubDate>"), F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate>")), F.lit("")), F.lit("</item>"))


def sitemap_url(loc: Column, lastmod: Column) -> Column:
    return F.concat(F.lit("<url><loc>"), xml_escape(loc), F.lit("</loc><lastmod>"), lastmod, F.lit("</lastmod></url>"))


def json_ld(title: Column, summary: Column, lang: Column, url: Column, pages: Column) -> Column:
    """Description of a record for search engines; 60 pages or more make a book."""
    kind = F.when(pages >= 60, "Book").otherwise("CreativeWork")
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), kind.alias("@type"), title.alias("name"), nonblank(summary).alias("description"), nonblank(lang).alias("inLanguage"), url.alias("url")))


# Fields that tell how a record was made; they are not published.
PROVENANCE = ["relevance_notes", "error"]


def published(df: DataFrame, keep: Column) -> DataFrame:
    """Records to publish, without provenance and with blank texts as null."""
    out = df.where(keep)
    if "enrichment" in out.columns:
        out = out.withColumn("enrichment", F.when(F.col("enrichment").isNotNull(), F.col("enrichment").dropFields(*PROVENANCE)))
    return out.drop("context_seen", "ingested_at")


def write_swapped(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table as a whole: write beside it, then rename.

    A failed write leaves the old table; readers see one of the two.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    staged, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(staged)
    fs = Path(path).getFileSystem(conf)
    had = fs.exists(Path(path))
    if had:
        fs.rename(Path(path), Path(old))
    fs.rename(Path(staged), Path(path))
    if had:
        fs.delete(Path(old), True)


def write_lines(df: DataFrame, line: str, path: str) -> None:
    """One text line per row, in as many files as there are partitions."""
    df.select(F.col(line)).write.mode("overwrite").text(path)


def markdown_table(rows: list, columns: list[str]) -> str:
    """Rows of a small report as a Markdown table."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    head = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(head + ["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows])
