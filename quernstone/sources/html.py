"""Links to documents in HTML pages, one and two levels deep."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.rules import DOCUMENT_FORMATS

# Elements whose text is the context of a link, and those outside of the editorial part.
_BLOCKS = {"p", "li", "div", "td", "article"}
_ASIDE = {"aside", "nav", "footer", "header"}

LINK_SCHEMA = "page_url string, page_title string, url string, filename string, extension string, link_text string, context string, pos int, editorial boolean"


class _Links(HTMLParser):
    """Anchors with their text and the text of the block around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title = ""
        self.found: list[dict] = []
        self._in_title = False
        self._open: list[dict] = []
        self._blocks: list[list[str]] = []
        self._stack: list[str] = []
        self._waiting: list[list[dict]] = [[]]
        self.has_scope = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "title":
            self._in_title = True
        if tag in _BLOCKS:
            self._blocks.append([])
            self._waiting.append([])
        if tag in _ASIDE or tag in ("article", "main") or a.get("role") == "article":
            self._stack.append(tag if tag in _ASIDE else "scope")
            self.has_scope |= tag not in _ASIDE
        elif tag in ("section", "div") and self._stack:
            self._stack.append("")
        if tag == "a" and a.get("href"):
            self._open.append({"href": a["href"], "text": [], "inside": "scope" in self._stack, "aside": bool(_ASIDE & set(self._stack))})

    def handle_data(self, data: str) -> None:
        if self._in_title:
            self.title += data
        for link in self._open:
            link["text"].append(data)
        for b in self._blocks:
            b.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag == "title":
            self._in_title = False
        if tag == "a" and self._open:
            link = self._open.pop()
            self.found.append(link)
            self._waiting[-1].append(link)
        if tag in _BLOCKS and self._blocks:
            text = _flat("".join(self._blocks.pop()))
            for link in self._waiting.pop() if len(self._waiting) > 1 else []:
                link["context"] = text[:400]
        if self._stack and (tag in _ASIDE or tag in ("article", "main", "section", "div")):
            self._stack.pop()


def _flat(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def parse_page(url: str, html: str | None) -> list[tuple]:
    """Rows of :data:`LINK_SCHEMA` for every anchor with an absolute address."""
    if not html:
        return []
    p = _Links()
    try:
        p.feed(html)
        p.close()
    except Exception:  # broken markup: keep what was found
        pass
    out = []
    for i, link in enumerate(p.found):
        target = urljoin(url or "", link["href"].strip())
        parts = urlsplit(target)
        if parts.scheme not in ("http", "https"):
            continue
        name = parts.path.rstrip("/").rpartition("/")[2]
        ext = name.rpartition(".")[2].lower() if "." in name else ""
        inside = not link["aside"] and (link["inside"] or not p.has_scope)
        out.append((url, _flat(p.title), target, name, ext, _flat("".join(link["text"])), link.get("context", ""), i, inside))
    return out


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """All links of the pages; broken or empty pages have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in LINK_SCHEMA.split(", ")]
        for pdf in batches:
            yield pd.DataFrame([r for u, h in zip(pdf["url"], pdf["html"], strict=True) for r in parse_page(u, h)], columns=cols)

    return pages.select(F.col(url).alias("url"), F.col(html).alias("html")).mapInPandas(run, LINK_SCHEMA)


def document_links(links: DataFrame) -> DataFrame:
    """Links to documents, each address once: the first anchor of its page counts."""
    w = Window.partitionBy("page_url", "url").orderBy("pos")
    return links.where(F.col("extension").isin(DOCUMENT_FORMATS)).withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def deep_links(pages: DataFrame, links: DataFrame, roots: DataFrame, max_pages: int = 30) -> DataFrame:
    """Document links of the root pages and of the pages of the same host they point to.

    Level two is a join of the links with the pages at hand. ``max_pages`` per
    root is the crawl budget of the feature. The same file under several
    addresses is listed once, with its longest context.
    """
    host = lambda c: F.lower(F.regexp_extract(c, r"^https?://([^/?#]+)", 1))
    start = roots.select(F.col("url").alias("page_url")).distinct()
    first = links.join(start, "page_url", "left_semi").where("editorial")
    level = first.where((host(F.col("url")) == host(F.col("page_url"))) & ~F.col("extension").isin(DOCUMENT_FORMATS))
    w = Window.partitionBy("page_url").orderBy("pos")
    visits = level.withColumn("r", F.row_number().over(w)).where(F.col("r") <= max_pages).select(F.col("page_url").alias("root"), F.col("url").alias("page_url")).distinct()
    second = links.join(visits, "page_url").where("editorial").drop("root")
    both = document_links(first.unionByName(second))
    best = Window.partitionBy("filename", F.substring("link_text", 1, 80)).orderBy(F.desc(F.length("context")), "page_url", "pos")
    return both.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def outside_links(links: DataFrame) -> DataFrame:
    """Links that leave the host of their page, each address once per page."""
    host = lambda c: F.lower(F.regexp_extract(c, r"^https?://(?:www\.)?([^/?#:]+)", 1))
    return links.where((host(F.col("url")) != host(F.col("page_url"))) & (F.length("link_text") > 0)).dropDuplicates(["page_url", "url"]).select("page_url", "url", host(F.col("url")).alias("domain"), "link_text")


def probe(pages: DataFrame, url: str = "url", html: str = "html", least: int = 5) -> DataFrame:
    """``url, documents, status, hint``: what a page promises as a source."""
    n = F.regexp_count(F.coalesce(F.col(html), F.lit("")), F.lit(r"(?i)href=[\"'][^\"']+\.(pdf|epub|odt|txt)\b"))
    body = F.lower(F.coalesce(F.col(html), F.lit("")))
    hint = F.when(F.contains(body, F.lit("opds")), "opds").when(F.contains(body, F.lit("<rss")) | F.contains(body, F.lit("application/rss+xml")), "rss").when(F.contains(body, F.lit("wp-content")), "wp_rest").otherwise("html")
    return pages.select(F.col(url).alias("url"), n.alias("documents"), F.when(n >= least, "validated").when(n > 0, "to_review").otherwise("empty").alias("status"), hint.alias("hint"))
