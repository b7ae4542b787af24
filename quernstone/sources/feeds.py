"""RSS, Atom and OPDS feeds, JSON services, run reports and dimensions.

Each reader takes files or a DataFrame of payloads and gives the columns of a
hit: ``url, filename, extension, link_text, context, source_url, src_meta``.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from datetime import UTC
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HIT = "url string, filename string, extension string, link_text string, context string, source_url string, src_meta map<string,string>"
_COLS = ["url", "filename", "extension", "link_text", "context", "source_url", "src_meta"]

# Media types of acquisition links, best first.
_MEDIA = [("application/pdf", "pdf"), ("application/epub+zip", "epub"), ("text/plain", "txt")]


def _plain(s: str | None, most: int = 400) -> str:
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", s or "")).strip()[:most]


def _day(raw: str | None) -> str:
    raw = (raw or "").strip()
    try:
        return parsedate_to_datetime(raw).astimezone(UTC).date().isoformat()
    except (TypeError, ValueError):
        m = re.match(r"\d{4}(-\d\d(-\d\d)?)?", raw)
        return m[0] if m else ""


def _name(url: str) -> str:
    return re.sub(r"[?#].*$", "", url).rstrip("/").rpartition("/")[2]


def _local(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


def _children(e: ET.Element, name: str) -> list[ET.Element]:
    return [c for c in e if _local(c.tag) == name]


def _text(e: ET.Element, *names: str) -> str:
    for n in names:
        for c in _children(e, n):
            if (t := "".join(c.itertext()).strip()):
                return t
    return ""


def _tree(payload: str | None) -> ET.Element | None:
    try:
        return ET.fromstring(payload or "")
    except ET.ParseError:
        return None


def parse_rss(source: str, payload: str, max_items: int = 50) -> list[dict]:
    """Items of an RSS or entries of an Atom feed; its pages are html, no documents."""
    root = _tree(payload)
    if root is None:
        return []
    out = []
    for e in [x for x in root.iter() if _local(x.tag) in ("item", "entry")][:max_items]:
        link = _text(e, "link") or next((c.get("href", "") for c in _children(e, "link")), "")
        if link:
            out.append({"url": link, "filename": _name(link), "extension": "html", "link_text": _plain(_text(e, "title")), "context": _plain(_text(e, "description", "summary", "content", "encoded")), "source_url": source, "src_meta": {"pubdate": _day(_text(e, "pubdate", "published", "updated", "date"))}})
    return out


def parse_opds(source: str, payload: str) -> list[dict]:
    """Acquisition entries of an OPDS feed with their best media type."""
    root = _tree(payload)
    out = []
    for e in _children(root, "entry") if root is not None else []:
        links = [(c.get("type", ""), c.get("href", ""), c.get("rel", "")) for c in _children(e, "link")]
        links = [x for x in links if "acquisition" in x[2] or x[0] in dict(_MEDIA)]
        best = next(((h, x) for m, x in _MEDIA for t, h, _ in links if t.startswith(m)), None)
        if best is None:
            ident = _text(e, "id")
            if not re.match(r"https?://", ident):
                continue
            best = (ident.rstrip("/") + ".pdf", "pdf")
        people = [_text(a, "name") for a in _children(e, "author")]
        out.append({"url": best[0], "filename": _name(best[0]), "extension": best[1], "link_text": _plain(_text(e, "title")), "context": _plain("; ".join(p for p in people if p) + " " + _text(e, "summary", "content")), "source_url": source, "src_meta": {"date": _day(_text(e, "published", "issued", "updated")), "lang": _text(e, "language"), "publisher": _text(e, "publisher")}})
    return out


def next_page(payload: str) -> str:
    root = _tree(payload)
    return next((c.get("href", "") for c in _children(root, "link") if c.get("rel") == "next"), "") if root is not None else ""


def _first(v) -> str:
    if isinstance(v, list):
        v = v[0] if v else ""
    return "" if v is None else str(v)


def _json(payload: str | None):
    try:
        return json.loads(payload or "")
    except ValueError:
        return None


def parse_archive(source: str, payload: str, most: int = 50) -> list[dict]:
    """Answers of a library search: ``response.docs`` or ``response.results.docs``."""
    data = _json(payload)
    resp = data.get("response", data) if isinstance(data, dict) else {}
    docs = (resp.get("docs") or (resp.get("results") or {}).get("docs") or []) if isinstance(resp, dict) else []
    out, seen = [], set()
    for d in docs:
        i = _first(d.get("identifier"))
        if i and i not in seen and len(out) < most:
            seen.add(i)
            out.append({"url": f"https://archive.example/download/{i}/{i}.pdf", "filename": f"{i}.pdf", "extension": "pdf", "link_text": _first(d.get("title")), "context": _plain(_first(d.get("description"))), "source_url": source, "src_meta": {"date": _first(d.get("date"))[:10], "lang": _first(d.get("language")), "publisher": _first(d.get("publisher"))}})
    return out


def parse_repository(source: str, payload: str) -> list[dict]:
    """Answers of an open repository: records without a main file are left out."""
    data = _json(payload) or {}
    out = []
    for d in (data.get("response") or {}).get("docs") or []:
        url = _first(d.get("fileMain_s"))
        if not url:
            continue
        uri = _first(d.get("uri_s"))
        hal = re.search(r"(?:hal|tel|halshs)-\d+", uri)
        people = "; ".join(d.get("authFullName_s") or []) if isinstance(d.get("authFullName_s"), list) else _first(d.get("authFullName_s"))
        out.append({"url": url, "filename": (hal[0] if hal else _name(url).removesuffix(".pdf")) + ".pdf", "extension": "pdf", "link_text": _first(d.get("title_s")), "context": _plain(f"{people} {_first(d.get('abstract_s'))}"), "source_url": source, "src_meta": {"date": _first(d.get("producedDate_s")), "lang": _first(d.get("language_s")), "doi": _first(d.get("doiId_s")), "hal_id": hal[0] if hal else ""}})
    return out


def parse_media(source: str, payload: str) -> list[dict]:
    """A page of a media listing (a JSON array)."""
    data = _json(payload)
    out = []
    for d in data if isinstance(data, list) else []:
        url = _first(d.get("source_url"))
        ext = _name(url).rpartition(".")[2].lower()
        if url and ext in ("pdf", "epub", "odt", "txt"):
            field = lambda k: _plain((d.get(k) or {}).get("rendered") if isinstance(d.get(k), dict) else d.get(k))  # noqa: B023, E731
            out.append({"url": url, "filename": _name(url), "extension": ext, "link_text": field("title"), "context": field("caption") or field("description"), "source_url": source, "src_meta": {"date": _first(d.get("date"))[:10]}})
    return out


#: Source types and their parsers; more can be registered.
PARSERS: dict[str, Callable[[str, str], list[dict]]] = {"rss": parse_rss, "opds": parse_opds, "archive_org": parse_archive, "hal": parse_repository, "wp_rest": parse_media}


def register(kind: str, parser: Callable[[str, str], list[dict]]) -> None:
    PARSERS[kind] = parser


def _html(source: str, payload: str) -> list[dict]:
    from quernstone.functions.rules import DOCUMENT_FORMATS
    from quernstone.sources.html import parse_page

    rows, seen = [], set()
    for _, _, url, name, ext, text, context, _, _ in parse_page(source, payload):
        if ext in DOCUMENT_FORMATS and url not in seen:
            seen.add(url)
            rows.append({"url": url, "filename": name, "extension": ext, "link_text": text, "context": context, "source_url": source, "src_meta": {}})
    return rows


def dispatch(payloads: DataFrame, kind: str = "type", url: str = "url", payload: str = "payload") -> DataFrame:
    """Hits of all payloads by their source type; ``html`` where it is blank, none for unknown types.

    Broken payloads give no hit. Each payload is parsed whole, in one row.
    """
    parsers = dict(PARSERS) | {"html": _html}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, u, p in zip(pdf["kind"], pdf["url"], pdf["payload"], strict=True):
                parser = parsers.get((k or "").strip() or "html")
                if parser and p:
                    rows.extend(parser(u, p))
            yield pd.DataFrame(rows, columns=_COLS)

    return payloads.select(F.col(kind).alias("kind"), F.col(url).alias("url"), F.col(payload).alias("payload")).mapInPandas(run, HIT)


def first_per_url(hits: DataFrame, order: str = "source_url") -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("url").orderBy(order, "filename", "link_text")
    return hits.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


REPORT = (
    "date string, sources_scanned int, documents_found int, documents_scored int, documents_downloaded int, interrupted string,"
    " results array<struct<url:string,filename:string,format:string,source:string,score:int,raison:string,downloaded:boolean,saved_as:string,link_text:string,context_seen:string,"
    "download_status:string,content_hash:string,bib:struct<doc_date:string,lang:string,editeur:string,doi:string,isbn:string,hal_id:string>>>"
)


def run_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per result of the run reports under ``path``; broken files are skipped."""
    raw = spark.read.schema(REPORT + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return raw.where("_corrupt is null").select("date", F.explode("results").alias("r")).select("date", "r.*")


def catalogue(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of a JSON catalogue ``{"docs": {id: record}}``; ``record`` is their schema."""
    raw = spark.read.schema(f"docs map<string, struct<{record}>>").option("multiLine", True).json(path)
    return raw.select(F.explode("docs").alias("doc_id", "d")).select("doc_id", "d.*")


def string_keys(spark: SparkSession, entries: dict, value: str = "value") -> DataFrame:
    """A small dimension out of a parsed mapping; keys of digits only become text."""
    return spark.createDataFrame([(str(k), None if v is None else str(v)) for k, v in entries.items()], f"id string, {value} string")


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, valid``: files with the PDF signature and 100 bytes or more."""
    df = spark.read.format("binaryFile").load(path)
    return df.select("path", "length", ((F.substring("content", 1, 4) == F.lit(b"%PDF")) & (F.col("length") >= 100)).alias("valid"))


def issue_fields(issues: DataFrame, body: str, fields: list[str]) -> DataFrame:
    """Fields ``**name**: value`` of issue texts, and the first url of the text."""
    t = F.coalesce(F.col(body), F.lit(""))
    cols = [F.nullif(F.trim(F.regexp_extract(t, rf"(?im)^\W*{f}\W*:\s*(.+)$", 1)), F.lit("")).alias(f) for f in fields]
    return issues.select("*", *cols, F.nullif(F.regexp_extract(t, r"https?://[^\s)>\]]+", 0), F.lit("")).alias("first_url"))
