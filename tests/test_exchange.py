"""Parsers, exports, writers and streams on small fixtures."""

import json

from pyspark.sql import functions as F

from quernstone.sources import feeds, html, sinks
from quernstone.streaming import flows

PAGE = """<html><head><title>T &amp; t</title></head><body><nav><a href="/n.pdf">nav</a></nav>
<article><p>Voir <a href="doc/a.pdf">le <b>texte</b></a> ici.</p><li><a href="doc/a.pdf">encore</a></li><a href="/page2">suite</a><a href="mailto:x@y">m</a></article></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame([("https://h.example/x/", PAGE), ("https://h.example/page2", '<p><a href="b.EPUB">b</a> long contexte</p>'), ("https://h.example/bad", None)], "url string, html string")
    links = html.page_links(pages)
    docs = {r["url"]: r for r in html.document_links(links).collect()}
    assert set(docs) == {"https://h.example/n.pdf", "https://h.example/x/doc/a.pdf", "https://h.example/b.EPUB"}
    a = docs["https://h.example/x/doc/a.pdf"]
    assert (a["link_text"], a["context"], a["page_title"], a["editorial"]) == ("le texte", "Voir le texte ici.", "T & t", True)
    assert not docs["https://h.example/n.pdf"]["editorial"]
    deep = html.deep_links(pages, links, spark.createDataFrame([("https://h.example/x/",)], "url string"))
    assert {r["filename"] for r in deep.collect()} == {"a.pdf", "b.EPUB"}
    assert html.probe(pages).where("url like '%/x/'").first()["status"] == "to_review"


def test_feeds(spark):
    rss = "<rss><channel><item><title>A</title><link>http://x/a</link><description>&lt;p&gt;d&lt;/p&gt;</description><pubDate>Mon, 19 Apr 1999 20:21:47 GMT</pubDate></item></channel></rss>"
    opds = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>B</title><author><name>N</name></author><link rel="http://opds-spec.org/acquisition" type="application/epub+zip" href="http://x/b.epub"/><link rel="http://opds-spec.org/acquisition" type="application/pdf" href="http://x/b.pdf"/></entry><link rel="next" href="http://x/2"/></feed>'
    arch = json.dumps({"response": {"results": {"docs": [{"identifier": "i", "title": ["C"]}, {"identifier": "i"}]}}})
    hal = json.dumps({"response": {"docs": [{"fileMain_s": "http://x/h.pdf", "uri_s": "http://h/hal-0123456", "title_s": ["D"], "language_s": "fr"}, {"title_s": "no file"}]}})
    wp = json.dumps([{"source_url": "http://x/w.pdf", "title": {"rendered": "<i>W</i>"}, "date": "2020-01-02T00:00:00"}, {"source_url": "http://x/w.png"}])
    rows = [("rss", "u1", rss), ("opds", "u2", opds), ("archive_org", "u3", arch), ("hal", "u4", hal), ("wp_rest", "u5", wp), ("", "http://p/", PAGE), ("strange", "u7", "x"), ("rss", "u8", "<broken"), (None, "u9", None)]
    got = {r["link_text"]: r for r in feeds.dispatch(spark.createDataFrame(rows, "type string, url string, payload string")).collect()}
    assert got["A"]["src_meta"]["pubdate"] == "1999-04-19" and got["A"]["context"] == "d"
    assert got["B"]["url"] == "http://x/b.pdf" and feeds.next_page(opds) == "http://x/2"
    assert got["C"]["filename"] == "i.pdf" and got["D"]["src_meta"]["hal_id"] == "hal-0123456" and got["W"]["src_meta"]["date"] == "2020-01-02"
    assert "le texte" in got and len([r for r in got if r]) == 7


def test_files(spark, tmp_path):
    (tmp_path / "run_1.json").write_text(json.dumps({"date": "r1", "results": [{"url": "u", "score": 5, "bib": {"lang": "fr"}}]}))
    (tmp_path / "run_2.json").write_text("{broken")
    got = feeds.run_reports(spark, str(tmp_path / "run_*.json")).collect()
    assert [(r["date"], r["url"], r["score"], r["bib"]["lang"]) for r in got] == [("r1", "u", 5, "fr")]
    (tmp_path / "cat.json").write_text(json.dumps({"docs": {"00ab": {"title": "x"}, "13352415": {"title": None}}}))
    assert sorted(r["doc_id"] for r in feeds.catalogue(spark, str(tmp_path / "cat.json"), "title: string").collect()) == ["00ab", "13352415"]
    assert feeds.string_keys(spark, {13352415: "reason"}).first()["id"] == "13352415"
    pdfs = tmp_path / "pdf"
    pdfs.mkdir()
    (pdfs / "a.pdf").write_bytes(b"%PDF-1.4" + b"x" * 200)
    (pdfs / "b.pdf").write_bytes(b"%PDF")
    assert sorted(r["valid"] for r in feeds.pdf_files(spark, str(pdfs)).collect()) == [False, True]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 'T {x}\\ "q"', None, "1999", "http://u?a&b")], "id string, title string, author string, year string, url string")
    none = F.lit(None).cast("string")
    b = df.select(sinks.bibtex(F.col("id"), F.col("title"), F.col("author"), F.col("year"), F.col("url"), none, none, none, none)).first()[0]
    assert b == '@misc{a,\n  title = {T (x) "q"},\n  year = {1999},\n  url = {http://u?a&b}\n}'
    c = json.loads(df.select(sinks.csl_json(F.col("id"), F.col("title"), F.lit("Jean de La Tour"), F.col("year"), F.col("url"), none)).first()[0])
    assert c["author"] == [{"given": "Jean de La", "family": "Tour"}] and c["issued"] == {"date-parts": [[1999]]} and "DOI" not in c
    x = df.select(sinks.rss_item(F.col("title"), F.col("url"), F.lit("<n>"), F.lit(None).cast("timestamp"))).first()[0]
    assert x == "<item><title>T {x}\\ &quot;q&quot;</title><link>http://u?a&amp;b</link><description>&lt;n&gt;</description></item>"
    p = str(tmp_path / "t")
    sinks.write_swapped(df, p)
    sinks.write_swapped(df.unionAll(df), p)
    assert spark.read.parquet(p).count() == 2 and len(list(tmp_path.iterdir())) == 1
    assert sinks.markdown_table(df.collect(), ["id", "author"]) == "| id | author |\n|---|---|\n| a |  |"


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "cat")
    rows = [("s", "2026-01-01 00:00:00", True, 2), ("s", "2026-01-02 00:00:00", True, 1), ("s", "2026-01-03 00:00:00", True, None), ("t", "2026-01-01 00:00:00", False, 0)]
    spark.createDataFrame(rows, "label string, at string, ok boolean, found int").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("label string, at string, ok boolean, found int").parquet(src)
    q = flows.fetch_state(stream).writeStream.outputMode("update").format("memory").queryName("state").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["label"]: (r["failures"], r["low_runs"], r["interval_days"]) for r in spark.sql("select * from state").collect()}
    assert got == {"s": (0, 3, 14), "t": (1, 0, 7)}
    from tests.test_core import CAT, RUN

    sinks.write_swapped(spark.createDataFrame([], CAT), out)
    rep = str(tmp_path / "rep")
    spark.createDataFrame([("b", "r1", "s", "v", 6, 2, "tract", "2001", "es", True, "b.pdf", "B")], RUN).write.parquet(rep)
    q = flows.upsert_catalogue(spark.readStream.schema(RUN).parquet(rep), out, str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert [(r["id"], r["score_final"]) for r in spark.read.parquet(out).collect()] == [("b", 2)]
