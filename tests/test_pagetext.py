import os
import subprocess
import sys

from pyspark.sql import functions as F

from quernstone.functions import pagetext
from quernstone.operators import audit


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_addresses(spark):
    df = spark.createDataFrame([("http://h/a b/é%20c.pdf?x=1 2",), (None,), ("http://[bad",)], "u string")
    assert [r[0] for r in df.select(pagetext.encode_url("u")).collect()] == ["http://h/a%20b/%C3%A9%20c.pdf?x=1%202", None, "http://[bad"]
    assert df.select(pagetext.encode_url_twice("u")).first()[0].startswith("http://h/a%20b/%C3%A9%2520c.pdf")


def test_titles(spark):
    t = lambda *v: one(spark, pagetext.display_title(*[F.lit(x).cast("string") for x in v]))
    assert t("A &amp; B", "l", "f.pdf", "id") == "A & B" and t(" ", "&#233;t", "f.pdf", "id") == "ét" and t(None, None, "a_b-c.pdf", "id") == "a b c" and t(None, "", None, "id") == "id"


def test_pages(spark):
    page = "Le titre\nPar Auteur\nJanvier 1999\nLes bergers du haut pays défendent les landes communes.\nPublic Disclosure Authorized\nLe titre\n-----\nFin courte"
    assert one(spark, pagetext.denoise(F.lit(page), F.lit("Le titre"))) == "Les bergers du haut pays défendent les landes communes.\nFin courte"
    assert one(spark, pagetext.denoise(F.lit(None).cast("string"), F.lit(None).cast("string"))) == ""
    assert one(spark, pagetext.is_cover(F.lit("Un titre\nUn auteur"))) and not one(spark, pagetext.is_cover(F.lit("\n".join(["une ligne de texte avec assez de mots dedans"] * 4))))
    assert one(spark, pagetext.banner_only(F.lit("HAL is a multi-disciplinary open access archive x"))) and one(spark, pagetext.banner_only(F.lit(None).cast("string"))) and not one(spark, pagetext.banner_only(F.lit("texte")))
    assert not one(spark, pagetext.readable(F.lit("[p.1] " * 60))) and one(spark, pagetext.readable(F.lit("a" * 200)))
    assert one(spark, pagetext.stub_summary(F.lit("court\n" + "l" * 41 + "\n" + "m" * 600))) == ("l" * 41 + " " + "m" * 600)[:500]


def test_candidates(spark):
    c = lambda *v: one(spark, audit.candidate_confidence(*[F.lit(x).cast("string") for x in v]))
    assert c("2001-02", "", "fait en 2001") == "high" and c("2001", "2001", "sans") == "medium" and c("2001", "", "") == "low" and c("2001", "", "en 1950") == "conflict" and c("", "", "1950") == "none"


def test_library_does_without_llm():
    code = "import sys; sys.modules['quernstone.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and 'p1_found' not in q and 'p6_found' in q; assert set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_queries_have_sql_of_their_own():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
