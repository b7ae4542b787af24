import pytest
from pyspark.sql import functions as F

from quernstone.functions.dateparse import readings
from quernstone.operators.timestamps import format_mixture, normalise_timestamps, parse_values

CASES = {
    "2025-11-18_19-04": "2025-11-18T18:04:00Z",
    "cleanup_2026-08-04_05-50": "2026-08-04T03:50:00Z",
    "2025-11-14T04:07:24.682885+01:00": "2025-11-14T03:07:24Z",
    "2025-11-25T18:40:18.829897-03:30": "2025-11-25T22:10:18Z",
    "31/07/2025 06:43 PM": "2025-07-31T16:43:00Z",
    "04/10/2025": "2025-10-04",
    "1783602507281": "2026-07-09T13:08:27Z",
    "1791277478": "2026-10-06T09:04:38Z",
    "D:20120722091048+05'45": "2012-07-22T03:25:48Z",
    "D:20050203022014Z00'00'": "2005-02-03T02:20:14Z",
    "D:20250607": "2025-06-07",
    "D:200504232117": "2005-04-23T19:17:00Z",
    "1er novembre 1925": "1925-11-01",
    "23 de novembro de 1952": "1952-11-23",
    "14. April 2020": "2020-04-14",
    "April 1985": "1985-04",
    "July 25, 2018": "2018-07-25",
    " 1914 ": "1914",
    "08/1926": "1926-08",
    "19-Feb-2017": "2017-02-19",
    "Mon, 19 Apr 1999 20:21:47 GMT": "1999-04-19T20:21:47Z",
    "Sun Oct 27 02:52:51 2002": "2002-10-27T00:52:51Z",  # occurs twice: the first one, still summer time
    "2026-03-29 02:30:00": "2026-03-29T01:30:00Z",  # skipped: the offset before the change
    "17 Sep 2026 17:04:34 CEST": "2026-09-17T15:04:34Z",
    "11 mars 2026 à 9h49": "2026-03-11T08:49:00Z",
}


@pytest.mark.parametrize("raw", CASES)
def test_one_reading(raw):
    assert CASES[raw] in [v for _, v in readings(raw)]


@pytest.mark.parametrize("raw", ["", None, "1930-1937", "1963 ?", "c. 2023", "vers 1890", "s.d.", "XIXe siècle", "D:00000000000000", "31/04/2025", "2025-02-30", "0000-00-00 00:00:00", "25:61", "x" * 5000])
def test_no_reading(raw):
    assert readings(raw) == []


def test_day_first_is_a_choice():
    assert [f for f, _ in readings("03/04/2025")] == ["day_first"]
    assert {v for _, v in readings("03/04/2025", day_first=None)} == {"2025-04-03", "2025-03-04"}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id string, source string, when string, raw string, status string")


def test_mixture_decides_by_source(spark):
    rows = [(str(i), "day", f"{13 + i % 15}/0{1 + i % 9}/2024", "", "") for i in range(40)] + [(str(100 + i), "month", f"0{1 + i % 9}/{13 + i % 15}/2024", "", "") for i in range(40)]
    rows += [("a", "day", "03/04/2024", "", ""), ("b", "month", "03/04/2024", "", "")]
    got = {r["rec_key"]: r for r in normalise_timestamps(_frame(spark, rows), "id", {"when": F.col("when")}, "source", day_first=None).where("rec_key in ('a', 'b')").collect()}
    assert got["a"]["utc_value"] == "2024-04-03" and got["b"]["utc_value"] == "2024-03-04"


def test_ambiguity_is_marked(spark):
    rows = [(str(i), "s", "03/04/2024", "", "") for i in range(4)]
    got = normalise_timestamps(_frame(spark, rows), "id", {"when": F.col("when")}, "source", day_first=None).collect()
    assert {r["status"] for r in got} == {"ambiguous"} and {r["utc_value"] for r in got} == {None}


def test_edges(spark):
    rows = [("1", None, "2024", "x", "y"), ("1", None, "2024", "x", "y"), (None, "s", "2024-05", "x", "y"), ("2", "s", None, "x", "y"), ("3", "s", "  ", "x", "y"), ("4", "s", "z" * 100000, "x", "y")]
    got = normalise_timestamps(_frame(spark, rows), "id", {"when": F.col("when")}, "source").collect()
    assert sorted((r["rec_key"] or "", r["status"]) for r in got) == [("", "ok"), ("1", "ok"), ("1", "ok"), ("4", "unreadable")]
    empty = _frame(spark, []).where("false")
    assert normalise_timestamps(empty, "id", {"when": F.col("when")}, "source").count() == 0
    assert format_mixture(parse_values(empty, "id", {"when": F.col("when")}, "source")).count() == 0


def test_query(spark, sf):
    import __spark_entry__ as e

    rows = e.queries()["p6_found"](spark, sf).collect()
    assert rows and all(r["utc_value"] for r in rows)
    assert len({(r["id"], r["field"]) for r in rows}) == len(rows)
