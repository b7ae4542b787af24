"""Discovery: link ranking, abstracts, identifiers, lookups, new-source flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.text import nonblank


def unknown_only(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key, without case and blanks, is not known; rows without key pass."""
    k = F.lower(F.trim(F.col(key)))
    seen = known.select(F.lower(F.trim(F.col(key))).alias("__k")).where("__k is not null").distinct()
    return found.withColumn("__k", k).join(seen, "__k", "left_anti").drop("__k")


def unknown_records(hits: DataFrame, catalog: DataFrame, ids: list[Column]) -> DataFrame:
    """Hits none of whose possible ids is in the catalogue."""
    h = hits.withColumn("__h", F.monotonically_increasing_id()).withColumn("__ids", F.array(*ids))
    hit = h.select("__h", F.explode("__ids").alias("id")).join(catalog.select("id").distinct(), "id").select("__h").distinct()
    return h.join(hit, "__h", "left_anti").drop("__h", "__ids")


def rebuild_abstract(df: DataFrame, key: str, inverted: str) -> DataFrame:
    """Text out of a map from words to positions."""
    words = df.select(key, F.explode(inverted).alias("w", "ps")).select(key, "w", F.explode("ps").alias("p"))
    ordered = words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("p", "w"))).alias("l"))
    return ordered.select(key, F.array_join(F.transform("l", lambda s: s["w"]), " ").alias("abstract"))


def best_address(links: Column, doi: Column) -> Column:
    """``url, confidence``: a PDF link, else any link, else the DOI."""
    pdf = F.get(F.filter(links, lambda x: F.contains(F.lower(F.coalesce(x["type"], F.lit(""))), F.lit("pdf")) | F.endswith(F.lower(x["url"]), F.lit(".pdf"))), F.lit(0))["url"]
    other = F.get(links, F.lit(0))["url"]
    ref = F.when(nonblank(doi).isNotNull(), F.concat(F.lit("https://doi.org/"), F.trim(doi)))
    return F.struct(F.coalesce(pdf, other, ref).alias("url"), F.when(pdf.isNotNull(), "high").when(other.isNotNull(), "medium").when(ref.isNotNull(), "low").alias("confidence"))


def rank_domains(found: DataFrame, top: int = 30) -> DataFrame:
    """Candidate urls by sightings, with a bonus for domains many records point to (top-k report).

    ``found`` has ``url, domain, doc_id``.
    """
    bonus = found.groupBy("domain").agg(F.countDistinct("doc_id").alias("sources"))
    seen = found.groupBy("url", "domain").agg(F.count(F.lit(1)).alias("seen"))
    return seen.join(bonus, "domain").orderBy(F.desc("seen"), F.desc("sources"), "url").limit(top).select("url", "domain", "seen", "sources")


def capped(df: DataFrame, per: str, order: list[Column], each: int, total: int) -> DataFrame:
    """At most ``each`` rows per key and ``total`` in all, in order (the limits are the feature)."""
    w = Window.partitionBy(per).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= each).orderBy("__r", per, *order).limit(total).drop("__r")


def queries_from_concepts(concepts: DataFrame, langs: list[str]) -> DataFrame:
    """First equivalent of each concept in each language: ``slug, lang, query``."""
    e = concepts.select("slug", F.explode("equivalents").alias("lang", "terms"))
    return e.where(F.col("lang").isin(langs)).select("slug", "lang", F.get("terms", F.lit(0)).alias("query")).where("query is not null")


def first_answer(answers: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the first service that answered for each key."""
    first = answers.groupBy(key).agg(F.min(order).alias("__o"))
    return answers.join(first.withColumnRenamed("__o", order), [key, order], "left_semi")


def link_status(head: Column, get: Column) -> Column:
    """``ok``, ``dead`` or ``unchecked`` out of response codes; null codes mean no answer.

    Codes that many servers give to HEAD only are checked with GET.
    """
    code = F.when(head.isNull() | head.isin(403, 405, 500, 501), F.coalesce(get, head)).otherwise(head)
    return F.when(code.between(200, 399), "ok").when(code.isin(404, 410), "dead").otherwise("unchecked")


def due_for_check(url: Column, checked: Column, now: str, days: int = 14) -> Column:
    """Links with an address that were not checked for so long, or never."""
    return nonblank(url).isNotNull() & (checked.isNull() | (checked < F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(days))))


def archive_copy(existing: Column, lookup: Column, submitted: Column, status: Column) -> Column:
    """Archived address of a link: the one at hand, a found one, a new one unless it is dead."""
    return F.coalesce(nonblank(existing), nonblank(lookup), F.when(status != "dead", nonblank(submitted)))


def address_variants(url: Column) -> Column:
    """Other addresses under which a library file may be found."""
    stem = F.regexp_replace(url, r"\.(pdf|epub|txt|odt)$", "")
    item = F.regexp_extract(url, r"/download/([^/]+)/", 1)
    base = F.regexp_extract(url, r"^(.*/download/[^/]+/)", 1)
    canonical = F.when(item != "", F.concat(base, item, F.lit(".pdf")))
    return F.array_distinct(F.array_compact(F.array(url, F.concat(stem, F.lit(".pdf")), F.concat(stem, F.lit("_text.pdf")), canonical)))


def theme_score(hay: Column, core: list[str], related: list[str]) -> Column:
    """0 to 10 out of the core and related keywords that occur in a text.

    A keyword listed twice counts twice; many core keywords raise the floor.
    """
    n = lambda ks: sum((F.contains(hay, F.lit(k)).cast("int") for k in ks), F.lit(0))
    c, r = n(core), n(related)
    base = F.least(F.lit(10), F.bround(F.least(F.lit(4), c) * 1.5 + F.least(F.lit(3), r) * 0.5, 0)).cast("int")
    floor = F.when(c >= 5, 7).when(c >= 3, 6).when(c >= 2, 5).otherwise(0)
    return F.greatest(base, floor).cast("int")
