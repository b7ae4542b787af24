"""Queries on pages, addresses, pending work and state reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import cite, meta, pagetext, rules
from quernstone.functions.text import nonblank
from quernstone.operators import audit, discover
from quernstone.plans import fields, records
from quernstone.plans.corpus import PUBLISHABLE
from quernstone.session import table

DATING = ["crue", "Vers", "Dès", "By", "Hacia", "Um"]
NOW = "2026-11-26 00:00:00"


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs")


def display_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", pagetext.display_title(F.col("title"), F.lit(None).cast("string"), F.col("filename"), F.col("id")).alias("title"))


def encoded_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", pagetext.encode_url("url").alias("encoded"), pagetext.encode_url_twice("url").alias("twice"))


def address_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).where("download_status <> 'ok'").select("id", F.explode(discover.address_variants(F.col("url"))).alias("address"))


def readable_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", pagetext.readable(t).alias("readable"), pagetext.banner_only(t).alias("banner_only"), pagetext.is_cover(t).alias("cover"))


def denoised_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", pagetext.denoise(F.col("text"), F.lit(None).cast("string")).alias("text"))


def stub_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", pagetext.stub_summary(F.col("text")).alias("stub"))


def year_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every excerpt with a keyword close to a year, in order of the text; this corpus has words of dating, none of publishing."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(cite.year_evidence(F.col("text"), "|".join(DATING))).alias("pos", "excerpt"))


def date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a date, with a candidate and how far to trust it."""
    df = _cat(spark, sf_dir).where(nonblank(F.col("doc_date")).isNull())
    blob = F.concat_ws(" ", "title", "filename", "url")
    guess = meta.publication_date(F.col("title"), F.col("filename"), F.col("url"), year_now=2026)
    pdf = meta.pdf_date(F.col("meta.creation_date"))
    candidate = F.when(pdf != "", pdf).otherwise(guess)
    return df.select("id", candidate.alias("candidate"), audit.candidate_confidence(candidate, guess, blob).alias("confidence"))


def pending_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to read: first those never read, then those whose reading failed."""
    df = _cat(spark, sf_dir).where(F.col("downloaded"))
    phase = F.when(F.col("enrichment").isNull(), 1).when(rules.enrichment_failed(F.col("enrichment.error"), F.col("enrichment.summary")), 2)
    return df.select("id", phase.alias("phase")).where("phase is not null")


def retry_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _cat(spark, sf_dir).where("score_initial between 4 and 5 and not coalesce(downloaded, false) and trim(url) <> ''")
    return df.select("id", "score_initial")


def links_to_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links due for a check, those of shown and lost records first."""
    due = discover.due_for_check(F.col("url"), F.when(F.col("link_status").isNotNull(), F.col("ingested_at")), NOW, 60)
    df = _cat(spark, sf_dir).where(due)
    return df.groupBy(rules.of_record(rules.publishable).alias("shown"), F.coalesce("link_status", F.lit("never")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files with the record they belong to, by file name; the smallest id of a name counts."""
    cat = _cat(spark, sf_dir)
    files = cat.where("saved_as is not null").select(F.lower(F.regexp_replace("saved_as", r"^.*/|^[0-9a-f]{8}_", "")).alias("name")).distinct()
    owner = cat.groupBy(F.lower("filename").alias("name")).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("claims"))
    return files.join(owner, "name", "left")


def fetch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of all sources at one glance."""
    s = records.fetch_intervals(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("sources"), F.count_if(F.col("low_runs") >= 3).alias("low_yield"), F.max("interval_days").alias("longest"), F.max_by("source", F.struct("interval_days", "low_runs", "source")).alias("idlest"))


def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.fetch_gate(spark, sf_dir).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


_F = [display_titles, encoded_urls, address_variants, readable_documents, denoised_documents, stub_summaries, year_evidence, date_candidates, pending_enrichment, retry_downloads, links_to_check, file_records, fetch_report, gate_counts]


def queries() -> dict:
    return {f.__name__: f for f in _F}


def oracle_sql() -> dict[str, str]:
    gates = records.oracle_sql()
    strip = "trim(regexp_replace(regexp_replace(coalesce(filename, ''), '(?i)\\.[a-z0-9]+$', ''), '[_-]', ' ', 'g'))"
    marked = " or ".join("contains(t, '{}')".format(b.replace("'", "''")) for b in pagetext.BANNER)
    lines = "list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: {})"
    dates = fields.oracle_sql()["heuristic_dates"]
    named = "list_transform(regexp_extract_all(concat_ws(' ', title, filename, url), '\\b(1[5-9]\\d\\d|20\\d\\d)\\b', 1), lambda y: cast(y as int))"
    return {
        "date_candidates": f"""select id, k as candidate, case when y is null then 'none' when len(list_filter(n, lambda v: abs(v - y) >= 3)) > 0 then 'conflict' when list_contains(n, y) then 'high' when found = k then 'medium' else 'low' end as confidence
            from (select id, found, case when pdf_date <> '' then pdf_date else found end as k, try_cast(nullif(substr(case when pdf_date <> '' then pdf_date else found end, 1, 4), '') as int) as y, {named} as n
            from catalog_docs join ({dates}) using (id) where coalesce(trim(doc_date), '') = '')""",
        "year_evidence": r"""select doc_id, cast(unnest(range(len(e))) as int) as pos, unnest(e) as excerpt
            from (select doc_id, regexp_extract_all(text, '(?i)[^\n]{0,30}(?:""" + "|".join(DATING) + r""")[^\n]{0,30}\b(?:1[5-9]|20)\d\d\b') as e from documents)""",
        "address_variants": r"""select id, address from (select distinct id, unnest([url, regexp_replace(url, '\.(pdf|epub|txt|odt)$', '') || '.pdf', regexp_replace(url, '\.(pdf|epub|txt|odt)$', '') || '_text.pdf',
            case when regexp_extract(url, '/download/([^/]+)/', 1) <> '' then regexp_extract(url, '^(.*/download/[^/]+/)', 1) || regexp_extract(url, '/download/([^/]+)/', 1) || '.pdf' end]) as address
            from catalog_docs where download_status <> 'ok') where address is not null""",
        "display_titles": f"select id, coalesce(nullif(trim(title), ''), nullif({strip}, ''), id) as title from catalog_docs",
        "readable_documents": f"""select doc_id, length(text) >= 200 and length(trim(regexp_replace(text, '\\[p\\.\\d+\\]', '', 'g'))) >= 200 as readable, t = '' or (({marked}) and length(trim(t)) <= 2000) as banner_only,
            len(l) <= 2 or coalesce(list_sum(list_transform(l, lambda x: length(x))), 0) < 120 as cover from (select doc_id, coalesce(text, '') as text, lower(coalesce(text, '')) as t,
            {lines.format("len(string_split_regex(x, '\\s+')) >= 5")} as l from documents)""",
        "stub_summaries": f"select doc_id, substr(array_to_string(list_slice({lines.format('length(x) > 40')}, 1, 5), ' '), 1, 500) as stub from documents",
        "pending_enrichment": "select id, case when enrichment is null then 1 else 2 end as phase from catalog_docs where downloaded and (enrichment is null or enrichment.error is not null or trim(enrichment.summary) = '')",
        "retry_downloads": "select id, score_initial from catalog_docs where score_initial between 4 and 5 and not coalesce(downloaded, false) and trim(url) <> ''",
        "links_to_check": f"""select {PUBLISHABLE} as shown, coalesce(link_status, 'never') as status, count(*) as n from catalog_docs where trim(url) <> '' and (link_status is null or ingested_at is null
            or ingested_at < timestamptz '{NOW}+00' - interval 60 day) group by all""",
        "file_records": """select f.name, o.id, o.claims from (select distinct lower(regexp_replace(saved_as, '^.*/|^[0-9a-f]{8}_', '')) as name from catalog_docs where saved_as is not null) f
            left join (select lower(filename) as name, min(id) as id, count(*) as claims from catalog_docs group by 1) o on o.name = f.name""",
        "fetch_report": f"select count(*) as sources, count(*) filter (low_runs >= 3) as low_yield, max(interval_days) as longest, arg_max(source, (interval_days, low_runs, source)) as idlest from ({gates['fetch_intervals']})",
        "gate_counts": f"select decision, count(*) as n from ({gates['fetch_gate']}) group by decision",
    }
