"""Queries on records, scores and sources (projections, predicates, aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import rules
from quernstone.functions.text import nonblank
from quernstone.operators import stats
from quernstone.session import table

EFF = "coalesce(score_final, score_initial, latest_score, 0)"
EXT = r"lower(regexp_extract(regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '/+$', ''), '\.([A-Za-z0-9]{2,4})$', 1))"
IS_DOC = f"(coalesce(lower(format) in ('pdf','epub','txt','odt'), false) or coalesce({EXT} in ('pdf','epub','txt','odt'), false))"
FAILED = "(enrichment.error is not null or (enrichment.summary is not null and trim(enrichment.summary) = ''))"
PUBLISHABLE = f"({IS_DOC} and {EFF} >= 4 and not ({FAILED} and score_final is null))"
DECADE = r"""coalesce((select cast((y // 10) * 10 as varchar) || 's' from (select try_cast(substr(s, i, 4) as int) as y, i
  from (select coalesce(doc_date, '') as s), range(1, greatest(length(coalesce(doc_date, '')) - 2, 2)) t(i)
  where regexp_full_match(substr(s, i, 4), '[0-9]{4}')) where y between 1400 and 2100 order by i limit 1), 'inconnu')"""

NOISY = ["Kiosque du Pré Commun", "Forum des Landes", "Commentaires Libres", "Radio Marais Notes"]
_NOISY_SQL = ", ".join(f"'{s}'" for s in NOISY)


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs")


def corpus_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "sources").select(F.col("label").alias("source"), "orientation")
    df = _cat(spark, sf_dir).join(src, "source", "left")
    return stats.count_by_dimensions(
        df,
        {
            "lang": F.coalesce(nonblank(F.col("lang")), F.lit("inconnu")),
            "source": F.coalesce("source", F.lit("inconnu")),
            "decade": rules.decade(F.col("doc_date")),
            "doc_type": F.coalesce(nonblank(F.col("doc_type")), F.lit("non_classe")),
            "orientation": F.coalesce("orientation", F.lit("non_renseigne")),
            "score": rules.of_record(rules.effective_score),
            "downloaded": F.coalesce("downloaded", F.lit(False)),
        },
    )


_DIMS = {
    "lang": "coalesce(nullif(trim(lang), ''), 'inconnu')",
    "source": "coalesce(c.source, 'inconnu')",
    "decade": DECADE,
    "doc_type": "coalesce(nullif(trim(doc_type), ''), 'non_classe')",
    "orientation": "coalesce(s.orientation, 'non_renseigne')",
    "score": f"cast({EFF} as varchar)",
    "downloaded": "cast(coalesce(downloaded, false) as varchar)",
}


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dense_histogram(_cat(spark, sf_dir), {"latest_score": F.col("latest_score"), "score_final": F.col("score_final")})


def bias_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "sources").select(F.col("label").alias("source"), "orientation")
    df = _cat(spark, sf_dir).join(src, "source", "left")
    return df.agg(
        stats.share(F.lower(F.substring("lang", 1, 2)) == "fr").alias("french"),
        stats.share(F.col("orientation") == "militant").alias("militant"),
        stats.share(rules.decade(F.col("doc_date")) == "inconnu").alias("undated"),
        F.count(F.lit(1)).alias("records"),
    )


def source_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.source_runs(table(spark, sf_dir, "doc_runs"))


def latest_run_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "doc_runs")
    last = runs.agg(F.max("run_date").alias("run_date"))
    return stats.source_runs(runs.join(F.broadcast(last), "run_date", "left_semi"))


def source_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "sources").select(F.col("label").alias("source"), "type")
    return stats.with_defaults(src, stats.fertility(table(spark, sf_dir, "doc_runs")), "source", ["runs", "seen", "downloads", "per_run"])


def sterile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    eff = rules.of_record(rules.effective_score)
    got = _cat(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.count_if(eff >= 7).alias("high"))
    return got.where("records >= 3").withColumn("sterile", F.col("high") == 0)


def source_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose downloads were mostly worth reading; others lose automatic download."""
    read = F.col("downloaded") & F.col("score_final").isNotNull()
    got = _cat(spark, sf_dir).groupBy("source").agg(F.count_if(read).alias("read"), F.count_if(read & (F.col("score_final") >= 4)).alias("good"))
    return got.withColumn("revoked", (F.col("read") >= 10) & (F.col("good") / F.col("read") < 0.7))


def record_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    eff = rules.of_record(rules.effective_score)
    return _cat(spark, sf_dir).select("id", eff.alias("score"), rules.score_label(eff).alias("label"), rules.decade(F.col("doc_date")).alias("decade"), rules.document_year(F.col("doc_date")).alias("year"))


def publishable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).where(rules.of_record(rules.publishable)).select("id", rules.of_record(rules.effective_score).alias("score"))


def record_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _cat(spark, sf_dir).select("id", rules.record_id(u).alias("url_md5"), rules.alternative_id(u).alias("url_sha1"), rules.host(u).alias("host"), rules.netloc(u).alias("netloc"), rules.path_extension(u).alias("extension"))


def archive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cold = rules.archivable(F.col("score_final"), F.col("score_initial"), F.col("downloaded"), F.col("source"), NOISY) & (rules.of_record(rules.effective_score) < 6)
    return _cat(spark, sf_dir).groupBy("source").agg(F.count_if(cold).alias("archived"), F.count_if(~F.coalesce(cold, F.lit(False))).alias("kept"))


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a known record would not be fetched again, with how many there are."""
    runs = table(spark, sf_dir, "doc_runs").dropDuplicates(["id", "run_date"]).groupBy("id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.coalesce("downloaded", F.lit(False))).alias("loads"))
    df = _cat(spark, sf_dir).join(runs, "id", "left").fillna(0, ["runs", "loads"])
    reason = (
        F.when(F.col("score_final").isNotNull(), "read")
        .when(F.coalesce("score_initial", F.lit(0)) < 4, "rejected on title")
        .when((F.col("loads") >= 4) | (F.col("runs") >= 8), "attempts exhausted")
        .otherwise("due")
    )
    return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def advanced_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conjunction of optional criteria; a record without year fails the year range."""
    year = rules.document_year(F.col("doc_date"))
    eff = rules.of_record(rules.effective_score)
    criteria = [year.between(1850, 2015), F.lower(F.substring("lang", 1, 2)).isin("fr", "en"), eff.between(5, 9), F.col("doc_type").isin("brochure", "livre", "rapport")]
    out = F.lit(True)
    for c in criteria:
        out = out & c
    return _cat(spark, sf_dir).where(out).select("id", year.alias("year"), eff.alias("score"), "doc_type")


def collection_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs per day with the records first seen in them."""
    runs = table(spark, sf_dir, "doc_runs")
    return runs.groupBy(F.substring("run_date", 1, 10).alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("records"))


def doc_type_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _cat(spark, sf_dir).groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))
    return stats.bars(counts, "doc_type", "n")


def context_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of a prompt about the corpus: its best records, a bounded top-k report."""
    df = _cat(spark, sf_dir).where("latest_score is not null").orderBy(F.desc("latest_score"), "id").limit(20)
    return df.select("id", "title", "latest_score", "source")


_F = [corpus_by_dimension, score_histogram, bias_shares, source_performance, latest_run_performance, source_fertility, sterile_sources, source_trust, record_scores, publishable_records, record_urls, archive_split, skip_reasons, advanced_filter, collection_activity, doc_type_bars, context_summary]


def queries() -> dict:
    return {f.__name__: f for f in _F}


_RUNS = "count(*) as found, count(*) filter (downloaded) as downloaded, round_even(avg(score), 1) as mean_score, max(score) as max_score"
YEAR = r"try_cast(nullif(regexp_extract(coalesce(doc_date, ''), '\b(1[5-9]\d\d|20\d\d)\b', 1), '') as int)"
HOST = r"nullif(lower(regexp_extract(trim(url), '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"


def oracle_sql() -> dict[str, str]:
    return {
        "corpus_by_dimension": " union all ".join(
            f"select '{d}' as dimension, v as value, count(*) as n from (select {e} as v from catalog_docs c left join sources s on c.source = s.label) group by v" for d, e in _DIMS.items()
        ),
        "score_histogram": """with v as (select 'latest_score' as measure, latest_score as score from catalog_docs union all select 'score_final', score_final from catalog_docs)
            select m.measure, cast(r.score as int) as score, count(v.score) as n from (values ('latest_score'), ('score_final')) m(measure) cross join range(0, 11) r(score)
            left join v on v.measure = m.measure and v.score = r.score group by all""",
        "bias_shares": f"""select round_even(100 * avg(cast(coalesce(lower(substr(lang, 1, 2)) = 'fr', false) as double)), 1) as french,
            round_even(100 * avg(cast(coalesce(s.orientation = 'militant', false) as double)), 1) as militant,
            round_even(100 * avg(cast(d = 'inconnu' as double)), 1) as undated, count(*) as records
            from (select *, {DECADE} as d from catalog_docs) c left join sources s on c.source = s.label""",
        "source_performance": f"select source, {_RUNS} from doc_runs group by source",
        "latest_run_performance": f"select source, {_RUNS} from doc_runs where run_date = (select max(run_date) from doc_runs) group by source",
        "source_fertility": """select s.label as source, s.type, coalesce(f.runs, 0) as runs, coalesce(seen, 0) as seen, coalesce(downloads, 0) as downloads,
            coalesce(round_even(downloads / greatest(f.runs, 1), 2), 0) as per_run from sources s left join (select source, count(distinct run_date) as runs, count(*) as seen,
            count(*) filter (downloaded) as downloads from doc_runs group by source) f on f.source = s.label""",
        "sterile_sources": f"select source, count(*) as records, count(*) filter ({EFF} >= 7) as high, count(*) filter ({EFF} >= 7) = 0 as sterile from catalog_docs group by source having count(*) >= 3",
        "source_trust": """select *, read >= 10 and good / read < 0.7 as revoked from (select source, count(*) filter (downloaded and score_final is not null) as read,
            count(*) filter (downloaded and score_final >= 4) as good from catalog_docs group by source)""",
        "record_scores": f"""select id, {EFF} as score, case when {EFF} >= 9 then 'essentiel' when {EFF} >= 7 then 'important' when {EFF} >= 5 then 'utile' when {EFF} >= 3 then 'marginal' else 'faible' end as label,
            {DECADE} as decade, {YEAR} as year from catalog_docs""",
        "publishable_records": f"select id, {EFF} as score from catalog_docs where {PUBLISHABLE}",
        "record_urls": f"""select id, substr(md5(url), 1, 8) as url_md5, substr(sha1(url), 1, 8) as url_sha1, {HOST} as host,
            nullif(lower(regexp_extract(trim(url), '(?i)^[a-z][a-z0-9+.-]*://([^/?#]+)', 1)), '') as netloc, {EXT} as extension from catalog_docs""",
        "archive_split": f"""select source, count(*) filter (cold) as archived, count(*) filter (not cold) as kept from (select source, coalesce(coalesce(score_initial, 0) <= 2 and score_final is null
            and not coalesce(downloaded, false) and source in ({_NOISY_SQL}) and {EFF} < 6, false) as cold from catalog_docs) group by source""",
        "skip_reasons": """select case when score_final is not null then 'read' when coalesce(score_initial, 0) < 4 then 'rejected on title'
            when coalesce(loads, 0) >= 4 or coalesce(runs, 0) >= 8 then 'attempts exhausted' else 'due' end as reason, count(*) as n
            from catalog_docs left join (select id, count(*) as runs, count(*) filter (downloaded) as loads from (select distinct id, run_date, downloaded from doc_runs) group by id) using (id) group by 1""",
        "advanced_filter": f"""select id, {YEAR} as year, {EFF} as score, doc_type from catalog_docs where {YEAR} between 1850 and 2015 and lower(substr(lang, 1, 2)) in ('fr', 'en')
            and {EFF} between 5 and 9 and doc_type in ('brochure', 'livre', 'rapport')""",
        "collection_activity": "select substr(run_date, 1, 10) as day, count(*) as rows, count(distinct id) as records from doc_runs group by 1",
        "doc_type_bars": "select doc_type, count(*) as n, round_even(100 * count(*) / sum(count(*)) over (), 1) as percent from catalog_docs group by doc_type",
        "context_summary": "select id, title, latest_score, source from catalog_docs where latest_score is not null order by latest_score desc, id limit 20",
    }
