"""Queries on upserts, history, change detection, editorial views and fetch state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.functions import rules, text
from quernstone.operators import catalog, throttle
from quernstone.plans.corpus import EFF, PUBLISHABLE
from quernstone.session import materialize, table

NOW = "2026-11-26 00:00:00"
DOSSIERS = {"semences": ["semence", "semilla", "grain", "glean", "glanage"], "eaux": ["eaux", "agua", "water", "wasser", "tourbi"], "partage": ["partage", "partag", "shared", "compartid", "geteilt"]}
FEEDS = {"communs": ["communs", "commons", "allmende", "baldi"], "sans-terre": ["sans-terre", "landless", "sin tierra", "landlosen"]}


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "doc_runs")


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = catalog.run_history(_runs(spark, sf_dir))
    return got.select("id", "run_date", "source", "score", "downloaded")


def latest_run_per_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = catalog.latest_per_key(catalog.run_history(_runs(spark, sf_dir)), "id", [F.col("run_date")])
    return got.select("id", "run_date", "score")


def late_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows delivered twice and rows that came a day or more after their run, per source."""
    r = _runs(spark, sf_dir).withColumn("ran", F.to_utc_timestamp(rules.run_timestamp(F.col("run_date")), "Europe/Paris"))
    late = F.col("received_at") >= F.col("ran") + F.expr("interval 1 day")
    got = r.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id", "run_date").alias("runs"), F.count_if(late).alias("late"))
    return got.withColumn("twice", F.col("rows") - F.col("runs"))


def merged_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue after its latest run rows are merged, twice (the second time changes nothing), with overrides and an archive."""
    cat = _cat(spark, sf_dir)
    last = catalog.latest_per_key(catalog.run_history(_runs(spark, sf_dir)), "id", [F.col("run_date")])
    report = last.select("id", "run_date", "source", "url", "score", F.lit(None).cast("int").alias("read_score"), F.lit(None).cast("string").alias("doc_type"), F.lit("").alias("doc_date"), F.lit("").alias("lang"), "downloaded", F.concat(F.col("id"), F.lit(".pdf")).alias("saved_as"), F.col("link_text").alias("title"), F.when(F.col("score") >= 8, True).alias("recit_de_lutte"), F.when(F.col("score") >= 8, F.col("model")).otherwise("").alias("editeur"), F.lit(" ").alias("doi"))
    archived = cat.where("source = 'Kiosque du Pré Commun' and latest_score <= 1").select("id")
    overrides = cat.where("score_final is null and latest_score >= 9").select("id", F.lit(10).alias("score"))
    base = cat.select("id", "url", "source", "first_seen", "latest_run", "score_initial", "latest_score", "score_final", "doc_type", "doc_date", "lang", "downloaded", "saved_as", "title", "editeur", "doi", "isbn", "hal_id", "recit_de_lutte", "collected_date", "meta")
    once = catalog.merge_records(base, report, archived, overrides, ("meta",))
    got = catalog.merge_records(once, report, archived, overrides, ("meta",))
    return got.select("id", "latest_run", "score_initial", "latest_score", "score_final", "doc_type", "lang", "downloaded", "saved_as", "title", "editeur", "doi", "isbn", "hal_id", "recit_de_lutte", "collected_date", F.col("meta.page_count").alias("page_count"))


def archive_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _cat(spark, sf_dir).select("id", "source", "score_initial", "score_final", "downloaded")
    cold = rules.archivable(F.col("score_final"), F.col("score_initial"), F.col("downloaded"), F.col("source"), ["Kiosque du Pré Commun", "Forum des Landes"])
    kept, moved = catalog.move_to_archive(cat, cat.limit(0), cold)
    return kept.select("id", F.lit("catalog").alias("tier")).unionByName(moved.select("id", F.lit("archive").alias("tier")))


def local_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote copy without languages and dates of half its records, filled from the local one."""
    cat = _cat(spark, sf_dir).select("id", "lang", "doc_date", "score_final")
    gone = F.pmod(F.conv(F.substring("id", 1, 4), 16, 10).cast("int"), F.lit(2)) == 0
    remote = cat.select("id", F.when(gone, "").otherwise(F.col("lang")).alias("lang"), F.when(gone, None).otherwise(F.col("doc_date")).alias("doc_date"), F.when(gone, None).otherwise(F.col("score_final")).alias("score_final"))
    return catalog.fill_from_local(remote, cat, ["lang", "doc_date", "score_final"])


def changed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day of the last visible change, against a snapshot before the enrichment."""
    cat = _cat(spark, sf_dir)
    now = cat.select("id", catalog.fingerprint(F.col("title"), F.col("enrichment.summary")).alias("hash"))
    then = cat.select("id", catalog.fingerprint(F.col("title"), F.when(F.col("downloaded"), F.col("enrichment.summary"))).alias("hash"), F.lit("2026-01-01").alias("lastmod"))
    return catalog.change_dates(now, then, "2026-11-26").select("id", "lastmod")


def candidate_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts seen in record urls, merged into those known from runs before 2026."""
    spot = lambda df, day: df.select(rules.host(F.col("url")).alias("url"), F.col("id").alias("doc_id"), F.lit(1).alias("page"), day.alias("day")).where("url is not null and day is not null")
    runs = spot(_runs(spark, sf_dir), F.substring("run_date", 1, 10))
    old = runs.where("day < '2026-01-01'").groupBy("url").agg(F.count(F.lit(1)).cast("int").alias("seen_count"), F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.array_sort(F.collect_set(F.struct("doc_id", "page"))).alias("found_from"))
    got = catalog.merge_candidates(materialize(old, "cand"), runs.where("day >= '2026-01-01'"))
    return got.select("url", "seen_count", "first_seen", "last_seen", F.size("found_from").alias("places"))


# --- editorial views ------------------------------------------------------------------------


def _hay(df: DataFrame):
    return text.haystack(F.col("filename"), F.col("source"), F.col("enrichment.summary"), F.array_join("enrichment.matched_keywords", " "))


def dossier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _cat(spark, sf_dir).where(rules.of_record(rules.effective_score) >= 6)
    hay = df.select("id", rules.of_record(rules.effective_score).alias("score"), _hay(df).alias("hay"))
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("dossier"), text.hits(F.col("hay"), k).alias("matched")) for s, k in DOSSIERS.items()]))
    return hay.select("id", "score", rows.alias("d")).where(F.size("d.matched") > 0).select("d.dossier", "id", "score", F.array_join("d.matched", ", ").alias("matched_on"))


def published_dossiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per dossier, of those that may be shown only."""
    shown = _cat(spark, sf_dir).where(rules.of_record(rules.publishable)).select("id")
    return dossier_records(spark, sf_dir).join(shown, "id", "left_semi").groupBy("dossier").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("best"))


def concept_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 30 of each concept among the records that may be shown (reports of fixed length)."""
    df = _cat(spark, sf_dir).where(rules.of_record(rules.publishable))
    hay = df.select("id", "latest_run", rules.of_record(rules.effective_score).alias("score"), text.haystack(F.col("title"), F.col("filename")).alias("hay"))
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("feed"), text.hits(F.col("hay"), k).alias("m")) for s, k in FEEDS.items()]))
    w = Window.partitionBy("feed").orderBy(F.desc_nulls_last("latest_run"), F.desc("score"), "id")
    return hay.select("id", "latest_run", "score", rows.alias("f")).where(F.size("f.m") > 0).select("f.feed", "id", "latest_run", "score").withColumn("rank", F.row_number().over(w)).where("rank <= 30").select("feed", "rank", "id")


def _shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).where(rules.of_record(rules.publishable)).select("id", "latest_run", "score_final", rules.of_record(rules.effective_score).alias("score"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(spark, sf_dir).orderBy(F.desc_nulls_last("latest_run"), F.desc("score"), "id").limit(30).select("id", "latest_run", "score")


def scoops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(spark, sf_dir).where("score_final >= 9").orderBy(F.desc_nulls_last("latest_run"), F.desc("score"), "id").limit(30).select("id", "latest_run", "score")


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record of the week; a run date that cannot be read counts as now."""
    at = F.coalesce(rules.run_timestamp(F.col("latest_run")), F.lit(NOW).cast("timestamp"))
    recent = at >= F.lit(NOW).cast("timestamp") - F.expr("interval 21 days")
    return _shown(spark, sf_dir).select("id", "score", recent.alias("recent"), at.alias("at")).orderBy(F.desc("recent"), F.desc("score"), F.desc("at"), "id").limit(1).select("id", "score", "recent")


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records of the last sixty days; run dates that cannot be read are left out."""
    at = rules.run_timestamp(F.col("latest_run"))
    df = _cat(spark, sf_dir).where((F.col("latest_score") >= 8) & (at >= F.lit(NOW).cast("timestamp") - F.expr("interval 60 days")))
    return df.select("id", "latest_score", text.short_text(F.col("enrichment.summary"), F.col("title")).alias("short"))


def best_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three best records of each type (a report)."""
    w = Window.partitionBy("doc_type").orderBy(F.desc("score"), "id")
    df = _cat(spark, sf_dir).select("doc_type", "id", rules.of_record(rules.effective_score).alias("score"))
    return df.withColumn("rank", F.row_number().over(w)).where("rank <= 3")


def struggle_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _cat(spark, sf_dir).where("recit_de_lutte").select("id", rules.of_record(rules.effective_score).alias("score"))
    return df.orderBy(F.desc("score"), "id").limit(6)


# --- fetch state ----------------------------------------------------------------------------


def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    got = throttle.failure_streaks(ev, "user_id", [F.col("ts"), F.col("event_id")], F.col("event_type") == "error")
    return got.select("event_id", "user_id", "streak", throttle.backoff_days(F.col("streak")).alias("backoff_days"))


def fetch_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of each source after its runs, the yield being its downloads."""
    runs = catalog.run_history(_runs(spark, sf_dir)).groupBy("source", "run_date").agg(F.count_if(F.coalesce("downloaded", F.lit(False))).alias("loads"))
    return throttle.interval_fold(runs, "source", F.col("run_date"), F.col("loads"))


def fetch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision per source at a fixed moment."""
    state = fetch_intervals(spark, sf_dir).withColumnRenamed("source", "label")
    last = _runs(spark, sf_dir).groupBy(F.col("source").alias("label")).agg(F.max(rules.run_timestamp(F.col("run_date"))).alias("last_fetch"))
    src = table(spark, sf_dir, "sources").select("label", rules.host(F.col("url")).alias("domain"), (F.col("robots_exempt").isNotNull() | ~F.coalesce("local_only", F.lit(False))).alias("robots_allowed"))
    none = lambda t: F.lit(None).cast(t)
    full = src.join(state, "label", "left").join(last, "label", "left").select("label", "domain", none("timestamp").alias("cooldown_until"), "robots_allowed", F.lit(0).alias("failures"), none("timestamp").alias("last_failure"), "last_fetch", F.coalesce("interval_days", F.lit(7)).alias("interval_days"), F.coalesce("low_runs", F.lit(0)).alias("low_runs"))
    domains = src.select("domain").where("domain is not null").distinct().select("domain", none("timestamp").alias("rate_limit_until"), none("timestamp").alias("last_request"))
    return throttle.gate(full, domains, NOW)


_F = [run_history, latest_run_per_record, late_deliveries, merged_catalog, archive_move, local_fill, changed_records, candidate_upsert, dossier_records, published_dossiers, concept_feeds, feed, scoops, featured, digest, best_per_type, struggle_stories, failure_streaks, fetch_intervals, fetch_gate]


def queries() -> dict:
    return {f.__name__: f for f in _F}


_LAST = """select * from doc_runs qualify row_number() over (partition by id, run_date order by received_at desc, coalesce(source, '') desc, coalesce(url, '') desc, coalesce(cast(score as varchar), '') desc,
  coalesce(raison, '') desc, coalesce(context_seen, '') desc, coalesce(link_text, '') desc, coalesce(cast(downloaded as varchar), '') desc, coalesce(model, '') desc, coalesce(prompt_version, '') desc) = 1"""
_RUN_TS = "try_strptime(case when regexp_full_match({0}, '\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d{{2}}-\\d{{2}}') then {0} end, '%Y-%m-%d_%H-%M')"
_HAY = "lower(concat_ws(' ', nullif(trim(filename), ''), nullif(trim(source), ''), nullif(trim(enrichment.summary), ''), nullif(trim(array_to_string(enrichment.matched_keywords, ' ')), '')))"


def _dossiers_sql(groups: dict[str, list[str]], hay: str, src: str) -> str:
    parts = []
    for name, ks in groups.items():
        lst = "[" + ", ".join(f"'{k}'" for k in ks) + "]"
        parts.append(f"select '{name}' as g, *, array_to_string(list_filter({lst}, lambda k: contains({hay}, k)), ', ') as m from {src}")
    return "(select * from (" + " union all ".join(parts) + ") where m <> '')"


def oracle_sql() -> dict[str, str]:
    shown = f"(select id, latest_run, score_final, {EFF} as score from catalog_docs where {PUBLISHABLE})"
    short = "coalesce(nullif(trim(enrichment.summary), ''), nullif(trim(title), ''), '')"
    hosts = r"nullif(lower(regexp_extract(trim(url), '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"
    dossiers = _dossiers_sql(DOSSIERS, _HAY, f"(select *, {EFF} as score from catalog_docs where {EFF} >= 6)")
    feeds = _dossiers_sql(FEEDS, "lower(concat_ws(' ', nullif(trim(title), ''), nullif(trim(filename), '')))", f"(select *, {EFF} as score from catalog_docs where {PUBLISHABLE})")
    fold = "with recursive y as (select source, run_date, count(*) filter (downloaded) as f, row_number() over (partition by source order by run_date) as i from (" + _LAST + """) group by source, run_date),
        s as (select source, 0::bigint as i, 0 as low, 7 as days from y group by source union all select y.source, y.i, case when f >= 3 then 0 else low + 1 end,
        case when f >= 3 then 7 when low + 1 >= 3 then least(days * 2, 60) else days end from s join y on y.source = s.source and y.i = s.i + 1),
        z as (select source, low as low_runs, days as interval_days from s qualify row_number() over (partition by source order by i desc) = 1)"""
    ts = _RUN_TS.format("latest_run")
    return {
        "run_history": f"select id, run_date, source, score, downloaded from ({_LAST})",
        "latest_run_per_record": f"select id, run_date, score from ({_LAST}) qualify row_number() over (partition by id order by run_date desc) = 1",
        "late_deliveries": f"""select source, count(*) as rows, count(distinct (id, run_date)) as runs, count(*) filter (received_at >= ran + interval 1 day) as late, count(*) - count(distinct (id, run_date)) as twice
            from (select *, timezone('Europe/Paris', {_RUN_TS.format('run_date')}) as ran from doc_runs) group by source""",
        "merged_catalog": f"""with r as (select * from ({_LAST}) where id not in (select id from catalog_docs where source = 'Kiosque du Pré Commun' and latest_score <= 1) qualify row_number() over (partition by id order by run_date desc) = 1)
            select coalesce(c.id, r.id) as id, coalesce(r.run_date, c.latest_run) as latest_run, coalesce(r.score, c.score_initial, c.latest_score) as score_initial, coalesce(r.score, c.latest_score) as latest_score,
            case when c.score_final is null and c.latest_score >= 9 then 10 else c.score_final end as score_final, coalesce(c.doc_type, 'autre') as doc_type, coalesce(c.lang, '') as lang,
            coalesce(c.downloaded, false) or coalesce(r.downloaded, false) as downloaded, case when not coalesce(c.downloaded, false) and r.downloaded then r.id || '.pdf' else c.saved_as end as saved_as,
            case when coalesce(trim(c.title), '') = '' and r.downloaded then coalesce(r.link_text, c.title) else c.title end as title,
            coalesce(case when r.score >= 8 then nullif(trim(r.model), '') end, c.editeur, '') as editeur, coalesce(c.doi, '') as doi, coalesce(c.isbn, '') as isbn, coalesce(c.hal_id, '') as hal_id,
            coalesce(case when r.score >= 8 then true end, c.recit_de_lutte, false) as recit_de_lutte, coalesce(r.run_date, c.collected_date) as collected_date, c.meta.page_count as page_count from catalog_docs c full join r on c.id = r.id""",
        "archive_move": """select id, case when coalesce(score_initial, 0) <= 2 and score_final is null and not coalesce(downloaded, false) and source in ('Kiosque du Pré Commun', 'Forum des Landes') then 'archive' else 'catalog' end as tier from catalog_docs""",
        "local_fill": """select id, case when g then coalesce(nullif(trim(lang), ''), '') else coalesce(nullif(trim(lang), ''), lang) end as lang, coalesce(nullif(trim(doc_date), ''), case when not g then doc_date end) as doc_date, score_final
            from (select *, cast('0x' || substr(id, 1, 4) as int) % 2 = 0 as g from catalog_docs)""",
        "changed_records": "select id, case when downloaded or enrichment.summary is null then '2026-01-01' else '2026-11-26' end as lastmod from catalog_docs",
        "candidate_upsert": f"select url, count(*)::int as seen_count, min(day) as first_seen, max(day) as last_seen, count(distinct id)::int as places from (select {hosts} as url, id, substr(run_date, 1, 10) as day from doc_runs) where url is not null group by url",
        "dossier_records": f"select g as dossier, id, score, m as matched_on from {dossiers}",
        "published_dossiers": f"select g as dossier, count(*) as n, max(score) as best from {dossiers} where id in (select id from {shown}) group by g",
        "concept_feeds": f"select g as feed, row_number() over (partition by g order by latest_run desc nulls last, score desc, id) as rank, id from {feeds} qualify rank <= 30",
        "feed": f"select id, latest_run, score from {shown} order by latest_run desc nulls last, score desc, id limit 30",
        "scoops": f"select id, latest_run, score from {shown} where score_final >= 9 order by latest_run desc nulls last, score desc, id limit 30",
        "featured": f"""select id, score, recent from (select id, score, coalesce({ts}, timestamp '{NOW}') as moment, coalesce({ts}, timestamp '{NOW}') >= timestamp '{NOW}' - interval 21 day as recent from {shown})
            order by recent desc, score desc, moment desc, id limit 1""",
        "digest": f"select id, latest_score, case when length({short}) > 280 then rtrim(substr({short}, 1, 280)) || '…' else {short} end as short from catalog_docs where latest_score >= 8 and {ts} >= timestamp '{NOW}' - interval 60 day",
        "best_per_type": f"select doc_type, id, {EFF} as score, row_number() over (partition by doc_type order by {EFF} desc, id) as rank from catalog_docs qualify rank <= 3",
        "struggle_stories": f"select id, {EFF} as score from catalog_docs where recit_de_lutte order by score desc, id limit 6",
        "failure_streaks": """with e as (select *, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) as g from events),
            s as (select event_id, user_id, sum(cast(event_type = 'error' as int)) over (partition by user_id, g order by ts, event_id)::bigint as streak from e)
            select *, case when streak >= 2 then cast(least(7 * pow(2, least(streak, 12) - 2), 60) as int) else 0 end as backoff_days from s""",
        "fetch_intervals": f"{fold} select * from z",
        "fetch_gate": f"""{fold}, l as (select source, max({_RUN_TS.format('run_date')}) as last from doc_runs group by source)
            select label, case when not (robots_exempt is not null or not coalesce(local_only, false)) then 'robots_disallow' when last + coalesce(interval_days, 7) * interval 1 day > timestamp '{NOW}' and coalesce(low_runs, 0) >= 3 then 'low_yield_cooldown'
            when last + coalesce(interval_days, 7) * interval 1 day > timestamp '{NOW}' then 'ttl_not_elapsed' else 'ok' end as decision from sources s left join z on z.source = s.label left join l on l.source = s.label""",
    }
