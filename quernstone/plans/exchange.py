"""Queries on discovery, exports and event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import rules, text
from quernstone.operators import discover
from quernstone.plans.corpus import EFF, HOST, PUBLISHABLE
from quernstone.session import table
from quernstone.sources import sinks
from quernstone.streaming import flows

CORE = ["commun", "commons", "foncier", "allmende", "reforma agraria", "réforme agraire", "terre", "land", "terra", "tierra"]
RELATED = ["coopérati", "co-operative", "cooperativ", "ferme", "farm", "semence", "seed", "coutumier", "customary"]


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs")


def _shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).where(rules.of_record(rules.publishable))


def theme_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    hay = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("enrichment.summary", F.lit(""))))
    return _cat(spark, sf_dir).select("id", discover.theme_score(hay, CORE, RELATED).alias("score"))


def unknown_dois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the latest months whose DOI no older record has; no DOI passes."""
    cat = _cat(spark, sf_dir).select("id", "doi", F.substring("collected_date", 1, 7).alias("month"))
    new, old = cat.where("month >= '2026-01'"), cat.where("month < '2026-01'")
    return discover.unknown_only(new, old, "doi").select("id", "doi")


def unknown_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run rows whose address gives an id that no record has, per source."""
    runs = table(spark, sf_dir, "doc_runs").select("source", "url").distinct()
    return discover.unknown_records(runs, _cat(spark, sf_dir), [rules.record_id(F.col("url")), rules.alternative_id(F.col("url"))]).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def ranked_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "doc_runs").select("url", rules.host(F.col("url")).alias("domain"), F.col("id").alias("doc_id")).where("domain is not null")
    return discover.rank_domains(df)


def reference_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five quotations of each good record, fifty in all (the budget is the feature)."""
    good = _cat(spark, sf_dir).where("latest_score >= 7").select("id")
    q = table(spark, sf_dir, "citations").join(good, "id", "left_semi").select("id", "cit_id")
    return discover.capped(q, "id", [F.col("cit_id")], 5, 50)


def link_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of record links out of their download status."""
    code = F.regexp_extract(F.coalesce("download_status", F.lit("")), r"http_(\d{3})", 1).try_cast("int")
    code = F.when(F.col("download_status") == "ok", 200).otherwise(code)
    return _cat(spark, sf_dir).groupBy(discover.link_status(code, code).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def candidate_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best address of a record and how far to trust it."""
    links = F.when(rules.path_extension(F.col("url")) == "pdf", F.array(F.struct(F.lit("application/pdf").alias("type"), F.col("url").alias("url")))).when(F.col("download_status") == "ok", F.array(F.struct(F.lit("text/html").alias("type"), F.col("url").alias("url"))))
    return _cat(spark, sf_dir).select("id", discover.best_address(links, F.col("doi")).alias("a")).select("id", "a.url", "a.confidence")


def bibtex_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.coalesce(text.nonblank(F.col("meta.pdf_title")), text.nonblank(F.col("filename")))
    author = F.coalesce(text.nonblank(F.col("author")), text.nonblank(F.col("meta.pdf_author")))
    year = rules.document_year(F.col("doc_date")).cast("string")
    kind = F.when((F.col("format") == "pdf") & (F.col("meta.page_count") >= 60), "book").otherwise("misc")
    entry = sinks.bibtex(F.col("id"), title, author, year, F.col("url"), F.col("doi"), F.col("isbn"), F.substring("enrichment.summary", 1, 400), F.array_join("enrichment.matched_keywords", ", "), kind)
    return _shown(spark, sf_dir).select("id", entry.alias("entry"))


def ris_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = sinks.ris(F.col("meta.pdf_title"), F.col("author"), rules.document_year(F.col("doc_date")).cast("string"), F.col("url"), F.col("doi"), F.substring("enrichment.summary", 1, 400), F.col("enrichment.matched_keywords"))
    return _shown(spark, sf_dir).select("id", entry.alias("entry"))


def csl_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = sinks.csl_json(F.col("id"), F.col("meta.pdf_title"), F.col("author"), rules.document_year(F.col("doc_date")).cast("string"), F.col("url"), F.col("doi"))
    return _shown(spark, sf_dir).select("id", entry.alias("entry"))


def rss_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = sinks.rss_item(F.coalesce(text.nonblank(F.col("title")), F.col("filename")), F.col("url"), text.short_text(F.col("enrichment.summary")), rules.run_timestamp(F.col("latest_run")))
    return _shown(spark, sf_dir).select("id", item.alias("item"))


def sitemap_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = F.concat(F.lit("https://library.example/records/"), F.col("id"), F.lit(".html"))
    return _shown(spark, sf_dir).select("id", sinks.sitemap_url(loc, F.coalesce(F.col("collected_date"), F.lit("2026-11-26"))).alias("entry"))


def record_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sinks.json_ld(F.col("title"), F.col("enrichment.summary"), F.col("lang"), F.col("url"), F.col("meta.page_count"))
    return _shown(spark, sf_dir).select("id", d.alias("json_ld"))


def published_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sinks.published(_cat(spark, sf_dir), rules.of_record(rules.publishable))
    return got.select("id", "title", "source", F.col("enrichment.summary").alias("summary"))


def shared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with their yield, as shared between projects."""
    n = _cat(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.count_if(rules.of_record(rules.effective_score) >= 7).alias("good"))
    src = table(spark, sf_dir, "sources").select(F.col("label").alias("source"), "url", "type", "orientation")
    return src.join(n, "source", "left").fillna(0, ["records", "good"]).orderBy(F.desc("records"), F.lower("source"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type: the batch form of the streaming windows (an extension)."""
    got = flows.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "value")
    return got.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


_F = [theme_scores, unknown_dois, unknown_runs, ranked_hosts, reference_budget, link_states, candidate_addresses, bibtex_export, ris_export, csl_export, rss_export, sitemap_export, record_descriptions, published_catalog, shared_sources, event_windows]


def queries() -> dict:
    return {f.__name__: f for f in _F}


def _esc(x: str) -> str:
    return rf"trim(regexp_replace(translate(replace(coalesce({x}, ''), '\', ''), '{{}}', '()'), '\s*\n\s*', ' ', 'g'))"


def _xml(x: str) -> str:
    return f"replace(replace(replace(replace(replace(coalesce({x}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;')"


def _json(name: str, x: str) -> str:
    """SQL for a member of a JSON object; nothing where the value is null."""
    return f"""coalesce(',"{name}":' || to_json({x})::varchar, '')"""


def oracle_sql() -> dict[str, str]:
    hay = "lower(coalesce(title, '') || ' ' || coalesce(enrichment.summary, ''))"
    n = lambda ks: " + ".join(f"cast(contains({hay}, '{k}') as int)" for k in ks)
    field = lambda name, x: f"case when nullif({x}, '') is not null then '  {name} = {{' || {x} || '}}' end"
    year = r"nullif(regexp_extract(coalesce(doc_date, ''), '\b(1[5-9]\d\d|20\d\d)\b', 1), '')"
    title = "coalesce(nullif(trim(meta.pdf_title), ''), nullif(trim(filename), ''))"
    author = "coalesce(nullif(trim(author), ''), nullif(trim(meta.pdf_author), ''))"
    line = lambda tag, x: f"case when nullif(trim({x}), '') is not null then '{tag}  - ' || trim({x}) end"
    short = "coalesce(nullif(trim(enrichment.summary), ''), '')"
    ts = r"try_strptime(case when regexp_full_match(latest_run, '\d{4}-\d{2}-\d{2}_\d{2}-\d{2}') then latest_run end, '%Y-%m-%d_%H-%M')"
    return {
        "theme_scores": f"""select id, greatest(least(10, cast(round_even(least(4, c) * 1.5 + least(3, r) * 0.5, 0) as int)), case when c >= 5 then 7 when c >= 3 then 6 when c >= 2 then 5 else 0 end) as score
            from (select id, {n(CORE)} as c, {n(RELATED)} as r from catalog_docs)""",
        "unknown_dois": """select id, doi from catalog_docs where substr(collected_date, 1, 7) >= '2026-01' and (doi is null or lower(trim(doi)) not in (select lower(trim(doi)) from catalog_docs where doi is not null and substr(collected_date, 1, 7) < '2026-01'))""",
        "unknown_runs": "select source, count(*) as n from (select distinct source, url from doc_runs) where coalesce(substr(md5(url), 1, 8), '') not in (select id from catalog_docs) and coalesce(substr(sha1(url), 1, 8), '') not in (select id from catalog_docs) group by source",
        "ranked_hosts": f"""with f as (select url, {HOST} as domain, id from doc_runs), b as (select domain, count(distinct id) as sources from f group by domain)
            select url, domain, count(*) as seen, any_value(sources) as sources from f join b using (domain) where domain is not null group by url, domain order by seen desc, sources desc, url limit 30""",
        "reference_budget": "select id, cit_id from (select id, cit_id, row_number() over (partition by id order by cit_id) as r from citations where id in (select id from catalog_docs where latest_score >= 7)) where r <= 5 order by r, id, cit_id limit 50",
        "link_states": r"""select case when c between 200 and 399 then 'ok' when c in (404, 410) then 'dead' else 'unchecked' end as state, count(*) as n
            from (select case when download_status = 'ok' then 200 else try_cast(nullif(regexp_extract(coalesce(download_status, ''), 'http_(\d{3})', 1), '') as int) end as c from catalog_docs) group by 1""",
        "candidate_addresses": r"""select id, case when l then url when doi <> '' and trim(doi) <> '' then 'https://doi.org/' || trim(doi) end as url, case when p then 'high' when l then 'medium' when trim(doi) <> '' then 'low' end as confidence
            from (select *, lower(regexp_extract(regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '/+$', ''), '\.([A-Za-z0-9]{2,4})$', 1)) = 'pdf' as p, p or coalesce(download_status = 'ok', false) as l from catalog_docs)""",
        "bibtex_export": f"""select id, '@' || case when format = 'pdf' and meta.page_count >= 60 then 'book' else 'misc' end || '{{' || id || ',' || chr(10) || concat_ws(',' || chr(10), {field('title', f"coalesce(nullif({_esc(title)}, ''), 'Sans titre')")},
            {field('author', _esc(author))}, {field('year', year)}, {field('url', 'trim(url)')}, {field('doi', 'trim(doi)')}, {field('isbn', 'trim(isbn)')}, {field('abstract', _esc('substr(enrichment.summary, 1, 400)'))},
            {field('keywords', "trim(array_to_string(enrichment.matched_keywords, ', '))")}) || chr(10) || '}}' as entry from catalog_docs where {PUBLISHABLE}""",
        "ris_export": f"""select id, concat_ws(chr(10), 'TY  - GEN', 'TI  - ' || coalesce(nullif(trim(meta.pdf_title), ''), 'Sans titre'), {line('AU', 'author')}, {line('PY', year)}, {line('UR', 'url')}, {line('DO', 'doi')},
            {line('AB', 'substr(enrichment.summary, 1, 400)')}, nullif(array_to_string(list_transform(coalesce(enrichment.matched_keywords, []), lambda k: 'KW  - ' || k), chr(10)), ''), 'ER  - ') as entry from catalog_docs where {PUBLISHABLE}""",
        "rss_export": f"""select id, '<item><title>' || {_xml("coalesce(nullif(trim(title), ''), filename)")} || '</title><link>' || {_xml('url')} || '</link><description>' ||
            {_xml(f"case when length({short}) > 280 then rtrim(substr({short}, 1, 280)) || '…' else {short} end")} || '</description>' || coalesce('<pubDate>' || strftime({ts}, '%a, %d %b %Y %H:%M:%S') || ' +0000</pubDate>', '') || '</item>' as item
            from catalog_docs where {PUBLISHABLE}""",
        "record_descriptions": f"""select id, '{{"@context":"https://schema.org","@type":"' || case when meta.page_count >= 60 then 'Book' else 'CreativeWork' end || '"' || {_json('name', 'title')} || {_json('description', "nullif(trim(enrichment.summary), '')")}
            || {_json('inLanguage', "nullif(trim(lang), '')")} || {_json('url', 'url')} || '}}' as json_ld from catalog_docs where {PUBLISHABLE}""",
        "csl_export": rf"""select id, '{{"id":' || to_json(id)::varchar || ',"type":"document"' || {_json('title', "coalesce(nullif(trim(meta.pdf_title), ''), 'Sans titre')")} || {_json('URL', "nullif(trim(url), '')")}
            || case when a is null then '' when contains(a, ' ') then ',"author":[{{"given":' || to_json(regexp_extract(a, '(?s)^(.*) (\S+)$', 1))::varchar || ',"family":' || to_json(regexp_extract(a, '(?s)^(.*) (\S+)$', 2))::varchar || '}}]'
            else ',"author":[{{"literal":' || to_json(a)::varchar || '}}]' end || coalesce(',"issued":{{"date-parts":[[' || nullif(regexp_extract(coalesce(doc_date, ''), '\b(1[5-9]\d\d|20\d\d)\b', 1), '') || ']]}}', '')
            || {_json('DOI', "nullif(trim(doi), '')")} || '}}' as entry from (select *, nullif(trim(author), '') as a from catalog_docs where {PUBLISHABLE})""",
        "sitemap_export": f"select id, '<url><loc>https://library.example/records/' || id || '.html</loc><lastmod>' || coalesce(collected_date, '2026-11-26') || '</lastmod></url>' as entry from catalog_docs where {PUBLISHABLE}",
        "published_catalog": f"select id, title, source, enrichment.summary as summary from catalog_docs where {PUBLISHABLE}",
        "shared_sources": f"""select s.label as source, s.url, s.type, s.orientation, coalesce(records, 0) as records, coalesce(good, 0) as good from sources s left join
            (select source, count(*) as records, count(*) filter ({EFF} >= 7) as good from catalog_docs group by source) c on c.source = s.label""",
        "event_windows": "select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M') as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all",
    }
