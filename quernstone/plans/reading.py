"""Queries on long texts: pages, quotations, references; and quality audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import cite, meta
from quernstone.operators import audit
from quernstone.plans.corpus import PUBLISHABLE
from quernstone.plans.matching import fold_sql
from quernstone.session import table

YEAR_NOW = 2026


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cite.pages(table(spark, sf_dir, "documents"), "doc_id", "text")


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    return p.select("doc_id", "page_no", F.length("text").alias("chars"))


def document_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cite.references(table(spark, sf_dir, "documents"), "doc_id", "text")


def bibliography_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cite.bibliography_page(_pages(spark, sf_dir), "doc_id", 3)


def footnote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in footnotes; the texts have none, so that of the record stands as one under each."""
    urls = table(spark, sf_dir, "catalog_docs").select(F.col("id").alias("catalog_id"), "url", "doi")
    docs = table(spark, sf_dir, "documents").join(urls, "catalog_id", "left")
    noted = docs.select("doc_id", F.concat("text", F.coalesce(F.concat(F.lit("\n12 "), "url"), F.lit("")), F.coalesce(F.concat(F.lit("\n13. "), F.nullif("doi", F.lit(""))), F.lit(""))).alias("text"))
    return cite.footnote_links(cite.pages(noted, "doc_id", "text"), "doc_id")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of a record: its full documents and its summary."""
    docs = table(spark, sf_dir, "documents").where("catalog_id is not null").select(F.col("catalog_id").alias("id"), "text")
    cat = table(spark, sf_dir, "catalog_docs").where("enrichment.summary is not null").select("id", F.col("enrichment.summary").alias("text"))
    return docs.unionByName(cat)


def verified_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cite.verify_quotes(table(spark, sf_dir, "citations"), _texts(spark, sf_dir), "cit_id", "quote", "id", "text")


def quote_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored against recomputed verification of every quotation."""
    q = table(spark, sf_dir, "citations").select("cit_id", "id", "verified")
    found = verified_quotes(spark, sf_dir).select("cit_id", F.col("verified").alias("now"))
    has = _texts(spark, sf_dir).select("id").distinct().withColumn("has", F.lit(True))
    joined = q.join(found, "cit_id").join(has, "id", "left")
    cat = cite.quote_category(F.col("verified"), F.col("now"), F.coalesce("has", F.lit(False)))
    return joined.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def quote_page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page on which a passage stands; the passages are the first 80 characters of every page."""
    pages = _pages(spark, sf_dir)
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("page_no").cast("string"))
    return cite.quote_pages(pages.select(key.alias("passage"), "doc_id", F.substring("text", 1, 80).alias("quote")).distinct(), pages, "passage", "quote", "doc_id")


def quotes_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotations of a record zipped by position with those delivered for the next one."""
    q = table(spark, sf_dir, "citations").select("id", "quote_pos", "quote", "page")
    nxt = q.select("id", (F.col("quote_pos") - 1).alias("quote_pos"), F.col("page").alias("next_page"))
    return q.join(nxt, ["id", "quote_pos"], "left").select("id", "quote_pos", "page", "next_page")


def untranslated_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of other languages with a quotation that has no translation yet."""
    q = table(spark, sf_dir, "citations")
    other = F.lower(F.substring("lang", 1, 2)).isin("en", "es", "de", "pt", "it", "ca")
    missing = other & (F.trim(F.coalesce("quote", F.lit(""))) != "") & (F.trim(F.coalesce("quote_fr", F.lit(""))) == "")
    return q.groupBy("id").agg(F.count_if(missing).alias("pending"), F.count(F.lit(1)).alias("quotes")).where("pending > 0")


def summary_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "catalog_docs").select("id", audit.summary_issues(F.col("enrichment.summary"), F.col("title")).alias("issues"))
    return audit.counts(df)


def date_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "catalog_docs").select("id", audit.date_issues(F.col("doc_date"), F.col("title"), F.col("collected_date"), YEAR_NOW).alias("issues"))
    return audit.counts(df)


def title_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "catalog_docs").select("id", audit.title_issues(F.col("title")).alias("issues"))
    return audit.counts(df)


def enrichment_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "catalog_docs").where("enrichment is not null and enrichment.error is null")
    return df.select("id", F.explode(audit.retry_fields(F.col("enrichment.summary"), F.col("enrichment.en_clair"))).alias("field"))


def date_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "catalog_docs")
    stored, found = meta.plausible_date(F.col("doc_date"), YEAR_NOW), meta.pdf_date(F.col("meta.creation_date"))
    return df.groupBy(audit.date_confidence(stored, found).alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


def orphan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are not in all of: publishable, read in full, quoted."""
    from quernstone.functions import rules

    cat = table(spark, sf_dir, "catalog_docs").where(rules.of_record(rules.publishable)).select("id")
    docs = table(spark, sf_dir, "documents").where("catalog_id is not null").select(F.col("catalog_id").alias("id"))
    return audit.set_differences({"publishable": cat, "read": docs, "quoted": table(spark, sf_dir, "citations").where("id is not null")}, "id")


def inconsistent_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose catalogue title and PDF title differ although both are there."""
    df = table(spark, sf_dir, "catalog_docs").where("trim(title) <> '' and trim(meta.pdf_title) <> '' and title <> meta.pdf_title")
    return df.select("id", "title", F.col("meta.pdf_title").alias("pdf_title"))


_F = [document_pages, document_references, bibliography_pages, footnote_links, verified_quotes, quote_audit, quote_page_numbers, quotes_by_position, untranslated_quotes, summary_audit, date_audit, title_audit, enrichment_retries, date_confidence, orphan_records, inconsistent_titles]


def queries() -> dict:
    return {f.__name__: f for f in _F}


def _match(x: str) -> str:
    step = rf"regexp_replace(translate(regexp_replace(lower(coalesce({x}, '')), '[«»“”]', '', 'g'), '’‘', ''''''), '-\s*\n\s*', '', 'g')"
    return rf"trim(regexp_replace({fold_sql(step)}, '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


_TEXTS = "t as (select catalog_id as id, text from documents where catalog_id is not null union all select id, enrichment.summary from catalog_docs where enrichment.summary is not null)"
_WORDS = "string_split(m, ' ')"
_PROBE = f"(case when len({_WORDS}) >= 4 then array_to_string(list_slice({_WORDS}, 1, greatest(4, len({_WORDS}) * 7 // 10)), ' ') end)"
_VERIFIED = f"""with {_TEXTS}, b as (select id, {_match('text')} as body from t), q as (select cit_id, id, {_match('quote')} as m from citations), v as (select cit_id, id, bool_or(coalesce(m <> '' and contains(body, m), false)) as exact,
  bool_or(coalesce(contains(body, {_PROBE}), false)) as partial from q left join b using (id) group by all)"""
_PG = r"(select doc_id, cast(regexp_extract(part, '\[p\.(\d+)\]', 1) as int) as page_no, trim(regexp_replace(part, '^\[p\.\d+\]', '')) as text from (select doc_id, unnest(string_split(replace('[p.0]' || text, '[p.', chr(1) || '[p.'), chr(1))) as part from documents) where part <> '')"
_NOTED = _PG.replace("from documents)", r"from (select doc_id, text || coalesce(chr(10) || '12 ' || url, '') || coalesce(chr(10) || '13. ' || nullif(doi, ''), '') as text from documents d left join catalog_docs c on c.id = d.catalog_id))")
_ISO = r"\b((?:1[5-9]\d\d|20[0-4]\d)-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))\b"
_YR = r"\b(1[5-9]\d\d|20[0-4]\d)\b"
_URL = "(contains(s, 'http://') or contains(s, 'https://'))"


def oracle_sql() -> dict[str, str]:
    flat = lambda x, n: rf"lower(regexp_replace(substr({x}, 1, {n}), '\s+', ' ', 'g'))"
    real = r"length(trim(regexp_replace(s, 'https?://\S+', '', 'g')))"
    d_ok = r"regexp_full_match(d, '\d{4}(-\d{2}(-\d{2})?)?')"
    d_rg = r"regexp_full_match(d, '\d{4}-\d{4}')"
    issues = lambda pairs: " union all ".join(f"select '{n}' as issue from i where {c}" for n, c in pairs)
    return {
        "document_pages": f"select doc_id, page_no, length(text) as chars from {_PG} where page_no > 0 or text <> ''",
        "document_references": r"""select doc_id, cast(l[1] as int) as ref_no, trim(l[2]) as raw, cast(regexp_extract(l[2], '\b(1[5-9]\d\d|20\d\d)\b', 1) as int) as year,
            trim(regexp_extract(trim(l[2]), '^(.*?),\s+(?:1[5-9]\d\d|20\d\d)\b', 1)) as title, try_cast(nullif(regexp_extract(l[2], '\bp\.\s*(\d+)', 1), '') as int) as page
            from (select doc_id, [regexp_extract(x, '^\[(\d+)\] (.+)$', 1), regexp_extract(x, '^\[(\d+)\] (.+)$', 2)] as l from (select doc_id, unnest(string_split(text, chr(10))) as x from documents)
            where regexp_matches(x, '^\[\d+\] .+$')) where regexp_matches(l[2], '\b(1[5-9]\d\d|20\d\d)\b')""",
        "verified_quotes": f"{_VERIFIED} select cit_id, exact or partial as verified, case when exact then 'exact' when partial then 'partial' end as how from v",
        "quote_audit": f"""{_VERIFIED} select case when c.id is null or c.id not in (select id from t) then 'text missing' when coalesce(c.verified, false) and (exact or partial) then 'confirmed'
            when coalesce(c.verified, false) then 'regression' when exact or partial then 'newly verified' else 'never verified' end as category, count(*) as n from citations c join v using (cit_id) group by 1""",
        "quote_page_numbers": f"""with p as (select doc_id, page_no, text, {_match('text')} as body from {_PG} where page_no > 0 or text <> ''), q as (select distinct doc_id || '/' || page_no as passage, doc_id, {_match('substr(text, 1, 80)')} as m from p)
            select passage, min(page_no) as page_no from q join p using (doc_id) where m <> '' and contains(body, m) group by passage""",
        "quotes_by_position": "select a.id, a.quote_pos, a.page, b.page as next_page from citations a left join citations b on b.id = a.id and b.quote_pos = a.quote_pos + 1",
        "untranslated_quotes": """select id, count(*) filter (lower(substr(lang, 1, 2)) in ('en', 'es', 'de', 'pt', 'it', 'ca') and trim(coalesce(quote, '')) <> '' and trim(coalesce(quote_fr, '')) = '') as pending,
            count(*) as quotes from citations group by id having pending > 0""",
        "summary_audit": "with i as (select coalesce(enrichment.summary, '') as s, trim(coalesce(title, '')) as t from catalog_docs) select issue, count(*) as n from ("
        + issues([
            ("empty", "trim(s) = ''"), ("raw_url", f"trim(s) <> '' and {_URL}"), ("extract_mark", r"trim(s) <> '' and regexp_matches(s, '(?i)Extrait\s*:|Voir le document')"),
            ("repeats_title", f"trim(s) <> '' and length(t) >= 15 and starts_with({flat('s', 35)}, {flat('t', 25)})"),
            ("noise", r"trim(s) <> '' and length(s) > 100 and length(regexp_replace(s, '[^\p{L}]', '', 'g')) / greatest(length(s), 1) < 0.55"), ("too_short", f"trim(s) <> '' and {real} < 80"),
        ]) + ") group by issue",
        "date_audit": rf"""with r as (select trim(coalesce(doc_date, '')) as d, coalesce(title, '') as t, try_cast(nullif(regexp_extract(coalesce(collected_date, ''), '^(\d{{4}})', 1), '') as int) as seen from catalog_docs),
            i as (select *, case when {d_rg} or {d_ok} then cast(substr(d, 1, 4) as int) end as y, list_transform(regexp_extract_all(t, '\b(1[5-9]\d\d|20\d\d)\b', 1), lambda v: cast(v as int)) as named from r) select issue, count(*) as n from ("""
        + issues([("empty", "d = ''"), ("format", "d <> '' and y is null"), ("range", d_rg), ("future", f"y > {YEAR_NOW}"), ("very_old", "y < 1800"), ("after_collection", "y > seen"), ("title_year", "len(list_filter(named, lambda v: abs(v - y) >= 3)) > 0")])
        + ") group by issue",
        "title_audit": "with i as (select trim(title) as t from catalog_docs where trim(title) <> '') select issue, count(*) as n from ("
        + issues([
            ("format_residue", f"regexp_matches(t, '{audit.FORMAT_RESIDUE}')"),
            ("author_in_title", r"regexp_matches(t, '\([\p{Lu}][\p{Ll}]+\s+[\p{Lu}][\p{Ll}]+\)$')"), ("cut_off", "ends_with(t, '...') or ends_with(t, '…')"),
            ("capitals", r"len(list_filter(string_split_regex(t, '\s+')[2:], lambda w: regexp_full_match(regexp_replace(regexp_replace(w, '^[^\p{L}]+', ''), '[^\p{L}0-9]+$', ''), '\p{Lu}{4,}') and regexp_replace(regexp_replace(w, '^[^\p{L}]+', ''), '[^\p{L}0-9]+$', '') not in (" + ", ".join(f"'{a}'" for a in audit.ACRONYMS) + "))) > 0"),
            ("odd_signs", r"regexp_matches(t, '[_\[\]{}<>|\\]')"), ("bare_version", "regexp_matches(t, '(?i)^— version (lituanienne|italienne|anglaise|espagnole)$')"), ("series_lower_case", r"regexp_matches(t, '^Mini-Manuel\s+[a-z]')"), ("long", "length(t) > 90"),
        ]) + ") group by issue",
        "enrichment_retries": rf"""with i as (select id, coalesce(enrichment.summary, '') as s, enrichment.en_clair as p from catalog_docs where enrichment is not null and enrichment.error is null)
            select id, 'summary' as field from i where trim(s) = '' or {real} < 80 or regexp_matches(s, 'https?://') union all select id, 'en_clair' from i where coalesce(trim(p), '') = ''""",
        "date_confidence": rf"""with r as (select coalesce(meta.creation_date, '') as c, regexp_extract(coalesce(doc_date, ''), '{_ISO}', 1) as d, regexp_extract(coalesce(doc_date, ''), '{_YR}', 1) as y from catalog_docs),
            v as (select case when try_cast(substr(d, 1, 4) as int) between 1800 and {YEAR_NOW + 2} then d when try_cast(y as int) between 1800 and {YEAR_NOW + 2} then y else '' end as a,
            regexp_extract(c, '(1[5-9]\d\d|20[0-4]\d)', 1) as cy, regexp_extract(c, '(?:1[5-9]\d\d|20[0-4]\d)(\d\d)', 1) as m, regexp_extract(c, '(?:1[5-9]\d\d|20[0-4]\d)\d\d(\d\d)', 1) as dd from r),
            w as (select a, case when m between '01' and '12' and dd between '01' and '31' then cy || '-' || m || '-' || dd else cy end as b from v)
            select case when a = '' and b = '' then 'none' when a = b then 'high' when a = '' or b = '' then 'low' when substr(a, 1, 4) = substr(b, 1, 4) then 'medium' else 'conflict' end as confidence, count(*) as n from w group by 1""",
        "bibliography_pages": f"""with p as (select doc_id, page_no, len(list_filter(string_split({fold_sql('text')}, chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '\\s+', ' ', 'g'), ' ?: ?$', '')) in ({', '.join("'" + h + "'" for h in cite.HEADINGS)}))) > 0 as headed,
            len(regexp_extract_all(text, '\\b(1[5-9]\\d\\d|20\\d\\d)\\b')) as years from {_PG} where page_no > 0 or text <> ''), l as (select *, max(page_no) over (partition by doc_id) as last from p),
            g as (select doc_id, max(page_no) filter (headed) as h, arg_max(page_no, (years, -page_no)) filter (page_no > floor(last * 2 / 3) and years >= 3) as y from l group by doc_id)
            select doc_id, coalesce(h, y) as page_no, case when h is not null then 'heading' else 'years' end as how from g where h is not null or y is not null""",
        "footnote_links": rf"""with l as (select doc_id, page_no, string_split(text, chr(10)) as ls from {_NOTED} where page_no > 0 or text <> ''), u as (select doc_id, page_no, len(ls) as n, unnest(range(0, len(ls))) as i, unnest(ls) as line from l),
            k as (select * from u where regexp_matches(line, '^\s*([¹²³⁴⁵⁶⁷⁸⁹⁰]+|\d{{1,3}}[.)]?)\s+\S') or i >= n // 2)
            select distinct doc_id, page_no, kind, target from (select doc_id, page_no, 'url' as kind, regexp_replace(unnest(regexp_extract_all(line, 'https?://[^\s)"''<>\]]+')), '[.,);]+$', '') as target from k
            union all select doc_id, page_no, 'doi', 'https://doi.org/' || regexp_replace(unnest(regexp_extract_all(line, '\b10\.\d{{4,9}}/[-._;()/:A-Za-z0-9]+')), '[.,);]+$', '') from k)""",
        "orphan_records": f"""with p as (select id from catalog_docs where {PUBLISHABLE}), r as (select distinct catalog_id as id from documents where catalog_id is not null), q as (select distinct id from citations where id is not null),
            u as (select id from p union select id from r union select id from q) select * from (select id, id in (select id from p) as publishable, id in (select id from r) as read, id in (select id from q) as quoted from u)
            where not (publishable and read and quoted)""",
        "inconsistent_titles": "select id, title, meta.pdf_title as pdf_title from catalog_docs where trim(title) <> '' and trim(meta.pdf_title) <> '' and title <> meta.pdf_title",
    }
