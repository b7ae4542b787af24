"""Queries on languages, dates, identifiers, titles and excerpts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import lang, meta, text, titles
from quernstone.session import table

YEAR_NOW = 2026


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs")


def detected_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", lang.detect_language(F.col("text")).alias("detected"))


def language_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.coalesce(F.lower(F.substring("lang", 1, 2)), F.lit("none"))
    return table(spark, sf_dir, "documents").groupBy(tag.alias("tag"), lang.detect_language(F.col("text")).alias("detected")).agg(F.count(F.lit(1)).alias("n"))


def hinted_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", lang.detect_by_hints(F.col("title")).alias("by_hints"), lang.guess_language(F.col("title")).alias("guessed"))


def resolved_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "sources").select(F.col("label").alias("source"), "default_lang")
    df = _cat(spark, sf_dir).join(src, "source", "left")
    return df.select("id", lang.resolve_language(F.col("lang"), F.col("enrichment.summary"), F.concat_ws(" ", "title", "filename"), F.col("default_lang")).alias("language"))


def language_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How records without a valid tag get one, with counts."""
    src = table(spark, sf_dir, "sources").select(F.col("label").alias("source"), "default_lang")
    df = _cat(spark, sf_dir).join(src, "source", "left").where(~F.coalesce(F.lower(F.substring("lang", 1, 2)).isin(list(lang.FUNCTION_WORDS)), F.lit(False)))
    hint = lang.detect_by_hints(F.concat_ws(" ", "title", "filename"))
    method = F.when(hint != "", "hints").when(F.col("default_lang").isin(list(lang.FUNCTION_WORDS)), "source").otherwise("none")
    return df.groupBy(method.alias("method"), F.when(hint != "", hint).otherwise(F.coalesce("default_lang", F.lit(""))).alias("language")).agg(F.count(F.lit(1)).alias("n"))


def heuristic_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", meta.publication_date(F.col("title"), F.col("filename"), F.col("url"), year_now=YEAR_NOW).alias("found"), meta.pdf_date(F.col("meta.creation_date")).alias("pdf_date"))


def explicit_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", meta.plausible_date(F.col("doc_date"), YEAR_NOW).alias("date"))


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    hay = F.concat_ws(" ", "url", "title", "doi", "isbn", "hal_id")
    return _cat(spark, sf_dir).select("id", meta.find_doi(hay).alias("doi"), meta.find_isbn(F.col("isbn")).alias("isbn"), meta.find_hal_id(hay).alias("hal_id"))


def publishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", meta.publisher(F.col("editeur"), F.col("meta.pdf_creator")).alias("publisher"))


def editorial_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", titles.normalize_title(F.col("title"), F.col("meta.pdf_title"), F.col("filename"), F.col("author")).alias("title"))


def humanized_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", titles.humanized(F.col("filename")).alias("name"), titles.meaningless_title(F.col("meta.pdf_title"), F.col("filename")).alias("meaningless"))


def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cat(spark, sf_dir).select("id", text.first_sentence(F.col("enrichment.summary")).alias("sentence"), text.short_text(F.col("enrichment.en_clair"), F.col("enrichment.summary"), F.col("title")).alias("short"), text.strip_html(F.concat(F.lit("<p>"), F.col("title"), F.lit("</p>\n<b>"), F.col("source"), F.lit("</b>"))).alias("plain"))


def prompt_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short hash per model and prompt version of the runs."""
    key = F.coalesce(text.nonblank(F.col("prompt_version")), F.lit(""))
    h = F.when(key == "", "noprompt").otherwise(F.substring(F.sha2(key, 256), 1, 10))
    return table(spark, sf_dir, "doc_runs").groupBy("model", h.alias("prompt")).agg(F.count(F.lit(1)).alias("n"))


_F = [detected_languages, language_confusion, hinted_languages, resolved_languages, language_backfill, heuristic_dates, explicit_dates, identifiers, publishers, editorial_titles, humanized_filenames, excerpts, prompt_versions]


def queries() -> dict:
    return {f.__name__: f for f in _F}


def _sql_list(words: str) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words.split()) + ")"


def _detect_sql(x: str) -> str:
    w = f"regexp_extract_all(lower(coalesce({x}, '')), '[a-zà-öø-ÿ]+')"
    s = [f"len(list_filter(list_slice({w}, 1, 600), lambda w: w in {_sql_list(v)}))" for v in lang.FUNCTION_WORDS.values()]
    top = f"greatest({', '.join(s)})"
    pick = " ".join(f"when {c} = {top} then '{k}'" for k, c in zip(lang.FUNCTION_WORDS, s, strict=True))
    return f"case when length(coalesce({x}, '')) < 80 or len({w}) < 30 or {top} < 5 then '' {pick} end"


def _hints_sql(x: str) -> str:
    w = f"regexp_extract_all(regexp_replace(lower(coalesce({x}, '')), '[-_./%+]', ' ', 'g'), '[a-zà-öø-ÿ]{{3,}}')"
    s = [f"len(list_filter({w}, lambda w: w in {_sql_list(v)}))" for v in lang.TITLE_HINTS.values()]
    k = [f"len(list_distinct(list_filter({w}, lambda w: w in {_sql_list(v)})))" for v in lang.TITLE_HINTS.values()]
    lst = f"list_reverse_sort([{', '.join(s)}])"
    pick = " ".join(f"when {c} = {lst}[1] then (case when {d} >= 2 and {lst}[2] < {c} then '{n}' else '' end)" for n, c, d in zip(lang.TITLE_HINTS, s, k, strict=True))
    return f"case {pick} end"


def _guess_sql(x: str) -> str:
    s = {k: " + ".join(f"cast(contains(lower(coalesce({x}, '')), '{h}') as int)" for h in hs) for k, hs in lang.SUBSTRING_HINTS.items()}
    top = f"greatest({', '.join(s.values())})"
    return f"case when {top} < 1 then 'unknown' " + " ".join(f"when ({c}) = {top} then '{k}'" for k, c in s.items()) + " end"


_FIVE = "('fr', 'en', 'es', 'pt', 'de')"
_ISO = r"\b((?:1[5-9]\d\d|20[0-4]\d)-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))\b"
_YR = r"\b(1[5-9]\d\d|20[0-4]\d)\b"


def oracle_sql() -> dict[str, str]:
    mask = lambda x: rf"regexp_replace(coalesce({x}, ''), '\b1[5-9]\d\d-(?:1[5-9]|20)\d\d\b', 'XXXX-XXXX', 'g')"
    day = lambda x: f"(case when try_cast(substr(regexp_extract({mask(x)}, '{_ISO}', 1), 1, 4) as int) between 1950 and {YEAR_NOW + 2} then regexp_extract({mask(x)}, '{_ISO}', 1) end)"
    yr = lambda x: f"list_filter(regexp_extract_all({mask(x)}, '{_YR}', 1), lambda y: cast(y as int) between 1950 and {YEAR_NOW + 2})[1]"
    src = ("title", "filename", "url")
    c = "coalesce(meta.creation_date, '')"
    cy = r"(1[5-9]\d\d|20[0-4]\d)"
    pm = rf"regexp_extract({c}, '(?:1[5-9]\d\d|20[0-4]\d)(\d\d)', 1)"
    pd_ = rf"regexp_extract({c}, '(?:1[5-9]\d\d|20[0-4]\d)\d\d(\d\d)', 1)"
    hay = "concat_ws(' ', url, title, doi, isbn, hal_id)"
    soft = " or ".join(f"contains(lower(p), '{s}')" for s in meta.SOFTWARE)
    first = "trim(coalesce(enrichment.summary, ''))"
    sep = lambda s: f"contains({first}, '{s} ') then substr(split_part({first}, '{s} ', 1) || '{s}', 1, 300)"
    short = "coalesce(nullif(trim(enrichment.en_clair), ''), nullif(trim(enrichment.summary), ''), nullif(trim(title), ''), '')"
    hint_src = _hints_sql("concat_ws(' ', title, filename)")
    return {
        "detected_languages": f"select doc_id, {_detect_sql('text')} as detected from documents",
        "language_confusion": f"select coalesce(lower(substr(lang, 1, 2)), 'none') as tag, {_detect_sql('text')} as detected, count(*) as n from documents group by all",
        "hinted_languages": f"select id, {_hints_sql('title')} as by_hints, {_guess_sql('title')} as guessed from catalog_docs",
        "resolved_languages": f"""select id, coalesce(case when lower(substr(coalesce(lang, ''), 1, 2)) in {_FIVE} then lower(substr(lang, 1, 2)) end, nullif({_detect_sql('enrichment.summary')}, ''),
            nullif({hint_src}, ''), case when default_lang in {_FIVE} then default_lang end, '') as language from catalog_docs c left join sources s on c.source = s.label""",
        "language_backfill": f"""select case when h <> '' then 'hints' when default_lang in {_FIVE} then 'source' else 'none' end as method, case when h <> '' then h else coalesce(default_lang, '') end as language, count(*) as n
            from (select {hint_src} as h, default_lang from catalog_docs c left join sources s on c.source = s.label where not coalesce(lower(substr(lang, 1, 2)) in {_FIVE}, false)) group by all""",
        "heuristic_dates": f"""select id, coalesce({', '.join(day(s) for s in src)}, {', '.join(yr(s) for s in src)}, '') as found,
            case when {pm} between '01' and '12' and {pd_} between '01' and '31' then regexp_extract({c}, '{cy}', 1) || '-' || {pm} || '-' || {pd_} else regexp_extract({c}, '{cy}', 1) end as pdf_date from catalog_docs""",
        "explicit_dates": f"""select id, case when try_cast(substr(d, 1, 4) as int) between 1800 and {YEAR_NOW + 2} then d when try_cast(y as int) between 1800 and {YEAR_NOW + 2} then y else '' end as date
            from (select id, regexp_extract(coalesce(doc_date, ''), '{_ISO}', 1) as d, regexp_extract(coalesce(doc_date, ''), '{_YR}', 1) as y from catalog_docs)""",
        "identifiers": rf"""select id, regexp_replace(regexp_extract({hay}, '10\.\d{{4,9}}/[-._;()/:A-Za-z0-9]+'), '[.,;)]+$', '') as doi,
            coalesce(list_filter(list_transform(regexp_extract_all(coalesce(isbn, ''), '\b97[89][-\s]?(?:\d[-\s]?){{9}}\d\b|\b(?:\d[-\s]?){{9}}[\dXx]\b'), lambda s: upper(regexp_replace(s, '[-\s]', '', 'g'))),
            lambda s: case when length(s) = 13 then list_sum(list_transform(range(1, 14), lambda i: cast(s[i] as int) * (case when i % 2 = 1 then 1 else 3 end))) % 10 = 0
            else list_sum(list_transform(range(1, 11), lambda i: (case when s[i] = 'X' then 10 else cast(s[i] as int) end) * (11 - i))) % 11 = 0 end)[1], '') as isbn,
            lower(regexp_extract({hay}, '(?i)\b(?:hal|tel|halshs|hprints)-\d{{6,}}\b')) as hal_id from catalog_docs""",
        "publishers": f"select id, case when {soft} then '' else p end as publisher from (select id, coalesce(nullif(trim(editeur), ''), nullif(trim(meta.pdf_creator), ''), '') as p from catalog_docs)",
        "humanized_filenames": rf"""select id, trim(translate(regexp_replace(coalesce(filename, ''), '(?i)\.[a-z0-9]+$', ''), '_-', '  ')) as name,
            length(c) < 4 or regexp_matches(c, '(?i)\.(pdf|doc|docx|odt|cdr|indd|qxd|pub|txt)$') or (contains(c, '_') and not contains(c, ' ')) or (length(stem) > 0 and lower(c) = lower(stem))
            or len(list_filter(string_split_regex(c, '[\s\-—:·]+'), lambda w: length(w) > 2)) < 2 as meaningless
            from (select id, filename, trim(coalesce(meta.pdf_title, '')) as c, regexp_replace(coalesce(filename, ''), '(?i)\.[a-z0-9]{{2,4}}$', '') as stem from catalog_docs)""",
        "excerpts": rf"""select id, case when {sep('.')} when {sep('!')} when {sep('?')} else substr({first}, 1, 300) end as sentence,
            case when length({short}) > 280 then rtrim(substr({short}, 1, 280)) || '…' else {short} end as short,
            substr(trim(regexp_replace(regexp_replace(coalesce('<p>' || title || '</p>' || chr(10) || '<b>' || source || '</b>', ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 400) as plain from catalog_docs""",
        "prompt_versions": "select model, case when coalesce(nullif(trim(prompt_version), ''), '') = '' then 'noprompt' else substr(sha256(trim(prompt_version)), 1, 10) end as prompt, count(*) as n from doc_runs group by all",
    }
