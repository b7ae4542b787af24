"""Queries on duplicates, similarity and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text
from quernstone.operators import dedup, search
from quernstone.session import materialize, table

JACCARD = 0.95


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _digest():
    return F.sha2(F.col("text"), 256)


def duplicate_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.clusters(_docs(spark, sf_dir), "doc_id", _digest()).withColumn("digest", F.substring("digest", 1, 16))


def duplicate_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(_docs(spark, sf_dir), "doc_id", _digest())


def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_report(_docs(spark, sf_dir), _digest(), F.col("n_chars"))


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.fingerprint_tokens(F.col("text")).alias("tokens"))


def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between different fingerprints; ``jaccard_classes`` has the copies."""
    got = dedup.jaccard_pairs(_fingerprints(spark, sf_dir), "doc_id", "tokens", JACCARD)
    return got.withColumn("similarity", F.round("similarity", 6))


def jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.jaccard_members(_fingerprints(spark, sf_dir), "doc_id", "tokens")


def nearest_earlier_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.nearest_earlier(jaccard_pairs(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.postings(_docs(spark, sf_dir), "doc_id", "text")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir)


def term_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.document_frequency(_index(spark, sf_dir))


def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_terms(_index(spark, sf_dir))


def search_all_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_all(_index(spark, sf_dir), "doc_id", ["tourbieres", "tribunal", "tribunal"])


def search_any_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_any(_docs(spark, sf_dir), "doc_id", "text", ["prefet", "petition", "peat", "moor"])


def suggest_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = table(spark, sf_dir, "catalog_docs").select("source", "editeur", "author")
    return search.suggestions(cat, [("source", "source"), ("editeur", "editeur"), ("author", "author")], "pr")


def highlighted_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs").select("id", text.mark_terms(F.col("title"), ["communs", "Allmende", "land"]).alias("marked"))


def fuzzy_title_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles found in PDF files, each with the most similar catalogue title."""
    cat = table(spark, sf_dir, "catalog_docs")
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[a-zà-öø-ÿ0-9]{3,}"), F.lit(0)))
    left = materialize(cat.select(F.col("id").alias("pdf_id"), words(F.col("meta.pdf_title")).alias("w")).where("w is not null"), "fuzzy")
    right = materialize(cat.select(F.col("id").alias("ref_id"), words(F.col("title")).alias("w")).where("w is not null"), "fuzzy")
    return dedup.best_title_match(left, right, "pdf_id", "ref_id", "w", 0.8)


def source_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose keyword sets overlap by 30 % or more."""
    kw = table(spark, sf_dir, "catalog_docs").select("source", F.explode("enrichment.matched_keywords").alias("k")).groupBy("source", "k").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    sets = kw.groupBy("source").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    b = sets.select(F.col("source").alias("source_b"), F.col("ks").alias("kb"), F.explode("ks").alias("k"))
    a = sets.select(F.col("source").alias("source_a"), F.col("ks").alias("ka"), F.explode("ks").alias("k"))
    pairs = a.join(b, "k").where("source_a < source_b").select("source_a", "source_b", "ka", "kb").distinct()
    return pairs.select("source_a", "source_b", F.bround(text.jaccard(F.col("ka"), F.col("kb")), 3).alias("overlap")).where("overlap >= 0.3")


_F = [duplicate_clusters, duplicate_members, duplicate_report, jaccard_pairs, jaccard_classes, nearest_earlier_record, postings, term_frequencies, top_terms, search_all_terms, search_any_term, suggest_terms, highlighted_titles, fuzzy_title_match, source_similarity]


def queries() -> dict:
    return {f.__name__: f for f in _F}


def fold_sql(x: str) -> str:
    return rf"strip_accents(regexp_replace(lower({x}), '\p{{Mn}}+', '', 'g'))"


def _tokens_sql(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in text.stopwords())
    return rf"list_filter(regexp_extract_all({fold_sql(x)}, '[a-zß-öø-ÿ]{{3,}}'), lambda w: w not in ({stop}))"


_FINGER = r"list_sort(list_distinct(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+'), lambda w: length(w) >= 5)))"
_SETS = f"with f as (select doc_id, {_FINGER} as ts from documents), s as (select min(doc_id) as k, ts from f where len(ts) > 0 group by ts), e as (select k, len(ts) as n, unnest(ts) as t from s)"
_PAIRS = f"""{_SETS}, c as (select a.k as a, b.k as b, a.n as n, b.n as m, count(*) as c from e a join e b on a.t = b.t and a.k < b.k and least(a.n, b.n) >= {JACCARD} * greatest(a.n, b.n) - 1e-9
  group by all), p as (select a, b, round(c / (n + m - c), 6) as similarity from c where c / (n + m - c) >= {JACCARD} - 1e-9)"""
_POSTINGS = f"select term, doc_id, count(*) as tf from (select doc_id, unnest({_tokens_sql('text')}) as term from documents) group by all"


def oracle_sql() -> dict[str, str]:
    words = lambda c: rf"list_distinct(regexp_extract_all(lower({c}), '[a-zà-öø-ÿ0-9]{{3,}}'))"
    any_terms = " + ".join(f"cast(contains(h, '{t}') as int)" for t in ("prefet", "petition", "peat", "moor"))
    return {
        "duplicate_clusters": "select substr(sha256(text), 1, 16) as digest, count(*) as n, min(doc_id) as canonical from documents where text is not null group by sha256(text) having count(*) > 1",
        "duplicate_members": """select doc_id, canonical, rank, n from (select doc_id, min(doc_id) over w as canonical, row_number() over (partition by sha256(text) order by doc_id) as rank,
            count(*) over w as n from documents where text is not null window w as (partition by sha256(text))) where n > 1""",
        "duplicate_report": """select sum(n)::bigint as records, count(*) as contents, sum(n - 1)::bigint as duplicates, count(*) filter (n > 1) as groups, sum((n - 1) * size)::bigint as bytes_saved
            from (select count(*) as n, max(n_chars) as size from documents group by sha256(text))""",
        "jaccard_pairs": f"{_PAIRS} select * from p",
        "jaccard_classes": f"{_SETS} select doc_id, k as rep from f join s on f.ts = s.ts",
        "nearest_earlier_record": f"{_PAIRS} select b as record, a as duplicate_of, similarity from p qualify row_number() over (partition by b order by similarity desc, a) = 1",
        "postings": _POSTINGS,
        "term_frequencies": f"select term, count(*) as df, sum(tf)::bigint as cf from ({_POSTINGS}) group by term",
        "top_terms": f"select term, count(*) as df, sum(tf)::bigint as cf from ({_POSTINGS}) group by term order by df desc, term limit 10",
        "search_all_terms": f"""select doc_id, sum(tf * case term when 'tribunal' then 2 else 1 end)::bigint as score from ({_POSTINGS}) where term in ('tourbieres', 'tribunal')
            group by doc_id having count(*) = 2 order by score desc, doc_id limit 20""",
        "search_any_term": f"select doc_id, {any_terms} as hits from (select doc_id, {fold_sql('coalesce(text, $$$$)')} as h from documents) where {any_terms} > 0 order by hits desc, doc_id limit 20",
        "suggest_terms": f"""with t as (select 0 as o, 'source' as origin, trim(source) as term from catalog_docs union all select 1, 'editeur', trim(editeur) from catalog_docs union all select 2, 'author', trim(author) from catalog_docs),
            f as (select *, {fold_sql('term')} as form from t where term <> ''), one as (select * from f qualify row_number() over (partition by form order by o, term) = 1)
            select term, origin, case when starts_with(form, 'pr') then 0 when contains(form, 'pr') then 1 end as rank from one where contains(form, 'pr') order by rank, o, form limit 10""",
        "highlighted_titles": r"select id, regexp_replace(title, '(?i)(Allmende|communs|land)', '<mark>\1</mark>', 'g') as marked from catalog_docs",
        "fuzzy_title_match": f"""with a as (select id as pdf_id, {words('meta.pdf_title')} as w from catalog_docs where meta.pdf_title is not null), b as (select id as ref_id, {words('title')} as w from catalog_docs where title is not null),
            c as (select pdf_id, ref_id, len(any_value(a.w)) as n, len(any_value(b.w)) as m, count(*) as c from (select *, unnest(w) as t from a) a join (select *, unnest(w) as t from b) b on a.t = b.t group by pdf_id, ref_id)
            select pdf_id, ref_id, round(c / greatest(n, m), 6) as ratio from c where c / greatest(n, m) >= 0.8 qualify row_number() over (partition by pdf_id order by c / greatest(n, m) desc, ref_id) = 1""",
        "source_similarity": """with k as (select source, k, count(*) as n from (select source, unnest(enrichment.matched_keywords) as k from catalog_docs) group by all having count(*) >= 2),
            z as (select source, count(*) as n from k group by source), c as (select a.source as source_a, b.source as source_b, count(*) as c from k a join k b on a.k = b.k and a.source < b.source group by all)
            select * from (select source_a, source_b, round_even(c / (x.n + y.n - c), 3) as overlap from c join z x on x.source = source_a join z y on y.source = source_b) where overlap >= 0.3""",
    }
