"""Named queries of the problems tagged llm, and their SQL where there is any."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import abuse, language, lookalike, mixing, names, near_dup, packing, residue, tokens
from quernstone.session import materialize, table

_RESIDUE_FIELDS = {"summary": "enrichment.summary", "pdf_title": "meta.pdf_title"}


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "catalog_docs")


# --- 1: names -------------------------------------------------------------------------------


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _catalog(spark, sf_dir)
    typed = cat.select(F.col("meta.pdf_author").alias("name")).unionByName(cat.select(F.explode("enrichment.acteurs").alias("name")))
    return names.resolve_names(typed)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of the same person or organisation."""
    return names.spelling_pairs(_entities(spark, sf_dir))


def p1_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with the entity it denotes."""
    return _entities(spark, sf_dir)


# --- 2: near-duplicate works ----------------------------------------------------------------


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _catalog(spark, sf_dir)
    bad = residue_marks(cat, ("summary",)).where("is_residue").select(F.col("rec_key").alias("id"))
    members, links = near_dup.work_links(cat, "id", "title", "enrichment.summary", "url", bad)
    return near_dup.works(members, links)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of records of the same work."""
    return near_dup.work_pairs(materialize(_works(spark, sf_dir), "works"))


def p2_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record: its work and its number of links."""
    return _works(spark, sf_dir)


# --- 3: look-alikes -------------------------------------------------------------------------


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = lookalike.lookalike_forms(_catalog(spark, sf_dir), "id", "title", "title")
    quotes = lookalike.lookalike_forms(table(spark, sf_dir, "citations"), "cit_id", "quote", "quote")
    return materialize(titles.unionByName(quotes), "forms")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows whose texts look the same but differ in characters."""
    return lookalike.lookalike_pairs(_forms(spark, sf_dir))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title and quote in its consistent form, with its class."""
    return lookalike.lookalike_classes(_forms(spark, sf_dir))


# --- 4: residue -----------------------------------------------------------------------------


def _residue_model(cat: DataFrame) -> tuple[residue.Residue, dict[str, float]]:
    fields = {n: (F.col(c), n == "pdf_title") for n, c in _RESIDUE_FIELDS.items()}
    return residue.train_residue(cat, "id", fields, F.col("download_status"), F.col("url"))


def residue_marks(cat: DataFrame, names: tuple[str, ...] = ("summary", "pdf_title")) -> DataFrame:
    model, _ = _residue_model(cat)
    return residue.mark_residue(cat, model, "id", {n: (F.col(_RESIDUE_FIELDS[n]), n == "pdf_title") for n in names})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries and pdf titles that are or contain residue."""
    return residue_marks(_catalog(spark, sf_dir)).where("is_residue").select("field", F.col("rec_key").alias("id")).distinct()


def p4_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of the classifier on hosts it has not seen."""
    _, measures = _residue_model(_catalog(spark, sf_dir))
    return spark.createDataFrame(sorted((k, float(v)) for k, v in measures.items()), "measure string, value double")


# --- 5: language ----------------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _catalog(spark, sf_dir).select(F.col("enrichment.summary").alias("text"), "lang")
    return cat.unionByName(table(spark, sf_dir, "citations").select(F.col("quote").alias("text"), "lang"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    dicts = language.train_dictionaries(_labelled(spark, sf_dir), "text", "lang")
    cat = _catalog(spark, sf_dir)
    bad = residue_marks(cat, ("summary",)).where("is_residue").select(F.col("rec_key").alias("id"))
    kept = cat.select("id", F.col("enrichment.summary").alias("text"), "lang").join(bad, "id", "left_anti")
    quotes = table(spark, sf_dir, "citations")
    return language.language_segments(kept, dicts, "id", "text", F.col("lang"), "summary").unionByName(
        language.language_segments(quotes, dicts, "cit_id", "quote", F.col("lang"), "quote")
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of the texts whose label is missing or wrong, or that mix languages."""
    return language.wrong_labels(_segments(spark, sf_dir)).select("field", "rec_key", "seg_no", "lang").distinct()


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of every text with its language and confidence."""
    return _segments(spark, sf_dir).withColumn("confidence", F.round("confidence", 6))


# --- 7: packing -----------------------------------------------------------------------------


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[str, int]]]:
    specs = [(r["spec_name"], r["capacity_tokens"]) for r in table(spark, sf_dir, "pack_specs").orderBy("capacity_tokens", "spec_name").collect()]
    sizes = materialize(tokens.token_counts(table(spark, sf_dir, "documents")), "tokens")
    return packing.pack(sizes, specs), specs


def p7_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container of every text (of every piece, above the capacity) for each spec."""
    return _packed(spark, sf_dir)[0]


def p7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and unused space per spec."""
    packed, specs = _packed(spark, sf_dir)
    return packing.summary(packed, specs)


# --- 8: mixing ------------------------------------------------------------------------------


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = materialize(tokens.token_counts(table(spark, sf_dir, "documents"), keep=("source",), digest=True), "tokens")
    return mixing.mix_sources(sizes, table(spark, sf_dir, "mix_targets"))


def p8_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each mix with the number of their uses."""
    return _mixed(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source of each mix."""
    return _mixed(spark, sf_dir)[1]


# --- 9: abuse -------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = abuse.train_abuse(docs, table(spark, sf_dir, "toxic_labels"))
    return abuse.score_documents(docs, model)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with abusive, hateful or sexually explicit language."""
    return _scored(spark, sf_dir).where("flagged").select("doc_id").distinct()


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document and its most offending sentence."""
    return _scored(spark, sf_dir).select("doc_id", "source", F.round("score", 5).alias("score"), "sentence_no", "n_offending", "flagged")


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of flagged documents per source."""
    return abuse.rates(_scored(spark, sf_dir))


def queries() -> dict:
    found = [p1_found, p1_entities, p2_found, p2_works, p3_found, p3_canonical, p4_found, p4_validation, p5_found, p5_segments, p7_assignment, p7_summary, p8_selection, p8_shares, p9_found, p9_scores, p9_rates]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {}
