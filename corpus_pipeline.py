"""A training corpus from raw documents: judge, identify, deduplicate, redact, pack.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame, which is written and read again before the next. All but the last return the columns
of documents. Null texts fail the quality rules; an empty table goes through as one. Extra columns,
whatever their names, pass through all stages but the last; n_chars follows the text where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm import jaccard_join, language_id, packing, pii, quality
from tidegraph.llm.common import documents, drop_scratch, fold, materialise
from tidegraph.session import importable

#: A text that several languages' samples explain alike is rejected below this score.
LEAST_LANGUAGE_SCORE = 0.4
#: One that no sample explains needs many phrases: more than this multiple of what this share of the
#: held-out labelled texts of its language need at most, and SHORT phrases that any text may have over.
PHRASE_MULTIPLE, PHRASE_SHARE, SHORT = 2.0, 0.9, 8.0


def _rows(docs: DataFrame) -> DataFrame:
    """Whole rows in one column beside the id and the text, so that no column's name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    # the row comes along, so that the verdict needs no join back to it
    return quality.judge(_rows(docs), labels, keep=["doc_id", "__row"]).where("kept").select("__row.*")


def phrase_bounds(docs: DataFrame) -> dict[str, float]:
    """The most phrases per character by language, from labelled texts that the model has not seen."""
    labelled = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    found = language_id.predict(labelled.where(fold("doc_id", 4) == 2), language_id.fit(labelled.where(fold("doc_id", 4) != 2)))
    right = found.where("lang_pred = lang").groupBy("lang").agg(F.percentile_approx("score_phrase_rate", PHRASE_SHARE).alias("rate"))
    return {r["lang"]: PHRASE_MULTIPLE * r["rate"] for r in right.collect()}  # a row for each language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; a missing label is filled in.

    A language without a held-out text has the largest bound of the others; without any, none."""
    importable(spark)
    bounds = phrase_bounds(docs)
    found = language_id.predict(_rows(docs), language_id.fit(docs))
    most = F.lit(max(bounds.values(), default=float("inf")))
    for lang, bound in sorted(bounds.items()):
        most = F.when(F.col("lang_pred") == lang, F.lit(bound)).otherwise(most)
    explained = F.col("score_phrase_rate") <= most + SHORT / F.greatest(F.length("text"), F.lit(1))
    kept = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE) & explained)
    return kept.select(F.col("__row").withField("lang", F.coalesce("__row.lang", "lang_pred")).alias("__row")).select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    importable(spark)
    return jaccard_join.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; the length column follows the text."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: Learned models decide three stages, which SQL can't express; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES[:-1]):
        done = materialise(stage(spark, docs, sf_dir), name)
        if place:  # nobody reads the stage before any more
            drop_scratch(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
