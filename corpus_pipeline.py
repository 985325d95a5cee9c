"""The corpus pipeline: each stage is one of the ``shopflow.llm`` operators.

Language models and quality models are trained on the stage's whole own input (languages
on all outside op7's held-out fifth, quality on all labelled documents in it); each stage works on all that the one before
kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import language_id, near_duplicates, quality_rules
from shopflow.llm import queries as Q
from shopflow.llm.common import documents, free_names, quoted, written


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; goes: what has no letter, or fits its likeliest language far worse than
    the texts it was learned from (``least_fit``)."""
    lang, score, fit = added = free_names(docs.columns, "lang_pred", "score", "fit")
    scored = written(language_id.predict(docs, Q.language_model(docs), docs.columns, added=added), "pipeline-scored")
    # the texts that the model was learned from, each once
    taught = Q.teaches_language(scored).where("text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h"), F.col(lang).alias("pred"), F.col(fit).alias("fit")).distinct()
    fits = language_id.least_fits(taught, lang_pred="pred")
    least = F.coalesce(*[F.when(F.col(lang) == k, F.lit(v)) for k, v in fits.items()], F.lit(float("inf")))
    return scored.where(F.col(fit) >= least).select(*quoted(docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = Q.quality_model(spark, docs, sf_dir)
    added = free_names(docs.columns, *(name for name, _ in quality_rules.ADDED))
    return quality_rules.apply_rules(docs, model, docs.columns, added=added).where(F.col(added[-1])).select(*quoted(docs.columns))


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least id; of repeated rows one."""
    id_, node, n = free_names(docs.columns, "id", "node", "n")
    kept = (near_duplicates.duplicate_classes(docs.select("doc_id", "text")).where("is_kept")
            .groupBy(F.col("doc_id").alias(id_), F.col("node").alias(node)).agg(F.count("*").alias(n)))
    found = docs.join(kept, docs["doc_id"].eqNullSafe(F.col(id_)) & (near_duplicates.text_key(docs["text"]) == F.col(node)))
    once, more = found.where(F.col(n) == 1), found.where(F.col(n) > 1).dropDuplicates([id_, node])
    return once.unionByName(more).select(*quoted(docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of all documents that are left."""
    return Q.packed_documents(docs.select("doc_id", "text"))


STAGES = [("language ID", languages), ("quality rules", quality), ("near-duplicates", duplicates), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
