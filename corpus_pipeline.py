"""A corpus through five of the operators: each stage reads what the one before it kept.

Documents without a doc_id are left out by the stages that decide by id. Rows with one doc_id share one decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm import decontamination, jaccard_join, language_id, line_dedup, packing
from pairsmith.llm.tables import table, written


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: null texts, texts without a letter, and those of which the filters
    hold no more for any language than chance gives (score 0)."""
    model = language_id.documents_model(spark, sf_dir)
    return language_id.tagged(docs, model).where((F.col("lang_pred") != language_id.UND) & (F.col("score") > 0)).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated windows of three lines out of the texts; documents of which nothing is left go."""
    return line_dedup.dedup_lines(docs).where("text <> ''")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each group of near duplicates."""
    found = jaccard_join.near_duplicates(docs)
    drop = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_drop")), "drop")
    return _without(docs, drop)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak a benchmark item."""
    found = decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, written(found.select(F.col("doc_id").alias("_drop")).distinct(), "drop"))


def _without(docs: DataFrame, drop: DataFrame) -> DataFrame:
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    return row.join(drop, F.col("row.doc_id") == F.col("_drop"), "left_anti").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of what is left: a row for each piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", keep_known_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None  # SQL can't express the language filters and the tokenizer; tests compare stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
