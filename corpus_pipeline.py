"""The corpus pipeline: five stages, each over what the one before kept.

Every stage but the last returns the columns of ``documents``. A stage is written as
Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandtide.llm.decontaminate import clean
from demandtide.llm.language_id import accepted, train_model
from demandtide.llm.line_chunks import passage_dedup
from demandtide.llm.minhash_dedup import minhash_dedup
from demandtide.llm.packing import pack, word_count
from demandtide.llm.storage import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without letters and very unsure ones go."""
    return accepted(docs, train_model(docs.select("doc_id", "text", "lang")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines taken out; documents left without any text go. n_chars follows the new text."""
    cut = passage_dedup(docs)
    emptied = (F.col("removed_lines") > 0) & (F.trim("text") == "")
    kept = cut.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    gone = minhash_dedup(docs).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(stored(gone, "near-copies"), F.col("doc_id") == F.col("__gone"), "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in length buckets and batches; a document counts its words and an end mark."""
    return pack(docs.select("doc_id", (word_count(F.col("text")) + 1).alias("n_tokens")))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("packing", packing),
]

#: The classifier's decisions cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
