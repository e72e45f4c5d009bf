"""The training-data pipeline: quality rules, line dedup, near-duplicates, benchmark passages, packing.

Every stage takes all documents that the one before kept. All but the last return the columns of ``documents``; the last returns the packed
pieces. Between stages the documents are a written table, so a lost executor repeats work of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import read_table, row_key, write_aside
from tripflow.llm.decontaminate import drop_contaminated
from tripflow.llm.line_dedup import drop_lines
from tripflow.llm.near_dedup import keep_first
from tripflow.llm.packing import pack
from tripflow.llm.quality_rules import quality_filter


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shorter = drop_lines(docs)
    return shorter.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies lose different lines to documents before them, so documents that lost some are compared by their whole texts too. What has no
    word left was made of other documents' lines."""
    left = docs.select(F.col("doc_id").alias("left_id"), row_key(F.col("text")).alias("left_row"))
    shortened = (F.col("doc_id") == F.col("left_id")) & (row_key(F.col("text")) != F.col("left_row"))
    whole = read_table(spark, sf_dir, "documents").select("doc_id", "text").join(left, shortened, "left_semi")
    return keep_first(docs, whole).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # hashed n-gram models and byte-level BPE are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_aside(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
