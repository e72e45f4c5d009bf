"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import round_trip_report
from .common import read_table
from .decontaminate import contamination_report
from .filter_audit import audit_report
from .licenses import scan as license_scan
from .line_dedup import line_report
from .lm_scoring import lm_scores
from .near_dedup import near_report
from .packing import pack
from .quality_rules import quality_report
from .secrets import scan as secret_scan
from .unit_dedup import removal_report
from .vector_codes import code_report
from .warc import archive_report


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(read_table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(read_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_report(read_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(read_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_report(read_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_report(read_table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_lm_scoring, op2_warc_bundles, op3_secret_scan, op4_near_dedup, op5_decontaminate, op6_license_scan, op7_quality_rules,
        op8_best_fit_packing, op9_line_dedup, op10_substring_dedup, op11_byte_bpe, op12_vector_codes,
        op13_filter_audit,
    )
}
