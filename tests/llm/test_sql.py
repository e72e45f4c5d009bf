"""Every corpus query with SQL against it, over whole tables, and the registry."""

import os

import duckdb
import pytest

import corpus_pipeline
from tests.test_oracle import canonical
from tripflow.llm.oracle import LLM_SQL
from tripflow.llm.queries import LLM_QUERIES

from .helpers import SF_DIR


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_matches_sql(spark, oracle, name):
    frame = LLM_QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(LLM_SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(columns)
    assert canonical(frame.columns, frame.collect()) == canonical(columns, expected.fetchall())


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_runs_every_stage(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(os.path.join(SF_DIR, "documents.parquet"))
    pieces = corpus_pipeline.run(spark, SF_DIR)
    sums = pieces.groupBy("sequence_id").sum("length").collect()
    assert sums and all(r["sum(length)"] <= 1024 for r in sums)
    assert pieces.select("doc_id").distinct().count() < docs.count()


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(os.path.join(SF_DIR, "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema.simpleString() == docs.schema.simpleString()
