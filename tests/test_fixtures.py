"""The feed's plan."""

import pytest
from pyspark.sql import DataFrameWriter

from tripflow.fixtures import as_records, load_feed
from tripflow.plans import queries
from tripflow.plans.queries import _validated
from tripflow.session import write_aside

SF_DIR = "/root/testdata/sf0.001"
JIT_LIMIT = 8000  # bytes of bytecode; the JVM never compiles a longer method


@pytest.mark.parametrize("build", [
    load_feed, lambda spark, sf_dir: load_feed(spark, sf_dir, faults=False),
    lambda spark, sf_dir: as_records(load_feed(spark, sf_dir)), _validated,
])
def test_generated_methods_can_be_compiled(spark, build):
    code = build(spark, SF_DIR)._jdf.queryExecution().debug().codegenToSeq()
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    assert sizes and max(sizes) < JIT_LIMIT


def code_sizes(rows):
    code = rows._jdf.queryExecution().debug().codegenToSeq()
    return [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]


def test_strict_load_can_be_compiled(spark, monkeypatch):
    """Feed and strict parse in one task's code came to 15,871 bytes."""
    sizes = {}

    def measured(rows, label):
        sizes[label] = max(code_sizes(rows))
        return write_aside(rows, label)

    monkeypatch.setattr(queries, "write_aside", measured)
    assert queries.strict_load(spark, SF_DIR).count() == 994  # six of 1,000 come again
    assert "strict" in sizes and max(sizes.values()) < JIT_LIMIT


def test_event_files_are_sorted_before_their_lines_are_made(spark, monkeypatch):
    plans = []
    text = DataFrameWriter.text

    def recorded(writer, *args, **options):
        plans.append(writer._df)
        return text(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "text", recorded)
    folder = queries._event_files(spark, SF_DIR)
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(event_id" in plan and plan.count("Exchange") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert max(code_sizes(plans[0].select("raw_json"))) < JIT_LIMIT
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected = load_feed(spark, SF_DIR, faults=False).orderBy("n").select("raw_json").collect()
    assert [row["value"] for row in spark.read.text(folder).collect()] == [row["raw_json"] for row in expected]


@pytest.mark.parametrize("name", ["quarantine", "load_counts", "curated_marts"])
def test_a_clean_zone_that_is_loaded_twice_is_made_once(spark, monkeypatch, name):
    inputs = []
    stage = queries.Warehouse.stage_from_clean

    def recorded(warehouse, clean):
        inputs.extend(clean.inputFiles())
        return stage(warehouse, clean)

    monkeypatch.setattr(queries.Warehouse, "stage_from_clean", recorded)
    assert queries.QUERIES[name](spark, SF_DIR).count()
    assert inputs and not any("events.parquet" in path for path in inputs)
