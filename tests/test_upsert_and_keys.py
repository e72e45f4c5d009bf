import random

import pytest
from pyspark.sql import functions as F

from tripflow.operators.keys import Lookup, assign_keys, fill_keys, key_coverage, unfilled
from tripflow.operators.upsert import absent_from, first_per_key, insert_if_absent


def brute_force(existing, incoming):
    seen, added = set(existing), {}
    for key, order, value in sorted(incoming, key=lambda r: r[1]):
        if key not in seen:
            seen.add(key)
            added[key] = value
    return added


def test_insert_if_absent_against_brute_force(spark):
    rng = random.Random(3)
    existing = [f"k{i}" for i in range(0, 300, 3)]
    orders = list(range(3000))
    rng.shuffle(orders)
    # A third of all rows share one new key, another third one existing key.
    names = ["hot"] * 1000 + ["k0"] * 1000 + [f"k{rng.randrange(300)}" for _ in range(1000)]
    incoming = [(name, order, f"v{order}") for name, order in zip(names, orders)]
    target = spark.createDataFrame([(k, "old") for k in existing], "key string, value string")
    frame = spark.createDataFrame(incoming, "key string, ord bigint, value string").repartition(7)
    rows = insert_if_absent(target, frame, "key", ["ord"])
    assert rows.columns == ["key", "value"]
    assert {r.key: r.value for r in rows.collect()} == brute_force(existing, incoming)
    again = insert_if_absent(target.unionByName(rows), frame, "key", ["ord"])
    assert again.isEmpty()


def test_a_repeated_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(0, 100_000, numPartitions=4).select(
        F.when(F.col("id") >= 0, "hot").alias("key"), F.col("id").alias("ord"), F.col("id").alias("value")
    )
    first = first_per_key(frame, "key", ["ord"])
    assert first.collect() == [("hot", 0)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(") < plan.index("WindowGroupLimit [key", plan.index("Exchange hashpartitioning("))


def test_equal_order_picks_the_same_row_every_time(spark):
    rows = [("a", 1, "x"), ("a", 1, "b"), ("a", 1, None)]
    for shuffle in (rows, rows[::-1]):
        frame = spark.createDataFrame(shuffle, "key string, ord int, value string").repartition(3)
        assert first_per_key(frame, "key", ["ord"]).first().value is None


@pytest.mark.parametrize("start", [0, 41])
def test_keys_are_ranks_across_many_ranges(spark, start):
    names = [f"n{i:05d}" for i in range(5000)]
    random.Random(1).shuffle(names)
    frame = spark.createDataFrame([(n, n[::-1]) for n in names], "name string, other string").repartition(9)
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = assign_keys(frame, "name", "name_key", start)
        found = {r.name: (r.name_key, r.other) for r in keyed.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert found == {n: (start + i + 1, n[::-1]) for i, n in enumerate(sorted(names))}
    assert keyed.columns == ["name_key", "name", "other"]


def test_no_new_rows_get_no_keys(spark):
    assert assign_keys(spark.createDataFrame([], "name string"), "name", "k", 5).isEmpty()


@pytest.fixture
def fact(spark):
    rows = [(1, "a", None, 900), (2, "b", None, None), (3, None, None, None), (4, "zz", None, None), (5, "a", 77, None)]
    rows += [(i, "hot", None, None) for i in range(6, 1006)]
    return spark.createDataFrame(rows, "id int, name string, first_key bigint, second_key bigint")


@pytest.mark.parametrize("growing", [frozenset(), frozenset({"dim"})])
def test_fill_keys(spark, fact, growing):
    """Both joins: set keys stay, unmatched and null names stay null, no row is lost or doubled by a name with two keys."""
    dim = spark.createDataFrame([(10, "a"), (20, "b"), (30, "hot"), (31, "hot"), (40, "unused")], "name_key bigint, name string")
    lookups = [
        Lookup(column, F.col("name"), "dim", "name", "name_key") for column in ("first_key", "second_key")
    ]
    filled = fill_keys(fact, lookups, {"dim": dim}, "id", growing)
    assert filled.count() == fact.count()
    found = {r.id: (r.first_key, r.second_key) for r in filled.collect()}
    expected = {1: (10, 900), 2: (20, 20), 3: (None, None), 4: (None, None), 5: (77, 10)}
    assert found == expected | {i: (30, 30) for i in range(6, 1006)}
    assert filled.columns == fact.columns
    assert {r.id for r in unfilled(filled, lookups).collect()} == {4}
    coverage = {r.key_column: (r.rows_total, r.rows_missing) for r in key_coverage(filled, ["first_key"]).collect()}
    assert coverage == {"first_key": (1005, 2)}


def test_the_plan_does_not_count_dimensions(spark, fact):
    """No job runs while a plan is built, and Catalyst may broadcast a small dimension."""
    dim = spark.range(10).select(F.col("id").alias("name_key"), F.col("id").cast("string").alias("name"))
    lookups = [Lookup("first_key", F.col("name"), "dim", "name", "name_key")]
    spark.sparkContext.setJobGroup("planning", "none")
    filled = fill_keys(fact, lookups, {"dim": dim}, "id")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
    spark.sparkContext.setJobGroup("", "")
    assert "Join" in filled._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_in_the_shuffle_join(spark):
    """Half of the fact has one name; adaptive execution divides that partition among tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        fact = spark.range(0, 200_000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("string").alias("name"),
            F.col("id"), F.lit(None).cast("bigint").alias("name_key"),
        )
        dim = spark.range(1000).select(F.col("id").alias("dim_key"), F.col("id").cast("string").alias("dim_name"))
        filled = fill_keys(fact, [Lookup("name_key", F.col("name"), "dim", "dim_name", "dim_key")], {"dim": dim}, "id", frozenset({"dim"}))
        assert [r.name for r in filled.filter("name_key <> CAST(name AS BIGINT) OR name_key IS NULL").take(1)] == []
        assert len(filled.collect()) == 200_000
        assert "skew=true" in filled._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in conf:
            spark.conf.unset(name)


def test_nothing_that_grows_is_broadcast(spark, fact):
    rows = spark.range(10).select(F.col("id").cast("string").alias("key"))
    drivers = spark.createDataFrame([("d", 1)], "driver_id string, driver_key bigint")
    lookup = Lookup("driver_key", F.col("driver_id"), "dim_driver", "driver_id", "driver_key")
    trips = spark.createDataFrame([("r", "d", None)], "ride_id string, driver_id string, driver_key bigint")
    for plan in (absent_from(rows, rows, "key"), fill_keys(trips, [lookup], {"dim_driver": drivers}, "ride_id")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text
