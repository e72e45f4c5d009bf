"""Surrogate keys: assignment to new rows and lookup from facts."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_shared_checkpoints, write_aside

# Dimensions that grow with the data. Only ids and keys are shuffled to them; Catalyst chooses the join of the others by their statistics.
GROWING = frozenset({"dim_driver", "dim_rider"})

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row's position in the low 33 bits


def max_key(table: DataFrame | None, key: str) -> int:
    return 0 if table is None else table.agg(F.max(key)).first()[0] or 0


def assign_keys(new_rows: DataFrame, natural_key: str, key: str, start: int = 0) -> DataFrame:
    """Adds ``key`` = ``start`` + rank by ``natural_key``, which must be unique in ``new_rows``.

    The ranking is global but no task sees more than its share: natural keys are range-partitioned,
    numbered inside their range, and shifted by the sizes of the ranges before it. Range bounds come
    from sampling, so the numbered keys are checkpointed once and never recomputed with other bounds.
    Only the natural keys are ranked and checkpointed. Rows with other columns are written aside first, so that what they
    are computed from runs once, and get their keys by a join.
    """
    use_shared_checkpoints(new_rows.sparkSession)
    if new_rows.columns != [natural_key]:
        new_rows = write_aside(new_rows, "new-rows")
    numbered = (
        new_rows.select(natural_key)
        .repartitionByRange(natural_key)
        .sortWithinPartitions(natural_key)
        .withColumn("slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("range_no", F.shiftright("slot", _POSITION_BITS))
    )
    # One row per range, so its size is that of the shuffle's partition list and not of the data.
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("range_no").agg(F.count("*").alias("size"))
        .select("range_no", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    position = F.col("slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    ranked = numbered.join(F.broadcast(offsets), "range_no").select(
        (F.lit(start) + F.col("offset") + position + 1).cast("bigint").alias(key), natural_key
    )
    if new_rows.columns == [natural_key]:
        return ranked
    return new_rows.join(ranked, natural_key).select(key, *new_rows.columns)


class Lookup(NamedTuple):
    """Fill ``fact.key_column`` from ``dim.dim_key`` where ``fact_value`` equals ``dim.natural_key``."""

    key_column: str
    fact_value: Column
    dim: str
    natural_key: str
    dim_key: str


def _date_lookup(key_column: str, time_column: str) -> Lookup:
    return Lookup(key_column, F.to_date(time_column), "dim_date", "full_date", "date_key")


def event_lookups() -> list[Lookup]:
    return [*_common_lookups(), *_location_lookups(), _date_lookup("event_date_key", "event_timestamp")]


def trip_lookups() -> list[Lookup]:
    return [*_common_lookups(), *_location_lookups(), _date_lookup("trip_date_key", "trip_completed_at")]


def payment_lookups() -> list[Lookup]:
    return [*_common_lookups(), _date_lookup("payment_date_key", "payment_timestamp")]


def _common_lookups() -> list[Lookup]:
    return [
        Lookup("payment_method_key", F.col("payment_method"), "dim_payment_method",
               "payment_method_name", "payment_method_key"),
        Lookup("driver_key", F.col("driver_id"), "dim_driver", "driver_id", "driver_key"),
        Lookup("rider_key", F.col("rider_id"), "dim_rider", "rider_id", "rider_key"),
    ]


def _location_lookups() -> list[Lookup]:
    return [
        Lookup(f"{side}_location_key", F.col(f"{side}_location"), "dim_location", "location_name", "location_key")
        for side in ("pickup", "dropoff")
    ]


def fill_keys(
    fact: DataFrame, lookups: list[Lookup], dims: dict[str, DataFrame], row_id: str, growing: frozenset[str] = GROWING
) -> DataFrame:
    """Sets each key column that is null and has a match; set keys and unmatched rows stay as they are.

    All keys of a fact are filled in one plan. ``row_id`` is unique in the fact. A dimension that names a value twice, as two
    unguarded writers can make it, gives its smallest key, so no join multiplies rows.

    For the dimensions in ``growing`` only pairs of row id and natural key travel to the dimension. What all of them find travels back
    in one shuffle of row ids and keys, which is dealt out as the fact is, so the fact's other columns stay where they are. Rows without a
    natural key take no part, so null is never a hot key, and adaptive execution splits the partitions of names that are.
    """
    filled = fact
    grown = [lookup for lookup in lookups if lookup.dim in growing]
    if grown:
        keys, partitions = found_keys(fact, grown, dims, row_id), own_partitions(fact, row_id)
        if partitions:
            keys = keys.repartition(partitions, row_id)
        # Reduced after the joins and not before them: only a join of two plain shuffles can be split where a name is hot.
        found = F.col("found")
        smallest = [F.min(F.when(found["lookup"] == x.key_column, found["key"])).alias(f"found_{x.key_column}") for x in grown]
        keys = keys.groupBy(row_id).agg(*smallest)
        filled = filled.join(keys.hint("shuffle_hash" if partitions else "merge"), row_id, "left")
    for lookup in lookups:
        found, wanted = f"found_{lookup.key_column}", f"wanted_{lookup.key_column}"
        if lookup not in grown:
            side = _side(lookup, dims, wanted, found).groupBy(wanted).agg(F.min(found).alias(found))
            filled = filled.join(side, lookup.fact_value == F.col(wanted), "left")
        key = F.col(found).cast(fact.schema[lookup.key_column].dataType)
        filled = filled.withColumn(lookup.key_column, F.coalesce(lookup.key_column, key)).drop(found, wanted)
    return filled.select(*fact.columns)


def found_keys(fact: DataFrame, lookups: list[Lookup], dims: dict[str, DataFrame], row_id: str) -> DataFrame:
    """(row_id, found): the key column and the key of every open key that has a match."""
    parts = []
    for lookup in lookups:
        wanted, key = f"wanted_{lookup.key_column}", f"found_{lookup.key_column}"
        pairs = fact.filter(_is_open(lookup)).select(row_id, lookup.fact_value.alias(wanted))
        found = F.struct(F.lit(lookup.key_column).alias("lookup"), F.col(key).cast("bigint").alias("key"))
        side = _side(lookup, dims, wanted, key)
        side = side.hint("merge") if lookup.dim in GROWING else side  # else the pairs or the names may be broadcast
        parts.append(pairs.join(side, wanted).select(row_id, found.alias("found")))
    return reduce(DataFrame.unionByName, parts)


def _side(lookup: Lookup, dims: dict[str, DataFrame], wanted: str, found: str) -> DataFrame:
    return dims[lookup.dim].select(F.col(lookup.natural_key).alias(wanted), F.col(lookup.dim_key).alias(found))


def own_partitions(rows: DataFrame, row_id: str) -> int | None:
    """The number of partitions, if rows are already dealt out by the hash of ``row_id``: by a table's buckets, or by ``repartition`` with a number.

    Spark would else bring both sides of a join to ``spark.sql.shuffle.partitions``, moving the larger side for the sake of the smaller.
    Rows are only planned here.
    """
    plan = rows.groupBy(row_id).count()._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    partitions = plan.outputPartitioning().numPartitions()
    while plan.children().size() == 1:
        if plan.nodeName() == "Exchange":
            return partitions if plan.shuffleOrigin().toString() == "REPARTITION_BY_NUM" else None
        plan = plan.children().apply(0)
    return partitions


def buckets_of(row_ids: DataFrame, row_id: str, buckets: int) -> list[int]:
    """The buckets that these rows are in, by the hash that deals tables out into buckets."""
    bucket = F.pmod(F.hash(row_id), F.lit(buckets)).alias("bucket")
    return sorted(row["bucket"] for row in row_ids.select(bucket).distinct().collect())


def _is_open(lookup: Lookup) -> Column:
    return F.col(lookup.key_column).isNull() & lookup.fact_value.isNotNull()


def unfilled(fact: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Rows with a key still null although its natural value is known. Files whose statistics show no null key are skipped."""
    null_key = reduce(or_, (F.col(lookup.key_column).isNull() for lookup in lookups))
    return fact.filter(null_key).filter(reduce(or_, map(_is_open, lookups)))


def key_coverage(fact: DataFrame, key_columns: list[str]) -> DataFrame:
    """One row per key column: rows in the fact and rows whose key is missing."""
    counts = fact.agg(F.count("*").alias("rows_total"), *(F.count_if(F.col(k).isNull()).alias(k) for k in key_columns))
    return counts.unpivot(["rows_total"], key_columns, "key_column", "rows_missing")
