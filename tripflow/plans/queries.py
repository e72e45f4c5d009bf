"""The registered queries: every operator over the whole ``events`` table.

Each takes ``(spark, sf_dir)``. Wall-clock columns are left out, as no two runs agree on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import as_records, load_feed, read_events, ride_feed
from ..operators import dims, facts, marts, quality
from ..operators.keys import fill_keys, key_coverage as count_missing_keys
from ..operators.parse import decode_envelope, normalise
from ..operators.staging import (
    ZONE_ORDER,
    stage_events as rows_to_stage,
    staging_rows_from_clean,
    staging_rows_from_files,
)
from ..operators.strict import check_strict, strict_violations as count_violations
from ..operators.validate import split_valid, validate
from ..operators.zones import clean_zone, raw_zone, rejected_zone
from ..schemas import EVENT_FIELDS, STAGING_REQUIRED, UNIQUE_COLUMN
from ..session import shared_path, write_aside
from ..sources.files import newest_file, numbered_bad_lines, parse_lines
from ..sources.landing import land_raw_files, landed_digests
from ..sources.streams import RecordFiles, tap_view
from ..streaming.job import route_batch, start_streaming
from ..streaming.lake import Lake
from .batch import load_star, refresh_marts, run_batch
from .warehouse import Warehouse, bucket_of_file

WALL_CLOCK = ["ingested_at", "ingestion_date", "created_at", "loaded_at"]

# Incremental queries: an earlier load ended at this time; the new load delivers the whole feed again.
FIRST_DAY_END = "2024-01-02"
FIRST_HALF_END = "2024-01-16"


def _portable(df: DataFrame) -> DataFrame:
    df = df.drop(*WALL_CLOCK)
    if "kafka_timestamp" in df.columns:
        df = df.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))
    return df


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_envelope(as_records(load_feed(spark, sf_dir)))


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(_envelope(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_normalised(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    clean = clean_zone(_validated(spark, sf_dir))
    if until:
        clean = clean.filter(F.col("kafka_timestamp") < F.lit(until).cast("timestamp"))
    return rows_to_stage(None, staging_rows_from_clean(clean), ZONE_ORDER)


def _staged_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_aside(_staged(spark, sf_dir), "staged")


# -- parsing, validation, zones --------------------------------------------------------------------


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir).select("offset", *EVENT_FIELDS)


def tap_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(tap_view(as_records(load_feed(spark, sf_dir))))


def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("offset", *EVENT_FIELDS, "validation_error", "is_valid")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(raw_zone(_envelope(spark, sf_dir)))


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(clean_zone(_validated(spark, sf_dir)))


def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(rejected_zone(_validated(spark, sf_dir)))


def rejection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid(_validated(spark, sf_dir))
    return quality.rejection_summary(rejected, ("validation_error",))


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.batch_metrics(_validated(spark, sf_dir))


# -- staging ---------------------------------------------------------------------------------------


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir)


def stage_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging_rows_from_clean(clean_zone(_validated(spark, sf_dir)))
    return rows_to_stage(_staged(spark, sf_dir, FIRST_HALF_END), rows, ZONE_ORDER)


def strict_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written first: one task's code for feed and strict parse together is more than the JVM compiles.
    lines = write_aside(load_feed(spark, sf_dir, faults=False).select(F.col("raw_json").alias("value"), "offset"), "lines")
    events = parse_lines(lines, "offset").withColumnRenamed("offset", "arrival")
    rows = write_aside(staging_rows_from_files(events), "strict")
    return rows_to_stage(None, check_strict(rows), ["arrival"])


def strict_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_violations(staging_rows_from_clean(_normalised(spark, sf_dir)))


# -- dimensions ------------------------------------------------------------------------------------


def dim_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_payment_method(_staged(spark, sf_dir))


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(_staged(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_date(_staged(spark, sf_dir))


def dim_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_driver(_staged(spark, sf_dir))


def dim_rider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_rider(_staged(spark, sf_dir))


def dim_rider_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after two loads: the first day, then everything."""
    first = write_aside(dims.dim_rider(_staged(spark, sf_dir, FIRST_DAY_END)), "riders")
    return first.unionByName(dims.dim_rider(_staged(spark, sf_dir), first))


# -- facts -----------------------------------------------------------------------------------------


def fct_ride_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_ride_events(_staged(spark, sf_dir))


def fct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_trips(_staged(spark, sf_dir))


def fct_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_payments(_staged(spark, sf_dir))


def fct_trips_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after two loads: the first half of the month, then everything."""
    first = write_aside(facts.fct_trips(_staged(spark, sf_dir, FIRST_HALF_END)), "trips")
    return first.unionByName(facts.fct_trips(_staged(spark, sf_dir), first))


def _filled(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    staged = _staged_once(spark, sf_dir)
    build, lookups = facts.FACTS[name]
    wanted = {lookup.dim for lookup in lookups()}
    built = {dim: dims.DIMENSIONS[dim](staged) for dim in wanted}
    return fill_keys(build(staged), lookups(), built, UNIQUE_COLUMN[name])


def fill_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir, "fct_ride_events")


def fill_trip_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir, "fct_trips")


def fill_payment_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir, "fct_payments")


def key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that meet the table constraints but were never validated, keyed from validated staging."""
    rows = staging_rows_from_clean(_normalised(spark, sf_dir)).dropna(subset=STAGING_REQUIRED)
    fact = write_aside(facts.fct_ride_events(rows_to_stage(None, rows, ZONE_ORDER)), "fact")
    lookups = facts.event_lookups()
    staged = _staged_once(spark, sf_dir)
    built = {name: build(staged) for name, build in dims.DIMENSIONS.items()}
    return count_missing_keys(fill_keys(fact, lookups, built, "event_id"), [x.key_column for x in lookups])


# -- end to end ------------------------------------------------------------------------------------


def _routed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The feed as record files, streamed through the routing job into a fresh lake."""
    root = shared_path(spark, "stream")
    as_records(load_feed(spark, sf_dir)).write.parquet(f"{root}/records")
    lake = Lake(f"{root}/lake")
    start_streaming(
        spark, RecordFiles(f"{root}/records"), lake, f"{root}/checkpoint", trigger=None
    ).awaitTermination()
    return lake


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _routed_lake(spark, sf_dir)
    columns = ["zone", "validation_error", *EVENT_FIELDS, "kafka_key", "topic", "partition", "offset"]
    clean = lake.read_clean(spark).withColumns(
        {"zone": F.lit("clean"), "validation_error": F.lit(None).cast("string")}
    )
    rejected = lake.read_rejected(spark).withColumn("zone", F.lit("rejected"))
    return clean.select(*columns).unionByName(rejected.select(*columns))


def _fresh_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"tripflow_{uuid.uuid4().hex}", shared_path(spark, "warehouse")).create()


def stream_to_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream to clean zone, to staging, to the star; returns the keyed trips."""
    warehouse = _fresh_warehouse(spark)
    warehouse.stage_from_clean(_routed_lake(spark, sf_dir).read_clean(spark))
    load_star(warehouse)
    return _portable(warehouse.table("fct_trips"))


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """The feed as event files whose names and lines follow the delivery order."""
    folder = f"{shared_path(spark, 'files')}.jsonl"
    # Sorted before the lines are made of them: the bounds' sample then makes no lines, and none is shuffled.
    events = read_events(spark, sf_dir).repartitionByRange("event_id").sortWithinPartitions("event_id")
    ride_feed(events, faults=False).select("raw_json").write.text(folder)
    return folder


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone as the streaming job leaves it."""
    return _portable(_routed_lake(spark, sf_dir).read_raw(spark))


def _poisoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean zone with events that pass all rules and still do not fit the table: one kind in each of four rows in a hundred."""
    clean, kind = clean_zone(_validated(spark, sf_dir)), F.col("offset") % 100
    return clean.withColumns({
        "fare_usd": F.when(kind == 8, F.lit(1e9)).otherwise(F.col("fare_usd")),
        "event_version": F.when(kind == 28, F.lit("v" * 11)).otherwise(F.col("event_version")),
        "driver_id": F.when(kind == 48, F.lit("d" * 101)).otherwise(F.col("driver_id")),
        "rider_id": F.when(kind == 68, F.lit("r" * 101)).otherwise(F.col("rider_id")),
        "pickup_location": F.when(kind == 68, F.lit("p" * 101)).otherwise(F.col("pickup_location")),
    })


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged and quarantined events after the same clean zone was promoted twice."""
    warehouse = _fresh_warehouse(spark)
    clean = write_aside(_poisoned(spark, sf_dir), "clean")
    for _ in range(2):
        warehouse.stage_from_clean(clean)
    staged = warehouse.table("ride_events").select(F.lit("").alias("constraint_names"), "event_id")
    return staged.unionByName(warehouse.table("quarantined_events").select("constraint_names", "event_id"))


def refill_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts before dimensions, one key set by hand, and the fill by a session object that is told no bucket count."""
    warehouse = Warehouse(spark, f"tripflow_{uuid.uuid4().hex}", shared_path(spark, "warehouse"), buckets=3).create()
    warehouse.stage_from_clean(clean_zone(_validated(spark, sf_dir)))
    warehouse.load_fact("fct_trips")
    trips = warehouse.table("fct_trips")
    preset = F.when(F.col("ride_id").endswith("7"), F.lit(-1)).cast("bigint")
    warehouse.replace("fct_trips", trips.withColumn("driver_key", preset))
    load_star(warehouse)
    reopened = Warehouse(spark, warehouse.database, warehouse.location).create()
    reopened.fill_fact_keys("fct_trips")
    reopened.load_fact("fct_trips")
    return _portable(reopened.table("fct_trips"))


def _named(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.range(1).select(F.explode(F.create_map(*(F.lit(x) for pair in counts.items() for x in pair))).alias("name", "rows"))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads report, half of the month and then all of it, and the tables' row counts after them."""
    warehouse = _fresh_warehouse(spark)
    clean = write_aside(clean_zone(_validated(spark, sf_dir)), "clean")
    reported = {}
    for name, rows in (("first", clean.filter(F.col("kafka_timestamp") < F.lit(FIRST_HALF_END).cast("timestamp"))), ("second", clean)):
        counts = warehouse.stage_from_clean(rows)
        reported |= {f"{name}_attempted": counts["attempted"], f"{name}_inserted": counts["inserted"]}
        reported |= load_star(warehouse)
    return _named(spark, reported)


def refill_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips keyed before one driver was known, and filled afterwards: ``as_planned`` is true where a row's bucket has a new file just if
    some row of the bucket lacked its key."""
    late = "drv_0003"
    warehouse = Warehouse(spark, f"tripflow_{uuid.uuid4().hex}", shared_path(spark, "warehouse"), buckets=64).create()
    warehouse.stage_from_clean(clean_zone(_validated(spark, sf_dir)))
    for name in dims.DIMENSIONS:
        if name != "dim_driver":
            warehouse.load_dimension(name)
    known = warehouse.table("ride_events").filter(F.col("driver_id") != late)
    warehouse.append("dim_driver", dims.dim_driver(known, warehouse.table("dim_driver")))
    warehouse.load_fact("fct_trips", with_keys=True)
    file_name = F.col("_metadata.file_name")
    before = warehouse.table("fct_trips").select(
        "ride_id", file_name.alias("old_file"), bucket_of_file(file_name).alias("bucket"), F.col("driver_key").isNull().alias("open")
    )
    before = write_aside(before, "files")
    warehouse.load_dimension("dim_driver")
    warehouse.fill_fact_keys("fct_trips")
    wanted = before.groupBy("bucket").agg(F.bool_or("open").alias("wanted"))
    expected = before.join(wanted, "bucket").select("ride_id", "old_file", "wanted")
    after = warehouse.table("fct_trips").select("*", file_name.alias("new_file")).join(expected, "ride_id")
    moved = F.col("old_file") != F.col("new_file")
    return _portable(after.withColumn("as_planned", moved == F.col("wanted")).drop("old_file", "new_file", "wanted"))


def newest_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of deliveries in many parts, of which a batch takes the newest whole one; returns what was staged."""
    warehouse, folder = _fresh_warehouse(spark), shared_path(spark, "incoming")
    feed = load_feed(spark, sf_dir, faults=False).select("n", "raw_json")
    half = feed.filter("n % 2 = 0").select("raw_json")
    half.write.text(f"{folder}/0.jsonl")
    feed.repartitionByRange("n").sortWithinPartitions("n").select("raw_json").write.text(f"{folder}/1.jsonl")
    unfinished = half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unfinished.text(f"{folder}/2.jsonl")
    warehouse.load_staging(newest_file(spark, folder))
    return _portable(warehouse.table("ride_events"))


LINES_PER_FILE = 5_000


def _file_no() -> Column:
    return F.expr(f"CAST(n div {LINES_PER_FILE} AS BIGINT)").alias("file_no")


def _no_of_file(path: str) -> Column:
    return F.regexp_extract(path, "file_no=([0-9]+)/", 1).cast("bigint").alias("file_no")


def bad_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the faulty feed's files that are no whole event, with their numbers."""
    folder = shared_path(spark, "files")
    feed = load_feed(spark, sf_dir).select(_file_no(), "n", "raw_json").repartition("file_no").sortWithinPartitions("file_no", "n")
    feed.select("file_no", "raw_json").write.partitionBy("file_no").text(folder)
    return numbered_bad_lines(spark, folder).select(_no_of_file("file"), "line_number", F.col("value").alias("line"))


def landed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of landed files, from the landed bytes. The files' lines end in carriage return and line feed; the last has no end."""
    source, raw = shared_path(spark, "files"), shared_path(spark, "raw")
    feed = load_feed(spark, sf_dir, faults=False).select(_file_no(), "n", "raw_json")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("n", "raw_json"))), lambda line: line["raw_json"])
    files = feed.groupBy("file_no").agg(F.array_join(lines, "\r\n").alias("text"))
    # An event's last character is the only one of its kind, so it can stand for the end that the writer puts after each text.
    files = files.select("file_no", F.expr("substring(text, 1, length(text) - 1)").alias("text"))
    files.repartition("file_no").write.option("lineSep", "}").partitionBy("file_no").text(source)
    landed = land_raw_files(spark, f"{source}/*", raw)
    return landed_digests(spark, raw).join(landed.select("path", "part"), "part").select(_no_of_file("path"), "bytes", "sha256")


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three promotions of a clean zone report: of its first half, of the same again, and after the second half came."""
    warehouse, lake = _fresh_warehouse(spark), Lake(shared_path(spark, "lake"))
    validated, reported = _validated(spark, sf_dir), {}
    half = F.col("kafka_timestamp") < F.lit(FIRST_HALF_END).cast("timestamp")
    for name, batch_id, rows in (("first", 0, validated.filter(half)), ("again", None, None), ("second", 1, validated.filter(~half))):
        if batch_id is not None:
            route_batch(rows, batch_id, lake, "run")
        counts = warehouse.promote(lake)
        reported |= {f"{name}_{key}": counts[key] for key in ("attempted", "inserted")}
        if batch_id is None:
            reported["again_files"] = counts["files"]
    return _named(spark, reported)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three zones after a batch that failed between two of its writes was replayed."""
    root = shared_path(spark, "replay")
    as_records(load_feed(spark, sf_dir)).write.parquet(f"{root}/records")

    class Interrupted(Lake):
        def write_clean(self, *_: object) -> None:
            raise RuntimeError("interrupted after the raw zone was written")

    def drain(lake: Lake) -> None:
        start_streaming(spark, RecordFiles(f"{root}/records"), lake, f"{root}/checkpoint", trigger=None).awaitTermination()

    try:
        drain(Interrupted(f"{root}/lake"))
    except StreamingQueryException as error:
        if "interrupted after" not in str(error):
            raise
    lake = Lake(f"{root}/lake")
    drain(lake)
    return _zone_rows(spark, lake)


def _zone_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    zones = [("raw", lake.read_raw(spark)), ("clean", lake.read_clean(spark))]
    parts = [rows.select(F.lit(zone).alias("zone"), F.lit(None).cast("string").alias("validation_error"), "offset") for zone, rows in zones]
    parts.append(lake.read_rejected(spark).select(F.lit("rejected").alias("zone"), "validation_error", "offset"))
    return reduce(DataFrame.unionByName, parts)


def packed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three zones after three batches were packed, their old files removed, and one more batch came."""
    lake, validated = Lake(shared_path(spark, "lake")), write_aside(_validated(spark, sf_dir), "validated")
    for batch_id in range(4):
        if batch_id == 3:
            for zone in ("raw", "clean", "rejected"):
                for day in lake.batches(spark, zone).select("ingestion_date").distinct().collect():
                    lake.pack(spark, zone, day["ingestion_date"].isoformat())
                lake.remove_replaced(spark, zone)
        route_batch(validated.filter(F.least(F.col("offset") % 5, F.lit(3)) == batch_id), batch_id, lake, "run")
    return _zone_rows(spark, lake)


def curated_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored reports after two loads, half of the month as a part and all of it folded in, and a refresh without a new load."""
    warehouse = _fresh_warehouse(spark)
    clean = write_aside(clean_zone(_validated(spark, sf_dir)), "clean")
    first = clean.filter(F.col("kafka_timestamp") < F.lit(FIRST_HALF_END).cast("timestamp"))
    for rows, fold in ((first, False), (clean, True)):
        warehouse.stage_from_clean(rows)
        for name in facts.FACTS:
            warehouse.load_fact(name)
        refresh_marts(warehouse, fold)
    refresh_marts(warehouse)
    columns = {
        "mart_driver_activity": ("driver_id", "activity_date", "trips", "fare_usd"),
        "mart_revenue": ("payment_method", "payment_date", "payments", "revenue_usd"),
        "mart_demand": ("pickup_location", "request_hour", "requests", None),
    }
    reports = []
    for mart, (name, time, number, amount) in columns.items():
        report = warehouse.mart(mart)
        money = F.col(amount) if amount else F.lit(None)
        reports.append(report.select(
            F.lit(mart).alias("mart"), F.col(name).alias("name"), F.date_format(time, "yyyy-MM-dd HH").alias("hour"),
            F.col(number).alias("number"), money.cast("decimal(20,2)").alias("amount"),
        ))
    return reduce(DataFrame.unionByName, reports)


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone after the same files were landed twice."""
    folder, files = shared_path(spark, "raw"), _event_files(spark, sf_dir)
    for _ in range(2):
        land_raw_files(spark, files, folder)
    return spark.read.text(folder).select("value")


def batch_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files to the star; returns each event with its names looked up through its keys."""
    warehouse = _fresh_warehouse(spark)
    run_batch(spark, warehouse, _event_files(spark, sf_dir), shared_path(spark, "raw"))
    fact = warehouse.table("fct_ride_events")
    location = warehouse.table("dim_location").select("location_key", "location_name")
    for side in ("pickup", "dropoff"):
        names = location.select(
            F.col("location_key").alias(f"{side}_location_key"), F.col("location_name").alias(f"{side}_name")
        )
        fact = fact.join(names, f"{side}_location_key", "left")  # a missing key shows as a missing name
    return (
        fact.join(warehouse.table("dim_payment_method"), "payment_method_key", "left")
        .join(warehouse.table("dim_date").withColumnRenamed("date_key", "event_date_key"), "event_date_key", "left")
        .join(warehouse.table("dim_driver").withColumnRenamed("driver_id", "driver_name"), "driver_key", "left")
        .join(warehouse.table("dim_rider").withColumnRenamed("rider_id", "rider_name"), "rider_key", "left")
        .select(
            "event_id", "event_type", "fare_usd", "payment_method_name", "pickup_name", "dropoff_name",
            "full_date", "day_name", "driver_name", "rider_name",
        )
    )


# -- curated reports -------------------------------------------------------------------------------


def driver_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.driver_activity(facts.completed_trips(_staged(spark, sf_dir)))


def revenue_by_date_and_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_date_and_method(facts.completed_payments(_staged(spark, sf_dir)))


def demand_by_pickup_and_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.demand_by_pickup_and_hour(facts.fct_ride_events(_staged(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        parse_events, tap_events, validate_events, raw_events, valid_events, rejected_events,
        rejection_summary, batch_metrics, stage_events, stage_incremental, strict_load, strict_violations,
        dim_payment_method, dim_location, dim_date, dim_driver, dim_rider, dim_rider_incremental,
        fct_ride_events, fct_trips, fct_payments, fct_trips_incremental,
        fill_event_keys, fill_trip_keys, fill_payment_keys, key_coverage,
        stream_route, stream_raw, stream_to_warehouse, landed_lines, batch_warehouse,
        quarantine, refill_keys, refill_buckets, load_counts, newest_file_load, bad_line_numbers, landed_bytes,
        promotions, stream_replay, packed_zones, curated_marts,
        driver_activity, revenue_by_date_and_method, demand_by_pickup_and_hour,
    )
}
