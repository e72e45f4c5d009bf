"""Maps the ``events`` test table to a ride-event feed, row by row, with injected faults.

Every field is arithmetic on the dense ``event_id`` (``n``), on ``user_id`` (``u``) and the other columns, so any engine derives the same feed, and
riders, drivers and stops grow with the table. Five consecutive events form one ride. With ``faults=True`` one row in six is damaged,
cycling through 24 kinds of damage made from the validation rules; with ``faults=False`` only the repeated deliveries remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import EVENT_TIME_PATTERN, EVENT_TYPES

# The feed's vocabulary.
FEED_PAYMENT_METHODS = ["cash", "EcoCash", "card"]
TOPIC = "ride_events"

# Damage by number. 0-9: this field is null. Then a value outside its vocabulary, and completed events that break a fare rule.
NULLED = [
    "event_id", "ride_id", "driver_id", "rider_id", "event_type", "event_timestamp", "pickup_location", "dropoff_location",
    "payment_method", "payment_status",
]
ODD_TYPE, ODD_METHOD, ODD_STATUS, ODD_TIME = 10, 11, 12, 13
TRIP_NO_FARE, PAID_NO_FARE, TRIP_ZERO_FARE, PAID_NEGATIVE_FARE, PAYMENT_FAILED = 14, 15, 16, 17, 18
# Two faults at once: the rule that comes first must win.
NO_DRIVER_ODD_METHOD, ODD_TYPE_NO_TIME, NO_PICKUP_ODD_STATUS = 19, 20, 21
TRUNCATED, REPEATED = 22, 23
KINDS = 24


def _pick(values: list[str], index: str) -> str:
    return f"element_at(array({', '.join(repr(value) for value in values)}), CAST({index} + 1 AS INT))"


def _number(prefix: str, digits: str, width: int) -> str:
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def _unless_nulled(name: str, value: str, *more: int) -> str:
    kinds = ", ".join(map(str, (NULLED.index(name), *more)))
    return f"CASE WHEN f NOT IN ({kinds}) THEN {value} END"


# Numbers of one event, as text. They are columns of their own: an expression that a field uses twice is compiled twice, and the JVM never
# compiles a method above 8000 bytes of bytecode, which is what one task's code for the feed would come to.
_NUMBERS = {
    "event_no": f"CAST(if(f = {REPEATED}, n - 1, n) AS STRING)",
    "ride_no": "CAST(r AS STRING)",
    "driver_no": "CAST((u * 3 + r % 3) div 4 AS STRING)",
    "rider_no": "CAST(u AS STRING)",
}

# Fields of one event. n: row number; u: user; r: ride; k: step of the ride; f: kind of damage, -1 for none.
_FIELDS = {
    "event_id": _unless_nulled("event_id", _number("evt_", "event_no", 6)),
    "ride_id": _unless_nulled("ride_id", _number("ride_", "ride_no", 6)),
    "driver_id": _unless_nulled("driver_id", _number("drv_", "driver_no", 4), NO_DRIVER_ODD_METHOD),
    "rider_id": _unless_nulled("rider_id", _number("rdr_", "rider_no", 4)),
    "event_type": _unless_nulled("event_type", f"""CASE WHEN f IN ({ODD_TYPE}, {ODD_TYPE_NO_TIME}) THEN 'ride_paused'
        WHEN f IN ({TRIP_NO_FARE}, {TRIP_ZERO_FARE}) THEN 'trip_completed'
        WHEN f IN ({PAID_NO_FARE}, {PAID_NEGATIVE_FARE}, {PAYMENT_FAILED}) THEN 'payment_completed'
        ELSE {_pick(EVENT_TYPES, 'k')} END"""),
    "event_version": "if(source_type = 'error', '1.1', '1.0')",
    "event_timestamp": _unless_nulled(
        "event_timestamp", f"""if(f = {ODD_TIME}, '2024-02-30T25:61:00', date_format(ts, "{EVENT_TIME_PATTERN}"))""", ODD_TYPE_NO_TIME
    ),
    "pickup_location": _unless_nulled("pickup_location", "concat('Stop ', CAST(u div 8 AS STRING))", NO_PICKUP_ODD_STATUS),
    "dropoff_location": _unless_nulled("dropoff_location", "concat('Stop ', CAST(u div 8 + 1 + n % 5 AS STRING))"),
    "fare_usd": f"""CASE WHEN f IN ({TRIP_NO_FARE}, {PAID_NO_FARE}) THEN NULL
        WHEN f = {TRIP_ZERO_FARE} THEN '0.0' WHEN f = {PAID_NEGATIVE_FARE} THEN '-0.01'
        WHEN f = {PAYMENT_FAILED} OR k IN (3, 4) THEN CAST(round(value, 2) AS STRING) END""",
    "payment_method": _unless_nulled("payment_method", f"""CASE WHEN f IN ({ODD_METHOD}, {NO_DRIVER_ODD_METHOD}) THEN 'barter'
        ELSE {_pick(FEED_PAYMENT_METHODS, 'r % 3')} END"""),
    "payment_status": _unless_nulled("payment_status", f"""CASE WHEN f IN ({ODD_STATUS}, {NO_PICKUP_ODD_STATUS}) THEN 'on_hold'
        WHEN f IN ({PAID_NO_FARE}, {PAID_NEGATIVE_FARE}) THEN 'paid' WHEN f = {PAYMENT_FAILED} THEN 'failed'
        ELSE if(k = 4, 'paid', 'pending') END"""),
}


def _member(name: str) -> str:
    value = name if name == "fare_usd" else f"""concat('"', {name}, '"')"""
    return f"""',"{name}":', coalesce({value}, 'null')"""


def _object() -> str:
    first, second, *others = _FIELDS
    # The event id is left out of the object when null; all other nulls are written.
    start = f"""coalesce(concat('{{"{first}":"', {first}, '",'), '{{'), '"{second}":', coalesce(concat('"', {second}, '"'), 'null')"""
    return f"concat({start}, {', '.join(map(_member, others))}, '}}')"


def ride_feed(events: DataFrame, faults: bool = True) -> DataFrame:
    """Text envelope plus ``n``, the delivery order."""
    kind = f"if(event_id % 6 = 1, event_id div 6 % {KINDS}, -1)"
    if not faults:
        kind = f"if({kind} = {REPEATED}, {REPEATED}, -1)"
    return (
        events.selectExpr(
            "event_id AS n", "user_id AS u", "event_id div 5 AS r", "event_id % 5 AS k", "ts", "value", "event_type AS source_type",
            f"{kind} AS f",
        )
        .selectExpr("*", *(f"{value} AS {name}" for name, value in _NUMBERS.items()))
        .selectExpr("n", "f", "ts", *(f"{value} AS {name}" for name, value in _FIELDS.items()))
        .selectExpr(
            "n",
            "coalesce(ride_id, event_id, concat('bad_record_', n)) AS kafka_key",
            f"""CASE WHEN f = {TRUNCATED} THEN '{{"event_id"' ELSE {_object()} END AS raw_json""",
            f"'{TOPIC}' AS topic",
            "0 AS partition",
            "n AS offset",
            "CAST(ts AS TIMESTAMP) AS kafka_timestamp",
        )
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def load_feed(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    return ride_feed(read_events(spark, sf_dir), faults)


def as_records(feed: DataFrame) -> DataFrame:
    """The feed in the binary shape that a topic subscription delivers."""
    return feed.select(
        F.col("kafka_key").cast("binary").alias("key"),
        F.col("raw_json").cast("binary").alias("value"),
        "topic", "partition", "offset",
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
