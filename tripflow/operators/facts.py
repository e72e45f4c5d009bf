"""New fact rows from staging, with all dimension keys still null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGING_FIELDS
from .keys import Lookup, assign_keys, event_lookups, max_key, payment_lookups, trip_lookups
from .upsert import absent_from, insert_if_absent


def _with_null_keys(rows: DataFrame, lookups: list[Lookup]) -> DataFrame:
    return rows.withColumns(
        {x.key_column: F.lit(None).cast("int" if x.dim == "dim_date" else "bigint") for x in lookups}
    )


def fct_ride_events(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Staged events the fact lacks. ``event_id`` is already unique in staging, so nothing is deduplicated."""
    rows = absent_from(staging.select(*STAGING_FIELDS), existing, "event_id")
    return _with_null_keys(rows, event_lookups())


def completed_trips(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per completed ride: its first completion by event time, then by event id."""
    completed = staging.filter("event_type = 'trip_completed' AND ride_id IS NOT NULL").select(
        "ride_id", "driver_id", "rider_id", "pickup_location", "dropoff_location",
        F.lit("completed").alias("trip_status"), F.col("event_timestamp").alias("trip_completed_at"),
        "fare_usd", "payment_method", "payment_status", "event_version",
        "event_timestamp", "event_id",
    )
    return insert_if_absent(existing, completed, "ride_id", ["event_timestamp", "event_id"])


def fct_trips(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = completed_trips(staging, existing)
    keyed = assign_keys(rows, "ride_id", "trip_key", max_key(existing, "trip_key"))
    return _with_null_keys(keyed, trip_lookups())


def completed_payments(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per completed payment event. ``event_id`` is unique in staging."""
    payments = staging.filter(
        "event_type = 'payment_completed' AND event_id IS NOT NULL AND ride_id IS NOT NULL"
    ).select(
        F.col("event_id").alias("payment_event_id"), "ride_id", "driver_id", "rider_id", "payment_method",
        "payment_status", F.col("fare_usd").alias("amount_usd"),
        F.col("event_timestamp").alias("payment_timestamp"), "event_version",
    )
    return absent_from(payments, existing, "payment_event_id")


def fct_payments(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = completed_payments(staging, existing)
    keyed = assign_keys(rows, "payment_event_id", "payment_key", max_key(existing, "payment_key"))
    return _with_null_keys(keyed, payment_lookups())


#: Facts whose rows get a key of their own when they are loaded.
NUMBERED = frozenset({"fct_trips", "fct_payments"})

FACTS = {
    "fct_ride_events": (fct_ride_events, event_lookups),
    "fct_trips": (fct_trips, trip_lookups),
    "fct_payments": (fct_payments, payment_lookups),
}
