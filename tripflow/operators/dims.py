"""New dimension rows from staging. Null natural keys never enter a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts
from ..schemas import DEFAULT_CITY
from .keys import assign_keys, max_key
from .upsert import absent_from


def _new_values(values: DataFrame, existing: DataFrame | None) -> DataFrame:
    (name,) = values.columns
    return absent_from(values.filter(F.col(name).isNotNull()).distinct(), existing, name)


def _keyed(values: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    (name,) = values.columns
    return assign_keys(_new_values(values, existing), name, key, max_key(existing, key))


def dim_payment_method(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _keyed(staging.select(F.col("payment_method").alias("payment_method_name")), existing, "payment_method_key")


def dim_location(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct pickup and dropoff names, collected in one pass over staging."""
    names = staging.select(F.explode(F.array("pickup_location", "dropoff_location")).alias("location_name"))
    return _keyed(names, existing, "location_key").withColumns(
        {"city_name": F.lit(DEFAULT_CITY), "area_type": F.lit(None).cast("string")}
    )


def dim_date(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per event date. The date is reduced first; its parts are derived from the few that remain."""
    days = _new_values(staging.select(F.to_date("event_timestamp").alias("full_date")), existing)
    return days.select(*(part.alias(name) for name, part in date_parts(F.col("full_date")).items()))


def dim_driver(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _keyed(staging.select("driver_id"), existing, "driver_key").withColumn(
        "driver_status", F.lit(None).cast("string")
    )


def dim_rider(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _keyed(staging.select("rider_id"), existing, "rider_key").withColumn(
        "rider_status", F.lit(None).cast("string")
    )


DIMENSIONS = {
    "dim_payment_method": dim_payment_method,
    "dim_location": dim_location,
    "dim_date": dim_date,
    "dim_driver": dim_driver,
    "dim_rider": dim_rider,
}
