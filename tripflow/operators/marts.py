"""Curated reports over the facts. Each is one partial aggregate, so a hot driver or place costs no more."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def driver_activity(trips: DataFrame) -> DataFrame:
    """Completed trips and fares per driver and day."""
    return trips.groupBy("driver_id", F.to_date("trip_completed_at").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_usd").alias("fare_usd")
    )


def revenue_by_date_and_method(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.to_date("payment_timestamp").alias("payment_date"), "payment_method").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount_usd").alias("revenue_usd")
    )


def demand_by_pickup_and_hour(events: DataFrame) -> DataFrame:
    """Ride requests per pickup location, day and hour."""
    requests = events.filter("event_type = 'ride_requested'")
    return requests.groupBy(
        "pickup_location", F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz").alias("request_hour")
    ).agg(F.count(F.lit(1)).alias("requests"))


class Mart(NamedTuple):
    """A report that is kept: its measures are counts and sums, so reports over parts of a fact add up to the report over all of it."""

    fact: str
    report: Callable[[DataFrame], DataFrame]
    keys: list[str]
    measures: dict[str, str]


MARTS = {
    "mart_driver_activity": Mart("fct_trips", driver_activity, ["driver_id", "activity_date"], {"trips": "bigint", "fare_usd": "decimal(20,2)"}),
    "mart_revenue": Mart(
        "fct_payments", revenue_by_date_and_method, ["payment_date", "payment_method"], {"payments": "bigint", "revenue_usd": "decimal(20,2)"}
    ),
    "mart_demand": Mart("fct_ride_events", demand_by_pickup_and_hour, ["pickup_location", "request_hour"], {"requests": "bigint"}),
}


def add_up(mart: Mart, parts: DataFrame) -> DataFrame:
    """The report from reports over parts."""
    return parts.groupBy(*mart.keys).agg(*(F.sum(name).cast(kind).alias(name) for name, kind in mart.measures.items()))
