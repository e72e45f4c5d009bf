"""Rows for the staging table, from event files or from the clean zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_event_time, to_money
from ..schemas import STAGING_FIELDS
from .upsert import insert_if_absent

FILE_ORDER = ["arrival"]
ZONE_ORDER = ["topic", "partition", "offset"]


def staging_rows_from_files(events: DataFrame) -> DataFrame:
    """Typed rows of strictly read events. Text is stored as written, without case folding."""
    typed = {
        "event_timestamp": parse_event_time(F.col("event_timestamp")),
        "fare_usd": to_money(F.col("fare_usd")),
    }
    return events.select(
        *(typed.get(name, F.col(name)).alias(name) for name in STAGING_FIELDS),
        F.col("fare_usd").alias("fare_text"), "whole_event", *FILE_ORDER,
    )


def staging_rows_from_clean(clean: DataFrame) -> DataFrame:
    """Typed rows of the clean zone, ordered by their place in the topic."""
    return clean.select(
        *(to_money(F.col(name)).alias(name) if name == "fare_usd" else name for name in STAGING_FIELDS),
        F.col("fare_usd").cast("string").alias("fare_text"), *ZONE_ORDER,
    )


def stage_events(target: DataFrame | None, rows: DataFrame, order: list[str]) -> DataFrame:
    """Staging rows to append: the first delivery of every event the target lacks."""
    return insert_if_absent(target, rows.select(*STAGING_FIELDS, *order), "event_id", order)
