"""The rule chain: the first failing rule names the rejection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EVENT_TYPES, FARE_EVENT_TYPES, PAYMENT_METHODS, PAYMENT_STATUSES


class Rule(NamedTuple):
    code: str
    fails: str  # SQL predicate over normalised columns; null counts as "does not fail"


def _one_of(values: list[str]) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


_HAS_FARE = f"event_type IN {_one_of(FARE_EVENT_TYPES)}"

# Codes, predicates and their precedence.
RULES = [
    Rule("missing_event_id", "event_id IS NULL"),
    Rule("missing_ride_id", "ride_id IS NULL"),
    Rule("missing_driver_id", "driver_id IS NULL"),
    Rule("missing_rider_id", "rider_id IS NULL"),
    Rule("missing_event_type", "event_type IS NULL"),
    Rule("invalid_event_type", f"event_type NOT IN {_one_of(EVENT_TYPES)}"),
    Rule("missing_or_invalid_event_timestamp", "event_timestamp IS NULL"),
    Rule("missing_pickup_location", "pickup_location IS NULL"),
    Rule("missing_dropoff_location", "dropoff_location IS NULL"),
    Rule("missing_payment_method", "payment_method IS NULL"),
    Rule("invalid_payment_method", f"payment_method NOT IN {_one_of(PAYMENT_METHODS)}"),
    Rule("missing_payment_status", "payment_status IS NULL"),
    Rule("invalid_payment_status", f"payment_status NOT IN {_one_of(PAYMENT_STATUSES)}"),
    Rule("fare_required_for_completed_events", f"{_HAS_FARE} AND fare_usd IS NULL"),
    Rule("fare_must_be_positive_for_completed_events", f"{_HAS_FARE} AND fare_usd <= 0"),
    Rule(
        "payment_completed_must_have_paid_status",
        "event_type = 'payment_completed' AND payment_status <> 'paid'",
    ),
]


def first_failure(rules: list[Rule] = RULES) -> Column:
    """Code of the first failing rule, else null. ``coalesce`` stops at the first non-null branch."""
    return F.coalesce(*(F.when(F.expr(rule.fails), F.lit(rule.code)) for rule in rules))


def validate(events: DataFrame) -> DataFrame:
    return events.withColumn("validation_error", first_failure()).withColumn(
        "is_valid", F.col("validation_error").isNull()
    )


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). ``is_valid`` is never null, so together they are the whole input."""
    return validated.filter("is_valid"), validated.filter("NOT is_valid")
