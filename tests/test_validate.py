import itertools
import random

import pytest

from tripflow.fixtures import load_feed
from tripflow.operators.parse import decode_envelope, normalise
from tripflow.operators.quality import batch_metrics, rejection_summary
from tripflow.operators.validate import split_valid, validate
from tripflow.schemas import EVENT_TYPES, PAYMENT_METHODS, PAYMENT_STATUSES
from tripflow.fixtures import as_records

# Rows per code at the two small scales.
GOLDEN = {
    None: (839, 8402),
    "missing_event_id": (14, 139),
    "missing_ride_id": (7, 70),
    "missing_driver_id": (14, 139),
    "missing_rider_id": (7, 70),
    "missing_event_type": (7, 70),
    "invalid_event_type": (14, 139),
    "missing_or_invalid_event_timestamp": (14, 139),
    "missing_pickup_location": (14, 139),
    "missing_dropoff_location": (7, 70),
    "missing_payment_method": (7, 70),
    "invalid_payment_method": (7, 69),
    "missing_payment_status": (7, 70),
    "invalid_payment_status": (7, 69),
    "fare_required_for_completed_events": (14, 138),
    "fare_must_be_positive_for_completed_events": (14, 138),
    "payment_completed_must_have_paid_status": (7, 69),
}


@pytest.mark.parametrize("which, scale", [(0, "0.001"), (1, "0.01")])
def test_golden_counts(spark, which, scale):
    feed = load_feed(spark, f"/root/testdata/sf{scale}")
    validated = validate(normalise(decode_envelope(as_records(feed)))).cache()
    found = {r.validation_error: r["count"] for r in validated.groupBy("validation_error").count().collect()}
    assert found == {code: counts[which] for code, counts in GOLDEN.items()}

    valid, rejected = split_valid(validated)
    metrics = batch_metrics(validated).first()
    assert (metrics.valid, metrics.rejected) == (valid.count(), rejected.count())
    assert metrics.total == metrics.valid + metrics.rejected == sum(found.values())
    by_day = rejection_summary(rejected).collect()
    assert sum(r.records for r in by_day) == metrics.rejected
    assert len({r.ingestion_date for r in by_day}) == 1
    validated.unpersist()


def expected_code(e):
    """The rules in plain Python."""
    for name in ("event_id", "ride_id", "driver_id", "rider_id"):
        if e[name] is None:
            return f"missing_{name}"
    if e["event_type"] is None:
        return "missing_event_type"
    if e["event_type"] not in EVENT_TYPES:
        return "invalid_event_type"
    if e["event_timestamp"] is None:
        return "missing_or_invalid_event_timestamp"
    for name in ("pickup_location", "dropoff_location"):
        if e[name] is None:
            return f"missing_{name}"
    for name, allowed in (("payment_method", PAYMENT_METHODS), ("payment_status", PAYMENT_STATUSES)):
        if e[name] is None:
            return f"missing_{name}"
        if e[name] not in allowed:
            return f"invalid_{name}"
    if e["event_type"] in ("trip_completed", "payment_completed"):
        if e["fare_usd"] is None:
            return "fare_required_for_completed_events"
        if e["fare_usd"] <= 0:
            return "fare_must_be_positive_for_completed_events"
    if e["event_type"] == "payment_completed" and e["payment_status"] != "paid":
        return "payment_completed_must_have_paid_status"
    return None


def test_first_failure_against_brute_force(spark):
    ids = ["x", "x", "x", "x", "x", "", None]
    choices = {
        "event_id": ids, "ride_id": ids, "driver_id": ids, "rider_id": ids,
        "event_type": [*EVENT_TYPES, "trip_completed", "payment_completed", "other", None],
        "event_timestamp": ["2024-01-02T03:04:05"] * 6 + [None],
        "pickup_location": ["Mbare"] * 6 + [None], "dropoff_location": ["Mbare"] * 6 + [None],
        "fare_usd": [None, 0.0, -1.0, 5.0, 7.5],
        "payment_method": [*PAYMENT_METHODS, "gold", None], "payment_status": [*PAYMENT_STATUSES, "paid", "odd", None],
    }
    rng = random.Random(7)
    events = [{name: rng.choice(values) for name, values in choices.items()} for _ in range(6000)]
    # Every single-fault and two-fault combination of the nullable fields, so that precedence is covered.
    good = {name: values[0] for name, values in choices.items()} | {"payment_method": "cash"}
    events += [good | {a: None, b: None} for a, b in itertools.combinations_with_replacement(choices, 2)]
    schema = ", ".join(f"{n} {'double' if n == 'fare_usd' else 'string'}" for n in choices)
    frame = spark.createDataFrame([tuple(e.values()) for e in events], schema)
    found = [(r.validation_error, r.is_valid) for r in validate(frame).collect()]
    expected = [expected_code(e) for e in events]
    assert found == [(code, code is None) for code in expected]
    assert len(set(expected)) == 17


def test_not_a_number_is_not_rejected(spark):
    row = ("e", "r", "d", "p", "trip_completed", "t", "a", "b", float("nan"), "cash", "paid")
    names = "event_id ride_id driver_id rider_id event_type event_timestamp pickup_location dropoff_location".split()
    schema = ", ".join(f"{n} string" for n in names) + ", fare_usd double, payment_method string, payment_status string"
    assert validate(spark.createDataFrame([row], schema)).first().is_valid
