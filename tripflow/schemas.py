"""Fixed schemas, vocabularies and constraints of the trip-event model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the event contract -------------------------------------
EVENT_TYPES = ["ride_requested", "driver_assigned", "trip_started", "trip_completed", "payment_completed"]
FARE_EVENT_TYPES = ["trip_completed", "payment_completed"]
PAYMENT_METHODS = ["cash", "card", "ecocash"]
PAYMENT_STATUSES = ["pending", "paid", "failed"]
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
DEFAULT_CITY = "Harare"
# --------------------------------------------------------------------------

_STRING, _DOUBLE, _TIMESTAMP = T.StringType(), T.DoubleType(), T.TimestampType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_EVENT = {
    "event_id": _STRING,
    "ride_id": _STRING,
    "driver_id": _STRING,
    "rider_id": _STRING,
    "event_type": _STRING,
    "event_version": _STRING,
    "event_timestamp": _STRING,
    "pickup_location": _STRING,
    "dropoff_location": _STRING,
    "fare_usd": _DOUBLE,
    "payment_method": _STRING,
    "payment_status": _STRING,
}
EVENT_SCHEMA = _struct(_EVENT)
EVENT_FIELDS = list(_EVENT)

# What a topic subscription delivers; file-backed streams use the same shape.
RECORD_SCHEMA = _struct({
    "key": T.BinaryType(),
    "value": T.BinaryType(),
    "topic": _STRING,
    "partition": T.IntegerType(),
    "offset": T.LongType(),
    "timestamp": _TIMESTAMP,
    "timestampType": T.IntegerType(),
})

_KEY = {"kafka_key": _STRING}
_TEXT = {"raw_json": _STRING}
_TRACE = {
    "topic": _STRING,
    "partition": T.IntegerType(),
    "offset": T.LongType(),
    "kafka_timestamp": _TIMESTAMP,
    "ingested_at": _TIMESTAMP,
    "ingestion_date": T.DateType(),
}
ENVELOPE_FIELDS = [*_KEY, *_TEXT, *_TRACE]

# Normalised events carry a zone-free event time; every other field keeps its parsed type.
_NORMALISED = _EVENT | {"event_timestamp": T.TimestampNTZType()}
RAW_ZONE_SCHEMA = _struct(_KEY | _TEXT | _TRACE)
CLEAN_ZONE_SCHEMA = _struct(_NORMALISED | _KEY | _TRACE)
REJECTED_ZONE_SCHEMA = _struct({"validation_error": _STRING} | _TEXT | _NORMALISED | _KEY | _TRACE)

# Warehouse tables as column DDL. VARCHAR lengths are enforced by Spark when rows are inserted.
TABLES = {
    "ride_events": (
        "event_id varchar(100), ride_id varchar(100), driver_id varchar(100), rider_id varchar(100), "
        "event_type varchar(50), event_timestamp timestamp_ntz, pickup_location varchar(100), "
        "dropoff_location varchar(100), fare_usd decimal(10,2), payment_method varchar(50), "
        "payment_status varchar(50), created_at timestamp_ntz, event_version varchar(10)"
    ),
    "fct_ride_events": (
        "event_id varchar(100), ride_id varchar(100), driver_id varchar(100), rider_id varchar(100), "
        "event_type varchar(50), event_timestamp timestamp_ntz, pickup_location varchar(100), "
        "dropoff_location varchar(100), fare_usd decimal(10,2), payment_method varchar(50), "
        "payment_status varchar(50), loaded_at timestamp_ntz, event_version varchar(10), "
        "payment_method_key bigint, pickup_location_key bigint, dropoff_location_key bigint, "
        "event_date_key int, driver_key bigint, rider_key bigint"
    ),
    "fct_trips": (
        "trip_key bigint, ride_id varchar(100), driver_id varchar(100), rider_id varchar(100), "
        "pickup_location varchar(100), dropoff_location varchar(100), trip_status varchar(50), "
        "trip_completed_at timestamp_ntz, fare_usd decimal(10,2), payment_method varchar(50), "
        "payment_status varchar(50), event_version varchar(10), created_at timestamp_ntz, "
        "payment_method_key bigint, pickup_location_key bigint, dropoff_location_key bigint, "
        "trip_date_key int, driver_key bigint, rider_key bigint"
    ),
    "fct_payments": (
        "payment_key bigint, payment_event_id varchar(100), ride_id varchar(100), driver_id varchar(100), "
        "rider_id varchar(100), payment_method varchar(50), payment_status varchar(50), "
        "amount_usd decimal(10,2), payment_timestamp timestamp_ntz, event_version varchar(10), "
        "created_at timestamp_ntz, payment_method_key bigint, payment_date_key int, driver_key bigint, "
        "rider_key bigint"
    ),
    "dim_payment_method": "payment_method_key bigint, payment_method_name varchar(50), created_at timestamp_ntz",
    "dim_location": (
        "location_key bigint, location_name varchar(100), city_name varchar(100), area_type varchar(50), "
        "created_at timestamp_ntz"
    ),
    "dim_date": (
        "date_key int, full_date date, day_of_month int, month_number int, month_name varchar(20), "
        "quarter_number int, year_number int, day_name varchar(20), is_weekend boolean, "
        "created_at timestamp_ntz"
    ),
    "dim_driver": (
        "driver_key bigint, driver_id varchar(100), driver_status varchar(50), created_at timestamp_ntz"
    ),
    "dim_rider": "rider_key bigint, rider_id varchar(100), rider_status varchar(50), created_at timestamp_ntz",
}

# Conflict column of each table: a second row with the same value is never inserted.
UNIQUE_COLUMN = {
    "ride_events": "event_id",
    "fct_ride_events": "event_id",
    "fct_trips": "ride_id",
    "fct_payments": "payment_event_id",
    "dim_payment_method": "payment_method_name",
    "dim_location": "location_name",
    "dim_date": "date_key",
    "dim_driver": "driver_id",
    "dim_rider": "rider_id",
}

STAGING_FIELDS = [
    "event_id", "ride_id", "driver_id", "rider_id", "event_type", "event_timestamp", "pickup_location",
    "dropoff_location", "fare_usd", "payment_method", "payment_status", "event_version",
]
STAGING_REQUIRED = ["event_id", "ride_id", "event_type", "event_timestamp"]
STAGING_MAX_LENGTH = {
    "event_id": 100, "ride_id": 100, "driver_id": 100, "rider_id": 100, "event_type": 50,
    "pickup_location": 100, "dropoff_location": 100, "payment_method": 50, "payment_status": 50,
    "event_version": 10,
}

# Stored reports: sums by key, and one row without keys for each load of the fact that they include.
MART_TABLES = {
    "mart_driver_activity": "driver_id varchar(100), activity_date date, trips bigint, fare_usd decimal(20,2), included_load timestamp_ntz",
    "mart_revenue": "payment_date date, payment_method varchar(50), payments bigint, revenue_usd decimal(20,2), included_load timestamp_ntz",
    "mart_demand": "pickup_location varchar(100), request_hour timestamp_ntz, requests bigint, included_load timestamp_ntz",
}

# Batches of the clean zone that staging has.
PROMOTED_BATCHES = "ingestion_date date, run_id string, batch_id bigint, files bigint, created_at timestamp_ntz"
