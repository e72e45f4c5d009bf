"""SQL counterparts of the registered queries, written for DuckDB over the same ``events`` table."""

from __future__ import annotations

from tripflow.fixtures import FEED_PAYMENT_METHODS
from tripflow.schemas import EVENT_TYPES, STAGING_MAX_LENGTH, STAGING_REQUIRED


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _number(prefix: str, value: str, width: int) -> str:
    return f"('{prefix}' || lpad(CAST({value} AS VARCHAR), CAST(greatest({width}, length(CAST({value} AS VARCHAR))) AS INTEGER), '0'))"


def _quoted(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


def _feed(faults: bool) -> str:
    """CTEs ``numbered``, ``fields`` and ``feed``: events to text envelopes."""
    kind = "CASE WHEN event_id % 6 = 1 THEN (event_id // 6) % 24 ELSE -1 END"
    if not faults:
        kind = f"CASE WHEN {kind} = 23 THEN 23 ELSE -1 END"
    text_fields = [
        "ride_id", "driver_id", "rider_id", "event_type", "event_version", "event_timestamp",
        "pickup_location", "dropoff_location",
    ]
    parts = [f"'\"{name}\":' || {_quoted(name)}" for name in text_fields]
    parts.append("'\"fare_usd\":' || coalesce(fare, 'null')")
    parts += [f"'\"{name}\":' || {_quoted(name)}" for name in ("payment_method", "payment_status")]
    body = " || ',' || ".join(parts)
    return f"""
numbered AS (
  SELECT event_id AS n, user_id AS u, event_id // 5 AS r, event_id % 5 AS k, ts, event_type AS source_type,
    round(value, 2) AS amount, {kind} AS f
  FROM events
),
fields AS (
  SELECT n, f, ts,
    CASE WHEN f <> 0 THEN {_number('evt_', 'CASE WHEN f = 23 THEN n - 1 ELSE n END', 6)} END AS event_id,
    CASE WHEN f <> 1 THEN {_number('ride_', 'r', 6)} END AS ride_id,
    CASE WHEN f NOT IN (2, 19) THEN {_number('drv_', '((u * 3 + r % 3) // 4)', 4)} END AS driver_id,
    CASE WHEN f <> 3 THEN {_number('rdr_', 'u', 4)} END AS rider_id,
    CASE WHEN f = 4 THEN NULL WHEN f IN (10, 20) THEN 'ride_paused' WHEN f IN (14, 16) THEN 'trip_completed'
         WHEN f IN (15, 17, 18) THEN 'payment_completed' ELSE {_list(EVENT_TYPES)}[k + 1] END AS event_type,
    CASE WHEN source_type = 'error' THEN '1.1' ELSE '1.0' END AS event_version,
    CASE WHEN f IN (5, 20) THEN NULL WHEN f = 13 THEN '2024-02-30T25:61:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_timestamp,
    CASE WHEN f NOT IN (6, 21) THEN {_number('Stop ', '(u // 8)', 1)} END AS pickup_location,
    CASE WHEN f <> 7 THEN {_number('Stop ', '(u // 8 + 1 + n % 5)', 1)} END AS dropoff_location,
    CASE WHEN f IN (14, 15) THEN NULL WHEN f = 16 THEN '0.0' WHEN f = 17 THEN '-0.01'
         WHEN f = 18 OR k IN (3, 4) THEN CAST(amount AS VARCHAR) END AS fare,
    CASE WHEN f = 8 THEN NULL WHEN f IN (11, 19) THEN 'barter' ELSE {_list(FEED_PAYMENT_METHODS)}[r % 3 + 1] END AS payment_method,
    CASE WHEN f = 9 THEN NULL WHEN f IN (12, 21) THEN 'on_hold' WHEN f IN (15, 17) THEN 'paid' WHEN f = 18 THEN 'failed'
         WHEN k = 4 THEN 'paid' ELSE 'pending' END AS payment_status
  FROM numbered
),
feed AS (
  SELECT n, ts,
    coalesce(ride_id, event_id, 'bad_record_' || CAST(n AS VARCHAR)) AS kafka_key,
    CASE WHEN f = 22 THEN '{{"event_id"'
         ELSE '{{' || coalesce('"event_id":"' || event_id || '",', '') || {body} || '}}' END AS raw_json
  FROM fields
)"""


def _json(name: str) -> str:
    return f"CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.{name}') END"


_TIME = f"try_strptime({_json('event_timestamp')}, '%Y-%m-%dT%H:%M:%S') AS event_timestamp"
_FEED = _feed(faults=True)

_PARSED = f"""{_FEED},
parsed AS (
  SELECT n, ts, kafka_key, raw_json,
    {_json('event_id')} AS event_id, {_json('ride_id')} AS ride_id, {_json('driver_id')} AS driver_id,
    {_json('rider_id')} AS rider_id, lower({_json('event_type')}) AS event_type,
    {_json('event_version')} AS event_version, {_TIME},
    {_json('pickup_location')} AS pickup_location, {_json('dropoff_location')} AS dropoff_location,
    TRY_CAST({_json('fare_usd')} AS DOUBLE) AS fare_usd,
    lower({_json('payment_method')}) AS payment_method, lower({_json('payment_status')}) AS payment_status
  FROM feed
)"""

# Written out here, apart from the library's rules, so that the two can disagree.
_CHAIN = """
    CASE
      WHEN event_id IS NULL THEN 'missing_event_id'
      WHEN ride_id IS NULL THEN 'missing_ride_id'
      WHEN driver_id IS NULL THEN 'missing_driver_id'
      WHEN rider_id IS NULL THEN 'missing_rider_id'
      WHEN event_type IS NULL THEN 'missing_event_type'
      WHEN NOT list_contains(
        ['ride_requested', 'driver_assigned', 'trip_started', 'trip_completed', 'payment_completed'], event_type
      ) THEN 'invalid_event_type'
      WHEN event_timestamp IS NULL THEN 'missing_or_invalid_event_timestamp'
      WHEN pickup_location IS NULL THEN 'missing_pickup_location'
      WHEN dropoff_location IS NULL THEN 'missing_dropoff_location'
      WHEN payment_method IS NULL THEN 'missing_payment_method'
      WHEN NOT list_contains(['cash', 'card', 'ecocash'], payment_method) THEN 'invalid_payment_method'
      WHEN payment_status IS NULL THEN 'missing_payment_status'
      WHEN NOT list_contains(['pending', 'paid', 'failed'], payment_status) THEN 'invalid_payment_status'
      WHEN event_type IN ('trip_completed', 'payment_completed') AND fare_usd IS NULL THEN 'fare_required_for_completed_events'
      WHEN event_type IN ('trip_completed', 'payment_completed') AND fare_usd <= 0 THEN 'fare_must_be_positive_for_completed_events'
      WHEN event_type = 'payment_completed' AND payment_status <> 'paid'
        THEN 'payment_completed_must_have_paid_status'
    END"""
_VALIDATED = f"""{_PARSED},
validated AS (SELECT *, {_CHAIN} AS validation_error FROM parsed)"""

_STAGING = """event_id, ride_id, driver_id, rider_id, event_type, event_timestamp, pickup_location, dropoff_location,
    CAST(fare_usd AS DECIMAL(10, 2)) AS fare_usd, payment_method, payment_status, event_version"""


def _first(name: str, source: str, where: str) -> str:
    return f"""{name} AS (
  SELECT {_STAGING} FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY n) = 1
)"""


_STAGED = f"{_VALIDATED},\n{_first('staged', 'validated', 'validation_error IS NULL')}"


def _staged_until(name: str, time: str) -> str:
    return _first(name, "validated", f"validation_error IS NULL AND ts < TIMESTAMP '{time} 00:00:00'")


_DIMS = """
dim_payment_method AS (
  SELECT row_number() OVER (ORDER BY payment_method_name) AS payment_method_key, payment_method_name
  FROM (SELECT DISTINCT payment_method AS payment_method_name FROM staged WHERE payment_method IS NOT NULL)
),
dim_location AS (
  SELECT row_number() OVER (ORDER BY location_name) AS location_key, location_name,
    'Harare' AS city_name, CAST(NULL AS VARCHAR) AS area_type
  FROM (
    SELECT pickup_location AS location_name FROM staged WHERE pickup_location IS NOT NULL
    UNION
    SELECT dropoff_location FROM staged WHERE dropoff_location IS NOT NULL
  )
),
dim_date AS (
  SELECT DISTINCT CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(event_timestamp AS DATE) AS full_date,
    CAST(day(event_timestamp) AS INTEGER) AS day_of_month, CAST(month(event_timestamp) AS INTEGER) AS month_number,
    rpad(monthname(event_timestamp), 9, ' ') AS month_name,
    CAST(quarter(event_timestamp) AS INTEGER) AS quarter_number, CAST(year(event_timestamp) AS INTEGER) AS year_number,
    rpad(dayname(event_timestamp), 9, ' ') AS day_name, isodow(event_timestamp) IN (6, 7) AS is_weekend
  FROM staged WHERE event_timestamp IS NOT NULL
),
dim_driver AS (
  SELECT row_number() OVER (ORDER BY driver_id) AS driver_key, driver_id, CAST(NULL AS VARCHAR) AS driver_status
  FROM (SELECT DISTINCT driver_id FROM staged WHERE driver_id IS NOT NULL)
),
dim_rider AS (
  SELECT row_number() OVER (ORDER BY rider_id) AS rider_key, rider_id, CAST(NULL AS VARCHAR) AS rider_status
  FROM (SELECT DISTINCT rider_id FROM staged WHERE rider_id IS NOT NULL)
)"""


def _trips(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT row_number() OVER (ORDER BY ride_id) AS trip_key, ride_id, driver_id, rider_id, pickup_location,
    dropoff_location, 'completed' AS trip_status, event_timestamp AS trip_completed_at, fare_usd, payment_method,
    payment_status, event_version
  FROM (
    SELECT * FROM {source} WHERE event_type = 'trip_completed' AND ride_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY event_timestamp, event_id) = 1
  )
)"""


_TRIPS = _trips("trips", "staged")
_PAYMENTS = """payments AS (
  SELECT row_number() OVER (ORDER BY event_id) AS payment_key, event_id AS payment_event_id, ride_id, driver_id,
    rider_id, payment_method, payment_status, fare_usd AS amount_usd, event_timestamp AS payment_timestamp,
    event_version
  FROM staged WHERE event_type = 'payment_completed' AND event_id IS NOT NULL AND ride_id IS NOT NULL
)"""


def _null_keys(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS {'INTEGER' if 'date' in name else 'BIGINT'}) AS {name}" for name in names)


_EVENT_KEYS = (
    "payment_method_key", "pickup_location_key", "dropoff_location_key", "event_date_key", "driver_key", "rider_key",
)
_TRIP_KEYS = tuple(name.replace("event_date", "trip_date") for name in _EVENT_KEYS)
_PAYMENT_KEYS = ("payment_method_key", "payment_date_key", "driver_key", "rider_key")


def _keyed(source: str, time: str, date_column: str, locations: bool = True) -> str:
    columns = f"f.*, pm.payment_method_key, dd.date_key AS {date_column}, dr.driver_key, ri.rider_key"
    joins = f"""FROM {source} f
LEFT JOIN dim_payment_method pm ON f.payment_method = pm.payment_method_name
LEFT JOIN dim_date dd ON CAST(f.{time} AS DATE) = dd.full_date
LEFT JOIN dim_driver dr ON f.driver_id = dr.driver_id
LEFT JOIN dim_rider ri ON f.rider_id = ri.rider_id"""
    if locations:
        columns += ", lp.location_key AS pickup_location_key, ld.location_key AS dropoff_location_key"
        joins += """
LEFT JOIN dim_location lp ON f.pickup_location = lp.location_name
LEFT JOIN dim_location ld ON f.dropoff_location = ld.location_name"""
    return f"SELECT {columns} {joins}"


_EVENT_COLUMNS = """event_id, ride_id, driver_id, rider_id, event_type, event_version, event_timestamp,
  pickup_location, dropoff_location, fare_usd, payment_method, payment_status"""
_TRACE = "kafka_key, 'ride_events' AS topic, CAST(0 AS INTEGER) AS partition, n AS \"offset\""

_CLEAN_FEED = _feed(faults=False)
_STRICT = f"""{_CLEAN_FEED},
parsed AS (
  SELECT n, ts, {_json('event_id')} AS event_id, {_json('ride_id')} AS ride_id, {_json('driver_id')} AS driver_id,
    {_json('rider_id')} AS rider_id, {_json('event_type')} AS event_type, {_json('event_version')} AS event_version,
    {_TIME}, {_json('pickup_location')} AS pickup_location, {_json('dropoff_location')} AS dropoff_location,
    {_json('fare_usd')} AS fare_usd, {_json('payment_method')} AS payment_method,
    {_json('payment_status')} AS payment_status
  FROM feed
),
{_first('staged', 'parsed', 'true')}"""

_VIOLATIONS = {
    **{f"{name}_not_null": f"{name} IS NULL" for name in STAGING_REQUIRED},
    **{f"{name}_max_length": f"length({name}) > {size}" for name, size in STAGING_MAX_LENGTH.items()},
    "fare_usd_numeric": "fare_usd IS NOT NULL AND TRY_CAST(fare_usd AS DECIMAL(10, 2)) IS NULL",
}

_UNVALIDATED = _first(
    "unvalidated", "parsed", " AND ".join(f"{name} IS NOT NULL" for name in STAGING_REQUIRED)
)

_REPORTS = {
    "driver_activity": """SELECT driver_id, CAST(trip_completed_at AS DATE) AS activity_date, count(*) AS trips,
  CAST(sum(fare_usd) AS DECIMAL(20, 2)) AS fare_usd FROM trips GROUP BY 1, 2""",
    "revenue_by_date_and_method": """SELECT CAST(payment_timestamp AS DATE) AS payment_date, payment_method, count(*) AS payments,
  CAST(sum(amount_usd) AS DECIMAL(20, 2)) AS revenue_usd FROM payments GROUP BY 1, 2""",
    "demand_by_pickup_and_hour": """SELECT pickup_location, date_trunc('hour', event_timestamp) AS request_hour, count(*) AS requests
FROM staged WHERE event_type = 'ride_requested' GROUP BY 1, 2""",
}

_FIELD_LIST = _list([
    "event_id", "ride_id", "driver_id", "rider_id", "event_type", "event_version", "event_timestamp", "pickup_location",
    "dropoff_location", "fare_usd", "payment_method", "payment_status",
])

_ALL_ZONES = f"""WITH {_VALIDATED}
SELECT 'raw' AS zone, NULL AS validation_error, n AS "offset" FROM validated
UNION ALL SELECT CASE WHEN validation_error IS NULL THEN 'clean' ELSE 'rejected' END, validation_error, n FROM validated"""

ORACLE_SQL = {
    "parse_events": f'WITH {_PARSED} SELECT n AS "offset", {_EVENT_COLUMNS} FROM parsed',
    "tap_events": f"""WITH {_FEED}
SELECT kafka_key AS ride_id_key, raw_json AS event_json, 'ride_events' AS topic, CAST(0 AS INTEGER) AS partition,
  n AS "offset", ts AS kafka_timestamp FROM feed""",
    "validate_events": f"""WITH {_VALIDATED}
SELECT n AS "offset", {_EVENT_COLUMNS}, validation_error, validation_error IS NULL AS is_valid FROM validated""",
    "raw_events": f"WITH {_FEED} SELECT {_TRACE}, raw_json, ts AS kafka_timestamp FROM feed",
    "valid_events": f"""WITH {_VALIDATED}
SELECT {_EVENT_COLUMNS}, {_TRACE}, ts AS kafka_timestamp FROM validated WHERE validation_error IS NULL""",
    "rejected_events": f"""WITH {_VALIDATED}
SELECT validation_error, raw_json, {_EVENT_COLUMNS}, {_TRACE}, ts AS kafka_timestamp
FROM validated WHERE validation_error IS NOT NULL""",
    "rejection_summary": f"""WITH {_VALIDATED}
SELECT validation_error, count(*) AS records FROM validated WHERE validation_error IS NOT NULL GROUP BY 1""",
    "batch_metrics": f"""WITH {_VALIDATED}
SELECT count(*) AS total, count(*) FILTER (validation_error IS NULL) AS valid,
  count(*) FILTER (validation_error IS NOT NULL) AS rejected FROM validated""",
    "stage_events": f"WITH {_STAGED} SELECT * FROM staged",
    "stage_incremental": f"""WITH {_STAGED}, {_staged_until('existing', '2024-01-16')}
SELECT * FROM staged WHERE event_id NOT IN (SELECT event_id FROM existing)""",
    "strict_load": f"WITH {_STRICT} SELECT * FROM staged",
    "strict_violations": f"WITH {_PARSED} " + " UNION ALL ".join(
        f"SELECT '{name}' AS constraint_name, count(*) FILTER ({broken}) AS violations FROM parsed"
        for name, broken in _VIOLATIONS.items()
    ),
    **{
        name: f"WITH {_STAGED}, {_DIMS} SELECT * FROM {name}"
        for name in ("dim_payment_method", "dim_location", "dim_date", "dim_driver", "dim_rider")
    },
    "dim_rider_incremental": f"""WITH {_STAGED}, {_staged_until('first_load', '2024-01-02')},
riders AS (
  SELECT rider_id, rider_id IN (SELECT rider_id FROM first_load) AS known
  FROM (SELECT DISTINCT rider_id FROM staged WHERE rider_id IS NOT NULL)
)
SELECT row_number() OVER (ORDER BY known DESC, rider_id) AS rider_key, rider_id,
  CAST(NULL AS VARCHAR) AS rider_status FROM riders""",
    "fct_ride_events": f"WITH {_STAGED} SELECT *, {_null_keys(*_EVENT_KEYS)} FROM staged",
    "fct_trips": f"WITH {_STAGED}, {_TRIPS} SELECT *, {_null_keys(*_TRIP_KEYS)} FROM trips",
    "fct_payments": f"WITH {_STAGED}, {_PAYMENTS} SELECT *, {_null_keys(*_PAYMENT_KEYS)} FROM payments",
    "fct_trips_incremental": f"""WITH {_STAGED}, {_staged_until('first_load', '2024-01-16')},
{_trips('known', 'first_load')}, {_TRIPS}
SELECT *, {_null_keys(*_TRIP_KEYS)} FROM known
UNION ALL BY NAME
SELECT * REPLACE (row_number() OVER (ORDER BY ride_id) + (SELECT count(*) FROM known) AS trip_key),
  {_null_keys(*_TRIP_KEYS)}
FROM trips WHERE ride_id NOT IN (SELECT ride_id FROM known)""",
    "fill_event_keys": f"WITH {_STAGED}, {_DIMS} {_keyed('staged', 'event_timestamp', 'event_date_key')}",
    "fill_trip_keys": f"WITH {_STAGED}, {_DIMS}, {_TRIPS} {_keyed('trips', 'trip_completed_at', 'trip_date_key')}",
    "fill_payment_keys": f"""WITH {_STAGED}, {_DIMS}, {_PAYMENTS}
{_keyed('payments', 'payment_timestamp', 'payment_date_key', locations=False)}""",
    "key_coverage": f"""WITH {_STAGED}, {_DIMS}, {_UNVALIDATED},
keyed AS ({_keyed('unvalidated', 'event_timestamp', 'event_date_key')})
""" + " UNION ALL ".join(
        f"SELECT '{key}' AS key_column, count(*) AS rows_total, count(*) FILTER ({key} IS NULL) AS rows_missing FROM keyed"
        for key in _EVENT_KEYS
    ),
    "stream_route": f"""WITH {_VALIDATED}
SELECT CASE WHEN validation_error IS NULL THEN 'clean' ELSE 'rejected' END AS zone, validation_error,
  {_EVENT_COLUMNS}, {_TRACE} FROM validated""",
    "stream_to_warehouse": f"""WITH {_STAGED}, {_DIMS}, {_TRIPS}
{_keyed('trips', 'trip_completed_at', 'trip_date_key')}""",
    "stream_raw": f"WITH {_FEED} SELECT {_TRACE}, raw_json, ts AS kafka_timestamp FROM feed",
    "quarantine": f"""WITH {_VALIDATED},
poisoned AS (
  SELECT n, event_id, CASE n % 100 WHEN 8 THEN 'fare_usd_numeric' WHEN 28 THEN 'event_version_max_length' WHEN 48 THEN 'driver_id_max_length'
    WHEN 68 THEN 'rider_id_max_length,pickup_location_max_length' ELSE '' END AS constraint_names
  FROM validated WHERE validation_error IS NULL
)
SELECT constraint_names, event_id FROM poisoned WHERE constraint_names <> ''
UNION ALL
SELECT DISTINCT '', event_id FROM poisoned WHERE constraint_names = ''""",
    "refill_keys": f"""WITH {_STAGED}, {_DIMS}, {_TRIPS}, keyed AS ({_keyed('trips', 'trip_completed_at', 'trip_date_key')})
SELECT * REPLACE (CASE WHEN ride_id LIKE '%7' THEN -1 ELSE driver_key END AS driver_key) FROM keyed""",
    "load_counts": f"""WITH {_STAGED}, {_DIMS}, {_TRIPS}, {_PAYMENTS}, {_staged_until('first_load', '2024-01-16')},
valid AS (SELECT * FROM validated WHERE validation_error IS NULL)
SELECT 'first_attempted' AS name, count(*) AS rows FROM valid WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
UNION ALL SELECT 'second_attempted', count(*) FROM valid
UNION ALL SELECT 'first_inserted', count(*) FROM first_load
UNION ALL SELECT 'second_inserted', count(*) FROM staged WHERE event_id NOT IN (SELECT event_id FROM first_load)
UNION ALL SELECT 'fct_ride_events', count(*) FROM staged
UNION ALL SELECT 'fct_trips', count(*) FROM trips
UNION ALL SELECT 'fct_payments', count(*) FROM payments
""" + "\n".join(
        f"UNION ALL SELECT '{name}', count(*) FROM {name}"
        for name in ("dim_payment_method", "dim_location", "dim_date", "dim_driver", "dim_rider")
    ),
    "newest_file_load": f"WITH {_STRICT} SELECT * FROM staged",
    "landed_lines": f"WITH {_CLEAN_FEED} SELECT raw_json AS value FROM feed",
    "batch_warehouse": f"""WITH {_STRICT}
SELECT event_id, event_type, fare_usd, payment_method AS payment_method_name, pickup_location AS pickup_name,
  dropoff_location AS dropoff_name, CAST(event_timestamp AS DATE) AS full_date,
  rpad(dayname(event_timestamp), 9, ' ') AS day_name, driver_id AS driver_name, rider_id AS rider_name
FROM staged""",
    "driver_activity": f"WITH {_STAGED}, {_TRIPS} {_REPORTS['driver_activity']}",
    "revenue_by_date_and_method": f"WITH {_STAGED}, {_PAYMENTS} {_REPORTS['revenue_by_date_and_method']}",
    "demand_by_pickup_and_hour": f"WITH {_STAGED} {_REPORTS['demand_by_pickup_and_hour']}",
    "curated_marts": f"""WITH {_STAGED}, {_TRIPS}, {_PAYMENTS}
SELECT 'mart_driver_activity' AS mart, driver_id AS name, strftime(activity_date, '%Y-%m-%d 00') AS hour, trips AS number, fare_usd AS amount
FROM ({_REPORTS['driver_activity']})
UNION ALL SELECT 'mart_revenue', payment_method, strftime(payment_date, '%Y-%m-%d 00'), payments, revenue_usd
FROM ({_REPORTS['revenue_by_date_and_method']})
UNION ALL SELECT 'mart_demand', pickup_location, strftime(request_hour, '%Y-%m-%d %H'), requests, NULL
FROM ({_REPORTS['demand_by_pickup_and_hour']})""",
    "refill_buckets": f"""WITH {_STAGED}, {_DIMS}, {_TRIPS}, keyed AS ({_keyed('trips', 'trip_completed_at', 'trip_date_key')})
SELECT * REPLACE (CASE WHEN driver_id = 'drv_0003' THEN (SELECT count(*) FROM dim_driver)
  WHEN driver_id > 'drv_0003' THEN driver_key - 1 ELSE driver_key END AS driver_key), true AS as_planned FROM keyed""",
    "bad_line_numbers": f"""WITH {_FEED},
lines AS (SELECT n // 5000 AS file_no, row_number() OVER (PARTITION BY n // 5000 ORDER BY n) AS line_number, raw_json AS line FROM feed)
SELECT * FROM lines
WHERE NOT coalesce(list_has_all(CASE WHEN json_valid(line) THEN json_keys(line) END, {_FIELD_LIST}), false)""",
    "landed_bytes": f"""WITH {_CLEAN_FEED},
files AS (SELECT n // 5000 AS file_no, string_agg(raw_json, chr(13) || chr(10) ORDER BY n) AS body FROM feed GROUP BY 1)
SELECT file_no, octet_length(encode(body)) AS bytes, sha256(body) AS sha256 FROM files""",
    "promotions": f"""WITH {_VALIDATED}, {_staged_until('first_load', '2024-01-16')}, {_first('staged', 'validated', 'validation_error IS NULL')},
valid AS (SELECT *, ts < TIMESTAMP '2024-01-16 00:00:00' AS early FROM validated WHERE validation_error IS NULL)
SELECT 'first_attempted' AS name, count(*) AS rows FROM valid WHERE early
UNION ALL SELECT 'first_inserted', count(*) FROM first_load
UNION ALL SELECT name, 0 FROM (VALUES ('again_attempted'), ('again_inserted'), ('again_files')) AS t(name)
UNION ALL SELECT 'second_attempted', count(*) FROM valid WHERE NOT early
UNION ALL SELECT 'second_inserted', count(*) FROM staged WHERE event_id NOT IN (SELECT event_id FROM first_load)""",
    "stream_replay": _ALL_ZONES,
    "packed_zones": _ALL_ZONES,
}
