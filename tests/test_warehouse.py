import datetime as dt
import json
import uuid
from functools import partial

import pytest
from pyspark.sql import functions as F

from tripflow.operators import marts
from tripflow.operators.dims import DIMENSIONS
from tripflow.operators.facts import FACTS
from tripflow.operators.keys import fill_keys, key_coverage, own_partitions
from tripflow.operators.strict import StrictLoadError
from tripflow.plans import warehouse as plans
from tripflow.plans.batch import load_star, refresh_marts, run_batch
from tripflow.plans.warehouse import Warehouse
from tripflow.schemas import TABLES, UNIQUE_COLUMN
from tripflow.session import write_aside

TYPES = ["ride_requested", "driver_assigned", "trip_started", "trip_completed", "payment_completed"]
PLACES = ["Mbare", "Avondale", "Borrowdale"]


def event(n, **changes):
    ride, step = divmod(n, 5)
    day = dt.datetime(2024, 5, 1) + dt.timedelta(hours=7 * ride, minutes=step)
    return {
        "event_id": f"evt_{n:04d}", "ride_id": f"ride_{ride}", "driver_id": f"drv_{ride % 7}", "rider_id": f"rdr_{ride}",
        "event_type": TYPES[step], "event_version": "1.0", "event_timestamp": day.isoformat(timespec="seconds"),
        "pickup_location": PLACES[ride % 2], "dropoff_location": PLACES[ride % 2 + 1],
        "fare_usd": 5.25 + ride if step >= 3 else None, "payment_method": ["cash", "EcoCash"][ride % 2],
        "payment_status": "paid" if step == 4 else "pending",
    } | changes


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"w_{uuid.uuid4().hex}", str(tmp_path / "warehouse"), buckets=4).create()


@pytest.fixture
def files(tmp_path):
    def write(name, events):
        path = tmp_path / f"{name}.jsonl"
        path.write_text("".join(json.dumps(e) + "\n" for e in events))
        return str(path)

    return write


def contents(warehouse, name):
    table = warehouse.table(name)
    return sorted(map(tuple, table.drop("created_at", "loaded_at").collect()), key=str)


def snapshot(warehouse):
    return {name: contents(warehouse, name) for name in TABLES}


def test_batch_run_fills_the_star(spark, warehouse, files, tmp_path):
    events = [event(n) for n in range(100)]
    counts = run_batch(spark, warehouse, files("a", events + events[:10]), str(tmp_path / "raw"))
    assert counts == {
        "attempted": 110, "inserted": 100, "ride_events": 100, "fct_ride_events": 100, "fct_trips": 20,
        "fct_payments": 20, "dim_payment_method": 2, "dim_location": 3, "dim_driver": 7, "dim_rider": 20,
        "dim_date": len({e["event_timestamp"][:10] for e in events}),
    }
    assert spark.read.text(str(tmp_path / "raw")).count() == 110
    for name, (_, lookups) in FACTS.items():
        coverage = key_coverage(warehouse.table(name), [x.key_column for x in lookups()])
        assert all(r.rows_missing == 0 for r in coverage.collect())
    # Batch text is stored as written.
    assert {r.payment_method_name for r in warehouse.table("dim_payment_method").collect()} == {"cash", "EcoCash"}
    assert [tuple(r) for r in warehouse.table("dim_location").drop("created_at").orderBy("location_key").collect()] == [
        (1, "Avondale", "Harare", None), (2, "Borrowdale", "Harare", None), (3, "Mbare", "Harare", None),
    ]
    trip = warehouse.table("fct_trips").filter("ride_id = 'ride_3'").first()
    assert (str(trip.fare_usd), trip.trip_status, trip.driver_id) == ("8.25", "completed", "drv_3")
    assert trip.created_at is not None
    driver = warehouse.table("dim_driver").filter(F.col("driver_key") == trip.driver_key).first()
    assert driver.driver_id == "drv_3"


def test_a_second_run_adds_nothing(spark, warehouse, files):
    path = files("a", [event(n) for n in range(60)])
    run_batch(spark, warehouse, path)
    before = snapshot(warehouse)
    assert run_batch(spark, warehouse, path)["inserted"] == 0
    assert snapshot(warehouse) == before


@pytest.mark.parametrize("use_since", [False, True])
def test_later_loads_extend_and_never_change(spark, warehouse, files, use_since):
    first = [event(n) for n in range(0, 50)]
    run_batch(spark, warehouse, files("a", first))
    before = snapshot(warehouse)
    since = warehouse.table("ride_events").agg(F.max("created_at")).first()[0] + dt.timedelta(microseconds=1)
    changed = [event(n, driver_id="drv_other", fare_usd=99.0) for n in range(40, 50)]
    later = [event(n, pickup_location="Airport") for n in range(50, 90)]
    counts = run_batch(spark, warehouse, files("b", changed + later), since=since if use_since else None)
    assert (counts["attempted"], counts["inserted"]) == (50, 40)
    after = snapshot(warehouse)
    for name in TABLES:
        assert set(before[name]) <= set(after[name])
    keys = [r.location_key for r in warehouse.table("dim_location").collect()]
    assert sorted(keys) == [1, 2, 3, 4]
    assert warehouse.table("dim_location").filter("location_name = 'Airport'").first().location_key == 4
    trips = warehouse.table("fct_trips")
    assert trips.select("trip_key").distinct().count() == trips.count() == 18
    assert trips.filter("driver_id = 'drv_other'").isEmpty()


def test_one_bad_row_keeps_the_whole_file_out(spark, warehouse, files):
    warehouse.load_staging(files("a", [event(n) for n in range(10)]))
    with pytest.raises(StrictLoadError):
        warehouse.load_staging(files("b", [event(n) for n in range(10, 20)] + [event(20, ride_id=None)]))
    for line in ("not json at all", {"event_id": "x"}):
        with pytest.raises(StrictLoadError, match="c.jsonl") as caught:
            warehouse.load_staging(files("c", [event(n) for n in range(10, 12)] + [line]))
        assert [text for _, _, text in caught.value.lines] == [json.dumps(line)]
    assert warehouse.count("ride_events") == 10
    assert not [d for d in spark.catalog.listDatabases() if "scratch" in d.name]


def test_facts_first_then_dimensions_then_keys(spark, warehouse, files):
    """The other order of the same steps ends in the same tables."""
    path = files("a", [event(n) for n in range(60)])
    warehouse.load_staging(path)
    for name in FACTS:
        warehouse.load_fact(name)
    assert warehouse.table("fct_trips").filter("driver_key IS NOT NULL").isEmpty()
    for name in DIMENSIONS:
        warehouse.load_dimension(name)
    for name in FACTS:
        warehouse.fill_fact_keys(name)
    stepwise = snapshot(warehouse)
    other = Warehouse(spark, f"w_{uuid.uuid4().hex}", warehouse.location + "_b", buckets=3).create()
    run_batch(spark, other, path)
    assert snapshot(other) == stepwise


def test_filling_rewrites_only_when_there_is_something_to_fill(spark, warehouse, files):
    run_batch(spark, warehouse, files("a", [event(n, rider_id=None) for n in range(20)]))

    def folder():
        return spark.sql(f"DESCRIBE FORMATTED {warehouse.database}.fct_trips").filter("col_name = 'Location'").first()[1]

    before = folder()
    warehouse.fill_fact_keys("fct_trips")
    assert folder() == before
    assert warehouse.table("fct_trips").filter("rider_key IS NULL").count() == 4


def test_an_interrupted_load_is_completed_by_the_next(spark, warehouse, files):
    """Half of the new rows reached the tables before the job died."""
    warehouse.load_staging(files("a", [event(n) for n in range(60)]))
    half = DIMENSIONS["dim_driver"](warehouse.table("ride_events"), warehouse.table("dim_driver")).filter("driver_key > 3")
    warehouse.append("dim_driver", half)
    build, _ = FACTS["fct_ride_events"]
    part = build(warehouse.table("ride_events"), warehouse.table("fct_ride_events")).filter("event_id < 'evt_0030'")
    warehouse.append("fct_ride_events", part)
    load_star(warehouse)
    drivers = warehouse.table("dim_driver")
    assert drivers.select("driver_key").distinct().count() == drivers.select("driver_id").distinct().count() == 7
    assert drivers.count() == 7 and warehouse.count("fct_ride_events") == 60
    assert warehouse.table("fct_ride_events").filter("driver_key IS NULL").isEmpty()


def test_newest_file_of_a_folder_is_taken(spark, warehouse, files, tmp_path):
    files("a", [event(n) for n in range(5)])
    assert run_batch(spark, warehouse, str(tmp_path))["inserted"] == 5


def test_loads_use_the_bucketing(spark, warehouse, files):
    """Neither side of the staging-to-fact load is shuffled, and only keys of the target are read."""
    run_batch(spark, warehouse, files("a", [event(n) for n in range(60)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build, _ = FACTS["fct_ride_events"]
        rows = build(warehouse.table("ride_events"), warehouse.table("fct_ride_events"))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plan and "Exchange" not in plan
    assert "ReadSchema: struct<event_id:string>" in plan


def test_a_first_load_of_events_is_not_written_aside(spark, warehouse, files, monkeypatch):
    """Staging is dealt out as the fact is, and its rows get no key of their own; later loads look for keys in the new rows alone."""
    aside = []

    def recorded(rows, label):
        aside.append(UNIQUE_COLUMN["fct_ride_events"] in rows.columns)
        return write_aside(rows, label)

    monkeypatch.setattr(plans, "write_aside", recorded)
    warehouse.load_staging(files("a", [event(n) for n in range(60)]))
    load_star(warehouse)
    assert sorted(aside) == [False, False]
    assert warehouse.table("fct_ride_events").filter("rider_key IS NULL OR driver_key IS NULL").count() == 0
    assert len({row["bucket"] for row in warehouse.files("fct_ride_events").collect()}) == warehouse.files("fct_ride_events").count()
    warehouse.load_staging(files("b", [event(n) for n in range(100)]))
    load_star(warehouse)
    assert sorted(aside) == [False, False, False, False, True]
    fact = warehouse.table("fct_ride_events")
    assert fact.count() == fact.select("event_id").distinct().count() == 100
    assert fact.filter("rider_key IS NULL OR driver_key IS NULL").count() == 0


def test_large_dimensions_leave_the_fact_in_place(spark, warehouse, files, monkeypatch):
    """Keys are the same, and the only shuffles are of row ids with a natural key or a found key."""
    path = files("a", [event(n, rider_id=None if n % 10 == 0 else "rdr_1") for n in range(60)])
    run_batch(spark, warehouse, path)
    expected = contents(warehouse, "fct_ride_events")
    monkeypatch.setattr("tripflow.plans.warehouse.fill_keys", partial(fill_keys, growing=frozenset(DIMENSIONS)))
    other = Warehouse(spark, f"w_{uuid.uuid4().hex}", warehouse.location + "_b", buckets=4).create()
    run_batch(spark, other, path)
    assert contents(other, "fct_ride_events") == expected

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build, lookups = FACTS["fct_ride_events"]
        rows = build(other.table("ride_events"), other.table("fct_ride_events"))
        filled = fill_keys(rows, lookups(), other.dimensions(), "event_id", frozenset(DIMENSIONS))
        plan = filled._jdf.queryExecution().executedPlan()
        widths = exchanges(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert widths and max(widths) == 2


def exchanges(plan):
    """Column counts of all shuffles below a physical plan node."""
    found = [plan.output().size()] if plan.nodeName() == "Exchange" else []
    children = plan.children()
    if plan.nodeName() == "AdaptiveSparkPlan":
        return exchanges(plan.initialPlan())
    for i in range(children.size()):
        found += exchanges(children.apply(i))
    return found


def test_another_bucket_count_hides_no_row(spark, warehouse, files):
    """Created with 4 buckets, opened without a count: fill, group-by, join and a second load see each row once."""
    warehouse.load_staging(files("a", [event(n) for n in range(100)]))
    warehouse.load_fact("fct_ride_events")
    for name in DIMENSIONS:
        warehouse.load_dimension(name)
    opened = Warehouse(spark, warehouse.database, warehouse.location).create()
    assert {opened.buckets(name) for name in ("ride_events", "fct_ride_events", "fct_trips", "fct_payments")} == {4}
    opened.fill_fact_keys("fct_ride_events")
    fact = opened.table("fct_ride_events")
    assert fact.groupBy("event_id").count().count() == fact.count() == 100
    assert fact.join(opened.table("ride_events"), "event_id").count() == 100
    assert opened.load_fact("fct_ride_events") == 100
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        Warehouse(spark, warehouse.database, warehouse.location, buckets=8).create()


def test_one_writer_per_table(spark, warehouse, files):
    warehouse.load_staging(files("a", [event(n) for n in range(20)]))
    second = Warehouse(spark, warehouse.database, warehouse.location)
    with second.writing("dim_driver"):
        with pytest.raises(RuntimeError, match="being written"):
            warehouse.load_dimension("dim_driver")
        assert warehouse.load_dimension("dim_rider") == 4
    assert warehouse.load_dimension("dim_driver") == 4
    with pytest.raises(ZeroDivisionError), second.writing("dim_driver"):
        raise ZeroDivisionError
    assert warehouse.load_dimension("dim_driver") == 4


def test_replaced_folders_are_cleaned(spark, warehouse, files):
    warehouse.load_staging(files("a", [event(n) for n in range(20)]))
    warehouse.load_fact("fct_trips")
    for name in DIMENSIONS:
        warehouse.load_dimension(name)
    warehouse.fill_fact_keys("fct_trips")
    assert warehouse.clean() == 0 and warehouse.clean(older_than_hours=0) == 1
    assert warehouse.count("fct_trips") == 4 and warehouse.clean(older_than_hours=0) == 0


def test_first_completion_of_a_ride_wins(spark, warehouse, files):
    late, early, tie = (
        event(3, event_id=i, event_timestamp=t, fare_usd=f)
        for i, t, f in (("e1", "2024-05-01T09:00:00", 1.0), ("e3", "2024-05-01T08:00:00", 3.0), ("e2", "2024-05-01T08:00:00", 2.0))
    )
    run_batch(spark, warehouse, files("a", [late, early, tie]))
    assert [float(r.fare_usd) for r in warehouse.table("fct_trips").collect()] == [2.0]


def test_reports_against_brute_force(spark, warehouse, files):
    events = [event(n) for n in range(200)]
    run_batch(spark, warehouse, files("a", events))
    activity, revenue, demand = {}, {}, {}
    for e in events:
        day, hour = e["event_timestamp"][:10], e["event_timestamp"][:13]
        if e["event_type"] == "trip_completed":
            n, total = activity.get((e["driver_id"], day), (0, 0))
            activity[e["driver_id"], day] = (n + 1, total + e["fare_usd"])
        if e["event_type"] == "payment_completed":
            n, total = revenue.get((day, e["payment_method"]), (0, 0))
            revenue[day, e["payment_method"]] = (n + 1, total + e["fare_usd"])
        if e["event_type"] == "ride_requested":
            demand[e["pickup_location"], hour] = demand.get((e["pickup_location"], hour), 0) + 1
    found = marts.driver_activity(warehouse.table("fct_trips")).collect()
    assert {(r[0], str(r[1])): (r.trips, float(r.fare_usd)) for r in found} == activity
    found = marts.revenue_by_date_and_method(warehouse.table("fct_payments")).collect()
    assert {(str(r[0]), r[1]): (r.payments, float(r.revenue_usd)) for r in found} == revenue
    found = marts.demand_by_pickup_and_hour(warehouse.table("fct_ride_events")).collect()
    assert {(r[0], r.request_hour.isoformat()[:13]): r.requests for r in found} == demand


@pytest.mark.parametrize("partitions", [2, 4, 8, 16])
def test_the_fact_stays_whatever_the_shuffle_partitions(spark, warehouse, files, partitions):
    """Of a table with 4 buckets, and of rows dealt out by bucket, no shuffle is wider than a row id and a key."""
    run_batch(spark, warehouse, files("a", [event(n) for n in range(60)]))
    expected = contents(warehouse, "fct_ride_events")
    _, lookups = FACTS["fct_ride_events"]
    names = [lookup.key_column for lookup in lookups()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        fact = warehouse.table("fct_ride_events")
        unkeyed = fact.withColumns({name: F.lit(None).cast(fact.schema[name].dataType) for name in names})
        assert own_partitions(unkeyed, "event_id") == own_partitions(unkeyed.repartition(4, "event_id"), "event_id") == 4
        assert own_partitions(unkeyed.repartition("ride_id"), "event_id") is None and own_partitions(unkeyed, "ride_id") is None
        filled = fill_keys(unkeyed, lookups(), warehouse.dimensions(), "event_id", frozenset(DIMENSIONS))
        assert max(exchanges(filled._jdf.queryExecution().executedPlan())) == 2
        assert sorted(map(tuple, filled.drop("loaded_at").collect()), key=str) == expected
        assert {f.name: f.dataType for f in filled.schema} == {f.name: f.dataType for f in fact.schema}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def file_names(warehouse, name):
    return {row.file_name: row.bucket for row in warehouse.files(name).collect()}


def partly_keyed(spark, path, location, files, buckets=16):
    """Events keyed while one driver was unknown, of whom only two rides are."""
    warehouse = Warehouse(spark, f"w_{uuid.uuid4().hex}", location, buckets=buckets).create()
    late = {"driver_id": "late"}
    warehouse.load_staging(files(path, [event(n, **(late if n // 5 in (3, 11) else {})) for n in range(200)]))
    for name in DIMENSIONS:
        rows = DIMENSIONS[name](warehouse.table("ride_events").filter("driver_id <> 'late'"), warehouse.table(name))
        warehouse.append(name, rows) if name == "dim_driver" else warehouse.load_dimension(name)
    warehouse.load_fact("fct_trips", with_keys=True)
    return warehouse


def test_only_buckets_with_a_found_key_get_new_files(spark, files, tmp_path):
    warehouse = partly_keyed(spark, "a", str(tmp_path / "tables"), files)
    before = file_names(warehouse, "fct_trips")
    assert warehouse.fill_fact_keys("fct_trips") == 0 and file_names(warehouse, "fct_trips") == before  # no dimension has the name
    place = F.col("_metadata.file_name")
    fact = warehouse.table("fct_trips").select("*", place.alias("file"))
    touched = {before[r.file] for r in fact.filter("driver_id = 'late'").collect()}
    expected = {r.ride_id: r for r in warehouse.table("fct_trips").collect()}
    warehouse.load_dimension("dim_driver")
    assert warehouse.fill_fact_keys("fct_trips") == len(touched) in (1, 2)
    after = file_names(warehouse, "fct_trips")
    assert {bucket for file, bucket in after.items() if file not in before} == touched
    assert {bucket for file, bucket in before.items() if file not in after} == touched
    assert len(after) == len(set(after.values()))  # one file for each bucket, still
    rows = warehouse.table("fct_trips").collect()
    assert len(rows) == 40
    for row in rows:
        old = expected[row.ride_id].asDict()
        assert row.asDict() | {"driver_key": None} == old | {"driver_key": None}
        assert row.driver_key == (7 if row.driver_id == "late" else old["driver_key"]) or row.driver_id == "late" and row.driver_key
    assert warehouse.table("fct_trips").groupBy("ride_id").count().count() == 40
    assert warehouse.fill_fact_keys("fct_trips") == 0


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_switch_that_was_cut_short_is_finished_by_the_next_writer(spark, files, tmp_path, monkeypatch, moves):
    warehouse = partly_keyed(spark, "a", str(tmp_path / "tables"), files, buckets=4)
    warehouse.load_dimension("dim_driver")
    real, done = Warehouse._finish_switch, []

    def stop(self, name):
        note, store = self._switch_note(name)
        if not store.exists(note):
            return
        text = json.loads(open(note.toString().removeprefix("file:")).read())
        for file in text["old"][:moves]:
            store.delete(plans.hadoop_path(spark, f"{text['to']}/{file}")[0], False)
        for file in text["new"][: moves - 1 if moves else 0]:
            store.rename(*(plans.hadoop_path(spark, f"{text[end]}/{file}")[0] for end in ("from", "to")))
        done.append(name)
        raise KeyboardInterrupt

    monkeypatch.setattr(Warehouse, "_finish_switch", stop)
    with pytest.raises(KeyboardInterrupt):
        warehouse.fill_fact_keys("fct_trips")
    monkeypatch.setattr(Warehouse, "_finish_switch", real)
    assert done == ["fct_trips"] and warehouse.clean(older_than_hours=0) == 0  # the note keeps the new files
    with warehouse.writing("fct_trips"):
        pass
    rows = warehouse.table("fct_trips").collect()
    assert len(rows) == len({r.ride_id for r in rows}) == 40 and all(r.driver_key for r in rows)


def test_promotion_reads_new_batches_only(spark, warehouse, tmp_path, monkeypatch):
    from tests.test_streaming import SF_DIR
    from tripflow.fixtures import as_records, load_feed
    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate
    from tripflow.streaming.job import route_batch
    from tripflow.streaming.lake import Lake

    validated, lake = validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR))))), Lake(str(tmp_path / "lake"))
    assert warehouse.promote(lake) == {"batches": 0, "files": 0, "attempted": 0, "inserted": 0, "quarantined": 0}
    route_batch(validated.filter("offset < 400"), 0, lake, "run")
    first = warehouse.promote(lake)
    assert first["batches"] == 1 and first["attempted"] >= first["inserted"] > 0
    again = warehouse.promote(lake)
    assert again == {"batches": 0, "files": 0, "attempted": 0, "inserted": 0, "quarantined": 0}
    route_batch(validated.filter("offset >= 400 AND offset < 700"), 1, lake, "run")
    monkeypatch.setattr(plans, "LISTED_BATCHES", 0)  # more batches than are listed: joined instead
    route_batch(validated.filter("offset >= 700"), 0, lake, "other run")
    second = warehouse.promote(lake)
    assert second["batches"] == 2 and first["attempted"] + second["attempted"] == 839
    assert warehouse.count("ride_events") == first["inserted"] + second["inserted"] == 833

    # Cut short between staging and the note: the batch is read again and adds nothing.
    route_batch(validated.filter("offset < 10"), 7, lake, "run")
    with monkeypatch.context() as broken:
        broken.setattr(F, "localtimestamp", lambda: F.raise_error(F.lit("lost")).cast("timestamp_ntz"))
        broken.setattr(Warehouse, "stage_from_clean", lambda self, clean: {"attempted": clean.count(), "inserted": 0, "quarantined": 0})
        with pytest.raises(Exception, match="lost"):
            warehouse.promote(lake)
    assert warehouse.promote(lake)["batches"] == 1 and warehouse.count("ride_events") == 833


def test_marts_add_loads_up(spark, warehouse, files, monkeypatch):
    reports = {"mart_driver_activity": marts.driver_activity, "mart_revenue": marts.revenue_by_date_and_method, "mart_demand": marts.demand_by_pickup_and_hour}

    def check():
        for name, report in reports.items():
            whole = report(warehouse.table(marts.MARTS[name].fact))
            found = warehouse.mart(name).select(*whole.columns)
            assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))

    def load(name, numbers):
        warehouse.load_staging(files(name, [event(n, **({"driver_id": None} if n % 50 == 3 else {})) for n in numbers]))
        for fact in FACTS:
            warehouse.load_fact(fact)

    assert set(refresh_marts(warehouse).values()) == {0}
    load("a", range(60))
    assert set(refresh_marts(warehouse, fold=False).values()) == {1}
    check()
    load("b", range(300, 400))
    load("c", range(40, 120))
    assert set(refresh_marts(warehouse, fold=False).values()) == {2}
    check()
    load("d", range(500, 530))
    with monkeypatch.context() as broken:  # cut short: nothing has changed, and the load is added the next time
        broken.setattr(Warehouse, "replace", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            warehouse.refresh_mart("mart_demand")
    assert set(refresh_marts(warehouse).values()) == {1}
    check()
    assert set(refresh_marts(warehouse).values()) == {0}
    stored = warehouse.table("mart_demand")
    assert stored.filter("included_load IS NOT NULL").count() == 4
    keys = stored.filter("included_load IS NULL").groupBy("pickup_location", "request_hour").count()
    assert keys.filter("count > 1").isEmpty()  # folded: one row for each key
