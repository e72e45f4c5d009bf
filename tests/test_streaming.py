import glob
import json

import pytest
from pyspark.sql import functions as F

from tripflow.fixtures import as_records, load_feed
from tripflow.session import object_store_conf
from tripflow.sources.streams import RecordFiles, TopicSource, tap_stream
from tripflow.streaming.job import route_batch, start_streaming, validated_stream
from tripflow.streaming.lake import Lake

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def records(spark, tmp_path):
    """The feed in four files, so that a stream can take it in several batches."""
    path = str(tmp_path / "records")
    as_records(load_feed(spark, SF_DIR)).repartition(4, "offset").write.parquet(path)
    return path


def drain(spark, source, lake, checkpoint, **options):
    query = start_streaming(spark, source, lake, checkpoint, trigger=None, **options)
    query.awaitTermination()
    return query


def sizes(spark, lake):
    return lake.read_raw(spark).count(), lake.read_clean(spark).count(), lake.read_rejected(spark).count()


def test_zones_hold_the_whole_feed(spark, tmp_path, records):
    lake, seen = Lake(str(tmp_path / "lake")), {}
    drain(spark, RecordFiles(records, 1), lake, str(tmp_path / "cp"), on_metrics=seen.__setitem__)
    assert sizes(spark, lake) == (1000, 839, 161)
    assert len(seen) == 4
    assert sum(m["total"] for m in seen.values()) == 1000
    assert sum(m["rejected"] for m in seen.values()) == 161
    assert len(lake.read_raw(spark).columns) == 8
    assert len(lake.read_clean(spark).columns) == 19
    assert len(lake.read_rejected(spark).columns) == 21
    # Text and times come back exactly as delivered.
    delivered = load_feed(spark, SF_DIR).select("kafka_key", "raw_json", "topic", "partition", "offset", "kafka_timestamp")
    kept = lake.read_raw(spark).select(*delivered.columns)
    assert kept.exceptAll(delivered).isEmpty() and delivered.exceptAll(kept).isEmpty()
    folders = glob.glob(f"{lake.path('raw')}/ingestion_date=*/run_id=*/batch_id=*")
    assert len({f.split("batch_id=")[1] for f in folders}) == 4


def test_restart_continues_after_the_last_batch(spark, tmp_path, records):
    lake, cp = Lake(str(tmp_path / "lake")), str(tmp_path / "cp")
    drain(spark, RecordFiles(records), lake, cp)
    seen = {}
    drain(spark, RecordFiles(records), lake, cp, on_metrics=seen.__setitem__)
    assert seen == {} and sizes(spark, lake) == (1000, 839, 161)
    as_records(load_feed(spark, SF_DIR)).write.mode("append").parquet(records)
    drain(spark, RecordFiles(records), lake, cp, on_metrics=seen.__setitem__)
    assert seen == {1: {"total": 1000, "valid": 839, "rejected": 161}}
    assert sizes(spark, lake) == (2000, 1678, 322)


def test_a_batch_that_failed_half_way_is_not_doubled(spark, tmp_path, records, monkeypatch):
    lake, cp = Lake(str(tmp_path / "lake")), str(tmp_path / "cp")

    def fail(*args):
        raise RuntimeError("lost the sink")

    with monkeypatch.context() as broken:
        broken.setattr(Lake, "write_rejected", fail)
        with pytest.raises(Exception, match="lost the sink"):
            drain(spark, RecordFiles(records), lake, cp)
    assert lake.read_raw(spark).count() == 1000
    drain(spark, RecordFiles(records), lake, cp)
    assert sizes(spark, lake) == (1000, 839, 161)


def test_a_new_checkpoint_adds_and_never_overwrites(spark, tmp_path, records):
    """Its batch ids start at 0 again, in partitions of their own."""
    lake = Lake(str(tmp_path / "lake"))
    drain(spark, RecordFiles(records), lake, str(tmp_path / "cp1"))
    drain(spark, RecordFiles(records), lake, str(tmp_path / "cp2"))
    assert sizes(spark, lake) == (2000, 1678, 322)


def test_route_batch_alone(spark, tmp_path, capsys):
    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate

    batch = validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR)))))
    lake = Lake(str(tmp_path / "lake"), rows_per_file=100)
    for _ in range(2):  # the same batch again changes nothing
        assert route_batch(batch, 3, lake, "run", show_samples=20) == {"total": 1000, "valid": 839, "rejected": 161}
        assert sizes(spark, lake) == (1000, 839, 161)
    assert "missing_event_id" in capsys.readouterr().out
    for file in glob.glob(f"{lake.path('raw')}/*/*/*/*.json"):
        with open(file) as lines:
            assert sum(1 for _ in lines) <= 100
    assert route_batch(batch.filter("false"), 4, lake, "run") == {"total": 0, "valid": 0, "rejected": 0}
    assert sizes(spark, lake) == (1000, 839, 161)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_small_batches_make_one_file_per_zone(spark, tmp_path, records):
    lake = Lake(str(tmp_path / "lake"))
    drain(spark, RecordFiles(records), lake, str(tmp_path / "cp"))
    assert len(glob.glob(f"{lake.path('clean')}/*/*/*/*.parquet")) == 1


def test_rejected_records_keep_their_reason_and_text(spark, tmp_path, records):
    lake = Lake(str(tmp_path / "lake"))
    drain(spark, RecordFiles(records), lake, str(tmp_path / "cp"))
    for row in lake.read_rejected(spark).collect():
        if row.validation_error == "missing_event_id":
            assert row.event_id is None
            assert row.raw_json == '{"event_id"' or "event_id" not in json.loads(row.raw_json)


def test_stream_plan_is_map_only(spark, records):
    stream = validated_stream(spark, RecordFiles(records))
    assert stream.isStreaming
    assert "Aggregate" not in stream._jdf.queryExecution().analyzed().toString()


def test_tap_follows_a_source(spark, records):
    query = tap_stream(spark, RecordFiles(records), sink="memory", name="tapped")
    try:
        query.processAllAvailable()
        tapped = spark.table("tapped")
        assert tapped.columns == ["ride_id_key", "event_json", "topic", "partition", "offset", "kafka_timestamp"]
        assert tapped.count() == 1000
        assert tapped.filter(F.col("event_json").isNull()).isEmpty()
    finally:
        query.stop()


def test_topic_options():
    assert TopicSource("a:1,b:2", "t", "g").options() == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "kafka.group.id": "g",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
    bounded = TopicSource(group_id=None, max_records_per_batch=10, min_partitions=4, starting_offsets="latest").options()
    assert (bounded["maxOffsetsPerTrigger"], bounded["minPartitions"]) == ("10", "4")
    assert bounded["startingOffsets"] == "latest" and "kafka.group.id" not in bounded


def test_object_store_conf():
    conf = object_store_conf("store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_a_day_is_read_by_partition_pruning(spark, tmp_path, records):
    lake = Lake(str(tmp_path / "lake"))
    drain(spark, RecordFiles(records), lake, str(tmp_path / "cp"))
    day = lake.read_clean(spark).first().ingestion_date
    for wanted, rows in ((day.isoformat(), 839), ("1999-01-01", 0)):
        found = lake.read_clean(spark).filter(F.col("ingestion_date") == F.lit(wanted).cast("date"))
        assert found.count() == rows
    assert "PartitionFilters: [isnotnull(ingestion_date" in found._jdf.queryExecution().executedPlan().toString()


def test_counts_take_no_job_of_their_own(spark, tmp_path):
    """Three zones, three writing jobs; a replay reports the same counts."""
    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate

    batch = validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR).coalesce(1)))))
    lake, context = Lake(str(tmp_path / "lake")), spark.sparkContext
    for attempt in range(2):
        context.setJobGroup(f"batch {attempt}", "")
        try:
            assert route_batch(batch, 0, lake, "run", expected=1000) == {"total": 1000, "valid": 839, "rejected": 161}
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        assert len(context.statusTracker().getJobIdsForGroup(f"batch {attempt}")) <= 3
    assert sizes(spark, lake) == (1000, 839, 161)
    assert len(glob.glob(f"{lake.path('raw')}/*/*/*/*.json")) == 1


def test_packing_changes_files_and_nothing_else(spark, tmp_path, monkeypatch):
    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate

    lake = Lake(str(tmp_path / "lake"))
    validated = validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR)))))
    for n in range(3):
        route_batch(validated.filter(f"offset % 5 = {n}"), n, lake, "run")
    readers = {"raw": lake.read_raw, "clean": lake.read_clean, "rejected": lake.read_rejected}
    contents = lambda: {zone: sorted(map(str, read(spark).collect())) for zone, read in readers.items()}
    before = contents()
    (day,) = {r.ingestion_date.isoformat() for r in lake.batches(spark, "clean").collect()}
    note = Lake._note_packs

    def lost(self, spark_, zone, packs):
        if packs["runs"]:
            raise KeyboardInterrupt
        note(self, spark_, zone, packs)

    for zone in readers:
        with monkeypatch.context() as broken:  # the packed files are there, and nobody sees them
            broken.setattr(Lake, "_note_packs", lost)
            with pytest.raises(KeyboardInterrupt):
                lake.pack(spark, zone, day)
        assert contents() == before and lake.batches(spark, zone).count() == 3
        assert lake.pack(spark, zone, day) == 3 and contents() == before
        assert lake.batches(spark, zone).first().files == 1
    route_batch(validated.filter("offset % 5 >= 3"), 9, lake, "run")  # late, and shown beside the packed files
    assert sizes(spark, lake) == (1000, 839, 161)
    plan = lake.read_clean(spark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "DataFilters: []" in plan and " Filter " not in plan  # hidden folders are not read
    whole = contents()
    for zone in readers:
        assert lake.remove_replaced(spark, zone) == 3 and lake.remove_replaced(spark, zone) == 0
        assert contents() == whole
        assert lake.pack(spark, zone, day) == 2 and lake.pack(spark, zone, day) == 0 and contents() == whole
    assert lake.pack(spark, "raw", "1999-01-01") == 0
    with pytest.raises(RuntimeError, match="meanwhile"):
        lake._note_packs(spark, "raw", lake._packs(spark, "raw") | {"version": 1})


def test_replayed_batches_of_a_packed_day(spark, tmp_path):
    """A batch that is written again after its day was packed stays hidden: the packed files hold the same records."""
    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate

    lake = Lake(str(tmp_path / "lake"))
    batch = validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR)))))
    for n in range(2):
        route_batch(batch, n, lake, "run")
    (day,) = {r.ingestion_date.isoformat() for r in lake.batches(spark, "raw").collect()}
    assert lake.pack(spark, "raw", day) == 2
    route_batch(batch, 1, lake, "run")
    assert lake.read_raw(spark).count() == 2000


def test_packing_sorts_nothing(spark, tmp_path, monkeypatch):
    """A packed file is a quarter of a gigabyte of compressed rows; no task may hold them all, to deal them out or to write them."""
    from pyspark.sql.readwriter import DataFrameWriter

    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate

    lake = Lake(str(tmp_path / "lake"))
    batch = validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR)))))
    for n in range(2):
        route_batch(batch.filter(f"offset % 2 = {n}"), n, lake, "run")
    (day,) = {r.ingestion_date.isoformat() for r in lake.batches(spark, "clean").collect()}
    plans, partitioned, save = [], [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *names: partitioned.append(names) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *args: (plans.append(self._df._jdf.queryExecution().executedPlan().toString()), save(self, *args)))
    assert lake.pack(spark, "clean", day, file_bytes=10_000) == 2
    (plan,) = plans
    assert not partitioned and "hashpartitioning(topic" in plan and "Sort" not in plan and "RoundRobin" not in plan
    assert lake.read_clean(spark).count() == 839


def test_a_batch_is_cached_as_it_is(spark, tmp_path):
    """No encodings are looked for, and the session's own setting comes back."""
    from tripflow.operators.parse import decode_envelope, normalise
    from tripflow.operators.validate import validate

    name, seen = "spark.sql.inMemoryColumnarStorage.compressed", []

    class Seen(Lake):
        def write_raw(self, validated, *args):
            seen.append(spark.conf.get(name))
            super().write_raw(validated, *args)

    lake = Seen(str(tmp_path / "lake"))
    route_batch(validate(normalise(decode_envelope(as_records(load_feed(spark, SF_DIR))))), 0, lake, "run")
    assert seen == ["false"] and spark.conf.get(name) == "true"
    assert sizes(spark, lake) == (1000, 839, 161)
