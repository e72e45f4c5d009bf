import datetime as dt
import json
import os
from decimal import Decimal

import pytest

from tripflow.operators.staging import FILE_ORDER, stage_events, staging_rows_from_files
from tripflow.operators.strict import StrictLoadError, check_strict, strict_violations
from tripflow.schemas import EVENT_FIELDS
from tripflow.sources.files import bad_lines, newest_file, numbered_bad_lines, read_event_files
from tripflow.sources.landing import copy_lines, land_raw_files, landed_digests, partition_value, ranges

EVENT = {
    "event_id": "evt_1", "ride_id": "ride_1", "driver_id": "drv_1", "rider_id": "rdr_1", "event_type": "trip_completed",
    "event_version": "1.0", "event_timestamp": "2024-01-02T03:04:05", "pickup_location": "Mbare",
    "dropoff_location": "Avondale", "fare_usd": 12.345, "payment_method": "EcoCash", "payment_status": "pending",
}


def write(path, *lines):
    path.write_text("".join((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines))
    return str(path)


def rows_of(spark, path):
    return staging_rows_from_files(read_event_files(spark, path))


def test_rows_are_typed_and_otherwise_verbatim(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", "", EVENT, "   \t", EVENT | {"event_id": "evt_2", "fare_usd": None, "extra": 1})
    rows = check_strict(rows_of(spark, path))
    found = {r.event_id: r for r in stage_events(None, rows, FILE_ORDER).collect()}
    assert found.keys() == {"evt_1", "evt_2"}
    first = found["evt_1"]
    assert first.fare_usd == Decimal("12.35") and found["evt_2"].fare_usd is None
    assert first.event_timestamp == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert first.payment_method == "EcoCash"


def test_an_explicit_null_version_stays_null(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", EVENT | {"event_version": None, "driver_id": None})
    row = check_strict(rows_of(spark, path)).first()
    assert row.event_version is None and row.driver_id is None


@pytest.mark.parametrize("line", [
    "not json", '{"event_id": "evt', "[1, 2", "7", '"text"', "null", "[]", json.dumps([EVENT]),
    json.dumps(EVENT) + " tail", json.dumps(EVENT) * 2, json.dumps(EVENT) + "," + json.dumps(EVENT),
    json.dumps(EVENT).replace('"', "'"),
])
def test_one_malformed_line_fails_the_load(spark, tmp_path, line):
    path = write(tmp_path / "a.jsonl", EVENT, line)
    with pytest.raises(Exception):
        check_strict(rows_of(spark, path))


BROKEN = [
    ({"event_id": None}, "event_id_not_null"),
    ({"ride_id": None}, "ride_id_not_null"),
    ({"event_type": None}, "event_type_not_null"),
    ({"event_timestamp": None}, "event_timestamp_not_null"),
    ({"event_timestamp": "yesterday"}, "event_timestamp_not_null"),
    ({"event_id": "x" * 101}, "event_id_max_length"),
    ({"pickup_location": "x" * 101}, "pickup_location_max_length"),
    ({"payment_method": "x" * 51}, "payment_method_max_length"),
    ({"event_version": "x" * 11}, "event_version_max_length"),
    ({"fare_usd": 1e8}, "fare_usd_numeric"),
    ({"fare_usd": "abc"}, "fare_usd_numeric"),
]


def test_each_constraint_is_reported(spark, tmp_path):
    for change, name in BROKEN:
        path = write(tmp_path / "a.jsonl", EVENT, EVENT | change)
        with pytest.raises(StrictLoadError) as caught:
            check_strict(rows_of(spark, path))
        assert caught.value.violations == {name: 1}


def test_an_absent_field_is_not_the_same_as_null(spark, tmp_path):
    for name in EVENT_FIELDS:
        path = write(tmp_path / "a.jsonl", EVENT, {k: v for k, v in EVENT.items() if k != name})
        with pytest.raises(StrictLoadError) as caught:
            check_strict(rows_of(spark, path))
        assert caught.value.violations["one_whole_event_per_line"] == 1


def test_limits_are_inclusive(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", EVENT | {"event_id": "x" * 100, "event_version": "y" * 10, "fare_usd": 99999999.99})
    rows = rows_of(spark, path)
    assert {r.violations for r in strict_violations(rows).collect()} == {0}
    assert check_strict(rows).first().fare_usd == Decimal("99999999.99")


def test_first_line_wins_across_splits_and_files(spark, tmp_path):
    """Small splits put the lines of one file on many tasks; the earliest line still wins."""
    lines = [EVENT | {"event_id": f"evt_{i % 50}", "ride_id": f"line_{i}"} for i in range(2000)]
    write(tmp_path / "a.jsonl", *lines)
    write(tmp_path / "b.jsonl", *[EVENT | {"event_id": f"evt_{i}", "ride_id": "late"} for i in range(60)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = rows_of(spark, str(tmp_path / "*.jsonl"))
        assert rows.rdd.getNumPartitions() > 8
        found = {r.event_id: r.ride_id for r in stage_events(None, rows, FILE_ORDER).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {f"evt_{i}": f"line_{i}" if i < 50 else "late" for i in range(60)}


def test_newest_file(spark, tmp_path):
    for age, name in enumerate(["b.jsonl", "c.jsonl", "a.jsonl", "z.txt"]):
        write(tmp_path / name, EVENT)
        os.utime(tmp_path / name, (1_700_000_000 + age * 60,) * 2)
    assert newest_file(spark, str(tmp_path)).endswith("/a.jsonl")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        newest_file(spark, str(tmp_path / "empty"))


def test_landing_again_replaces_only_the_file(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", EVENT, "not json", "é\r")
    other = write(tmp_path / "b.jsonl", "other")
    for source in (path, other, path):
        land_raw_files(spark, source, str(tmp_path / "raw"))
    landed = spark.read.option("lineSep", "\n").text(str(tmp_path / "raw")).collect()
    expected = [(json.dumps(EVENT), "a.jsonl"), ("not json", "a.jsonl"), ("é\r", "a.jsonl"), ("other", "b.jsonl")]
    assert sorted((r.value, r.source_file) for r in landed) == sorted(expected)
    with pytest.raises(Exception):
        land_raw_files(spark, str(tmp_path / "missing.jsonl"), str(tmp_path / "raw"))


def test_bad_lines_are_named(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", EVENT, "not json", EVENT, {"event_id": "x"})
    found = bad_lines(spark, path)
    assert [text for _, _, text in found] == ["not json", '{"event_id": "x"}']
    assert [(file.rsplit("/", 1)[1], number) for file, number, _ in found] == [("a.jsonl", 2), ("a.jsonl", 4)]


def test_bad_lines_are_numbered_across_splits_and_files(spark, tmp_path):
    """Blank lines, carriage returns and lines longer than a split; some files have no line feed at their end."""
    expected = set()
    for name in ("a", "b", "c"):
        lines = []
        for n in range(1, 700):
            kind = (n * 7 + ord(name)) % 13
            line = {0: "", 1: f"broken {n}", 2: "   ", 3: json.dumps({"event_id": n}), 4: "x" * 5000}.get(kind, json.dumps(EVENT | {"event_id": f"e{n}"}))
            if kind in (1, 3, 4):
                expected.add((f"{name}.jsonl", n, line))
            lines.append(line)
        end = "\r\n" if name == "b" else "\n"
        (tmp_path / f"{name}.jsonl").write_bytes(end.join(lines).encode() + (b"" if name == "c" else end.encode()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = numbered_bad_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
        assert sorted((r.file.rsplit("/", 1)[1], r.line_number, r.value) for r in found.collect()) == sorted(expected)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.file.rsplit("/", 1)[1], r.line_number, r.value) for r in found.collect()} == expected


def deliver(spark, folder, marked=True):
    writer = spark.range(10).selectExpr("cast(id AS string)").repartition(3).write
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(marked).lower()).text(folder)
    return folder


def test_newest_whole_delivery(spark, tmp_path):
    """Files and folders of part files compete; one that is still written does not count, however new."""
    write(tmp_path / "old.jsonl", EVENT)
    os.utime(tmp_path / "old.jsonl", (1_700_000_000,) * 2)
    (tmp_path / "other").mkdir()
    write(tmp_path / "other" / "deep.jsonl", EVENT)  # no delivery of this folder
    assert newest_file(spark, str(tmp_path)).endswith("/old.jsonl")
    whole = deliver(spark, str(tmp_path / "whole.jsonl"))
    deliver(spark, str(tmp_path / "unfinished.jsonl"), marked=False)
    found = newest_file(spark, str(tmp_path))
    assert found.endswith("/whole.jsonl") and spark.read.text(found).count() == 10
    assert spark.read.text(whole).count() == 10
    os.utime(tmp_path / "old.jsonl", (4_000_000_000,) * 2)
    assert newest_file(spark, str(tmp_path)).endswith("/old.jsonl")


CONTENTS = {
    "a.jsonl": b"one\ntwo\r\n\n\nthree", "b.jsonl": b"one\n", "empty.jsonl": b"", "c.jsonl": b"\n\n\n", "d=%1.jsonl": b"x" * 5000,
    "\u00e9 f.jsonl": b"\xff\xfe bad \x00 utf\n" * 300, "long.jsonl": b"y" * 300 + b"\n" + b"z\n" * 50 + b"w" * 999,
}


@pytest.mark.parametrize("range_bytes", [1 << 20, 64, 7])
def test_landed_bytes_are_the_source_bytes(spark, tmp_path, range_bytes):
    source, raw = tmp_path / "source", tmp_path / "raw"
    source.mkdir()
    for name, content in CONTENTS.items():
        (source / name).write_bytes(content)
    for _ in range(2):
        listed = land_raw_files(spark, str(source), str(raw), range_bytes)
    for name, content in CONTENTS.items():
        parts = sorted((raw / f"source_file={partition_value(name)}").glob("part-*"))
        assert b"".join(p.read_bytes() for p in parts) == content
        assert all(p.read_bytes().endswith(b"\n") for p in parts[:-1])  # whole lines, so readers of lines see the file's
    rows = {(r.source_file, r.part): (r.bytes, r.sha256) for r in listed.collect()}
    assert {(r.source_file, r.part): (r.bytes, r.sha256) for r in landed_digests(spark, str(raw)).collect()} == rows
    assert sorted(p.name for p in raw.iterdir() if not p.name.startswith("source_file=")) == ["_landed", "_landing"]
    assert not list((raw / "_landing").iterdir())


def test_files_of_one_name_share_a_partition(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder / "a.jsonl", folder)
    land_raw_files(spark, [str(tmp_path / "x" / "a.jsonl"), str(tmp_path / "y" / "a.jsonl")], str(tmp_path / "raw"))
    assert {(r.value, r.source_file) for r in spark.read.text(str(tmp_path / "raw")).collect()} == {("x", "a.jsonl"), ("y", "a.jsonl")}


def test_ranges_are_dealt_out(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b"x" * 1000)
    found = sorted((r.begin, r.stop, r.part) for r in ranges(spark, str(tmp_path / "a.jsonl"), 300).collect())
    assert found == [(0, 300, 0), (300, 600, 1), (600, 900, 2), (900, 1000, 3)]


def test_a_file_that_became_shorter_is_an_error(tmp_path):
    import pyarrow as pa

    (tmp_path / "a").write_bytes(b"one\ntwo\n")
    with pa.OSFile(str(tmp_path / "a")) as source, pytest.raises(OSError, match="shorter"):
        copy_lines(source, 0, 20, 20, lambda: pa.BufferOutputStream())
