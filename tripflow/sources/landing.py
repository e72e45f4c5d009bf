"""Landing: byte-exact copies of files in the raw zone, made by tasks.

A file is cut into ranges of ``RANGE_BYTES``, and the ranges are dealt out to tasks. A range takes the lines that begin in it, so its
part is whole lines, carriage returns and all; the last part ends as the file does, with a line feed or without. The parts of a file in
the order of their names are the file's bytes, and any reader of lines can take the folder as it stands.

Parts are written to a folder that readers do not see, under names of their attempt, and take their place at the end. A task that runs twice
writes the same bytes. What was landed is listed in ``_landed``, with the digest of every part.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path

RANGE_BYTES = 128 << 20
#: Bytes that a task reads at a time.
BLOCK_BYTES = 8 << 20
TASKS_PER_CORE = 16

_SHORTER = "the file became shorter while it was copied"
_COPIED = "path string, source_file string, part string, begin long, stop long, bytes long, sha256 string"


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it. Spark's names of the local and S3 schemes are others here."""
    path = re.sub("^s3a:", "s3:", re.sub("^file:/+", "/", path))
    return fs.FileSystem.from_uri(path)


def partition_value(name: str) -> str:
    """A file name as it stands in a partition's folder name."""
    return re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda found: f"%{ord(found[0]):02X}", name)


def _line_start(source: pa.NativeFile, at: int, size: int) -> int:
    """Where the first line begins that begins at ``at`` or later."""
    if at <= 0:
        return 0
    at -= 1  # a line begins at ``at`` if the byte before is a line feed
    source.seek(at)
    while at < size:
        block = source.read(min(1 << 16, size - at))
        if not block:
            raise OSError(_SHORTER)
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return size


def copy_lines(source: pa.NativeFile, begin: int, stop: int, size: int, sink: Callable[[], pa.NativeFile]) -> tuple[int, int, str]:
    """Copies the lines that begin in [begin, stop): where they begin, where they end, and their digest. Opens no sink for none."""
    start, end = _line_start(source, begin, size), _line_start(source, stop, size)
    digest = hashlib.sha256()
    if start < end or size == 0:
        with sink() as out:
            source.seek(start)
            left = end - start
            while left:
                block = source.read(min(BLOCK_BYTES, left))
                if not block:
                    raise OSError(_SHORTER)
                digest.update(block)
                out.write(block)
                left -= len(block)
    return start, end, digest.hexdigest()


def ranges(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, length, begin, stop, part) from the listing of the files; an empty file has one empty range. A missing file is an error."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    cut = listed.select("path", "length", F.posexplode(starts).alias("part", "begin"))
    return cut.withColumn("stop", F.least(F.col("begin") + range_bytes, "length"))


def _dealt_out(work: DataFrame) -> DataFrame:
    """Rows that are few bytes and much work, a few to a task. By number, as adaptive execution would join partitions of so few bytes."""
    cores = work.sparkSession.sparkContext.defaultParallelism
    return work.repartition(max(1, min(work.count(), TASKS_PER_CORE * cores)))


def land_raw_files(spark: SparkSession, path: str | list[str], raw_folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Copies event files into the raw zone, byte by byte, each into a partition with its name. A missing file is an error.

    Landing a file again replaces its partition and nothing else. Files of one name from several folders share a partition. Returns the list of
    the parts: (path, source_file, part, begin, stop, bytes, sha256). Both folders must be ones that ``open_store`` can reach.
    """
    folder, store = hadoop_path(spark, raw_folder)
    root = store.makeQualified(folder).toString().rstrip("/")
    run = uuid.uuid4().hex
    staged, listing = f"{root}/_landing/{run}", f"{root}/_landed/{run}"

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source_store, source_path = open_store(row["path"])
                name = row["path"].rsplit("/", 1)[1]
                place = hashlib.sha256(row["path"].encode()).hexdigest()[:12]  # files of one name keep apart
                part = f"part-{place}-{row['part']:06d}"
                sink_store, sink_path = open_store(f"{staged}/source_file={partition_value(name)}")
                sink_store.create_dir(sink_path, recursive=True)
                attempt = f"{sink_path}/.{part}-{uuid.uuid4().hex}"
                with source_store.open_input_file(source_path) as source:
                    sink = lambda: sink_store.open_output_stream(attempt)  # noqa: B023, E731
                    start, end, digest = copy_lines(source, row["begin"], row["stop"], row["length"], sink)
                if start == end and row["length"]:
                    continue  # no line begins here
                sink_store.move(attempt, f"{sink_path}/{part}")
                yield pa.RecordBatch.from_pylist([{
                    "path": row["path"], "source_file": name, "part": part, "begin": start, "stop": end, "bytes": end - start, "sha256": digest,
                }], schema=pa.schema([
                    ("path", pa.string()), ("source_file", pa.string()), ("part", pa.string()), ("begin", pa.int64()), ("stop", pa.int64()),
                    ("bytes", pa.int64()), ("sha256", pa.string()),
                ]))

    _dealt_out(ranges(spark, path, range_bytes)).mapInArrow(task, _COPIED).write.parquet(listing)
    landed = spark.read.schema(_COPIED).parquet(listing)
    for row in landed.select("source_file").distinct().toLocalIterator():
        name = f"source_file={partition_value(row['source_file'])}"
        final, _ = hadoop_path(spark, f"{root}/{name}")
        store.delete(final, True)
        store.rename(hadoop_path(spark, f"{staged}/{name}")[0], final)
    store.delete(hadoop_path(spark, staged)[0], True)
    return landed


def landed_digests(spark: SparkSession, raw_folder: str) -> DataFrame:
    """(source_file, part, bytes, sha256) of what is in the raw zone now, computed anew by tasks."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(raw_folder)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["path"])
                digest, size = hashlib.sha256(), 0
                with store.open_input_stream(path) as source:
                    while block := source.read(BLOCK_BYTES):
                        digest.update(block)
                        size += len(block)
                yield pa.RecordBatch.from_pydict({"path": [row["path"]], "bytes": [size], "sha256": [digest.hexdigest()]})

    found = _dealt_out(listed.select("path")).mapInArrow(task, "path string, bytes long, sha256 string")
    name = F.url_decode(F.replace(F.regexp_extract("path", "source_file=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    return found.select(name.alias("source_file"), F.element_at(F.split("path", "/"), -1).alias("part"), "bytes", "sha256")
