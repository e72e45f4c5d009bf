"""JSON-lines event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_FIELDS
from ..session import hadoop_path

# Amounts are read as written, so that their rounding to two decimals starts from the exact text.
_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS])


def parse_lines(lines: DataFrame, order: str) -> DataFrame:
    """Strict parse of a ``value`` column: malformed text raises when the row is read.

    ``whole_event`` is false where a line is not one object that mentions every event field, be it as
    null. The parser stops at the end of the first object, so a line is parsed as the only element of
    an array: text after the object then either breaks the array or shows up as a second element.
    """
    wanted = F.array(*map(F.lit, EVENT_FIELDS))
    as_array = F.concat(F.lit("["), "value", F.lit("]"))
    events = F.from_json(as_array, T.ArrayType(_TEXT_SCHEMA), {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    complete = F.size(F.array_except(wanted, F.json_object_keys("value"))) == 0
    return (
        lines.filter(F.col("value").rlike(r"\S"))
        .select(F.posexplode(events).alias("position", "event"), complete.alias("complete"), order)
        .select("event.*", F.coalesce((F.col("position") == 0) & F.col("complete"), F.lit(False)).alias("whole_event"), order)
    )


def read_event_files(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """All events of one or many files; blank lines are skipped and one bad line fails the read.

    ``partitions`` deals the lines out before they are parsed: for one compressed file, which cannot be split.

    ``arrival`` orders events as they stand in the files (files by name). A split is read front to
    back by one task, so file, split start and row number in the task give the line order however
    the files are split, and again after a task is retried elsewhere.
    """
    lines = spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("row_no"),
        ).alias("arrival"),
    )
    return parse_lines(lines.repartition(partitions) if partitions else lines, "arrival")


def newest_file(spark: SparkSession, folder: str, suffix: str = ".jsonl") -> str:
    """Path of the newest delivery: an event file of the folder, or a folder of part files that a Spark job has finished writing.

    Names end in ``suffix``. A delivery is as new as the newest of its files; only listings are read, never contents. A folder without the
    mark that writers leave at their end is still being written, or its writer has died, and does not count.
    """
    path, store = hadoop_path(spark, folder)
    root = F.lit(store.makeQualified(path).toString().rstrip("/") + "/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "modificationTime")
    # The first part of the path below the folder.
    top = F.concat(root, F.substring_index(F.substr("path", F.length(root) + 1), "/", 1))
    deliveries = files.groupBy(top.alias("delivery")).agg(
        F.max("modificationTime").alias("newest"), F.bool_or(F.col("path") == top).alias("is_file")
    )
    deliveries = deliveries.filter(F.col("delivery").endswith(suffix)).orderBy(F.desc("newest"), "delivery")
    for delivery in deliveries.toLocalIterator():
        if delivery["is_file"] or store.exists(hadoop_path(spark, f"{delivery['delivery']}/_SUCCESS")[0]):
            return delivery["delivery"]
    raise FileNotFoundError(f"no whole *{suffix} delivery in {folder}")


# -- bad lines -------------------------------------------------------------------------------------


def numbered_bad_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_number, value) of the lines that are no event object with every field. Blank lines count, but are not bad.

    A file is read in splits by as many tasks. Each split counts its lines, and a line's number is its place in its split
    plus the lines of the splits before; there are as many counts as the scan has splits. Bad lines alone meet the counts.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row_no"),  # front to back within a split, and the same in both readings
    )
    counts = lines.groupBy("file", "split").agg(F.count("*").alias("lines"), F.min("row_no").alias("first_row"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("file", "split", "first_row", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    wanted = F.array(*map(F.lit, EVENT_FIELDS))
    whole = F.coalesce(F.size(F.array_except(wanted, F.json_object_keys("value"))) == 0, F.lit(False))
    bad = lines.filter(F.col("value").rlike(r"\S") & ~whole)
    number = F.col("before") + F.col("row_no") - F.col("first_row") + 1
    return bad.join(counts, ["file", "split"]).select("file", number.alias("line_number"), "value")


def bad_lines(spark: SparkSession, path: str | list[str], limit: int = 5) -> list[tuple[str, int, str]]:
    """File, line number and text of the first bad lines, to name in an error."""
    found = numbered_bad_lines(spark, path).orderBy("file", "line_number").limit(limit).collect()
    return [(r["file"], r["line_number"], r["value"][:200]) for r in found]
