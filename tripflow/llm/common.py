"""Helpers that the corpus operators share: tables, words, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, shared_path, use_shared_checkpoints, write_aside

__all__ = [
    "ASCII_SPACE", "Scratch", "arrow_map", "batch_of", "join_lines_except", "lines_of", "lower_ascii", "mix", "read_table", "row_key",
    "shared_path", "small_batches", "use_shared_checkpoints", "words", "write_aside",
]

#: The characters that end a word.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Rows of text in one Arrow batch. A batch, its Python objects and an operator's working set fit in a worker's memory.
BATCH_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` in UTF-8. ``bytes.split`` splits on exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def join_lines_except(text: Column, lost: Column) -> Column:
    """The text without the lines at these places."""

    def joined(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    # The lines are a lambda variable, so that they are split once and not for every line.
    return F.get(F.transform(F.array(lines_of(text)), joined), 0)


def row_key(text: Column) -> Column:
    """Tells rows that share a doc_id apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Texts may be long, so Python workers get them in batches of few rows. A smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def arrow_map(
    rows: DataFrame, task: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    small_batches(rows.sparkSession)
    return rows.mapInArrow(task, schema)


def batch_of(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type, from_pandas=False) for f in schema], schema=schema
    )


class Scratch:
    """Tables written aside for later stages of one operator, in a folder of the shared one, and dropped when they have been read."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.folder = spark, shared_path(spark, label)
        self._paths: dict[int, str] = {}

    def keep(self, rows: DataFrame, label: str) -> DataFrame:
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        self._paths[id(kept)] = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that no plan reads any more."""
        for table in tables:
            path, store = hadoop_path(self.spark, self._paths.pop(id(table)))
            store.delete(path, True)

    def drop_all(self) -> None:
        path, store = hadoop_path(self.spark, self.folder)
        store.delete(path, True)
        self._paths.clear()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
