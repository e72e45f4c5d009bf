"""Vector codes: four bytes for a vector, by codebooks that are trained here.

Components become integers, vectors are cut into ``PARTS`` consecutive parts, and each part position has a codebook of at most ``ENTRIES``. Training
starts from the vectors of the smallest vec_ids; a round assigns every part to its nearest entry and moves each entry to the floored mean of its parts.

The nearest entry is found by an equal-average search. Entries are sorted by the sum of their components; from the place of a part's own sum the
search goes outward to both sides. The squared distance is at least the squared gap of the sums over the dimension, so a side ends
where that exceeds the best distance strictly: equal distances are still seen, and go to the lower index.

A round reads the table once, and tasks return sums and counts for each entry. What is kept by the driver, and sent to tasks, is the codebooks: at most
``ENTRIES`` vectors. All arithmetic is on integers, so results are the same however the rows are dealt.

Defined results: rows whose vector is null, empty, or holds a null or non-finite component are dropped, and so are vectors that are not as long as
that of the smallest kept vec_id. A dimension that is no multiple of ``PARTS`` is cut at the floors of its multiples. Null vec_ids come
last in the first codebook, and ties of vec_id go by the vectors. Integers beyond ``limit(dimension)`` (for 64 components, components beyond 185,000)
are cut to it, as squared distances would not fit a long. A sum of errors that does not fit is null. With fewer vectors than ``ENTRIES`` the codebooks are
smaller. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, write_aside

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components that a task searches at a time.
BLOCK = 1 << 19

SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("rows", pa.int64()), ("total", pa.int64())])
SUMS_DDL = "part int, entry int, place int, rows long, total long"
CODES = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())])
CODES_DDL = "vec_id long, label long, code string, error long"

Codebooks = list[np.ndarray]


def limit(dimension: int) -> int:
    return isqrt((2**63 - 1) // dimension) // 2


def borders(dimension: int) -> list[int]:
    return [dimension * part // PARTS for part in range(PARTS + 1)]


def to_integers(values: np.ndarray) -> np.ndarray:
    """Floors of the scaled components of finite vectors."""
    most = limit(values.shape[1])
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -most, most).astype(np.int64)


def cut(vectors: np.ndarray) -> list[np.ndarray]:
    at = borders(vectors.shape[1])
    return [vectors[:, begin:end] for begin, end in zip(at, at[1:], strict=False)]


class Codebook:
    """The entries of one part position, sorted by the sum of their components."""

    def __init__(self, entries: np.ndarray) -> None:
        self.width = entries.shape[1]
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.entries = sums[self.order], entries[self.order]
        self.largest = int(np.abs(entries).max(initial=0))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, and its squared distance, for every part."""
        entries, sums = self.entries, self.sums
        reach = max(self.largest, int(np.abs(parts).max(initial=0))) * 2 * max(self.width, 1)
        if reach**2 >= 2**62:  # squared gaps of sums do not fit
            parts, entries, sums = parts.astype(object), entries.astype(object), sums.astype(object)
        targets = parts.sum(axis=1) if self.width else np.zeros(len(parts), np.int64)
        which = np.full(len(parts), len(sums), np.int64)
        best = np.full(len(parts), -1, parts.dtype)  # -1: none yet

        def see(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Looks at one entry for each row; rows for which their side has ended are left out."""
            gap = sums[at] - targets[rows]
            going = ((best[rows] < 0) | (gap * gap <= self.width * best[rows])).astype(bool)
            rows, at = rows[going], at[going]
            off = parts[rows] - entries[at]
            distance, index = (off * off).sum(axis=1), self.order[at]
            known = best[rows]
            better = ((known < 0) | (distance < known) | ((distance == known) & (index < which[rows]))).astype(bool)
            best[rows[better]], which[rows[better]] = distance[better], index[better]
            return rows, at

        place = np.searchsorted(sums, targets)
        sides = [[np.arange(len(parts)), place, 1], [np.arange(len(parts)), place - 1, -1]]
        while any(len(rows) for rows, _, _ in sides):
            for side in sides:
                rows, at, step = side
                inside = (at >= 0) & (at < len(sums))
                rows, at = see(rows[inside], at[inside])
                side[:2] = rows, at + step
        return which, best.astype(np.int64)


def _finite(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and vectors of the rows that are kept."""
    column = batch.column("embedding")
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    rows = np.flatnonzero(lengths == dimension)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become not-a-number
    vectors = values[starts[rows][:, None] + np.arange(dimension)]
    kept = np.isfinite(vectors).all(axis=1)
    return rows[kept], vectors[kept]


def _blocks(batches: Iterable[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    size = max(1, BLOCK // dimension)
    for batch in batches:
        for begin in range(0, batch.num_rows, size):
            block = batch.slice(begin, size)
            rows, vectors = _finite(block, dimension)
            yield block, rows, cut(to_integers(vectors))


def _is_whole(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(F.forall(vector, number), F.lit(False))


def first_codebooks(vectors: DataFrame) -> Codebooks:
    """Parts of the vectors of the smallest vec_ids; at most ``ENTRIES`` rows come to the driver."""
    whole = vectors.select("vec_id", "embedding").filter(_is_whole(F.col("embedding")))
    pick = lambda rows: rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).collect()
    rows = pick(whole)
    if not rows:
        return []
    dimension = len(rows[0]["embedding"])
    if any(len(row["embedding"]) != dimension for row in rows):
        rows = pick(whole.filter(F.size("embedding") == dimension))
    return cut(to_integers(np.array([row["embedding"] for row in rows], np.float64)))


def move_entries(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round of training."""
    dimension = sum(book.shape[1] for book in books)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Codebook(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros_like(book) for book in books]
        for _, _, parts in _blocks(batches, dimension):
            for number, (search, part) in enumerate(zip(searches, parts, strict=True)):
                which, _ = search.nearest(part)
                if not len(part):
                    continue
                order = np.argsort(which, kind="stable")
                used, begins = np.unique(which[order], return_index=True)
                counts[number][used] += np.diff(begins, append=len(order))
                totals[number][used] += np.add.reduceat(part[order], begins, axis=0)
        for number, (count, total) in enumerate(zip(counts, totals, strict=True)):
            used = np.flatnonzero(count)
            width = total.shape[1]
            yield batch_of(
                SUMS, part=np.full(len(used) * width, number), entry=np.repeat(used, width), place=np.tile(np.arange(width), len(used)),
                rows=np.repeat(count[used], width), total=total[used].ravel(),
            )

    summed = vectors.select("embedding").mapInArrow(task, SUMS_DDL).groupBy("part", "entry", "place")
    moved = [book.copy() for book in books]
    for row in summed.agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")).collect():  # as many as the codebooks have numbers
        moved[row["part"]][row["entry"], row["place"]] = row["total"] // row["rows"]
    return moved


def train(vectors: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    books = first_codebooks(vectors)
    for _ in range(rounds if books else 0):
        books = move_entries(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of every kept vector."""
    dimension = sum(book.shape[1] for book in books)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Codebook(book) for book in books]
        for block, rows, parts in _blocks(batches, dimension) if books else ():
            found = [search.nearest(part) for search, part in zip(searches, parts, strict=True)]
            bytes_ = np.stack([which for which, _ in found], axis=1).astype(np.uint8)
            yield batch_of(
                CODES, vec_id=block.column("vec_id").take(pa.array(rows)), label=block.column("label").take(pa.array(rows)),
                code=[line.tobytes().hex() for line in bytes_], error=sum(distance for _, distance in found),
            )

    return vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").mapInArrow(task, CODES_DDL)


def decode(code: str, books: Codebooks) -> np.ndarray:
    """The integers that a code stands for."""
    return np.concatenate([book[index] for book, index in zip(books, bytes.fromhex(code), strict=True)])


def codebooks_digest(books: Codebooks) -> str:
    numbers = (str(number) for book in books for number in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def code_report(vectors: DataFrame) -> DataFrame:
    """Codes and errors, with the error of all vectors of the label and a digest of the codebooks."""
    books = train(vectors)
    coded = write_aside(encode(vectors, books), "codes")
    of_label = coded.groupBy(F.col("label").alias("same_label")).agg(F.try_sum("error").alias("label_error"))
    both = coded.join(of_label, F.col("label").eqNullSafe(F.col("same_label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
