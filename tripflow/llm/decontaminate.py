"""Benchmark decontamination by suffix arrays of the training documents.

Each task joins its documents into shards, sorts a shard's suffixes (prefix doubling in numpy) and binary-searches every test suffix for the
range of training suffixes that start with the same window of words. Ranges give all verbatim matches, with their places; matches that go on
from window to window give the longest ones. Documents are never shuffled, and only their ids and numbers leave a task.

A word that no test item has cannot be part of a match. The array therefore holds only runs of test words that are as long as the shortest
window: the suffixes left out could not be found by any search.

Defined results: a null or empty text, and an item without words, match nothing. An item without item_id marks words as hit but is not
listed. Items that repeat an item_id are listed once. Repeated documents and null doc_ids are judged row by row. A benchmark
without items leaves every document clean. Extra columns are ignored by ``contamination_report`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch_of, small_batches

WINDOW = 13
#: Words of the documents that share one suffix array.
SHARD_WORDS = 1_000_000
#: The test items go to every task. A larger benchmark is refused, not cut.
BENCHMARK_CHARS = 200_000_000

_BREAKS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
#: Lower-cases A-Z and makes every byte that ends a word a space. Bytes of other characters stay.
_TABLE = bytes(0x20 if b in _BREAKS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

REPORT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest_match", pa.int64()),
    ("longest_at", pa.int64()), ("longest_item", pa.string()),
])
REPORT_DDL = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "longest_match long, longest_at long, longest_item string"
)


def bench_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass
class Items:
    """The test suffixes: distinct windows, and which item has which window at which word."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # one row each, padded with -1
    sizes: np.ndarray
    longest: int
    owner_window: np.ndarray  # sorted
    owner_item: np.ndarray  # index into ids
    owner_at: np.ndarray
    ids: list[str | None]

    @classmethod
    def of(cls, rows: Iterable[tuple[object, str | None]], window: int = WINDOW) -> Items:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], int] = {}
        names: dict[str | None, int] = {}
        owners, longest = [], 0
        for item_id, text in rows:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in bench_words(text)]
            if not numbers:
                continue
            longest = max(longest, len(numbers))
            name = names.setdefault(None if item_id is None else str(item_id), len(names))
            size = min(window, len(numbers))
            for at in range(len(numbers) - size + 1):
                owners.append((found.setdefault(tuple(numbers[at : at + size]), len(found)), name, at))
        table = np.full((len(found), window), -1, np.int32)
        for row, numbers in enumerate(found):
            table[row, : len(numbers)] = numbers
        owner = np.array(sorted(owners), np.int64).reshape(-1, 3)
        return cls(vocabulary, table, (table >= 0).sum(axis=1), longest, *owner.T, list(names))


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Start positions ordered by their first ``depth`` symbols at least."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order, length = np.argsort(rank, kind="stable"), 1
    while length < depth:
        after = np.zeros(n, np.int64)
        after[: max(0, n - length)] = rank[length:] + 1
        keys = rank * (max(int(rank.max(initial=0)), n) + 2) + after
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = steps
        length *= 2
        if n == 0 or steps[-1] == n - 1:
            break
    return order


def search_ranges(symbols: np.ndarray, order: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the range of the suffix array whose suffixes begin with it: two binary searches of all windows at once."""
    width = windows.shape[1]
    padded = np.concatenate([symbols, np.zeros(width, symbols.dtype)])
    columns = np.arange(width)

    def bound(after_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(order), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = order[np.minimum(middle, len(order) - 1)]
            differs = np.where(windows < 0, 0, padded[at[:, None] + columns] - windows)
            first = (differs != 0).argmax(axis=1)
            sign = differs[np.arange(len(windows)), first]
            right = open_ & ((sign < 0) | ((sign == 0) & after_equal))
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    return (bound(False), bound(True)) if len(order) else (np.zeros(len(windows), np.int64),) * 2


def judge_shard(texts: list[str | None], items: Items) -> list[tuple]:
    """A report row, without its doc_id, for every text."""
    counts = np.zeros(len(texts), np.int64)
    pieces, places = [], []
    least = int(items.sizes.min(initial=WINDOW))
    for number, text in enumerate(texts):
        found = bench_words(text)
        counts[number] = len(found)
        ids = np.fromiter(map(items.vocabulary.get, found, repeat(0)), np.int32, len(found))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]]).astype(np.int8)))
        for start, end in edges.reshape(-1, 2):
            if end - start >= least:
                pieces += [ids[start:end], [0]]
                places += [(number, start, end - start)]
    symbols = np.concatenate([*pieces, np.zeros(0, np.int32)]).astype(np.int32)
    place = np.array(places, np.int64).reshape(-1, 3)
    document = np.repeat(place[:, 0], place[:, 2] + 1)
    begin = np.cumsum(place[:, 2] + 1) - place[:, 2] - 1
    word = np.arange(len(symbols)) - np.repeat(begin - place[:, 1], place[:, 2] + 1)

    order = suffix_array(symbols, items.longest)
    low, high = search_ranges(symbols, order, items.windows)
    many = high - low
    window = np.repeat(np.arange(len(many)), many)
    at = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]

    cover = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + items.sizes[window], -1)
    n_hit = np.bincount(document[np.cumsum(cover)[:-1] > 0], minlength=len(texts))

    # Every match of a window once for each of the items that have it.
    from_, to = np.searchsorted(items.owner_window, [window, window + 1])
    match = np.repeat(np.arange(len(window)), to - from_)
    owner = np.arange(len(match)) - np.repeat(np.cumsum(to - from_) - (to - from_), to - from_) + np.repeat(from_, to - from_)
    in_text, item = at[match], items.owner_item[owner]
    shift = in_text - items.owner_at[owner]
    ordered = np.lexsort((in_text, shift, item))
    breaks = np.ones(len(ordered), bool)
    breaks[1:] = (
        (np.diff(item[ordered]) != 0) | (np.diff(shift[ordered]) != 0) | (np.diff(in_text[ordered]) != 1)
        | (np.diff(document[in_text[ordered]]) != 0)
    )
    starts = np.flatnonzero(breaks)
    lengths = np.diff(np.concatenate([starts, [len(ordered)]])) - 1 + items.sizes[window[match[ordered[starts]]]]
    best: dict[int, tuple[int, int, int]] = {}
    seen: dict[int, set[int]] = {}
    for position, name, length in zip(in_text[ordered[starts]], item[ordered[starts]], lengths, strict=True):
        number = int(document[position])
        seen.setdefault(number, set()).add(int(name))
        best[number] = min(best.get(number, (0, 0, 0)), (-int(length), int(word[position]), int(name)))

    rows = []
    for number in range(len(texts)):
        names = sorted(items.ids[i] for i in seen.get(number, ()) if items.ids[i] is not None)
        n, hit = int(counts[number]), int(n_hit[number])
        length, start, name = best.get(number, (0, None, None))
        rows.append((
            n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0 and 20 * hit >= n,
            -length, start, None if name is None else items.ids[name],
        ))
    return rows


def load_items(benchmark: DataFrame) -> Items:
    size = benchmark.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    if size > BENCHMARK_CHARS:
        raise ValueError(f"the benchmark has {size} characters; at most {BENCHMARK_CHARS} fit in every task")
    return Items.of(benchmark.select("item_id", "text").orderBy("item_id", "text").collect())


def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches gathered until they have about ``SHARD_WORDS`` words."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes // 6
        if size >= SHARD_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = docs.sparkSession.sparkContext.broadcast(load_items(benchmark))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards(batches):
            ids = [x for batch in held for x in batch.column("doc_id").to_pylist()]
            rows = judge_shard([x for batch in held for x in batch.column("text").to_pylist()], items.value)
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield batch_of(REPORT, doc_id=ids, **dict(zip(REPORT.names[1:], columns, strict=True)))

    return arrow_map(docs.select("doc_id", "text"), task, REPORT_DDL)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    items = docs.sparkSession.sparkContext.broadcast(load_items(benchmark))
    place, verdict = docs.columns.index("text"), REPORT.names.index("contaminated") - 1

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards(batches):
            rows = judge_shard([x for batch in held for x in batch.column(place).to_pylist()], items.value)
            clean = [not row[verdict] for row in rows]
            for batch in held:
                yield batch.filter(pa.array(clean[: len(batch)], pa.bool_()))
                clean = clean[len(batch) :]

    small_batches(docs.sparkSession)
    return docs.mapInArrow(task, docs.schema)
