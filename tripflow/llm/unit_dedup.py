"""Substring dedup by line hashing: normalised units are grouped by digest across the corpus, and the earliest ranked occurrence stays.

Units are lines, the sentences of a line, and, since copies of a passage may have other line and sentence borders, runs of ``RUN`` words or more.
A run begins and ends at anchors: the words whose hash is the least of ``GAP`` in a row. Anchors depend on nothing outside of the passage, and
from any of them the next is at most ``GAP`` words away. So every repeated passage of ``RUN + 2 * GAP`` words has a run inside it, and at most about
``GAP`` words stay at each of its borders. The normal form of a unit has A-Z lower-cased, runs of
white space as one space, and neither white space nor ASCII punctuation at its ends. Units whose normal form has fewer than ``MIN_CHARS`` code
points always stay. Occurrences are ranked by doc_id, then by place, so a unit that comes back within its own document is removed there too.
Removed units keep their offsets in the original text.

A map task sends at most one row a digest to the search for first documents, however hot the digest; occurrences then meet the repeated
digests in a join that adaptive execution can split. Units are made twice, once for each of these, as they are as large as the texts.

Defined results: a null or empty text has no units. Rows that repeat a doc_id are one document, and a unit stays in each of them. Documents without
doc_id rank last and are one document. Extra columns are ignored by ``repeated_units`` and kept by ``drop_units``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch_of, mix, row_key, small_batches

MIN_CHARS = 30
#: Words that a run has at least, and words in a row of which one is an anchor.
RUN, GAP = 16, 16

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SENTENCE_END = re.compile(r"[.!?][\x20\x09-\x0D]+")
#: White space and ASCII punctuation.
_ENDS = b" \t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

UNITS = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.binary()), ("again", pa.bool_()),
])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("again", pa.bool_())])
UNITS_DDL = "doc_id long, row long, start long, end long, digest binary, again boolean"


def normal_form(unit: str) -> bytes | None:
    """In UTF-8; None if it is too short. Splitting and lower-casing bytes touches ASCII only."""
    form = b" ".join(unit.encode("utf-8", "surrogatepass").strip(_ENDS).split()).lower()
    if len(form) < 4 * MIN_CHARS and len(form.decode("utf-8", "surrogatepass")) < MIN_CHARS:
        return None
    return form


def anchors_of(found: list[bytes]) -> np.ndarray:
    """Places of the words that begin and end runs. A word's hash takes in the next word, so that common words are not always chosen."""
    if len(found) <= GAP:
        return np.zeros(0, np.int64)
    codes = np.fromiter(map(zlib.crc32, found), np.uint64, len(found))
    hashes = mix(codes[:-1] << np.uint64(32) | codes[1:])
    # The last of equal ones.
    least = GAP - 1 - np.lib.stride_tricks.sliding_window_view(hashes[::-1], GAP).argmin(axis=1)[::-1]
    return np.unique(np.arange(len(least)) + least)


def word_places(text: str) -> tuple[list[int], list[int]]:
    """Start and end of every word, in code points. With single spaces or line ends between words their lengths tell."""
    found = _WORD.findall(text)
    sizes = list(map(len, found))
    ends = list(accumulate(sizes, lambda end, size: end + 1 + size))
    if ends and ends[-1] == len(text):
        return list(map(sub, ends, sizes)), ends
    spans = [m.span() for m in _WORD.finditer(text)]
    return [start for start, _ in spans], [end for _, end in spans]


def _runs(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and normal form of every run. One that overlaps an earlier equal one is left out: it is not another copy."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    anchors = anchors_of(found)
    stops = np.searchsorted(anchors, anchors + RUN)
    stops = stops[stops < len(anchors)]
    if not len(stops):
        return
    starts, stops_at = word_places(text)
    ends: dict[bytes, int] = {}
    for begin, stop in zip(anchors.tolist(), anchors[stops].tolist(), strict=False):
        start, end = starts[begin], stops_at[stop - 1]
        form = b" ".join(found[begin:stop]).strip(_ENDS)
        if ends.get(form, 0) <= start:
            ends[form] = end
            yield start, end, form


def run_spans(text: str) -> Iterator[tuple[int, int]]:
    for start, end, _ in _runs(text):
        yield start, end


def _units(text: str) -> Iterator[tuple[int, int, bytes | None]]:
    """Start, end and normal form (None if too short) of every line, of every sentence of a line that has several, and of every run that is
    none of these."""
    known = set()
    for start, end in _line_spans(text):
        known.add((start, end))
        yield start, end, normal_form(text[start:end]) if end - start >= MIN_CHARS else None
    for start, end, form in _runs(text):
        if (start, end) not in known:
            yield start, end, form if len(form) >= 4 * MIN_CHARS else normal_form(text[start:end])


def unit_spans(text: str) -> Iterator[tuple[int, int]]:
    for start, end, _ in _units(text):
        yield start, end


def _line_spans(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every line, and of every sentence of a line that has several."""
    start = 0
    for line in text.split("\n"):
        end = start + len(line)
        yield start, end
        begin = start
        for stop in _SENTENCE_END.finditer(text, start, end):
            yield begin, stop.start() + 1
            begin = stop.end()
        if start < begin < end:
            yield begin, end
        start = end + 1


def _digests_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the search for first documents needs of the units: a row for each digest of a text, and whether it comes again there."""
    for batch in batches:
        docs, digests, again = [], [], []
        for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
            seen: dict[bytes, int] = {}
            repeated = set()
            for start, _, form in _units(text) if text else ():
                if form is not None and seen.setdefault(form, start) != start:
                    repeated.add(form)
            docs += [doc_id] * len(seen)
            digests += [hashlib.blake2b(form, digest_size=16).digest() for form in seen]
            again += map(repeated.__contains__, seen)
        yield batch_of(DIGESTS, doc_id=docs, digest=digests, again=again)


def _units_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True):
            seen: dict[bytes, int] = {}
            for start, end, form in _units(text) if text else ():
                if form is not None:
                    digest = hashlib.blake2b(form, digest_size=16).digest()
                    first = seen.setdefault(digest, start)
                    # A line and its only sentence may have one form: the same place is not a repetition.
                    rows.append((doc_id, row, start, end, digest, first != start))
        columns = list(zip(*rows, strict=True)) or [[]] * len(UNITS)
        yield batch_of(UNITS, **dict(zip(UNITS.names, columns, strict=True)))


def units_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, end, digest, again): offsets in code points; ``again`` if the text has the unit before."""
    return arrow_map(docs.select("doc_id", row_key(F.col("text")).alias("row"), "text"), _units_task, UNITS_DDL)


def repeated_units(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, end, digest, first_doc_id) of every unit to be removed, for every row of ``docs``."""
    units = units_of(docs)
    least, most = F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id")
    odd = F.max(F.col("doc_id").isNull() | F.col("again")).alias("odd")
    digests = arrow_map(docs.select("doc_id", "text"), _digests_task, "doc_id long, digest binary, again boolean")
    firsts = digests.groupBy("digest").agg(least, most, odd).filter("odd OR first_doc_id < last_doc_id")
    met = units.join(firsts.select("digest", "first_doc_id"), "digest")
    later = F.col("first_doc_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first_doc_id")))
    return met.filter(F.col("again") | later).select("doc_id", "row", "start", "end", "digest", "first_doc_id")


def removal_report(docs: DataFrame) -> DataFrame:
    """A row per removed unit."""
    return repeated_units(docs).select("doc_id", "start", "end", F.lower(F.hex("digest")).alias("digest"), "first_doc_id")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans. A line end goes if nothing is left of its line."""
    kept, at = [], 0
    for start, end in sorted(spans):
        if end <= at:
            continue
        if start > at:
            kept.append(text[at:start])
        whole_line = (start == 0 or text[start - 1] == "\n") and (end == len(text) or text[end] == "\n")
        at = end + 1 if whole_line and end < len(text) else end
    return "".join(kept) + text[at:]


def drop_units(docs: DataFrame) -> DataFrame:
    """The documents without the removed units, and all other columns as they are."""
    gone = repeated_units(docs).groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    gone = gone.select(F.col("doc_id").alias("__unit_doc"), F.col("row").alias("__unit_row"), F.col("spans").alias("__unit_spans"))
    same = F.col("doc_id").eqNullSafe(F.col("__unit_doc")) & (row_key(F.col("text")) == F.col("__unit_row"))
    joined = docs.join(gone, same, "left").select(*docs.columns, "__unit_spans")
    place = docs.columns.index("text")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                text if spans is None else cut(text, [(s["start"], s["end"]) for s in spans])
                for text, spans in zip(batch.column(place).to_pylist(), batch.column(-1).to_pylist(), strict=True)
            ]
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    small_batches(docs.sparkSession)
    return joined.mapInArrow(task, docs.schema)
