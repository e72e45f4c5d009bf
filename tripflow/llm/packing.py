"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens; a piece's length is all that packing needs. Lengths are few (``capacity`` of them), so
the corpus is reduced to a histogram and the driver plans bins over lengths: for each bin, a subset-sum over the available lengths,
kept as bit sets, finds the fullest feasible combination, which is then removed. A combination is used as often as its lengths last, so the
plan has at most ``capacity`` combinations whatever the corpus. Pieces are numbered within their length, and their number says which
bin they are in.

Numbering is spread: a length that a third of all pieces share is numbered in ``BLOCKS`` blocks of its own.

Defined results: a null or empty text is one piece with the end token only. Repeated rows and null doc_ids give pieces of their own.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, batch_of, write_aside

CAPACITY = 1024
END_TOKEN = 2
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Blocks in which the pieces of one length are numbered.
BLOCKS = 256

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ByteBpe:
    """Ids of the byte-level vocabulary, as its JSON file defines them.

    Texts with a special token go to the tokenizer of that file, all others to an equal vocabulary. Remembering what was encoded costs more than encoding
    it again, as much of a corpus occurs once.
    """

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        with open(public_tokenizers.path(ranks), "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.plain = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        ).encode_ordinary
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> list[int]:
        if any(map(text.__contains__, self.special)):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.plain(text)


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start and ids of a document's pieces: full ones from the end, what is left over first."""
    first = (len(ids) - 1) % capacity + 1
    begin = 0
    for end in range(first, len(ids) + 1, capacity):
        yield begin, ids[begin:end]
        begin = end


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, encoder: Callable[[], Callable[[str], list[int]]] = ByteBpe) -> DataFrame:
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.fromiter(chain(encode(text or ""), (END_TOKEN,)), "<u4")
                for number, (start, piece) in enumerate(cut(ids, capacity)):
                    rows.append((doc_id, number, start, len(piece), zlib.crc32(piece.tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * len(PIECES)
            yield batch_of(PIECES, **dict(zip(PIECES.names, columns, strict=True)))

    return arrow_map(docs.select("doc_id", "text"), task, PIECES_DDL)


def fullest(counts: np.ndarray, capacity: int) -> list[int]:
    """The available lengths, largest first, that fill one bin best: a 0/1 subset-sum over bit sets, a length offered as often as it fits.

    The longest available piece is always part of the bin: it is the hardest to place later.
    """
    lengths = [int(x) for x in np.flatnonzero(counts)[::-1]]
    longest = lengths[0]
    room = capacity - longest
    reach, steps = 1, []  # bit s of reach: some chosen subset has sum s
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        spare = int(counts[length]) - (length == longest)
        for _ in range(min(spare, room // length)):
            grown = reach | (reach << length & mask)
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = [longest]
    for length, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return sorted(chosen, reverse=True)


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, bins filled this way), until no piece is left."""
    left, plan = counts.astype(np.int64).copy(), []
    while left.any():
        chosen = fullest(left, capacity)
        used = np.bincount(chosen, minlength=len(left))
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        plan.append((chosen, times))
    return plan


def slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, numbers, per bin, first bin, offset of the first one) for each length of each combination.

    Equal lengths of a bin lie side by side, so number n of a slot is in bin ``n // per bin`` at ``offset + n % per bin * length``.
    """
    given: dict[int, int] = {}
    rows, bins = [], 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            many = chosen.count(length)
            start = given.get(length, 0)
            rows.append((length, start, many * times, many, bins, offset))
            given[length] = start + many * times
            offset += many * length
        bins += times
    return rows


def _place(batches: Iterable[pa.RecordBatch], table: object, names: list[str]) -> Iterator[pa.RecordBatch]:
    rows: np.ndarray = table.value
    keys = rows[:, 0] << 48 | rows[:, 1]
    for batch in batches:
        length = batch.column("length").to_numpy()
        number = batch.column("number").to_numpy()
        row = rows[np.searchsorted(keys, length << 48 | number, side="right") - 1]
        within = number - row[:, 1]
        columns = {
            "sequence_id": row[:, 4] + within // row[:, 3], "offset": row[:, 5] + within % row[:, 3] * length,
        }
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[n]) if n in columns else batch.column(n) for n in names], names=names
        )


def pack(docs: DataFrame, capacity: int = CAPACITY, encoder: Callable[[], Callable[[str], list[int]]] = ByteBpe) -> DataFrame:
    """A row per piece with its sequence and its place there."""
    spark = docs.sparkSession
    cuts = pieces_of(docs, capacity, encoder).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "ids_crc32", "start"), F.lit(BLOCKS)).cast("int")
    )
    cuts = write_aside(cuts, "pieces")  # texts are encoded once
    counts = cuts.groupBy("length", "block").count()
    rows = counts.orderBy("length", "block").collect()  # capacity * BLOCKS rows at most
    histogram = np.zeros(capacity + 1, np.int64)
    first = []
    for row in rows:
        first.append((row["length"], row["block"], int(histogram[row["length"]])))
        histogram[row["length"]] += row["count"]
    table = np.array(sorted(slots(plan_bins(histogram, capacity))), np.int64).reshape(-1, 6)
    starts = spark.createDataFrame(first or [(0, 0, 0)], "length long, block int, first long")

    order = W.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")
    numbered = (
        cuts.withColumn("rank", F.row_number().over(order) - 1)
        .join(F.broadcast(starts), ["length", "block"])
        .withColumn("number", F.col("first") + F.col("rank"))
        .select(*PIECES.names, "number")
    )
    names = [*PIECES.names, "sequence_id", "offset"]
    placed = partial(_place, table=spark.sparkContext.broadcast(table), names=names)
    return numbered.mapInArrow(placed, f"{PIECES_DDL}, sequence_id long, offset long")
