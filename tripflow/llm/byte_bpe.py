"""Byte-level BPE encoding and decoding by two tiers.

A pre-token that is a token as a whole is found by a minimal perfect hash: a key's bucket has a displacement, which sends each of the bucket's
keys to a slot of its own, and there are as many slots as keys. The slot's token is compared with the pre-token, as strangers land in some slot
too. All other pre-tokens are merged: their bytes are a linked list, the ranks of neighbouring pairs wait in a heap, and the lowest rank is
merged first, the leftmost of equals.

The table is built once by the driver from a rank file, whose size is that of the vocabulary, and travels with the tasks. Encoding and
decoding are map-only. Token ids are stored packed, as little-endian unsigned 32-bit integers.

No pre-token goes on over white space, so a text is taken chunk by chunk (white space, then other characters), and a worker remembers the short
ones of late, up to twice ``CACHED_CHUNKS``. Long texts are encoded in segments of whole chunks.

Defined results: a null or empty text has no tokens and decodes to nothing. Repeated rows and null doc_ids give rows of their own. Ids that
the vocabulary lacks, or bytes that are no whole ids, decode to null. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate, product
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Keys of a bucket of the perfect hash, on average.
BUCKET_KEYS = 2
#: Half of a worker's memory: chunks, and characters of the longest that is remembered.
CACHED_CHUNKS, CACHED_CHARS = 300_000, 48
#: Characters of a text, or ids, that are worked on at a time.
SEGMENT = 1_000_000
#: The characters of the Unicode property White_Space, which the pattern's white space means.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters and numbers that Unicode has had since version 17 only. The other library knows version 16 and takes them for neither.
NEWER = (
    "\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)

_NEWER = re.compile(f"[{NEWER}]")
_CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
_BORDER = re.compile(f"(?<=[^{WHITE_SPACE}])(?=[{WHITE_SPACE}])")
_ODD = 0x9E3779B97F4A7C15
_LOW = (1 << 64) - 1


class PerfectHash:
    """Sends each of n keys to its own slot below n; any other key to some slot."""

    def __init__(self, keys: list[bytes]) -> None:
        self.size = len(keys)
        self.buckets = self.size // BUCKET_KEYS + 1
        for self.seed in range(8):  # another seed only if two keys share all 64 bits
            hashes = np.array([xxhash.xxh3_64_intdigest(key, self.seed) for key in keys], np.uint64)
            if len(np.unique(hashes)) == self.size:
                break
        else:
            raise ValueError("a key occurs twice")
        self.moves = array("q", self._moves(hashes))

    def _moves(self, hashes: np.ndarray) -> list[int]:
        """A displacement for each bucket, largest buckets first. What is below zero names the slot of a lone key."""
        moves, free = np.zeros(self.buckets, np.int64), np.ones(self.size, bool)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        hashes, bucket = hashes[np.argsort(bucket, kind="stable")], np.sort(bucket)
        sizes = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(sizes) - sizes
        for size in range(int(sizes.max(initial=0)), 1, -1):
            open_ = np.flatnonzero(sizes == size)
            move = 0
            while len(open_):
                move += 1
                slots = self._slots(hashes[first[open_][:, None] + np.arange(size)], move)
                apart = (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1) & free[slots].all(axis=1)
                slots, fits = slots[apart], np.flatnonzero(apart)
                # Of buckets that want the same slot with this displacement the first gets it.
                wanted, earliest = np.unique(slots, return_index=True)
                won = (earliest[np.searchsorted(wanted, slots)] // size == np.arange(len(fits))[:, None]).all(axis=1)
                moves[open_[fits[won]]] = move
                free[slots[won].ravel()] = False
                open_ = np.delete(open_, fits[won])
        lone = np.flatnonzero(sizes == 1)
        moves[lone] = -np.flatnonzero(free) - 1
        return moves.tolist()

    def _slots(self, hashes: np.ndarray, move: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (hashes ^ np.uint64(move * _ODD & _LOW)) * np.uint64(_ODD)
        return ((mixed >> np.uint64(32)) % np.uint64(self.size)).astype(np.int64)

    def __call__(self, key: bytes) -> int:
        number = xxhash.xxh3_64_intdigest(key, self.seed)
        move = self.moves[number % self.buckets]
        return -move - 1 if move < 0 else (((number ^ (move * _ODD & _LOW)) * _ODD & _LOW) >> 32) % self.size


class Vocabulary:
    """The tokens of a rank file, found by bytes and by id. It must hold every single byte."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.digest = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
        self.byte_ids = [ranks[bytes([byte])] for byte in range(256)]
        self.of_two = [ranks.get(bytes(two), -1) for two in product(range(256), repeat=2)]  # by the two bytes as one number
        self.slot_of = PerfectHash(list(ranks))
        self.token_at, self.id_at = [b""] * len(ranks), array("q", bytes(8 * len(ranks)))
        for token, number in ranks.items():
            slot = self.slot_of(token)
            self.token_at[slot], self.id_at[slot] = token, number
        self.bytes_of = {number: token for token, number in ranks.items()}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)})

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: the first tier, then the second."""
        slot = self.slot_of(piece)
        return (self.id_at[slot],) if self.token_at[slot] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        find, of_two, size = self.ranks.get, self.of_two, len(piece)
        ids: list[int] = list(map(self.byte_ids.__getitem__, piece))  # by the place where a part begins; -1 within parts
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        # Rank of a part and the next, if they make a token.
        pairs = [of_two[first << 8 | second] for first, second in zip(piece, piece[1:], strict=False)]
        pairs.append(-1)
        # A waiting pair is one number, its rank and then its place, so that the leftmost of equal ranks comes first.
        waiting = [rank * size + at for at, rank in enumerate(pairs) if rank >= 0]
        heapify(waiting)
        while waiting:
            pair = heappop(waiting)
            rank = pair // size
            at = pair - rank * size
            if pairs[at] != rank:  # one of the two has been merged since
                continue
            middle = after[at]
            end = after[at] = after[middle]
            ids[at] = rank
            ids[middle] = pairs[middle] = -1
            if end < size:
                before[end] = at
                pairs[at] = found = find(piece[at : after[end]], -1)
                if found >= 0:
                    heappush(waiting, found * size + at)
            else:
                pairs[at] = -1
            if at:
                start = before[at]
                pairs[start] = found = find(piece[start:end], -1)
                if found >= 0:
                    heappush(waiting, found * size + start)
        return tuple([number for number in ids if number >= 0])

    def decode(self, packed: bytes) -> bytes | None:
        try:
            ids = np.frombuffer(packed, "<u4")
            parts = (ids[k : k + SEGMENT].tolist() for k in range(0, len(ids), SEGMENT))
            return b"".join(b"".join(map(self.bytes_of.__getitem__, part)) for part in parts)
        except (KeyError, ValueError):
            return None


class Encoder(dict):
    """Encodes texts; as a dictionary it is the memory of chunks' and pre-tokens' packed ids, and ``older`` the one that it filled before."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        import regex

        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}
        spelled = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]")
        self.findall = regex.compile(spelled).findall

    def pieces(self, chunk: str) -> list[str]:
        if chunk.isascii():
            return self.findall(chunk)
        known = _NEWER.sub("\ue000", chunk)  # a character for private use is neither letter, number nor space
        found = self.findall(known)
        if known == chunk:
            return found
        ends = list(accumulate(map(len, found)))
        return [chunk[begin:end] for begin, end in zip([0, *ends], ends, strict=False)]

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            pieces = self.pieces(chunk)
            if len(pieces) == 1:
                numbers = self.vocabulary.encode(chunk.encode())
                ids = pack(f"<{len(numbers)}I", *numbers)
            else:
                ids = b"".join(map(self.__getitem__, pieces))
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHED_CHUNKS:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def packed(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, _CHUNK.findall(part))) for part in segments(text))


_worker: dict[tuple[str, str], Encoder] = {}


def worker_encoder(vocabulary: Vocabulary, pattern: str) -> Encoder:
    """The encoder of this Python worker: its memory outlives a task. A worker keeps one."""
    key = (vocabulary.digest, pattern)
    if key not in _worker:
        _worker.clear()
        _worker[key] = Encoder(vocabulary, pattern)
    return _worker[key]


def segments(text: str) -> Iterator[str]:
    """Whole chunks of at least ``SEGMENT`` characters in all, but for the last."""
    begin = 0
    while len(text) - begin > SEGMENT and (border := _BORDER.search(text, begin + SEGMENT)):
        yield text[begin : border.start()]
        begin = border.start()
    yield text[begin:] if begin else text


def encode(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """(doc_id, ids): every text's packed token ids, by the rank file at ``path``, which the driver reads."""
    table = vocabulary or Vocabulary.read(path or public_tokenizers.path(RANKS))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(table, pattern)
        for batch in batches:
            ids = [encoder.packed(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return arrow_map(docs.select("doc_id", "text"), task, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids' tokens, end to end."""
    table = vocabulary or Vocabulary.read(path or public_tokenizers.path(RANKS))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            decoded = [None if packed is None else table.decode(packed) for packed in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    return arrow_map(encoded.select("doc_id", "ids"), task, "doc_id long, ids binary, decoded binary")


def round_trip_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of the ids and of what they decode to."""
    table = Vocabulary.read(path or public_tokenizers.path(RANKS))
    both = decode(encode(docs, vocabulary=table), vocabulary=table)
    return both.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
