"""Quality rules: a hashed n-gram log-likelihood ratio between a trusted and the raw corpus.

Two multinomials over ``BUCKETS`` hash buckets of unigrams and bigrams are counted: one over the trusted documents, one over
every document. A document's verdict is its mean log ratio per n-gram against a fixed threshold, so equal texts always get
equal verdicts, at every size of the corpus.

Defined results: a null or empty text has no words and fails the base rules. A null doc_id is carried through. Repeated rows are
counted and judged one by one. Without any trusted document the ratio is 0 for every text and only the base rules decide. An empty
table gives an empty result. Extra columns are ignored by ``quality_report`` and kept by ``quality_filter``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch_of, mix, small_batches, words

BUCKETS = 1 << 16
#: The trusted model learns from at most this many trusted documents: those whose ids have the smallest hashes.
TRUSTED_ROWS = 50_000
#: Mean log ratio per n-gram, in nats, below which a text counts as unlike the trusted ones.
THRESHOLD = -0.25
SYMBOLS = "#*$%&|<>"
#: A task's memory of words that it has hashed.
CACHED_WORDS = 200_000

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20]+")
FEATURES = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("log_ratio", pa.float64()), ("kept", pa.bool_()),
])
FEATURES_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, log_ratio double, kept boolean"
)


class Grams:
    """Bucket numbers of a text's unigrams and bigrams. Case and punctuation runs stay: they tell prose from noise."""

    def __init__(self) -> None:
        self.hashes: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall(text.encode("utf-8", "surrogatepass")) if text else []
        known = self.hashes
        if len(known) > CACHED_WORDS:
            known.clear()
        for token in set(tokens):
            if token not in known:
                known[token] = zlib.crc32(token)
        hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        ones = mix(hashes)
        with np.errstate(over="ignore"):
            twos = mix(ones[:-1] * np.uint64(0x9E3779B97F4A7C15) + ones[1:])
        return (np.concatenate([ones, twos]) >> np.uint64(48)).astype(np.int64)


def _count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, counts = Grams(), np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, trusted in zip(batch.column("text").to_pylist(), batch.column("trusted").to_pylist(), strict=True):
            found = grams(text)
            np.add.at(counts[0], found, 1)
            if trusted:
                np.add.at(counts[1], found, 1)
    seen = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_pydict({"bucket": seen, "raw": counts[0][seen], "target": counts[1][seen]})


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_ROWS) -> DataFrame:
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """One log ratio per bucket. What comes back to the driver is ``BUCKETS`` rows, whatever the corpus."""
    small_batches(docs.sparkSession)
    marked = docs.select("doc_id", "text").join(
        F.broadcast(trusted_ids(labels).withColumn("trusted", F.lit(True))), "doc_id", "left"
    )
    counted = arrow_map(marked.select("text", "trusted"), _count_task, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    p_raw = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    p_target = (target + BUCKETS * p_raw) / (target.sum() + BUCKETS)  # a bucket without evidence has ratio 0
    return np.log(p_target / p_raw)


def repeat_words(found: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    windows = list(zip(found, found[1:], found[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = np.zeros(len(found), bool)
    at = np.array([k for k, w in enumerate(windows) if counts[w] > 1])
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def features(text: str | None, grams: Grams, ratios: np.ndarray, threshold: float) -> tuple:
    text = text or ""
    found = words(text)
    n = len(found)
    repeated = repeat_words(found)
    failed = n < 50 or 100 * repeated > 50 * n
    at = grams(text)
    ratio = float(ratios[at].mean()) if len(at) else 0.0
    return (
        n, len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), sum(map(text.count, SYMBOLS)), dup_lines(text), repeated,
        failed, ratio, not failed and ratio >= threshold,
    )


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row of features and the verdict for every document."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, table = Grams(), ratios.value
        for batch in batches:
            rows = [features(text, grams, table, threshold) for text in batch.column("text").to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield batch_of(FEATURES, doc_id=batch.column("doc_id"), **dict(zip(FEATURES.names[1:], columns, strict=True)))

    return arrow_map(docs.select("doc_id", "text"), task, FEATURES_DDL)


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels))
    place = docs.columns.index("text")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, table = Grams(), ratios.value
        for batch in batches:
            kept = [features(text, grams, table, threshold)[-1] for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(task, docs.schema)
