"""Language-model scores: the log probability of every whole document under a gated recurrent model trained on the corpus.

Words are counted over all training documents, in a table that grows with them. The ``HEAD_WORDS`` most frequent words go to every task; all
others are one class of the output softmax, and a word's share within this class comes from the table by a join. The network learns from
all training documents in ``ROUNDS`` rounds: in each, every task trains on its share of the round's documents from the weights it was given, by
truncated backpropagation, and the results are averaged, weighted by tokens. Scoring runs through each document from its first word
to its end token with the state carried from window to window.

A score is a proper log probability: classes, words within classes, and one unknown word in the last class sum to one. Before training it
equals the smoothed unigram score.

Defined results: a null or empty text is the end token alone. A document without doc_id counts as one whose id is the empty text, so it is used
for training. Repeated rows are counted and scored one by one. Without training documents all words are unknown. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import recurrent
from .common import arrow_map, batch_of, small_batches, write_aside
from .recurrent import END, Trainer, Vocabulary

HEAD_WORDS = 1 << 17
#: Longer words are never head words, so that the head has a proven size.
HEAD_WORD_BYTES = 64
#: Shares of the training documents in each round of training and averaging, in percent.
ROUNDS = (10, 30, 60)
#: Documents that a task trains on or scores together, by their tokens: enough that no lane is left alone with a long document for long.
CHUNK_TOKENS = 3_000_000
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 500_000
#: Weights that travel as one row.
BLOCK = 1024

SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("head_base", pa.float64()),
    ("head_score", pa.float64()), ("rest", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
])
SCORED_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, head_base double, head_score double, "
    "rest array<struct<word: binary, n: bigint>>"
)


def tokens_of(text: str | None) -> list[bytes]:
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII white space only
    found.append(END)
    return found


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _round_of(doc_id: Column) -> Column:
    share = F.pmod(F.xxhash64(doc_id, F.lit("round")), F.lit(100))
    edges = np.cumsum(ROUNDS)
    return sum(((share >= int(edge)).cast("int") for edge in edges[:-1]), F.lit(0))


def _count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )
        counts.clear()
        return batch

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(tokens_of(text)[:-1])
        counts[END] += batch.num_rows
        if len(counts) > COUNTED_WORDS:
            yield flush()
    if counts:
        yield flush()


def count_words(training: DataFrame) -> DataFrame:
    """(word, n) of the training documents, as a written table."""
    return write_aside(arrow_map(training.select("text"), _count_task, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def head_of(counts: DataFrame, limit: int = HEAD_WORDS) -> Vocabulary:
    """The vocabulary that every task gets: ``limit`` words of HEAD_WORD_BYTES at most, and the size of the rest.

    Words are cut off between classes of similar counts, so that no sorted prefixes of all partitions meet in the driver: it gets a row for
    each class, about a thousand at most, and then the head alone.
    """
    total = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    short = counts.filter(F.octet_length("word") <= HEAD_WORD_BYTES).withColumn("class", F.floor(F.log2("n") * 16))
    classes = sorted(short.groupBy("class").count().collect(), key=lambda r: -r["class"])
    inside = [r["class"] for r, size in zip(classes, accumulate(r["count"] for r in classes), strict=True) if size <= limit]
    head = short.filter(F.col("class") >= F.lit(inside[-1] if inside else 1 << 20)).select("word", "n").toArrow()
    top = sorted(zip(head["n"].to_pylist(), head["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    numbers = np.array([n for n, _ in top], np.float64)
    return Vocabulary([w for _, w in top], numbers, int((total["tokens"] or 0) - numbers.sum()), total["words"] - len(top))


def _chunks(
    batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, with_rest: bool
) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray], list[Counter]]]:
    """Batches, the numbers of their documents' words, and the words that have none. The texts themselves are let go at once."""
    number, rest = vocabulary.number, vocabulary.rest
    held, documents, others, size = [], [], [], 0
    for batch in batches:
        held.append(batch.drop_columns(["text"]))
        for text in batch.column("text").to_pylist():
            found = tokens_of(text)
            numbers = np.fromiter(map(number.get, found, repeat(rest)), np.int32, len(found))
            documents.append(numbers)
            if with_rest:
                others.append(Counter(map(found.__getitem__, np.flatnonzero(numbers == rest).tolist())))
            size += len(found)
        if size >= CHUNK_TOKENS:
            yield held, documents, others
            held, documents, others, size = [], [], [], 0
    if documents:
        yield held, documents, others


def train(training: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after all rounds. Blocks of weights are averaged by tasks; the driver gets one model's weights, whatever the corpus."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    weights = recurrent.initial(vocabulary)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for number in range(len(ROUNDS)):
        start = spark.sparkContext.broadcast(weights)

        def learn(batches: Iterable[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(start.value, shared.value)
            for _, documents, _ in _chunks(batches, shared.value, with_rest=False):
                trainer.learn(documents)
            if trainer.tokens:
                flat = recurrent.flatten(trainer.p)
                blocks = [flat[k : k + BLOCK] for k in range(0, len(flat), BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(blocks)), pa.int32()), pa.array([trainer.tokens] * len(blocks), pa.int64()), pa.array([b.tobytes() for b in blocks], pa.binary())],
                    names=["block", "tokens", "weights"],
                )

        def average(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            tokens: Counter[int] = Counter()
            for batch in batches:
                for block, n, data in zip(*(batch.column(c).to_pylist() for c in ("block", "tokens", "weights")), strict=True):
                    part = np.frombuffer(data, np.float32).astype(np.float64) * n
                    sums[block] = sums[block] + part if block in sums else part
                    tokens[block] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([(sums[b] / tokens[b]).astype(np.float32).tobytes() for b in sums], pa.binary())],
                names=["block", "weights"],
            )

        learned = arrow_map(training.filter(_round_of(F.col("doc_id")) == number).select("text"), learn, "block int, tokens long, weights binary")
        averaged = learned.repartition(parts, "block").mapInArrow(average, "block int, weights binary")
        rows = sorted(averaged.collect(), key=lambda r: r["block"])
        if rows:
            flat = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in rows])
            weights = recurrent.unflatten(flat, weights)
    return weights


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = marked.filter("NOT held_out")
    counts = count_words(training)
    vocabulary = head_of(counts)
    weights = spark.sparkContext.broadcast(train(training, vocabulary))
    shared = spark.sparkContext.broadcast(vocabulary)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        base = np.append(np.log10(v.counts + 0.5), 0.0)
        for held, numbers, rest in _chunks(batches, v, with_rest=True):
            scores = recurrent.score(weights.value, v, numbers) / np.log(10)
            yield batch_of(
                SCORED, doc_id=[i for b in held for i in b.column("doc_id").to_pylist()],
                held_out=[i for b in held for i in b.column("held_out").to_pylist()], n_tokens=[len(x) for x in numbers],
                n_known=[int((x != v.rest).sum()) for x in numbers], head_base=[float(base[x].sum()) for x in numbers],
                head_score=scores, rest=[[{"word": w, "n": n} for w, n in r.items()] for r in rest],
            )

    scored = arrow_map(marked, task, SCORED_DDL).withColumn("id", F.monotonically_increasing_id())
    scored = write_aside(scored, "scored")  # documents are scored once
    rest = scored.select("id", F.explode("rest").alias("rest")).select("id", "rest.word", "rest.n")
    known = rest.join(counts.withColumnRenamed("n", "c"), "word", "left")
    sums = known.groupBy("id").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rest_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rest_known"),
    )
    tokens = int(vocabulary.counts.sum()) + vocabulary.rest_tokens
    space = float(np.log10(tokens + 0.5 * (len(vocabulary.words) + vocabulary.rest_words + 1)))
    rest_tokens = F.aggregate("rest", F.lit(0).cast("long"), lambda s, r: s + r["n"])
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    return scored.withColumn("rest_tokens", rest_tokens).drop("rest").join(sums, "id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("head_base") + rest_log - F.col("n_tokens") * space).alias("base_score"),
        (F.col("head_score") + rest_log - F.col("rest_tokens") * float(np.log10(vocabulary.rest_mass))).alias("score"),
    )
