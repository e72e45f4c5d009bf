"""Two-tier byte-level BPE against the library that it must equal, and the perfect hash by itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tripflow.llm import byte_bpe as b

from .helpers import SF_DIR, docs_of


@pytest.fixture(scope="module")
def vocabulary():
    return b.Vocabulary.read(public_tokenizers.path(b.RANKS))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids_of(encoder, text):
    return np.frombuffer(encoder.packed(text), "<u4").tolist()


@pytest.mark.parametrize("size", [0, 1, 2, 7, 5000])
def test_perfect_hash_is_minimal(size):
    keys = [f"key {n}".encode() for n in range(size)]
    slot_of = b.PerfectHash(keys)
    assert sorted(map(slot_of, keys)) == list(range(size))
    if size:
        assert all(0 <= slot_of(f"stranger {n}".encode()) < size for n in range(1000))


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError, match="twice"):
        b.PerfectHash([b"a", b"a"])


def test_first_tier_finds_every_token_and_no_other(vocabulary):
    for token, number in vocabulary.ranks.items():
        slot = vocabulary.slot_of(token)
        assert (vocabulary.token_at[slot], vocabulary.id_at[slot]) == (token, number)
    assert vocabulary.encode(b" zqxjkv") == vocabulary.merge(b" zqxjkv") and len(vocabulary.encode(b" zqxjkv")) > 1


def test_every_character_as_the_library(vocabulary, library):
    encoder = b.Encoder(vocabulary, public_tokenizers.PATTERN)
    for between in ("", "a", "1 "):
        for start in range(0, 0x110000, 64):
            text = between.join(chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
            assert ids_of(encoder, text) == library.encode_ordinary(text), hex(start)


def test_random_texts_as_the_library(vocabulary, library, monkeypatch):
    monkeypatch.setattr(b, "CACHED_CHUNKS", 50)
    monkeypatch.setattr(b, "SEGMENT", 40)
    encoder, draw = b.Encoder(vocabulary, public_tokenizers.PATTERN), random.Random(3)
    pool = [*"ab1'\"s \t\n\r\x0b\x1c\x1f\x85\xa0 é漢字🙂!?.,", "'re", " the", "ing", "  ", "\n\n"]
    for _ in range(4000):
        text = "".join(draw.choices(pool, k=draw.randrange(60)))
        assert ids_of(encoder, text) == library.encode_ordinary(text), text


def test_segments_join_to_the_text(monkeypatch):
    monkeypatch.setattr(b, "SEGMENT", 10)
    for text in ("", "a" * 50, "word " * 20, " " * 30 + "x", "one  two\n\nthree four five   "):
        assert "".join(b.segments(text)) == text


def test_long_runs(vocabulary, library):
    encoder = b.Encoder(vocabulary, public_tokenizers.PATTERN)
    for text in ("a" * 300_000, "ab" * 20_000 + " " * 50_000 + "z", "漢" * 5_000, "".join(random.Random(1).choices("etaoin", k=30_000))):
        assert vocabulary.decode(encoder.packed(text)) == text.encode()
        if len(text) <= 40_000:
            assert ids_of(encoder, text) == library.encode_ordinary(text)


def test_report_over_a_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in b.round_trip_report(docs).collect()}
    for doc in docs.collect():
        ids = library.encode_ordinary(doc["text"] or "")
        row = rows[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()
    assert len(rows) == docs.count()


def test_defined_results(spark):
    docs = docs_of(spark, [None, "", "same text", (2, "same text"), (None, "no id"), "<|endoftext|>"], extra=True).selectExpr("*", "'x' AS ids", "1 AS decoded")
    encoded = b.encode(docs)
    rows = [(r["doc_id"], bytes(r["decoded"]).decode()) for r in b.decode(encoded).collect()]
    assert sorted(rows, key=str) == sorted([(0, ""), (1, ""), (2, "same text"), (2, "same text"), (None, "no id"), (5, "<|endoftext|>")], key=str)
    assert {r["n_tokens"] for r in b.round_trip_report(docs).filter("doc_id < 2").collect()} == {0}
    assert b.round_trip_report(docs.filter("false")).count() == 0
    wrong = encoded.select("doc_id", F.lit(bytes([255] * 4)).alias("ids")).unionByName(encoded.select("doc_id", F.lit(b"abc").alias("ids")))
    assert {r["decoded"] for r in b.decode(wrong).collect()} == {None}


def test_memory_holds_packed_ids():
    """What is remembered is joined as it is: ids become integers once, when a pre-token is merged."""
    vocabulary = b.Vocabulary.read(public_tokenizers.path(b.RANKS))
    encoder = b.Encoder(vocabulary, public_tokenizers.PATTERN)
    text = "Straße, ellerean'll\n 12345 qzxwvkjq \u3000é"
    packed = encoder.packed(text)
    assert vocabulary.decode(packed) == text.encode()
    assert all(vocabulary.decode(ids) == chunk.encode() for chunk, ids in encoder.items())
