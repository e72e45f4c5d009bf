"""Archives round trip, quality features by hand and on labels, packing against the tokenizer and its bound."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyarrow import fs

from tripflow.llm import packing, quality_rules as q, warc

from .helpers import SF_DIR, docs_of

BIG = "<p>" + "same payload " * 20 + "</p>"
PAGES = [
    (5, "http://a/", BIG), (2, "http://b/x y\r\nZ: 1", BIG), (9, None, BIG), (None, "http://c/", BIG), (2, "http://b/", BIG), (3, "u", "tiny"), (4, "u", "tiny"),
    (7, "u", None), (8, "u", ""), (None, None, "é" * 60), (6, "http://é/", "ü\r\n\r\nWARC/1.1\r\n" * 20), (11, "u", "x" * 3_000_000),
]


def test_archive_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "1 AS first", "2 AS least")
    index = warc.write_bundles(pages, str(tmp_path))
    rows = warc.read_bundles(index).collect()
    digest = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    expected = []
    for page, _, html in PAGES:
        least = 2 if html == BIG else None
        revisit = least is not None and page != least
        expected.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response", least if revisit else None))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r[c] for c in columns)) for r in rows) == sorted(map(str, expected))
    texts = {(r["page_id"], bytes(r["payload"]).decode()) for r in rows if r["record_type"] == "response"}
    assert (11, "x" * 3_000_000) in texts and (7, "") in texts and (6, PAGES[10][2]) in texts
    # One record by the index, and whole files by plain decompression.
    entry = index.filter("page_id = 6").first().asDict()
    assert warc.read_record(entry)[6].decode() == PAGES[10][2]
    store, path = fs.FileSystem.from_uri(entry["bundle"])
    data = store.open_input_file(path).read()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert sum(1 for _ in warc.decode_records(whole)) == index.filter(index.bundle == entry["bundle"]).count()
    assert warc.archive_report(pages.filter("false")).count() == 0


def test_damaged_payload_is_found():
    record = warc.encode_record(1, None, b"abc", 3, hashlib.sha256(b"abd").hexdigest(), None)
    with pytest.raises(ValueError, match="differs"):
        list(warc.decode_records(record))


def by_hand(text):
    found = (text or "").encode().split()
    windows = Counter(zip(found, found[1:], found[2:]))  # noqa: B905
    covered = {k + j for k in range(len(found) - 2) for j in range(3) if windows[tuple(found[k : k + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    chars = sum(len(w.decode()) for w in found)
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    return len(found), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [None, "", " \n\n", "a b c " * 30, " ".join(f"w{k}" for k in range(60)), "é ü x " * 70, "x\ny\nx\n \n \nx", "## || <a> $5 " + "word " * 49, "a a a a", "w" * 100000]


def test_quality_features(spark):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (4, 1, 0), (0, None, None)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, [*TEXTS, (None, TEXTS[4]), (4, TEXTS[4])], extra=True)
    rows = q.quality_report(docs, labels).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(str((r["doc_id"], *(r[c] for c in columns))) for r in rows) == sorted(str((k, *by_hand(t))) for k, t in [*enumerate(TEXTS), (None, TEXTS[4]), (4, TEXTS[4])])
    assert all(r["kept"] == (not r["base_failed"] and r["log_ratio"] >= q.THRESHOLD) for r in rows)
    kept = q.quality_filter(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert q.quality_report(docs.filter("false"), labels).count() == 0
    assert q.quality_report(docs, labels.filter("false")).filter("abs(log_ratio) > 1e-9").count() == 0


def test_quality_agrees_with_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = q.quality_report(docs, labels).join(labels, "doc_id").filter("NOT base_failed").toPandas()
    assert rows.loc[rows["quality"] == 1, "kept"].mean() > 0.99
    assert rows.loc[rows["quality"] == 0, "kept"].mean() < 0.1


PACK = [None, "", "a", "word " * 3000, " two  spaces\r\n\ttab ", "<|endoftext|> special", "it's we'll 123 abc123 ---", "é😀 ñ x", "a\nb\n\nc", "\n", "x" * 5000]


def test_pieces_follow_the_tokenizer(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    docs = docs_of(spark, [*PACK, (None, "a"), (2, "a"), *((100 + k, "word " * (k % 37)) for k in range(300))], extra=True)
    rows = packing.pack(docs).collect()
    expected = []
    for r in docs.collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):  # noqa: B905
            expected.append((r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(str(tuple(r[c] for c in columns)) for r in rows) == sorted(map(str, expected))
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // 1024) + 1
    assert packing.pack(docs.filter("false")).count() == 0


def test_chunk_memory_changes_nothing(spark):
    encode = packing.ByteBpe()
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        assert encode(r["text"] or "") == encode.whole.encode(r["text"] or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["about 5 or 100\n~5 and ~100\n~100", "~5 first\nand 5 later ~5", "a ~~ b\n~~~ c\n~~~~ d\n~/path and /path", "x  y\n~x y"])
def test_chunks_after_a_space_are_not_first_chunks(text):
    encode = packing.ByteBpe()
    for each in (text, "\n".join(reversed(text.split("\n")))):
        assert encode(each) == encode.whole.encode(each, add_special_tokens=False).ids


def test_a_text_is_encoded_at_once():
    """Words that occur once cost most when they are encoded one by one."""
    encode, calls = packing.ByteBpe(), []
    plain = encode.plain
    encode.plain = lambda text: calls.append(text) or plain(text)
    text = "\n".join(f"once{k} twice{k} é{k}" for k in range(300)) + " \t end\u3000"
    assert encode(text) == encode.whole.encode(text, add_special_tokens=False).ids
    assert calls == [text]


def test_fullest_bin_is_best_by_search():
    draw = np.random.default_rng(3)
    for _ in range(200):
        counts = np.zeros(41, np.int64)
        for length in draw.integers(1, 41, 8):
            counts[length] += 1
        chosen = packing.fullest(counts, 40)
        pieces = [k for k in range(41) for _ in range(counts[k])]
        longest, rest = pieces[-1], pieces[:-1]
        sums = {longest}
        for x in rest:
            sums |= {s + x for s in sums if s + x <= 40}
        assert sum(chosen) == max(sums) and not (Counter(chosen) - Counter(pieces))
