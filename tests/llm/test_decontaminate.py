"""Suffix arrays against a scan of all windows."""

import hashlib
import random

import numpy as np

from tripflow.llm import decontaminate as d

from .helpers import docs_of


def by_hand(text, items):
    found = d.bench_words(text)
    hit, names = set(), set()
    for name, body in items:
        mine = d.bench_words(body)
        size = min(13, len(mine))
        windows = {tuple(mine[k : k + size]) for k in range(len(mine) - size + 1)} if mine else set()
        for k in range(len(found) - size + 1):
            if tuple(found[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                names.add(None if name is None else str(name))
    names.discard(None)
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(found), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(found)


def longest(text, items):
    found = d.bench_words(text)
    best = 0
    for _, body in items:
        mine = d.bench_words(body)
        size = min(13, len(mine))
        for a in range(len(found)):
            for b in range(len(mine)):
                n = 0
                while a + n < len(found) and b + n < len(mine) and found[a + n] == mine[b + n]:
                    n += 1
                if n >= size > 0:
                    best = max(best, n)
    return best


ITEMS = [
    (3, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (10, "short item"), (2, "É-café x_y z9"),
    (None, "nameless words of an item without any id to be listed under at all"), (7, None), (8, " ... "), (3, "short item"), (11, "la la la la la la la la la la la la la la la la"),
]
TEXTS = [
    None, "", "...", "a short, ITEM!", "one two three four five six seven eight nine ten eleven twelve", "x " * 400 + "short item",
    "zero " + ITEMS[0][1] + " sixteen", "one two three four five six seven eight nine ten eleven twelve THIRTEEN one two three four five six seven",
    "la " * 40, "É café X y Z9", "é café x y z9", ITEMS[3][1] + " tail", "short\nitem short item item short",
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen",
]


def test_cases(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = d.contamination_report(docs_of(spark, TEXTS, extra=True), items).collect()
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in rows} == {k: by_hand(t, ITEMS) for k, t in enumerate(TEXTS)}
    assert {r["doc_id"]: r["longest_match"] for r in rows} == {k: longest(t, ITEMS) for k, t in enumerate(TEXTS)}
    clean = d.drop_contaminated(docs_of(spark, TEXTS, extra=True), items)
    assert sorted(r["doc_id"] for r in clean.collect()) == [k for k, t in enumerate(TEXTS) if not by_hand(t, ITEMS)[-1]]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not d.contamination_report(docs_of(spark, TEXTS), none).filter("contaminated OR n_hit > 0").count()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.contamination_report(docs_of(spark, TEXTS).filter("false"), items).count() == 0


def test_random_shards():
    draw = random.Random(1)
    words = list("abcd")
    items = [(k, " ".join(draw.choices(words, k=draw.randrange(1, 30)))) for k in range(20)]
    texts = [" ".join(draw.choices([*words, "zz"], weights=[9, 9, 9, 9, 1], k=draw.randrange(0, 200))) for _ in range(30)]
    texts += [items[k][1] + " " + items[k + 1][1] for k in range(15)]
    rows = d.judge_shard(texts, d.Items.of(items))
    assert [r[:5] for r in rows] == [by_hand(t, items) for t in texts]
    assert [r[5] for r in rows] == [longest(t, items) for t in texts]


def test_suffix_array():
    draw = np.random.default_rng(0)
    symbols = draw.integers(0, 3, 300)
    order = d.suffix_array(symbols, 1 << 20)
    assert list(order) == sorted(range(300), key=lambda k: list(symbols[k:]))


def test_a_larger_benchmark_is_refused(spark, monkeypatch):
    monkeypatch.setattr(d, "BENCHMARK_CHARS", 10)
    try:
        d.load_items(spark.createDataFrame(ITEMS, "item_id long, text string"))
    except ValueError as error:
        assert "characters" in str(error)
    else:
        raise AssertionError("accepted")
