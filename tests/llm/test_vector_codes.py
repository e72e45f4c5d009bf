"""Equal-average search against all entries, and training against a plain loop."""

import hashlib
import math

import numpy as np
import pytest

from tripflow.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<float>, label int"


def plainly(rows, parts=4, entries=256, rounds=4):
    """Codes and errors of (vec_id, vector, label) rows by loops over Python integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(kept[0][1])
    kept = [(i, [math.floor(1024 * x) for x in vec], label) for i, vec, label in kept if len(vec) == size]
    at = [size * p // parts for p in range(parts + 1)]
    books = [[vec[at[p]:at[p + 1]] for _, vec, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, vec):
        part = vec[at[p]:at[p + 1]]
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p, book in enumerate(books):
            groups = {}
            for _, vec, _ in kept:
                groups.setdefault(nearest(p, vec)[1], []).append(vec[at[p]:at[p + 1]])
            moved.append([[sum(c) // len(c) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(book)])
        books = moved
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = [[nearest(p, vec) for p in range(parts)] for _, vec, _ in kept]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        of_label[label] = of_label.get(label, 0) + error
    return [
        (i, "".join(f"{k:02x}" for _, k in f), e, of_label[label], digest)
        for (i, _, label), f, e in zip(kept, found, errors, strict=True)
    ]


def coded(spark, rows):
    found = v.code_report(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS code", "1 AS error", "2 AS part", "3 AS same_label"))
    return sorted(map(tuple, found.collect()), key=str)


def single(rows):
    """The rows with components as a float column holds them."""
    return [(i, vec and [None if x is None else float(np.float32(x)) for x in vec], label) for i, vec, label in rows]


@pytest.mark.parametrize("scale", [3, 1000, 2**40])
def test_nearest_equals_all_entries(scale):
    draw = np.random.default_rng(5)
    entries = draw.integers(-scale, scale, (200, 6))
    entries[150:] = entries[:50]  # ties go to the lower index
    entries[20:30, :] = 0
    parts = np.concatenate([draw.integers(-scale, scale, (500, 6)), entries[::7], np.zeros((3, 6), np.int64)])
    which, distance = v.Codebook(entries).nearest(parts) if scale < 2**30 else v.Codebook(entries // 2**12).nearest(parts // 2**12)
    if scale >= 2**30:
        entries, parts = entries // 2**12, parts // 2**12
    for part, w, d in zip(parts.tolist(), which, distance, strict=True):
        everything = [sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)) for entry in entries.tolist()]
        assert (d, w) == (min(everything), everything.index(min(everything)))


def test_search_ends_early():
    """Entries whose sums are far are never compared."""
    entries = np.arange(0, 256_000, 1000)[:, None] * np.ones((1, 4), np.int64)
    book = v.Codebook(entries)
    book.entries = np.where(np.abs(np.arange(256) - 128)[:, None] > 2, 10**9, book.entries)  # would be noticed if seen
    which, distance = book.nearest(np.full((1, 4), 128_100))
    assert (which[0], distance[0]) == (128, 4 * 100**2)


def test_training_equals_plain_loops(spark):
    draw = np.random.default_rng(1)
    rows = [(int(n), draw.normal(0, 0.2, 8).tolist(), None if n % 5 == 0 else n % 3) for n in range(600)]
    rows += [(n, [0.25] * 8, 7) for n in range(600, 800)]  # one vector, many times
    rows = single(rows)
    assert coded(spark, rows) == sorted(plainly(rows), key=str)


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = single([
        (1, [0.5, -0.5, 0.25, 1.0], 1), (1, [0.5, -0.5, 0.25, 2.0], None), (None, [9.0, 9.0, 9.0, -9.0], None), (3, None, 1), (4, [], 1),
        (5, [1.0, None, 1.0, 1.0], 1), (6, [1.0, nan, 1.0, 1.0], 1), (7, [1.0, -inf, 1.0, 1.0], 1), (8, [1.0], 2), (2, [-0.0001] * 4, 2),
        (2, [-0.0001] * 4, 2),
    ])
    assert coded(spark, rows) == sorted(plainly(rows), key=str)
    assert coded(spark, rows[3:8]) == [] and coded(spark, rows[:0]) == []
    assert v.code_report(spark.createDataFrame(rows[3:8], SCHEMA)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_dimensions_without_equal_parts(spark):
    rows = single([(n, [n / 10, 1.0, -n / 7, 0.0, 0.5, n / 3], 0) for n in range(20)] + [(30, [1.0] * 4, 0)])
    assert coded(spark, rows) == sorted(plainly(rows), key=str)
    narrow = single([(n, [n / 10, 1.0], 0) for n in range(300)])
    assert coded(spark, narrow) == sorted(plainly(narrow), key=str)


def test_components_beyond_the_limit_are_cut(spark):
    rows = single([(n, [3e38 if n % 2 else -3e38, 1.0, 0.0, n / 5], 0) for n in range(10)])
    found = coded(spark, rows)
    assert len(found) == 10 and all(row[2] == 0 for row in found)
    assert v.decode("00010203", [np.full((4, 2), 5 + k) for k in range(4)]).tolist() == [5, 5, 6, 6, 7, 7, 8, 8]
