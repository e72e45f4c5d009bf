"""The chosen-path join against all pairs: copies, near copies around the threshold, hot groups, ties, nulls."""

import random

import numpy as np

from tripflow.llm import near_dedup
from tripflow.llm.components import connected_components
from tripflow.llm.common import words

from .helpers import docs_of


def set_of(text):
    found = [w.lower() for w in words(text)]
    return frozenset(zip(found, found[1:])) if len(found) > 1 else frozenset(found)  # noqa: B905


def by_hand(rows):
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted(str((doc, len(sets[k]), least.get(find(k)), doc == least.get(find(k)))) for k, (doc, _) in enumerate(rows))


def found(frame):
    return sorted(str(tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept"))) for r in near_dedup.near_report(frame).collect())


def edited(draw, base, times):
    out = list(base)
    for _ in range(times):
        out[draw.randrange(len(out))] = f"n{draw.random():.12f}"
    return " ".join(out)


def test_small_cases(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [
        (9, base), (3, base.upper()), (5, base + " tail"), (1, None), (2, ""), (4, " \n\t"), (6, "one"), (7, "ONE"), (8, "two"), (10, "a b"), (11, "b a"),
        (None, base), (None, None), (12, base), (12, base), (12, "quite another text here"), (-5, "a b a b a b"), (13, "a b\na"),
    ]
    assert found(docs_of(spark, rows, extra=True)) == by_hand(rows)
    assert near_dedup.near_report(docs_of(spark, rows).filter("false")).count() == 0
    kept = near_dedup.keep_first(docs_of(spark, rows, extra=True))
    assert kept.columns == docs_of(spark, rows, extra=True).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(x.split(",")[0][1:] for x in by_hand(rows) if x.endswith("True)"))


def test_groups_of_near_copies(spark):
    """One dense group of 150, chains of edits, and texts that share a hot line only."""
    draw = random.Random(7)
    vocabulary = [f"v{k}" for k in range(400)]
    base = draw.choices(vocabulary, k=130)
    texts = [edited(draw, base, draw.randrange(0, 16)) for _ in range(150)]
    for _ in range(12):
        step = draw.choices(vocabulary, k=90)
        for _ in range(5):
            texts.append(" ".join(step))
            step = edited(draw, step, 4).split()
    hot = " ".join(f"hot{k}" for k in range(14))
    texts += [hot + " " + " ".join(draw.choices(vocabulary, k=60)) for _ in range(250)]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    assert found(docs_of(spark, rows)) == by_hand(rows)


def test_clusters_of_many_blocks(spark, monkeypatch):
    """Groups whose members are near each other and mostly no links, with blocks far smaller than the groups."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    draw = random.Random(11)
    vocabulary = [f"v{k}" for k in range(600)]
    texts = []
    for low, high, size in ((12, 30, 120), (0, 12, 80), (4, 18, 60)):
        base = draw.choices(vocabulary, k=140)
        texts += [edited(draw, base, draw.randrange(low, high)) for _ in range(size)]
    rows = list(enumerate(texts)) + [(k, texts[k]) for k in range(0, 260, 9)] + [(None, texts[0])]
    draw.shuffle(rows)
    assert found(docs_of(spark, rows, extra=True)) == by_hand(rows)


def test_edges_of_a_hot_group_are_few(spark):
    """One group of near texts: its stars, which become components, are about as many as its members, whatever the nodes that it is in."""
    draw = random.Random(3)
    base = draw.choices([f"v{k}" for k in range(400)], k=130)
    docs = docs_of(spark, [edited(draw, base, draw.randrange(1, 6)) for _ in range(300)])
    classes = near_dedup.profiles(docs).withColumnRenamed("doc_id", "cls")
    scratch = near_dedup.Scratch(spark, "test-edges")
    edges = near_dedup.find_edges(classes, scratch)
    stars, pairs = edges.filter("equal = 0"), edges.filter("equal > 0")
    roots = {r["vertex"]: r["root"] for r in connected_components(stars.select("a", "b")).collect()}
    assert len(roots) == 300 and set(roots.values()) == {0}
    assert stars.count() <= 4 * 300 and pairs.count() <= 12 * 300
    assert pairs.filter("equal < 82").isEmpty()


def test_edges_of_a_group_of_many_blocks(spark, monkeypatch):
    """What tasks tell of one group grows with its members, not with their pairs of blocks; a group of near sets that are mostly no links is whole, too."""
    monkeypatch.setattr(near_dedup, "SKETCH_BLOCK", 16)

    class Counted(near_dedup.Scratch):
        told = 0

        def keep(self, rows, label):
            kept = super().keep(rows, label)
            self.told += kept.count() if label == "edges" else 0
            return kept

    draw, told = random.Random(3), []
    vocabulary = [f"v{k}" for k in range(400)]
    base = draw.choices(vocabulary, k=130)
    for size in (100, 400):
        docs = docs_of(spark, [edited(draw, base, draw.randrange(1, 6)) for _ in range(size)])
        scratch = Counted(spark, "test-told")
        near_dedup.find_edges(near_dedup.profiles(docs).withColumnRenamed("doc_id", "cls"), scratch)
        told.append(scratch.told)
    assert told[1] <= 6 * told[0] and told[1] <= 20 * 400
    texts = [edited(draw, base, draw.randrange(low, 22)) for low in (2, 14) for _ in range(90)]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    assert found(docs_of(spark, rows)) == by_hand(rows)


def test_wanted_rows(spark):
    """No wanted row is lost, and most of the others are left out."""
    rows = spark.range(40_000).selectExpr("id - 20000 AS a", "id * 7 AS b", "id")
    wanted = rows.filter("id % 10 = 3").select("a", "b")
    left = near_dedup.wanted_rows(rows, wanted, ["a", "b"])
    assert left.columns == rows.columns
    assert left.filter("id % 10 = 3").count() == 4000
    assert left.count() < 4000 + 0.1 * 36_000
    assert near_dedup.wanted_rows(rows, wanted.limit(0), ["a", "b"]).isEmpty()


def test_similar_by_products():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 120, draw.integers(1, 90)).astype(np.uint64)) for _ in range(40)]
    sets += [sets[0], np.array([5], np.uint64), np.arange(5000, 15_000, dtype=np.uint64), np.arange(5500, 15_500, dtype=np.uint64)]
    others = sets[::3]
    want = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    assert near_dedup.similar(sets).tolist() == [[want(a, b) for b in sets] for a in sets]
    assert near_dedup.similar(sets, others).tolist() == [[want(a, b) for b in others] for a in sets]


def test_other_texts_of_the_same_documents(spark):
    """Documents that are near copies by either text go with the smallest that is left."""
    one, two = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    docs = docs_of(spark, [(4, "left of one"), (7, "left of another"), (9, two), (11, two + " tail"), (12, ""), (13, None), (20, "alone"), (None, two)])
    whole = docs_of(spark, [(4, one), (7, one + " end"), (9, two), (11, "something else"), (12, one), (20, "quite alone here")])
    kept = near_dedup.keep_first(docs, whole.select("doc_id", "text"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["13", "20", "4", "9", "None"]


def test_nothing_is_left_behind(spark):
    from tripflow.session import hadoop_path, shared_folder

    path, store = hadoop_path(spark, shared_folder(spark))
    kept = lambda: {f.getPath().getName() for f in store.listStatus(path) if f.getPath().getName().startswith("near-")}
    before = kept()
    near_dedup.near_report(docs_of(spark, ["a b c", "a b c", "d"])).collect()
    assert kept() == before


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, 100 + k) for k in range(90)] + [(500, 501), (501, 500)]
    roots = {r["vertex"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {v: r for v, r in roots.items() if v <= 60} == dict.fromkeys(range(61), 0)
    assert {r for v, r in roots.items() if 100 <= v <= 200} == {100}
    assert roots[501] == 500
    path = random.Random(5).sample(range(700), 700)
    edges = [*zip(path, path[1:]), (900, 900)]  # noqa: B905
    roots = {r["vertex"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == dict.fromkeys(range(700), 0) | {900: 900}


def test_links_of_a_star_are_read_once(spark):
    """Rounds after the first read what is left of the links: two stars at the ends of a chain are long done when the chain is."""
    kept = []

    class Seen(near_dedup.Scratch):
        def keep(self, rows, label):
            table = super().keep(rows, label)
            kept.append((label, table.count()))
            return table

    edges = [(0, k) for k in range(1, 500)] + [(1000, k) for k in range(1001, 1500)] + [(499, 1200), (1300, 5000), (4000, 5000)]
    roots = connected_components(spark.createDataFrame(edges, "a long, b long"), Seen(spark, "test-links")).collect()
    assert {r["root"] for r in roots} == {0} and len(roots) == 1002
    assert sum(n for label, n in kept if label == "links") <= len(edges) + 10
    assert [label for label, _ in kept].count("links") > 1
