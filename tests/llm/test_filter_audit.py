"""The filter audit against filters that are really applied, order by order."""

from itertools import permutations

import pytest

from tripflow.llm import filter_audit as f

from .helpers import DOCS, SF_DIR

LABELS = "doc_id long, quality int, toxic int"


def fails_of(docs):
    """Letters that each (doc_id, text, lang) row fails, from the rules as stated."""
    found = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = text.encode().split()
        letters = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        letters += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
        same = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs)
        found.append(letters + "E" * same)
    return found


def applied(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = {}
    everything = list(zip(docs, fails_of(docs), strict=True))
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], letters) for d, letters in everything if (d[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, letter in enumerate(order, 1):
                removed = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                total[letter] += len(removed)
                rows[part, "".join(order), step] = [
                    len(left), len(removed), sum(letter in d[1] for d in gone), sum(d[1] == letter for d in own),
                    sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed), letter,
                ]
                gone = gone + removed
        for (p, _, _), row in rows.items():
            if p == part:
                row[-1] = total[row[-1]]
    return sorted((*key, *row) for key, row in rows.items())


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in docs], DOCS)
    for name in ("part", "hash", "bits", "rows", "first_id", "combos", "place", "own", "before", "letter", "is_good"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    told = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' AS text", "'y' AS part")
    return sorted(map(tuple, f.audit_report(frame, told).collect()))


LONG = " ".join(f"word{n}" for n in range(250))
DOCUMENTS = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (4, LONG + " #", "en"), (5, "SHOUT " * 300, "en"), (6, "SHOUT " * 300, None),
    (7, None, "en"), (8, "", "de"), (9, "", None), (None, LONG, "en"), (None, LONG, "en"), (None, None, None), (10, "a | b", ""), (2, "other", "en"),
    (11, "\x0b \n\t", "en"), (12, "é " * 400, "de"), (13, "Big " * 200 + "x" * 100_000, "en"), (1, LONG, "en"), (14, "a b " * 199 + "c", "en"),
    (15, " ".join(["x", "y"] * 100), "en"), (16, " ".join(f"x{n // 2}" for n in range(200)), "en"),
]
LABELLED = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, None), (5, 0, 1), (9, 1, 1), (None, 1, 1), (77, 1, 1), (8, 1, None)]


def test_equals_applied_filters(spark):
    assert audited(spark, DOCUMENTS, LABELLED) == applied(DOCUMENTS, LABELLED)


def test_without_labels_and_without_documents(spark):
    assert audited(spark, DOCUMENTS[:3], []) == applied(DOCUMENTS[:3], [])
    assert audited(spark, [], LABELLED) == []


@pytest.mark.parametrize("threshold", ["-1", "100m"])
def test_hot_text_with_and_without_broadcasts(spark, threshold):
    docs = [(n, "copy " + LONG, "en") for n in range(500)] + [(1000 + n, f"{n} {LONG}", "de") for n in range(100)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = audited(spark, docs, [])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("en", "EABCD", 1, 1, 499, 0, 499, 0, 0, 499 * 120) in found
    assert ("de", "ABCDE", 5, 100, 0, 0, 0, 0, 0, 0) in found


def test_only_repeated_texts_are_compared(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    checked = docs.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS hash")
    found = {r["doc_id"] for r in f.later_copies(docs, checked).collect()}
    texts = {}
    for row in docs.orderBy("doc_id").collect():
        texts.setdefault(row["text"], []).append(row["doc_id"])
    assert found == {i for ids in texts.values() for i in ids[1:]}
