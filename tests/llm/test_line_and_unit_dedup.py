"""Line and substring dedup against plain loops: nulls, ties, repeated rows, hot lines, many lines."""

import hashlib
from collections import defaultdict

import pytest

from tripflow.llm import line_dedup, unit_dedup

from .helpers import docs_of

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HOT = "This very common line is everywhere."
ROWS = [(k, f"{HOT}\nown line number {k} here\nshort\n{HOT.upper()}\n") for k in range(40)]
ROWS += [
    (100, None), (101, ""), (102, "\n\n\n"), (None, f"{HOT}\nx"), (None, f"{HOT}\ny"), (7, ROWS[7][1]), (7, f"other row\n{HOT}"),
    (-3, "ÉTÉ Ligne à la fin \n  own LINE number 5 HERE\t\n"), (103, "\n".join(["same line again and again"] * 500)), (104, "same line again and again"),
    (105, "éÉé ééé ééé\nÉÉé ééé ééé"), (106, "\n".join(f"line {k} of the longest document" for k in range(3000))), (107, "line 2999 of the longest document\nline 64 of the longest document"),
]


def lines_by_hand(rows):
    key = lambda line: line.strip(SPACES).translate(LOWER)
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), doc), doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(key(x)) < 10 or first[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_lines(spark):
    found = [tuple(r[c] for c in ("doc_id", "n_lines", "n_dropped", "kept_sha256")) for r in line_dedup.line_report(docs_of(spark, ROWS, extra=True)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, lines_by_hand(ROWS)))


def test_line_texts_and_columns(spark):
    docs = docs_of(spark, ROWS, extra=True)
    cut = line_dedup.drop_lines(docs)
    assert cut.columns == docs.columns
    digests = sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in cut.collect())
    assert digests == sorted(x[3] for x in lines_by_hand(ROWS))
    assert line_dedup.line_report(docs.filter("false")).count() == 0


def test_bitmaps_hold_only_words_with_losses(spark):
    keep = {r["doc_id"]: r["keep"] for r in line_dedup.line_bitmaps(docs_of(spark, ROWS)).collect()}
    assert [e["word"] for e in keep[107]] == [0] and 106 not in keep
    assert keep[107][0]["bits"] == ~0b11


def test_lines_without_python(spark):
    plan = line_dedup.line_report(docs_of(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def units_by_hand(rows):
    holders = defaultdict(set)
    spans = []
    for k, (doc, text) in enumerate(dict.fromkeys(rows)):
        seen = {}
        for start, end in unit_dedup.unit_spans(text or ""):
            form = unit_dedup.normal_form((text or "")[start:end])
            if form is not None:
                holders[form].add(doc)
                spans.append((k, doc, start, end, form, seen.setdefault(form, start) != start))
    out = set()
    for k, doc, start, end, form, again in spans:
        ids = [d for d in holders[form] if d is not None]
        if again or (ids and (doc is None or doc > min(ids))):
            out.add((doc, start, end, min(ids) if ids else None, k))
    return sorted(map(str, (x[:4] for x in out)))


SENTENCE = "A passage that several of the documents have inside of a longer line."
UNIT_ROWS = [*ROWS, (200, f"before it {SENTENCE} And after it."), (201, f"Before. {SENTENCE} Behind it."), (202, f"x. {SENTENCE.upper()} {SENTENCE} end")]


def test_units(spark):
    docs = docs_of(spark, UNIT_ROWS, extra=True)
    found = unit_dedup.repeated_units(docs).select("doc_id", "row", "start", "end", "first_doc_id").distinct().collect()
    assert sorted(str((r["doc_id"], r["start"], r["end"], r["first_doc_id"])) for r in found) == units_by_hand(UNIT_ROWS)


def test_unit_texts(spark):
    docs = docs_of(spark, [(1, f"Start. {SENTENCE} Tail of one."), (2, f"Other. {SENTENCE} Tail of two."), (3, f"{SENTENCE}\nkeep"), (4, None)], extra=True)
    cut = unit_dedup.drop_units(docs)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts == {1: f"Start. {SENTENCE} Tail of one.", 2: "Other.  Tail of two.", 3: "keep", 4: None}
    assert unit_dedup.drop_units(docs.filter("false")).count() == 0


@pytest.mark.parametrize("text", ["", "a", "A. B? c!\n\n d", "no end"])
def test_spans_are_inside(text):
    assert all(0 <= s <= e <= len(text) for s, e in unit_dedup.unit_spans(text))


def test_passages_with_other_borders(spark):
    def some(seed, n):
        return [hashlib.sha256(f"{seed} {k}".encode()).hexdigest()[:7] for k in range(n)]

    passage = some("passage", 60)
    # Other lines, no sentence ends, one word changed inside, other words around.
    edited = [*passage[:52], "changed", *passage[53:]]
    texts = {
        1: " ".join([*some("a", 9), *passage, *some("b", 9)]),
        2: " ".join([*some("c", 5), "\n".join(passage[:20]), " ".join(passage[20:]).upper(), *some("d", 7)]),
        3: " ".join([*some("e", 30), *edited, *some("f", 3)]),
    }
    cut = {r["doc_id"]: r["text"].lower().split() for r in unit_dedup.drop_units(docs_of(spark, list(texts.items()))).collect()}
    assert cut[1] == texts[1].split()
    for doc in (2, 3):
        own = [w for w in texts[doc].lower().split() if w not in passage]
        assert [w for w in cut[doc] if w not in passage] == own
        assert len([w for w in cut[doc] if w in passage]) <= 2 * unit_dedup.GAP + 8


def test_every_long_passage_holds_a_run():
    size = unit_dedup.RUN + 2 * unit_dedup.GAP + 1
    for seed in range(300):
        passage = [hashlib.sha256(f"{seed} {k}".encode()).hexdigest()[:5] for k in range(size)]
        forms = [
            {text[s:e] for s, e in unit_dedup.run_spans(text)}
            for text in (" ".join([*("x" + w for w in passage[:around]), *passage, *("y" + w for w in passage)]) for around in (0, 3, 40))
        ]
        assert any(form in " ".join(passage) for form in forms[0] & forms[1] & forms[2])


def test_runs_leave_the_first_copy_of_a_cycle_whole():
    text = "one two three four five six seven eight nine ten eleven twelve " * 20
    spans = list(unit_dedup.run_spans(text))
    first = {}
    for start, end in spans:
        assert first.setdefault(text[start:end], end) == end or start >= first[text[start:end]]


def test_places_of_words():
    """By lengths where words have one character between them, else by search."""
    for text in ("", "one", "a bé\nç\td", " a b", "a b ", "a  b", "a\u3000b c", "\n", "é" * 9 + "\x0bz"):
        spans = [m.span() for m in unit_dedup._WORD.finditer(text)]
        assert list(zip(*unit_dedup.word_places(text), strict=True)) == spans


def test_search_for_first_documents_gets_a_row_a_digest(spark):
    line = "a line that is long enough to be one unit"
    docs = docs_of(spark, [f"{line}\n{line}\n{line}", line, None])
    made = unit_dedup.arrow_map(docs.select("doc_id", "text"), unit_dedup._digests_task, "doc_id long, digest binary, again boolean").collect()
    assert sorted((r["doc_id"], r["again"]) for r in made) == [(0, True), (1, False)]
