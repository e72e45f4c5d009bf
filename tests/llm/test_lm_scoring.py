"""The recurrent model: gradients, probabilities that sum to one, base scores by hand, and a gain on held-out documents."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tripflow.llm import recurrent
from tripflow.llm.lm_scoring import count_words, head_of, lm_scores

from .helpers import docs_of


@pytest.fixture
def small():
    draw = np.random.default_rng(0)
    counts = np.sort(draw.integers(1, 90, 2300))[::-1].astype(float)
    return recurrent.Vocabulary([recurrent.END, *(b"w%d" % k for k in range(2299))], counts, 50, 20)


def test_gradients(small):
    draw = np.random.default_rng(1)
    p = {k: a.astype(np.float64) for k, a in recurrent.initial(small).items()}
    for name in ("x", "u", "wc", "wi"):
        p[name] = draw.normal(0, 0.4, p[name].shape)
    inputs, tokens = draw.integers(0, small.inputs, (6, 5)), draw.integers(0, small.rest + 1, (6, 5))
    first, there = draw.random((6, 5)) < 0.2, np.ones((6, 5), bool)
    there[4:, 4] = False
    state = draw.normal(0, 0.5, (5, recurrent.HIDDEN))

    def loss():
        states, _ = recurrent._states(p, state, inputs, first, keep=False)
        kept = tokens[there]
        return (small.share[kept].sum() - recurrent.window_score(p, small, states[there], kept).sum()) / there.sum()

    value, grads, seen, _ = recurrent.gradients(p, small, state, inputs, first, tokens, there)
    assert value == pytest.approx(loss())
    for name, array in p.items():
        for _ in range(6):
            at = tuple(int(draw.integers(0, s)) for s in array.shape)
            if name == "x":
                at = (int(draw.choice(seen)), at[1])
            kept, step = array[at], 1e-2
            array[at] = kept + step
            up = loss()
            array[at] = kept - step
            down = loss()
            array[at] = kept
            mine = grads[name][list(seen).index(at[0]), at[1]] if name == "x" else grads[name][at]
            assert mine == pytest.approx((up - down) / (2 * step), abs=1e-4)


def test_probabilities_sum_to_one(small):
    p = recurrent.initial(small, seed=4)
    p["wc"] *= 30
    state = np.random.default_rng(2).normal(0, 0.5, (1, recurrent.HIDDEN)).astype(np.float32)
    every = np.arange(small.rest + 1)
    logs = recurrent.window_score(p, small, np.repeat(state, len(every), axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_untrained_is_unigram(small):
    p = recurrent.initial(small)
    for name in ("wc", "wi"):
        p[name][:] = 0
    every = np.arange(small.rest)
    logs = recurrent.window_score(p, small, np.zeros((len(every), recurrent.HIDDEN), np.float32), every)
    total = small.weight.sum() + small.rest_mass
    assert np.allclose(logs, np.log(small.weight / total), atol=1e-4)


def test_state_runs_through_windows(small, monkeypatch):
    draw = np.random.default_rng(3)
    p = recurrent.initial(small, seed=5)
    p["wc"] *= 30
    documents = [np.append(draw.integers(1, small.rest + 1, n), small.end) for n in (0, 1, 7, 150, 40, 3, 90)]
    short = recurrent.score(p, small, documents)
    monkeypatch.setattr(recurrent, "WINDOW", 1000)
    assert np.allclose(short, recurrent.score(p, small, documents), atol=1e-2)
    alone = [recurrent.score(p, small, [d])[0] for d in documents]
    assert np.allclose(short, alone, atol=1e-2)


def base_by_hand(rows):
    tokens = {k: [*(text or "").encode().lower().split(), recurrent.END] for k, (_, text) in enumerate(rows)}
    held = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for k, (i, _) in enumerate(rows)}
    counts = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    n, v = sum(counts.values()), len(counts)
    return [
        (rows[k][0], held[k], len(ts), sum(t in counts for t in ts), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts))
        for k, ts in tokens.items()
    ]


CASES = [(k, f"the Cat sat on word{k % 7} mat\nagain THE cat {'x' * 70}{k % 3} y{k}") for k in range(60)]
CASES += [(None, "the cat"), (60, None), (61, ""), (62, "  \t"), (5, "twice here"), (5, "twice here"), (63, "word " * 3000)]


@pytest.mark.parametrize("head", [5, 100000])
def test_base_and_counts(spark, monkeypatch, head):
    monkeypatch.setattr("tripflow.llm.lm_scoring.HEAD_WORDS", head)
    monkeypatch.setattr(head_of, "__defaults__", (head,))
    found = lm_scores(docs_of(spark, CASES, extra=True)).collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6))
    mine = sorted(key((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])) for r in found)
    assert mine == sorted(map(key, base_by_hand(CASES)))
    assert all(r["score"] < 0 for r in found)


def test_counts_and_empty_table(spark):
    docs = docs_of(spark, ["a b A", None])
    assert {bytes(r["word"]): r["n"] for r in count_words(docs).collect()} == {b"a": 2, b"b": 1, recurrent.END: 2}
    assert lm_scores(docs.filter("false")).count() == 0
    assert lm_scores(docs_of(spark, [(0, "a"), (1, "b")]).filter("doc_id = -1")).count() == 0


def test_gain_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm_scores(docs).filter("held_out").toPandas()
    assert rows["score"].sum() > rows["base_score"].sum()
    assert (rows["score"] > rows["base_score"]).mean() > 0.6


def test_scores_by_a_plain_loop(small):
    """Every token of some documents by hand in double precision, also with weights whose logits have no useful bound."""
    draw = np.random.default_rng(8)
    documents = [np.append(draw.integers(0, small.rest + 1, n), small.end) for n in (0, 1, 40, 75, 33)]
    for scale in (1.0, 300.0):
        p = recurrent.initial(small, seed=6)
        p["wc"], p["wi"] = p["wc"] * np.float32(scale), p["wi"] * np.float32(scale)
        q = {k: a.astype(np.float64) for k, a in p.items()}
        bounded = recurrent._lowered(p["wi"], p["bi"])[1]
        assert bounded.all() if scale == 1.0 else not bounded.any()
        for document, got in zip(documents, recurrent.score(p, small, documents), strict=True):
            h, before, want = np.zeros(recurrent.HIDDEN), small.end, 0.0
            for token in document:
                x, g = q["x"][small.input[before]], h @ q["u"]
                r, z = (1 / (1 + np.exp(-(x + g)[k * recurrent.HIDDEN : (k + 1) * recurrent.HIDDEN])) for k in (0, 1))
                h = h + z * (np.tanh(x[2 * recurrent.HIDDEN :] + r * g[2 * recurrent.HIDDEN :]) - h)
                k = small.cls[token]
                logits = h @ q["wc"] + q["bc"]
                want += logits[k] - np.logaddexp.reduce(logits) + small.share[token]
                if k < small.fine_classes:
                    logits = h @ q["wi"][k] + q["bi"][k]
                    want += logits[small.slot[token]] - np.logaddexp.reduce(logits)
                before = token
            assert abs(got - want) <= 1e-4 * max(1.0, abs(want))


def test_no_reduction_for_every_class(small):
    """Sums and largest values of many short rows are slow as reductions: a window has a few, not some for each class."""
    import cProfile
    import pstats

    document = np.append(np.random.default_rng(9).integers(0, small.rest, 10 * recurrent.WINDOW), small.end)
    trainer = recurrent.Trainer(recurrent.initial(small), small)
    for run in (lambda: recurrent.score(trainer.p, small, [document] * 64), lambda: trainer.learn([document] * 64)):
        profile = cProfile.Profile()
        profile.runcall(run)
        calls = sum(entry[1] for (_, _, name), entry in pstats.Stats(profile).stats.items() if "'reduce' of" in name)
        assert calls <= 11 * (small.fine_classes + 20)
