import math
import zlib
from collections import Counter

import numpy as np

from tidemill.llm import lm


def corpus():
    rng = np.random.default_rng(0)
    kinds = [[f"{c}{x}{e}" for x in range(60)] for c, e in (("a", "ion"), ("b", "keit"))]
    rows = []
    for i in range(700):
        own = kinds[i % 2]
        rows.append((i, " ".join(own[min(59, int(x))] for x in rng.exponential(9, int(rng.integers(5, 60)))) + (f" rare{i}" if i % 3 else "")))
    return rows + [(1000, None), (1001, ""), (None, "A0ion b0keit"), (1002, "A1ION a1ion \n\x0b é"), (3, rows[3][1]), (1003, " ".join(kinds[0]) * 100), (1004, "x" * 300 + " a1ion"), (1005, "x" * 300)]


def test_scores_base_and_held_out(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, 0.0) for i, t in rows], "doc_id long, text string, n_tokens int, score double").repartition(3)
    split = lambda t: (t or "").encode().lower().split() + [lm.END]
    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not out(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, out(i), len(split(t)), sum(c[w] > 0 for w in split(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t)), 6)) for i, t in rows), key=str)
    scores = []
    for known in (lm.KNOWN, 20):
        got = lm.scored(docs, known=known).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == want
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)
        scores.append(sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in got))
    assert lm.scored(docs.limit(0)).count() == 0
    assert lm.scored(docs.filter("doc_id = 1001").union(docs.filter("doc_id = 1000"))).count() == 2


def small_model(seed=3, heads=130):
    voc = lm.Vocabulary({str(i).encode(): i for i in range(heads)}, np.log(np.full(heads + lm.TAILS, 1 / (heads + lm.TAILS))))
    voc.number[lm.END] = voc.number.pop(b"0")
    return lm.Model.fresh(voc, seed)


def test_probabilities_sum_to_one_and_state_is_carried():
    m = small_model()
    h = np.random.default_rng(1).standard_normal((2, lm.STATE)).astype(np.float32)
    every = np.arange(m.heads + lm.TAILS)
    for row in h:
        assert abs(np.exp(m.log_probabilities(np.repeat(row[None], len(every), 0), every)).sum() - 1) < 1e-4
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, m.heads + lm.TAILS, n) for n in (1, 50, 7, 16, 17, 90)]
    together = m.score(texts)
    gates = m.gates(m.w["in"])
    for t, got in zip(texts, together, strict=True):
        h, total, before = np.zeros((1, lm.STATE), np.float32), 0.0, m.start
        for x in t:
            h = m.advance(gates[:, [before]], h)
            total += m.log_probabilities(h, np.array([x]))[0]
            before = x
        assert abs(total - got) < 1e-3 * len(t)


def test_gradients(monkeypatch):
    m = small_model(heads=70)
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    rng = np.random.default_rng(5)
    inputs, targets = rng.integers(0, m.start, (6, 4)), rng.integers(0, m.heads + lm.TAILS, (6, 4))
    inputs[0] = inputs[3, 1] = m.start
    start = {k: v.copy() for k, v in m.w.items()}
    # With these sums the step is the gradient itself times a known factor.
    monkeypatch.setattr(lm, "RATE", 1e-4)
    seen = {k: np.full_like(v, 1e12) for k, v in m.w.items()}
    m._window(inputs, targets, np.zeros((4, lm.STATE)), seen)
    step = {k: (start[k] - m.w[k]) * 1e6 / 1e-4 / (24 / 64) for k in start}

    def loss(w):
        m.w = w
        return -m._window(inputs, targets, np.zeros((4, lm.STATE)), {k: np.full_like(v, 1e30) for k, v in w.items()})[1] / 24

    for k in ("in", "x", "h", "b", "class", "class_b", "out", "out_b"):
        at = np.unravel_index(np.argmax(np.abs(step[k])), step[k].shape)
        up, down = ({n: v.copy() for n, v in start.items()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        numeric = (loss(up) - loss(down)) / 2e-4
        assert abs(numeric - step[k][at]) < 0.03 * abs(numeric) + 1e-6, k


def test_every_training_document_trains_the_weights(spark, monkeypatch):
    given, train = {}, lm.trained

    def kept(texts, vocabulary, tokens):
        given.update(rows=texts.count(), tokens=tokens, targets=texts.selectExpr("sum(length(targets))").first()[0])
        return train(texts, vocabulary, tokens)

    monkeypatch.setattr(lm, "trained", kept)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, 1000))) for i in range(330)]
    got = lm.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert given["rows"] == got.filter("not held_out").count() and given["targets"] == 2 * given["tokens"]
    assert got.select("train_tokens").first()[0] == given["tokens"] > 281_250


def test_training_takes_every_token_and_ignores_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "COPY", 3_000)
    taken, lanes = [], lm.Model._lanes
    monkeypatch.setattr(lm.Model, "_lanes", lambda self, tokens, seen: taken.append(tokens.size) or lanes(self, tokens, seen))
    m = small_model()
    m.train(np.random.default_rng(6).integers(0, m.heads, 100_003), lm.fresh_sums(m))
    assert sum(taken) == 100_003
    rows = [(i, np.random.default_rng(i).integers(0, 140, 40).astype(np.uint16).tobytes()) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, targets binary")
    voc = lm.Vocabulary({str(i).encode(): i for i in range(129)} | {lm.END: 129}, np.log(np.full(130 + lm.TAILS, 1 / (130 + lm.TAILS))))
    one, other = (lm.trained(frame.repartition(n), voc, 12_000).w for n in (2, 7))
    assert all(np.allclose(one[k], other[k], atol=1e-6) for k in one)


def test_windows_compute_the_gates_of_each_input_once(monkeypatch):
    m, rows, gates = small_model(), [], lm.Model.gates
    monkeypatch.setattr(lm.Model, "gates", lambda self, x: rows.append(len(x)) or gates(self, x))
    rng = np.random.default_rng(7)
    m._window(rng.integers(0, m.start, (16, 100)), rng.integers(0, m.heads + lm.TAILS, (16, 100)), np.zeros((100, lm.STATE), np.float32), lm.fresh_sums(m))
    assert rows == [m.start + 1]


def test_gates_far_from_zero_are_shut_or_open():
    m = small_model()
    h = np.full((2, lm.STATE), 0.5, np.float32)
    far = np.repeat(np.array([[-1e4], [1e4]], np.float32)[None], 3, 0).repeat(lm.STATE, 2)
    with np.errstate(all="raise", under="ignore"):
        new = m.advance(far, h)
    # A shut update gate takes the candidate, an open one keeps the state.
    assert np.allclose(new[0], -1) and np.allclose(new[1], 0.5)
