import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import substrings, suffixes
from tidemill.llm.windows import cells, merged, runs, sketched


def brute(rows, length, items):
    """rows: (key, items). For each row the removed flags."""
    least = {}
    for key, x in rows:
        for i in range(len(x) - length + 1):
            w = tuple(x[i : i + length])
            least[w] = min(key, least.get(w, key))
    out = []
    for key, x in rows:
        gone = [False] * len(x)
        for i in range(len(x) - length + 1):
            if least[tuple(x[i : i + length])] < key:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def corpus(seed, n=60, vocab=300):
    rng = np.random.default_rng(seed)
    passages = [" ".join(f"w{x}" for x in rng.integers(0, vocab, 70)) for _ in range(5)]
    rows = []
    for i in range(n):
        t = " ".join(f"w{x}" for x in rng.integers(0, vocab, int(rng.integers(0, 90))))
        if i % 3 == 0:
            t += " " + passages[i % 5] + " end é"
        if i % 7 == 0:
            t = passages[i % 5][: int(rng.integers(10, 300))] + " " + t + "\n\t" + passages[(i + 1) % 5]
        rows.append((i, t))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (104, "same " * 400), (105, "same " * 300 + "x"), (106, "ab" * 3000), (None, rows[3][1]), (3, rows[3][1]), (107, "é" * 60), (108, "é" * 61)]
    return rows


@pytest.mark.parametrize("length", [50, 20])
def test_words_and_bytes_against_brute_force(spark, length):
    rows = corpus(length)
    docs = spark.createDataFrame([(i, t, "en", 5) for i, t in rows], "doc_id long, text string, lang string, n_items int").repartition(5)
    key = lambda i: 2**63 - 1 if i is None else i

    def shown(got):
        return sorted(((r.doc_id, r.n_items, [(s.start, s.length) for s in r.spans], bytes(r.text) if isinstance(r.text, (bytes, bytearray)) else r.text, r.lang) for r in got.collect()), key=str)

    for op, split, join in ((substrings.without_repeated_passages, lambda t: t.split(), lambda x: b" ".join(x).decode()), (suffixes.without_repeated_strings, list, bytes)):
        items = [(key(i), split((t or "").encode())) for i, t in rows]
        want = []
        for (i, _), (_, x), gone in zip(rows, items, brute(items, length, None), strict=True):
            edges = np.flatnonzero(np.diff([0, *map(int, gone), 0]))
            want.append((i, len(x), [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)], join([w for w, g in zip(x, gone, strict=True) if not g]), "en"))
        got = shown(op(docs, length, carry=("lang",)))
        assert got == sorted(want, key=str)
        assert any(w[2] for w in want)
        assert op(docs.limit(0), length).count() == 0
        assert [len(r.spans) for r in op(docs.filter("doc_id = 103"), length).collect()] == [0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 7, 255]), min_size=1, max_size=80), st.integers(1, 20), st.data())
def test_two_stage_sorting(values, depth, data):
    text = np.array(values, np.uint8)
    wanted = np.array(data.draw(st.lists(st.booleans(), min_size=len(values), max_size=len(values))), bool)
    # Only suffixes of full depth are ever asked for.
    wanted[max(0, len(values) - depth + 1) :] = False
    got = suffixes.two_stage(text, wanted, depth)
    assert sorted(got.tolist()) == np.flatnonzero(wanted).tolist()
    keys = [bytes(values[i : i + depth]) for i in got]
    assert keys == sorted(keys)
    lcp = suffixes.common_prefixes(text, got, depth)
    for a, b, n in zip(keys, keys[1:], lcp[1:], strict=False):
        assert n == next((i for i in range(depth) if a[i] != b[i]), depth)


@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30)), max_size=30), min_size=1, max_size=5))
def test_merged_sketches_never_underestimate(chunks):
    keys = np.random.default_rng(1).integers(0, 2**64, 31, dtype=np.uint64)
    where = {}
    for i, pairs in enumerate(chunks):
        for text, key in pairs:
            where.setdefault(key, set()).add((i, text))
    by = {}
    for i, pairs in enumerate(chunks):
        for part, cell, many in sketched(np.array([p[0] for p in pairs], np.int64), keys[[p[1] for p in pairs]], 3):
            by.setdefault(part, []).append((cell, many))
    got = set()
    for part, rows in by.items():
        for (cell, _), again in zip(rows, merged(rows), strict=True):
            got |= {(part, int(c)) for c in cell[again]}
    for key, at in where.items():
        part, cell = cells(keys[key : key + 1], 3)
        assert ((int(part[0]), int(cell[0])) in got) == (len(at) > 1)


@given(st.lists(st.integers(0, 40), min_size=1, max_size=6), st.integers(3, 12), st.data())
def test_runs_cover_each_window_once(sizes, length, data):
    items = np.array(data.draw(st.lists(st.integers(0, 3), min_size=sum(sizes), max_size=sum(sizes))), np.uint64)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    text, at, n, m = runs(items, bounds, length, max(1, length // 3))
    windows = [(int(t), int(a) + i) for t, a, k in zip(text, at, n, strict=True) for i in range(int(k))]
    assert windows == [(t, p) for t in range(len(sizes)) for p in range(bounds[t], bounds[t + 1] - length + 1)]
    seen = {}
    for t, a, k, h in zip(text, at, n, m, strict=True):
        for i in range(int(k)):
            assert seen.setdefault(tuple(items[a + i : a + i + length]), h) == h


def test_smaller_chunks_tell_the_same(spark):
    rng = np.random.default_rng(12)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    shared = words(60)
    rows = [(i, f"{words(40)} {shared if i % 3 == 0 else ''} {words(30)}") for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [sorted((r.doc_id, r.text) for r in substrings.without_repeated_passages(frame, chunk_bytes=size).collect()) for size in (2000, 6 << 20)]
    assert got[0] == got[1] and sum(shared in t for _, t in got[0]) == 1
