"""Near duplicates by similarity of shingles of five words, against all pairs."""

from functools import cache

import numpy as np
import pytest

from tests.llm.test_simple_ops import brute_fingerprint
from tidemill.llm import shingles


@cache
def five_words(text):
    w = text.lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@cache
def similarity(a, b):
    one, two = five_words(a), five_words(b)
    return len(one & two) / len(one | two) if one | two else 1.0


def components(rows, near):
    least = {}
    for i, (a, _) in enumerate(rows):
        met, new = {i}, [i]
        while new:
            j = new.pop()
            new += (got := [k for k in range(len(rows)) if k not in met and near(rows[j], rows[k])])
            met |= set(got)
        least[a] = min(least.get(a, a), *(rows[k][0] for k in met))
    return least


@pytest.mark.parametrize("block", [shingles.BLOCK, 3000])
def test_near_duplicates_against_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(0, 4000)}"
    rows = []
    for i in range(40):
        w = [word() for _ in range(int(rng.integers(30, 400)))]
        rows.append((10 * i, " ".join(w)))
        for k in range(1, 4):
            for p in rng.integers(0, len(w), max(1, len(w) // 60)):
                w[p] = word()
            rows.append((10 * i + k, " ".join(w)))
    rows += [(900, rows[0][1].upper()), (901, ""), (902, None), (903, "two words"), (904, "Two  words"), (905, "two others"), (906, rows[40][1]), (906, rows[80][1])]
    near = lambda a, b: a[0] == b[0] or similarity(a[1] or "", b[1] or "") >= 0.8
    want = {a: b for a, b in components(rows, near).items() if a != b}
    got = shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block=block).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(want)
    # Three bits of the fingerprint do not reach most of these.
    fp = {a: brute_fingerprint(t) for a, t in rows}
    assert sum((fp[a] ^ fp[b]).bit_count() > 3 for a, b in want.items()) > 20


def test_roots_decide_by_whole_sets():
    a = np.arange(90, dtype=np.uint64)
    # 80 of 100 is near, 79 of 101 is not; the fourth is reached over the first only.
    sets = [a, np.concatenate([a[:80], a[:10] + np.uint64(1000)]), np.concatenate([a[:79], a[:11] + np.uint64(2000)]), np.concatenate([a[10:], a[:10] + np.uint64(3000)])]
    assert shingles.roots(sets).tolist() == [0, 0, 2, 0]


@pytest.mark.parametrize("block", [shingles.BLOCK, 2500])
def test_chains_that_stars_leave_open(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(3):
        w = [f"c{c}w{i}" for i in range(120)]
        for step in range(20):
            rows.append((int(rng.integers(30)) * 1000 + 100 * c + step, " ".join(w)))
            w = w[4:] + [f"c{c}s{step}x{i}" for i in range(4)]
    near = lambda a, b: a[0] == b[0] or similarity(a[1], b[1]) >= 0.8
    want = {a: b for a, b in components(rows, near).items() if a != b}
    got = {r.doc_id: r.component_id for r in shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    assert got == want


def test_no_documents(spark):
    assert shingles.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_class_of_many_bands_is_one_row_after_the_stars(spark, monkeypatch):
    rng, real, rows_of = np.random.default_rng(7), shingles.staged, {}
    base, rows = [f"w{i}" for i in range(300)], []
    # Texts about 0.7 alike meet in many bands, in most of them with another smallest text, and are not linked.
    for i in range(60):
        w = list(base)
        for p in rng.choice(np.arange(5, 295, 10), 5, replace=False):
            w[p] = f"t{i}p{p}"
        rows.append((i, " ".join(w)))
    rows.append((60, rows[30][1] + " more"))

    def counted(frame, name):
        out = real(frame, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(shingles, "staged", counted)
    near = lambda a, b: a[0] == b[0] or similarity(a[1], b[1]) >= 0.8
    want = {a: b for a, b in components(rows, near).items() if a != b}
    found = {r.doc_id: r.component_id for r in shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == want and len(want) < 30
    assert rows_of["band-members"] > 5 * len(rows) and rows_of["band-unsettled"] <= len(rows)


@pytest.mark.parametrize("hubs", [1, 4])
@pytest.mark.parametrize("block", [shingles.BLOCK, 3000])
def test_strangers_in_the_bands_of_linked_groups(spark, monkeypatch, hubs, block):
    monkeypatch.setattr(shingles, "HUBS", hubs)
    rng, rows = np.random.default_rng(8), []
    for c in range(4):
        base = [f"c{c}w{i}" for i in range(300)]
        # Ids are dealt at random, so the smallest of a band is now one of the linked, now a stranger, who may be linked to a few of them.
        for k in range(24):
            w = list(base)
            for p in rng.choice(np.arange(5, 295, 10), [1, 1, 2, 4, 5, 6][k % 6], replace=False):
                w[p] = f"c{c}t{k}p{p}"
            rows.append((int(rng.integers(1 << 20)) * 128 + 32 * c + k, " ".join(w)))
    near = lambda a, b: a[0] == b[0] or similarity(a[1], b[1]) >= 0.8
    want = {a: b for a, b in components(rows, near).items() if a != b}
    found = {r.doc_id: r.component_id for r in shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    assert found == want
