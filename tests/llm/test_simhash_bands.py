"""The wide covering of the pipeline's near-duplicate step: fingerprints, anchors, bands."""

import numpy as np
import pytest

from tidemill.llm import shingles, simhash


def test_blocks_meet_at_the_nearest_anchor():
    fp = np.random.default_rng(1).integers(0, 1 << 64, 500, np.uint64)
    for cut in simhash.blocks(3):
        home = cut.anchors(fp)
        assert int(np.bitwise_count(cut.mask)) == 18 and (np.bitwise_count((fp & cut.mask) ^ home) <= 1).all()
        # An anchor is its own nearest one, and each of the 15 words around it leads to it.
        assert (cut.anchors(home) == home).all() and all((cut.anchors(home ^ flip) == home).all() for flip in cut.flips)


def test_fingerprints_hold_the_majority_of_each_run():
    h = np.random.default_rng(2).integers(0, 1 << 64, 900, np.uint64)
    lengths = np.array([1, 4, 600, 295])
    for run, got in zip(np.split(h, np.cumsum(lengths)[:-1]), simhash.majorities(h, lengths).tolist(), strict=True):
        assert got == sum(1 << k for k in range(64) if 2 * sum(int(x) >> k & 1 for x in run) > len(run))
    assert simhash.several(h, lengths, 3).shape == (4, 3)


@pytest.mark.parametrize("paired", [512, 2])
def test_joined_against_all_pairs(monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, 12, np.uint64)
    noise = np.bitwise_or.reduce([np.uint64(1) << rng.integers(0, 64, 200, np.uint64) for _ in range(9)])
    fp = base[rng.integers(0, 12, 200)] ^ noise
    anchor = np.sort(rng.integers(0, 9, 200))
    root = simhash.joined(anchor, fp, 14)
    want = np.arange(200)
    for _ in range(200):
        for i in range(200):
            near = (anchor == anchor[i]) & (np.bitwise_count(fp ^ fp[i]) <= 14)
            want[near] = want[near].min()
    assert root.tolist() == want.tolist() and len(set(want.tolist())) < 150


@pytest.mark.parametrize("rows", [1000, 1 << 24])
def test_pairs_of_similarity_four_fifths_meet(rows):
    """On real sets: the share of one fingerprint's misses, to the power of their number, is below 7 in a million."""
    prints, free = simhash.covering(rows)
    rng, n = np.random.default_rng(5), 6000
    for common, own, other in [(8, 1, 1), (80, 10, 10), (200, 0, 50), (20, 2, 3)]:
        h = rng.integers(0, 1 << 64, (n, common + own + other), np.uint64)
        left, right = h[:, : common + own], np.concatenate([h[:, :common], h[:, common + own :]], axis=1)
        a, b = (simhash.several(s.ravel(), np.full(n, s.shape[1]), prints)[:, :3] for s in (left, right))
        miss = []
        for j in (0, 1):
            hit = np.zeros(n, bool)
            for cut in simhash.blocks(free):
                hit |= cut.anchors(a[:, j]) == cut.anchors(b[:, j])
            miss.append(1 - (hit & (np.bitwise_count(a[:, j + 1] ^ b[:, j + 1]) <= simhash.APART)).mean())
        assert np.mean(miss) ** prints < 7e-6, (common, own, other, miss)


def test_the_step_proposes_by_simhash_bands(spark, monkeypatch):
    word = iter(f"w{i}" for i in range(10**6))
    text = " ".join(next(word) for _ in range(60))
    rows = [(1, text), (2, text + " more"), (3, " ".join(next(word) for _ in range(60))), (4, text.upper())]
    # Sets of four in sets of five, whose fingerprints are further apart than those of other near pairs.
    for i in range(200):
        short = " ".join(next(word) for _ in range(8))
        rows += [(100 + 2 * i, short), (101 + 2 * i, short + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in shingles.near_duplicates(docs).collect()}
    assert found == {2: 1, 4: 1, **{101 + 2 * i: 100 + 2 * i for i in range(200)}}
    monkeypatch.setattr(simhash, "bands", lambda *_: spark.createDataFrame([], "node long, band long, least long"))
    assert {r.doc_id for r in shingles.near_duplicates(docs.filter("doc_id < 100")).collect()} == {4}
