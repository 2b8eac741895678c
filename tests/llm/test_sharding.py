import zlib
from collections import defaultdict

import numpy as np

from tidemill.llm import sharding
from tidemill.llm.sharding import sharded


def run(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, s, s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, shard int").repartition(4)
    return sharded(docs, **how).collect()


def test_near_equal_whole_groups_and_slots(spark):
    rng = np.random.default_rng(2)
    texts = ["t" * int(x) + str(i) for i, x in enumerate(rng.lognormal(5, 1, 4000))] + ["copy " * 12] * 3000 + ["pair one"] * 2 + [None, "", ""]
    rows = [(i, t, f"s{i % 9}") for i, t in enumerate(texts)] + [(None, "no id", None), (7, texts[7], "s7"), (7, texts[7], "s7")]
    got = run(spark, rows, shards=10)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert sorted(by) == list(range(10))
    sizes = [sum(r.size for r in x) for x in by.values()]
    assert max(sizes) < 1.06 * np.mean(sizes) and min(sizes) > 0.94 * np.mean(sizes)
    for x in by.values():
        assert sorted(r.slot for r in x) == list(range(len(x)))
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    apart = {c for c, s in where.items() if len(s) > 1}
    assert apart <= {r.text_crc32 for r in got if r.group_split} <= {zlib.crc32(b"copy " * 12)}


def test_heavy_rows_are_sampled_and_poor_nodes_anew(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLE", 300)
    monkeypatch.setattr(sharding.grown, "__defaults__", (300,))
    rng = np.random.default_rng(4)
    rows = [(i, "h" * 3000 + str(i) if i % 100 == 0 else "x" * int(rng.integers(1, 40)) + str(i), f"s{i % 5}") for i in range(6000)] + [(9000, "very long " * 2000, "s1")]
    got = run(spark, rows, shards=16)
    sizes = np.bincount([r.shard for r in got], [r.size for r in got], 16)
    assert len(got) == len(rows) and sizes.max() < sizes.mean() + 20_100 and sorted(sizes)[-2] < 1.5 * sizes.mean() and sizes.min() > 0.5 * sizes.mean()


def test_small_tables(spark):
    assert run(spark, [], shards=4) == []
    assert len(run(spark, [(1, "a", "x")], shards=4)) == 1
    assert {r.shard for r in run(spark, [(i, "x" * 84, "s") for i in range(64)], target_bytes=1600)} <= set(range(4))


def test_cuts_come_from_all_rows(spark):
    rng = np.random.default_rng(6)
    keys = np.stack([rng.integers(0, 1 << 61, 3000), np.repeat(rng.integers(0, 5, 300), 10) << 31], axis=1)
    size = rng.integers(1, 200, 3000)
    rows = spark.createDataFrame([(k, int(s)) for k, s in zip(keys.tolist(), size, strict=True)], "keys array<long>, size long").repartition(3)
    # With few intervals there are many passes; the cut is the nearest to the middle either way, wherever the rows lie.
    for bins in (4, 4096):
        root = sharding.grown(rows, 2, bins)
        order = np.argsort(keys[:, 0])
        total, below = size.sum(), np.concatenate([[0], np.cumsum(size[order])])
        left = size[keys[:, root.dim] < root.cut].sum()
        assert root.dim == 0 and abs(left - total / 2) == np.abs(below - total / 2).min()
