import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import ordered


@pytest.fixture
def split(spark):
    """Many small ranges, so that a hot key lies in several."""
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def gate(times, gap, opens=None):
    out, at = [], opens
    for t in times:
        let = at is None or t >= at
        out.append(let)
        at = t + gap if let else at
    return out


@settings(max_examples=200)
@given(st.lists(st.integers(0, 60), max_size=25), st.integers(1, 20), st.integers(-5, 70))
def test_walk_and_passed(times, gap, opens):
    at = np.array(sorted(times), np.int64)
    want = gate(at.tolist(), gap, opens)
    assert ordered.passed(at, opens, gap).tolist() == want
    if len(at):
        count, to = ordered.walk(at, np.array([opens]), gap)
        assert count[0] == sum(want) and to[0] == (at[max(i for i, x in enumerate(want) if x)] + gap if any(want) else opens)


def rows_of(seed, hot=400):
    """A third of all events has one key; ties in time, a null key, keys with one event."""
    rng = random.Random(seed)
    return [(k, rng.randrange(3000), i, rng.choice([0.5, 2.0, 7.25, None])) for i, k in enumerate(["hot"] * hot + [rng.choice(["a", "b", None]) for _ in range(hot)] + [f"k{i}" for i in range(hot)])]


def by_key(rows, order):
    groups = {}
    for r in sorted(rows, key=order):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_moving_average_of_a_split_key(spark, split):
    rows = rows_of(1)
    got = ordered.moving_average(spark.createDataFrame(rows, "key string, t long, id long, ms double"), ["key"], ["t", "id"], F.col("ms"), 0.3)
    want = {}
    for k, own in by_key(rows, lambda r: (r[1], r[2])).items():
        for v in (r[3] for r in own if r[3] is not None):
            n, m = want.get(k, (0, None))
            want[k] = n + 1, v if m is None else 0.3 * v + 0.7 * m
    found = {r.key: (r.samples, r.ewma) for r in got.collect()}
    assert found.keys() == want.keys() and all(found[k][0] == want[k][0] and abs(found[k][1] - want[k][1]) < 1e-9 for k in want)
    # The hot key was folded in several tasks.
    frame = ordered.in_ranges(spark.createDataFrame(rows, "key string, t long, id long, ms double"), ["key"], ["t", "id"])
    assert frame.filter("key = 'hot'").select(F.spark_partition_id()).distinct().count() > 2
    assert ordered.moving_average(spark.createDataFrame([], "key string, t long, id long, ms double"), ["key"], ["t", "id"], F.col("ms"), 0.3).count() == 0


@pytest.mark.parametrize("gap", [40, 2500])
def test_rate_gate_of_a_split_key(spark, split, gap):
    rows = rows_of(gap)
    events = spark.createDataFrame(rows, "key string, t long, id long, ms double")
    got = ordered.gates(events, ["key"], ["id"], F.col("t"), gap)
    want = {}
    for own in by_key(rows, lambda r: (r[1], r[2])).values():
        n = 0
        for r, let in zip(own, gate([r[1] for r in own], gap), strict=True):
            want[r[2]] = let, n
            n += let
    assert {r.id: (r.let, r.before) for r in got.collect()} == want
    if gap > 1000:
        assert {r.id for r in ordered.admitted(events, ["key"], ["id"], F.col("t"), gap).collect()} == {i for i, (let, _) in want.items() if let}


@pytest.mark.parametrize("cap", [0, 1, 5000])
def test_rotation_of_a_split_key(spark, split, cap):
    rows = rows_of(cap + 7)
    sizes = spark.createDataFrame(rows, "key string, size long, id long, ms double").withColumn("size", F.expr("CASE WHEN id % 11 = 0 THEN NULL WHEN id % 7 = 0 THEN 0 ELSE size END"))
    want = {}
    for own in by_key(rows, lambda r: r[2]).values():
        held, part = 0, 1
        for _, size, i, _ in own:
            want[i] = part
            held += 0 if i % 11 == 0 or i % 7 == 0 else size
            if cap and held >= cap:
                held, part = 0, part + 1
    assert {r.id: r.part for r in ordered.rotated(sizes, ["key"], ["id"], F.col("size"), cap).collect()} == want


def test_odd_gates(spark):
    none = spark.createDataFrame([], "key string, t long, id long")
    assert ordered.gates(none, ["key"], ["id"], F.col("t"), 5).count() == 0
    with pytest.raises(ValueError):
        ordered.gates(none, ["key"], ["id"], F.col("t"), 0)
    some = spark.createDataFrame([("a", None, 1), ("a", 3, 2)], "key string, t long, id long")
    assert [tuple(r) for r in ordered.gates(some, ["key"], ["id"], F.col("t"), 5).collect()] == [("a", 2, 3, True, 0)]
