import random
from collections import Counter

import pytest

from tidemill.llm.ranking import ranked

SCHEMA = "g long, h string, a long, b double, t long, u string, c long"


def brute(rows, top, place):
    last = lambda v, sign=1: (v is None, 0 if v is None else sign * v if not isinstance(v, str) else v)
    groups = {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r)
    out = []
    for own in groups.values():
        pair = lambda r: (last(r[2], -1), last(r[3]))
        own = sorted(own, key=lambda r: (pair(r), last(r[4]), last(r[5])))
        pairs = sorted(set(map(pair, own)))
        for i, r in enumerate(own):
            at = {"pos": i + 1, "rank": 1 + sum(pair(x) < pair(r) for x in own), "dense": 1 + pairs.index(pair(r))}[place]
            if at <= top:
                out.append((*r[:6], i + 1, at, sum(pair(x) == pair(r) for x in own)))
    return Counter(out)


def found(spark, rows, top, place, parts=5):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumnsRenamed({"c": "part"}).selectExpr("*", "7 AS local", "8 AS tied")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = ranked(frame, ["g", "h"], [("a", "desc"), ("b", "asc")], ["t", "u"], top, place)
        assert got.columns == ["g", "h", "a", "b", "t", "u", "pos", "place", "tied"]
        return Counter(map(tuple, got.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("place", ["pos", "rank", "dense"])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, place, seed):
    rng = random.Random(seed)
    some = lambda *v: rng.choice(v)
    # A third of the rows in one group, many of them equal; nulls in every column.
    rows = [(some(1, 1, 2, 3, None), some("x", "x", "y", None), some(5, 4, None), some(0.5, 0.25, None), some(1, 2, None), some("p", "q", None), 0) for _ in range(500)]
    rows += [(9, "hot", 7, 0.5, i % 3, "r", 0) for i in range(300)] + [(9, "hot", 7, 0.5, 1, "r", 0)] * 40
    for top in (1, 3, 60):
        assert found(spark, rows, top, place) == brute([r[:6] for r in rows], top, place)


def test_one_group_over_many_partitions(spark):
    rows = [(1, "a", 1, 1.0, i, "z", 0) for i in range(4000)] + [(1, "a", 1, None, i, None, 0) for i in range(10)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(spark, rows, 4005, "pos", parts=13)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r[4], r[6]) for r in got if r[3] == 1.0) == [(i, i + 1) for i in range(4000)]
    assert sorted((r[4], r[6], r[8]) for r in got if r[3] is None) == [(i, 4001 + i, 10) for i in range(5)]


def test_empty_and_wrong(spark):
    assert not found(spark, [], 2, "pos")
    frame = spark.createDataFrame([(1, 2, 3)], "g long, a long, pos long")
    for bad in (dict(place="first"), dict(top=0), dict(ties=["pos"]), dict(ties=["a"]), dict(group=[])):
        with pytest.raises(ValueError):
            ranked(frame, **(dict(group=["g"], pair=[("a", "asc")], ties=[], top=2) | bad))


def test_nan_is_one_value(spark):
    rows = [(1, "a", 1, float("nan"), i, "z", 0) for i in range(6)]
    got = found(spark, rows, 2, "pos")
    assert sorted((r[4], r[6], r[8]) for r in got) == [(0, 1, 6), (1, 2, 6)]
