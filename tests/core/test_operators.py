from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import dedupe, rules, tasks, telemetry, verdict

T0 = datetime(2024, 1, 1)


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_dedupe(spark):
    rows = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 3, None), (None, 4, "n"), (None, 5, "m")], "k string, pos int, v string")
    assert sorted(map(str, dedupe.first_of(rows, ["k"], ["pos"]).collect())) == sorted(map(str, [r for r in rows.collect() if r.pos in (1, 3, 4)]))
    fresh = dedupe.new_rows(rows, spark.createDataFrame([("a",)], "k string"), ["k"], ["pos"])
    assert {(r.k, r.pos) for r in fresh.collect()} == {("b", 3), (None, 4)}
    listed = spark.createDataFrame([(0, " x "), (1, ""), (2, "y"), (3, "x")], "pos int, v string")
    assert {tuple(r) for r in dedupe.distinct_first(listed, F.col("v"), "pos").collect()} == {("x", 0), ("y", 2)}
    state = spark.createDataFrame([("q", "1"), ("q", "1"), ("q", "2"), ("done", "1")], "query string, row_key string")
    left = dedupe.open_keys(state, spark.createDataFrame([("done",)], "query string"), "query")
    assert left.count() == 2 and tuple(dedupe.totals(left, "query", "row_key").first()) == (1, 2)


def test_tasks(spark):
    names = spark.createDataFrame([(0, "ACME"), (1, "acme"), (2, "Other"), (3, " Fresh ")], "pos int, line string")
    got = tasks.build(names, spark.createDataFrame([("acme",)], "name string"))
    assert [r.name for r in got.orderBy("pos").collect()] == ["other", "fresh"]
    assert [(r.name, r.shard) for r in tasks.sharded(got, 3).orderBy("pos", "shard").collect()] == [(n, s) for n in ("other", "fresh") for s in range(3)]
    assert tasks.sharded(got, 0).select("shard_count").distinct().collect() == [(1,)]


def test_blocks(spark):
    def blocks(rows, size, n):
        df = spark.range(max(n, 1)).select(tasks.block(F.lit(rows), F.lit(size), F.lit(n), F.col("id")).alias("b"))
        return [r.b and tuple(r.b) for r in df.collect()]

    assert blocks(955, 100, 1) == [(1, 10)] and blocks(1000, 100, 3) == [(1, 4), (5, 8), (9, 10)]
    assert blocks(42, 100, 4) == [(1, 1), None, None, None] and blocks(0, 100, 2) == [None, None] and blocks(5, 0, 1) == [None]
    big = blocks(1_542_912, 100, 4)
    assert [p for a, b in big for p in range(a, b + 1)] == list(range(1, 15_431))
    pages = spark.range(1, 15_431).select("id", tasks.shard_of_page(F.col("id"), F.lit(1_542_912), F.lit(100), F.lit(4)).alias("s"))
    assert pages.groupBy("s").agg(F.min("id"), F.max("id")).count() == 4 and {(r.s, r.a, r.b) for r in pages.groupBy("s").agg(F.min("id").alias("a"), F.max("id").alias("b")).collect()} == {(i, *b) for i, b in enumerate(big)}


def test_resume_limit_and_order(spark):
    pages = spark.createDataFrame([(q, p) for q in "ab" for p in range(9, 0, -1)], "query string, page int")
    at = spark.createDataFrame([("a", 4)], "query string, page int")
    left = tasks.resumed(pages, at, ["query"], end_page=8)
    assert sorted(r.page for r in left.filter("query = 'a'").collect()) == [5, 6, 7, 8] and left.filter("query = 'b'").count() == 8
    few = tasks.limited(left, ["query"], 4)
    assert {(r["query"], r.page, r.partial) for r in few.collect()} == {("a", p, False) for p in range(5, 9)} | {("b", p, True) for p in range(1, 5)}
    assert [r.page for r in tasks.in_page_order(pages.filter("query = 'a'")).collect()] == list(range(1, 10))


def test_verdicts(spark):
    v = lambda *a, **k: verdict.page_violation(*[F.lit(x) for x in a], 100, **k)
    assert tuple(one(spark, v(2, 100, 100, 3), v(2, 90, 100, 3), v(2, 100, 0, 3), v(2, 100, 50, 3), v(3, 200, 50, 3), v(2, 100, 50, 3, strict=False))) == (None, "wrong_start", "empty", "short", None, None)
    m = lambda c, r, full=True: verdict.missing(F.lit(c).cast("long"), F.lit(r).cast("long"), F.lit(full), 100)
    assert tuple(one(spark, m(1000, 900), m(1000, 901), m(1000, 1100), m(1000, None), m(None, 5), m(1000, 0), m(1000, 0, False))) == (100, None, None, None, None, 1000, None)
    assert tuple(one(spark, verdict.written_before(F.lit(None).cast("int"), F.lit(None).cast("long")), verdict.written_before(F.lit(3), F.lit(None).cast("long")), verdict.written_before(F.lit(3), F.lit(300).cast("long")))) == (0, None, 300)
    o = lambda p, s, last, short, before: verdict.outcome(F.lit(p), F.lit(s), F.lit(last), F.lit(short).cast("long"), F.lit(before))
    assert tuple(one(spark, o(True, False, True, 500, False), o(False, True, False, None, False), o(False, True, True, 500, False), o(False, False, True, 500, False), o(False, False, True, 500, True), o(False, False, True, None, False))) == ("partial", "shard", "collected", "short", "collected", "collected")
    done = spark.createDataFrame([("q", s, c, 4) for s, c in ((0, 100), (1, 300), (2, 200), (1, 300))] + [("r", s, c, 4) for s, c in enumerate((100, 300, 200, 250))], "query string, shard int, n_results int, shard_count int")
    assert {tuple(r) for r in verdict.gate(done).collect()} == {("q", 3, 300, 4, False), ("r", 4, 300, 4, True)}
    log = [("a", 0, "blocked"), ("a", 1, "results"), ("a", 2, "blocked"), ("b", 0, "timeout"), ("c", 0, "error"), ("c", 1, "error"), ("c", 2, "results"), ("d", 0, "sleep"), ("d", 1, "no results")]
    got = verdict.settled(spark.createDataFrame(log, "query string, seq long, result string"), 2)
    assert {tuple(r) for r in got.collect()} == {("a", 2, "results", "done"), ("b", 1, "timeout", "open"), ("c", 3, "results", "failed"), ("d", 2, "no results", "done")}


def test_rules(spark):
    listed = rules.listed(spark.createDataFrame([(2, "skip", "b"), (1, "sleep5", "a"), (3, "skip", "A")], "ord int, action string, marker string"))
    for more in ([], [(100 + i, "skip", f"never{i}") for i in range(60)]):
        df = spark.createDataFrame([(0, "xb"), (1, "ba"), (2, "A"), (3, "none"), (4, None)], "i int, t string").orderBy("i")
        assert [r.r and r.r.action for r in df.select(rules.matched(F.col("t"), listed + more).alias("r")).collect()] == ["skip", "sleep5", "skip", None, None]


def log(spark, rows):
    return spark.createDataFrame([(e, T0 + timedelta(seconds=s), i, k, ms) for i, (e, s, k, ms) in enumerate(rows)], "endpoint string, ts timestamp, id long, kind string, ms long")


def test_telemetry(spark):
    o = telemetry.Options()
    scaled = [telemetry.scaled_timeout(F.lit(120.0), F.lit(x).cast("double"), telemetry.Options(latency_ref_ms=r)) for x, r in ((None, 3000), (9000, 3000), (1000, 3000), (600_000, 1000))]
    assert tuple(one(spark, *scaled)) == (120.0, 360.0, 120.0, 480.0)
    assert tuple(one(spark, telemetry.ewma(F.array(F.lit(10.0), F.lit(1.0))), telemetry.late_sample(F.lit(9000), F.lit(5000)), telemetry.late_sample(F.lit(10), F.lit(5000)))) == (7.3, 5000, None)
    assert telemetry.Options(fail_budget=0, latency_ref_ms=-1, scale_min=0, scale_max=0.5).normalised() == o
    events = log(spark, [("a", 0, "fail", 0), ("a", 1, "soft_fail", 0), ("a", 2, "ok", 0), ("a", 3, "soft_fail", 0), ("a", 4, "latency", 10_000), ("a", 5, "latency", 1000), ("b", 0, "attempt", 10), ("b", 1, "attempt", 30), ("b", 2, "cooldown", 0)])
    got = {r.endpoint: r for r in telemetry.summary(events, o).collect()}
    assert (got["a"].oks, got["a"].failures, got["a"].fails, round(got["a"].latency_ms), got["a"].speed) == (1, 3, 0.5, 7300, "SLOW")
    assert (got["b"].attempts, got["b"].mean_attempt_ms, got["b"].cooldowns, got["b"].speed) == (2, 20.0, 1, "unmeasured")
    assert tuple(one(spark, telemetry.admitted(F.array(*[F.lit(x).cast("long") for x in (0, 5, 9, 10, 19, 25)]), 10), telemetry.rotated(F.array(*[F.lit(x).cast("long") for x in (5, 5, 1, 20, 1)]), 10), telemetry.rotated(F.array(F.lit(9).cast("long")), 0))) == (3, [1, 1, 2, 2, 3], [1])
    streak = telemetry.longest_streak(events, ["endpoint"], ["ts", "id"], F.col("kind").isin("fail", "soft_fail"), 2)
    assert {tuple(r) for r in streak.collect()} == {("a", 2, True), ("b", 0, False)}


def test_freezes_cooldowns_and_picks(spark):
    marks = log(spark, [("w", 0, "x", 0), ("w", 200, "x", 0), ("w", 700, "x", 0)])
    got = telemetry.islands(marks, ["endpoint"], ["ts", "id"], "ts", 300).orderBy("first").collect()
    assert [(r.n_events, r.frozen_until) for r in got] == [(2, T0 + timedelta(seconds=500)), (1, T0 + timedelta(seconds=1000))]
    cool = telemetry.cooling(marks, ["endpoint"], ["ts", "id"], "ts", F.lit(True), 300).orderBy("id").collect()
    assert [r.cooling for r in cool] == [False, True, False]
    assert [r.gap_us for r in telemetry.stalls(marks, ["endpoint"], ["ts", "id"], "ts", 300).collect()] == [500_000_000]
    ends = spark.createDataFrame([("a", 5.0, None), ("b", 0.5, T0 + timedelta(seconds=60)), ("c", 0.0, T0 + timedelta(seconds=30)), ("d", 4.5, T0)], "endpoint string, fails double, until timestamp")
    now = F.lit(T0)
    assert [r.endpoint for r in telemetry.usable(ends, now, telemetry.Options()).collect()] == ["d"]
    assert telemetry.soonest(ends, now).first()[0] == "c" and telemetry.soonest(ends.filter("until IS NULL"), now).first()[0] == "a"
    assert tuple(one(spark, telemetry.pick_weight(F.lit(7000.0), F.lit(1.0), 3000), telemetry.pick_weight(F.lit(None).cast("double"), F.lit(0.0), 3000))) == (0.25, 1.0)
    draws = [telemetry.drawn(ends, F.when(F.col("endpoint") == "a", 1e6).otherwise(1e-6), seed).first()[0] for seed in range(3)]
    assert draws == ["a"] * 3
    probes = spark.createDataFrame([(0, "x", 200, None, 10, False), (1, "y", 429, None, 0, False), (2, "z", 500, None, 5, False), (3, "v", 200, "refused", 5, False), (4, "u", 200, None, 5, True)], "pos int, endpoint string, status int, error string, latency_ms long, port_only boolean")
    assert [r.endpoint for r in telemetry.probe_alive(probes).orderBy("pos").collect()] == ["x", "y", "u"]
    assert [tuple(r) for r in telemetry.seeded(probes.select("endpoint"), probes).collect()] == [("x", 10)]


def test_a_rule_counts_before_an_error_but_not_before_results(spark):
    from tidemill.operators import rules, verdict

    rows = [("results", None, "m1"), ("results", "EOF", "m1"), ("no results", None, "m2"), ("no results", None, "x"), (None, "Timeout 3 exceeded", "m3"), (None, "Timeout 3 exceeded", "x"), ("block", "HTTP 500", "x"), (None, None, "x")]
    own = [(0, "skip", "m1"), (1, "pauseAll", "m2"), (2, "sleep9", "m3")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, kind string, error string, body string")
    got = frame.orderBy("i").select(verdict.attempt_result(F.col("kind"), F.col("error"), rules.matched(F.col("body"), own)).alias("r")).collect()
    assert [r.r for r in got] == ["results", "skip", "pause", "no results", "sleep", "timeout", "error", "error"]
    assert verdict.attempt_result(F.lit("block"), F.lit(None).cast("string"), rules.matched(F.lit("x"), [])) is not None


def test_weighted_assignment(spark):
    pool = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("none", 0.0), ("less", -1.0)], "endpoint string, w double")
    events = spark.range(4000).withColumn("part", F.lit(1))
    got = telemetry.assigned(events, pool, F.col("w"), "id", seed=1)
    counts = {r.endpoint: r["count"] for r in got.groupBy("endpoint").count().collect()}
    assert counts.keys() == {"a", "b"} and abs(counts["b"] - 3000) < 5 * (4000 * 3 / 16) ** 0.5 and got.columns == ["id", "part", "endpoint"]
    # Another order of the pool and other partitions draw the same; another seed does not.
    again = telemetry.assigned(events.repartition(7), pool.orderBy(F.desc("endpoint")), F.col("w"), "id", seed=1)
    assert again.exceptAll(got).isEmpty() and not telemetry.assigned(events, pool, F.col("w"), "id", seed=2).exceptAll(got).isEmpty()
    assert {r.endpoint for r in telemetry.assigned(events.limit(3), pool.limit(0), F.col("w"), "id").collect()} == {None}
    with pytest.raises(ValueError):
        telemetry.assigned(events, pool, F.col("w"), "id", most=1)
