"""Order-sensitive measures over an event log: moving averages, failures, streaks, cooldowns, rate gates, gaps.

Folds of a key's events in order (moving average, rate gate, rotation) are in `ordered`, which splits a hot key over ranges; the functions on
arrays here are for values that are at hand in one row. The others are windows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import moving_average

ALPHA = 0.3


@dataclass(frozen=True)
class Options:
    """Limits of endpoints. Values that make no sense fall back to the defaults."""

    fail_budget: float = 5
    cooldown_ms: int = 900_000
    latency_ref_ms: int = 3000
    scale_min: float = 1.0
    scale_max: float = 4.0

    def normalised(self) -> Options:
        d = Options()
        low = self.scale_min if self.scale_min > 0 else d.scale_min
        return Options(self.fail_budget if self.fail_budget > 0 else d.fail_budget, self.cooldown_ms if self.cooldown_ms >= 0 else d.cooldown_ms, self.latency_ref_ms if self.latency_ref_ms > 0 else d.latency_ref_ms, low, self.scale_max if self.scale_max >= low else max(low, d.scale_max))


def micros(ts: str | Column) -> Column:
    """Microseconds of a timestamp, with or without a time zone."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def ewma(values: Column, alpha: float = ALPHA) -> Column:
    """Moving average of an array of doubles: the first value starts it."""
    return F.aggregate(values, F.lit(None).cast("double"), lambda a, v: F.coalesce(F.lit(alpha) * v + F.lit(1 - alpha) * a, v))


def late_sample(spent: Column, budget: Column, share: float = 0.1) -> Column:
    """The sample that a step which ran into its budget leaves: null for quick steps, never more than the budget."""
    return F.when(spent >= budget * share, F.least(spent, budget))


def fetch_samples(fetches: DataFrame, budget_ms: int, share: float = 0.1) -> DataFrame:
    """Latency samples (endpoint, ts, id, kind, ms) of timed fetches (endpoint, ts, id, ms, ok): what a good one took, or a failed one as late_sample() says."""
    budget = F.lit(budget_ms).cast("long")
    ms = F.when(F.col("ok"), F.col("ms")).otherwise(late_sample(F.col("ms"), budget, share)).cast("long")
    return fetches.select("endpoint", "ts", "id", F.lit("latency").alias("kind"), ms.alias("ms")).filter("ms > 0")


def scaled_timeout(base: Column, latency: Column, o: Options) -> Column:
    scale = F.least(F.greatest(latency / o.latency_ref_ms, F.lit(o.scale_min)), F.lit(o.scale_max))
    return F.when((latency > 0) & (base > 0), base * scale).otherwise(base)


def fails_since_success(events: DataFrame, by: list[str], order: list[str], success: Column, weight: Column) -> DataFrame:
    """events with `fails`: the weights summed since the key's last success, this event included."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = events.withColumns({"_ok": F.sum(success.cast("int")).over(w), "_w": F.when(success, 0.0).otherwise(weight)})
    again = Window.partitionBy(*by, "_ok").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("fails", F.sum("_w").over(again)).drop("_ok", "_w")


def longest_streak(events: DataFrame, by: list[str], order: list[str], bad: Column, limit: int) -> DataFrame:
    """by, longest run of consecutive bad events, and whether it reached the limit. Keys without a bad event have 0."""
    all_, own = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by, "_bad").orderBy(*order)
    marked = events.withColumn("_bad", bad)
    runs = marked.withColumn("_run", F.row_number().over(all_) - F.row_number().over(own))
    sizes = runs.groupBy(*by, "_bad", "_run").agg(F.count("*").alias("_n"))
    found = sizes.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("_bad"), F.col("_n"))), F.lit(0)).alias("longest"))
    return found.withColumn("reached", F.col("longest") >= limit)


def stalls(events: DataFrame, by: list[str], order: list[str], ts: str, budget_seconds: float) -> DataFrame:
    """Events before which nothing came for the budget or longer, with gap_us."""
    before = F.lag(ts).over(Window.partitionBy(*by).orderBy(*order))
    gap = micros(ts) - micros(before)
    return events.withColumn("gap_us", gap).filter(F.col("gap_us") >= int(budget_seconds * 1e6))


def admitted(times: Column, gap: int | Column) -> Column:
    """How many of an array of times (long, in order) a gate lets through: one if the last it let through is `gap` or longer ago."""
    gap = F.lit(gap) if isinstance(gap, int) else gap
    start = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda s, t: F.when(s["last"].isNull() | (t - s["last"] >= gap), F.struct(t.alias("last"), (s["n"] + 1).alias("n"))).otherwise(s)
    return F.aggregate(times, start, step)["n"]


def rotated(sizes: Column, cap: int) -> Column:
    """For short arrays (`ordered.rotated` is for tables): the part, from 1, that each of an array of sizes (long, in order) is written to: a part that has reached the cap is closed after the write. No cap: one part."""
    if cap <= 0:
        return F.transform(sizes, lambda _: F.lit(1))
    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit(1).alias("part"), F.array().cast("array<int>").alias("out"))

    def step(s, size):
        total, out = s["held"] + size, F.concat(s["out"], F.array(s["part"]))
        full = total >= cap
        return F.struct(F.when(full, F.lit(0).cast("long")).otherwise(total).alias("held"), F.when(full, s["part"] + 1).otherwise(s["part"]).alias("part"), out.alias("out"))

    return F.aggregate(sizes, start, step)["out"]


def cooling(events: DataFrame, by: list[str], order: list[str], ts: str, starts: Column, seconds: int) -> DataFrame:
    """events with `until`: the end of the cooldown that the latest earlier start set, and `cooling`: whether the event lies within it."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    until = F.max(F.when(starts, F.col(ts))).over(w) + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
    return events.withColumn("until", until).withColumn("cooling", F.coalesce(F.col(ts) < F.col("until"), F.lit(False)))


def islands(events: DataFrame, by: list[str], order: list[str], ts: str, seconds: int) -> DataFrame:
    """Frozen stretches: each event freezes for `seconds` from itself, and one within a freeze extends it. by, first, last, n_events, frozen_until."""
    w = Window.partitionBy(*by).orderBy(*order)
    gap = micros(ts) - micros(F.lag(ts).over(w))
    marked = events.withColumn("_new", F.coalesce(gap > seconds * 1_000_000, F.lit(True)).cast("int")).withColumn("_island", F.sum("_new").over(w))
    found = marked.groupBy(*by, "_island").agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n_events"))
    return found.withColumn("frozen_until", F.col("last") + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))).drop("_island")


def speed(latency: Column, reference: float) -> Column:
    return F.when(latency.isNull() | (latency <= 0), "unmeasured").when(latency > 2 * reference, "SLOW").when(latency < reference / 2, "fast").otherwise("")


def pick_weight(latency: Column, fails: Column, reference: float) -> Column:
    """An endpoint's weight in a draw: half for a slow one, less with each failure."""
    return F.when(latency > 2 * reference, 0.5).otherwise(1.0) / (1 + fails)


def drawn(endpoints: DataFrame, weight: Column, seed: int) -> DataFrame:
    """One endpoint by weighted draw: the largest of u ** (1 / weight)."""
    return endpoints.withColumn("_d", F.pow(F.rand(seed), 1 / weight)).agg(F.max_by("endpoint", "_d").alias("endpoint"))


def assigned(events: DataFrame, endpoints: DataFrame, weight: Column, key: str, seed: int = 0, most: int = 1000) -> DataFrame:
    """events with `endpoint`: each draws one by weight, from a hash of its key and seed, so that a task that runs again draws the same.

    The pool is a list that users keep, of at most `most` endpoints, and part of the plan. Weights of 0 or less are never drawn; without any others there is no endpoint.
    """
    pool = sorted((r.endpoint, r.w) for r in endpoints.select("endpoint", weight.cast("double").alias("w")).filter("w > 0").limit(most + 1).collect())
    if len(pool) > most:
        raise ValueError(f"a pool of more than {most} endpoints")
    if not pool:
        return events.withColumn("endpoint", F.lit(None).cast("string"))
    sums = list(accumulate(w for _, w in pool))
    drawn_ = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 11) / F.lit(float(1 << 53)) * F.lit(sums[-1])
    first = F.size(F.filter(F.lit(sums), lambda x: x <= drawn_))
    return events.withColumn("endpoint", F.get(F.lit([e for e, _ in pool]), F.least(first, F.lit(len(pool) - 1))))


def usable(endpoints: DataFrame, now: Column, o: Options) -> DataFrame:
    """endpoints (fails, until) with budget left and no cooldown running."""
    return endpoints.filter((F.coalesce("fails", F.lit(0)) < o.fail_budget) & F.coalesce(F.col("until") <= now, F.lit(True)))


def soonest(endpoints: DataFrame, now: Column) -> DataFrame:
    """When none is usable: the one whose cooldown ends first, or any if none is cooling."""
    return endpoints.agg(F.coalesce(F.min_by("endpoint", F.when(F.col("until") > now, F.struct("until", "endpoint"))), F.min("endpoint")).alias("endpoint"))


def summary(events: DataFrame, o: Options) -> DataFrame:
    """Per endpoint of an event log (endpoint, ts, id, kind, ms): counts, weighted failures since the last success, mean attempt, moving latency, speed."""
    ok, fail = F.col("kind") == "ok", F.col("kind").isin("fail", "soft_fail")
    weight = F.when(F.col("kind") == "fail", 1.0).when(F.col("kind") == "soft_fail", 0.5).otherwise(0.0)
    run = fails_since_success(events, ["endpoint"], ["ts", "id"], ok, weight)
    of = lambda k: F.count_if(F.col("kind") == k).alias
    found = run.groupBy("endpoint").agg(of("ok")("oks"), F.count_if(fail).alias("failures"), of("cooldown")("cooldowns"), of("attempt")("attempts"), F.avg(F.when(F.col("kind") == "attempt", F.col("ms"))).alias("mean_attempt_ms"), F.max_by("fails", F.struct("ts", "id")).alias("fails"))
    latency = moving_average(events.filter((F.col("kind") == "latency") & (F.col("ms") > 0)), ["endpoint"], ["ts", "id"], F.col("ms"), ALPHA)
    out = found.join(latency.select("endpoint", F.col("ewma").alias("latency_ms")), "endpoint", "left")
    return out.withColumn("speed", speed(F.col("latency_ms"), o.latency_ref_ms))


def probe_alive(probes: DataFrame) -> DataFrame:
    """Probes (pos, endpoint, status, error, latency_ms, port_only) that answered; 200 and 429 are answers. Order is pos."""
    return probes.filter(F.col("error").isNull() & F.col("status").isin(200, 429))


def alive_in_order(probes: DataFrame) -> DataFrame:
    """The probes that answered, delivered in the order of the list that they were made from: ranges of pos to tasks, sorted within each."""
    return probe_alive(probes).repartitionByRange("pos").sortWithinPartitions("pos")


def seeded(endpoints: DataFrame, probes: DataFrame) -> DataFrame:
    """endpoints with the latency of their probe, where it measured one."""
    measured = probe_alive(probes).filter("NOT port_only AND latency_ms > 0").select("endpoint", "latency_ms")
    return endpoints.join(measured, "endpoint")
