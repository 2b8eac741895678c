"""Whether pages keep their contract, whether a result set is whole, and what becomes of a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markers import hiccup, timed_out
from ..functions.text import action_seconds


def page_violation(page: Column, start: Column, n_rows: Column, last: Column, size: int, strict: bool = True) -> Column:
    """What is wrong with a page, or null: wrong_start, empty, or (strict) short before the last page."""
    bad = F.when(start != (page - 1) * size, "wrong_start").when(n_rows <= 0, "empty")
    return bad.when((n_rows != size) & (page < last), "short") if strict else bad


def full_walk(shard_count: Column, start_page: Column, end_page: Column, max_pages: Column) -> Column:
    return (shard_count <= 1) & (start_page <= 1) & (end_page <= 0) & (max_pages <= 0)


def missing(count: Column, rows: Column, full: Column, size: int) -> Column:
    """Rows missing, if at least a page of them is; else null. Unknown counts (null or negative) are never short."""
    return F.when(full & (count >= 0) & (rows >= 0) & (count - rows >= size), count - rows)


def written_before(page: Column, rows: Column) -> Column:
    """Rows that a checkpoint accounts for: none without a checkpoint, unknown (null) for one that has its page only."""
    return F.when(F.coalesce(page, F.lit(0)) > 0, rows).otherwise(F.lit(0).cast("long"))


def gate(finished: DataFrame) -> DataFrame:
    """finished: (query, shard, n_results, shard_count). Per query the shards that are done, the largest count, and whether none is left.

    Shards are a set: one that is walked again counts once, and restarting one does not forget the others.
    """
    done = finished.groupBy("query", "shard").agg(F.max("n_results").alias("n_results"), F.max("shard_count").alias("shard_count"))
    found = done.groupBy("query").agg(F.count("*").alias("shards_done"), F.max("n_results").alias("n_results"), F.max("shard_count").alias("shard_count"))
    return found.withColumn("last", F.col("shards_done") >= F.col("shard_count"))


def reset(finished: DataFrame, restarted: DataFrame) -> DataFrame:
    """finished without the shards (query, shard) that are walked again: they count anew when they finish."""
    return finished.join(restarted.select("query", "shard"), ["query", "shard"], "left_anti")


def run_counters(walks: DataFrame) -> DataFrame:
    """One row: how many walks (outcome, n_rows) ended in each way, and the rows of those that count."""
    of = lambda k: F.count_if(F.col("outcome") == k).alias(k)
    rows = F.coalesce(F.sum(F.when(F.col("outcome") != "failed", F.col("n_rows"))), F.lit(0)).alias("n_rows")
    return walks.agg(*map(of, ("collected", "shard", "partial", "short", "failed")), rows)


def outcome(partial: Column, is_sharded: Column, is_last: Column, short_by: Column, short_before: Column) -> Column:
    """partial, shard, short or collected. A set that is short again is accepted. Shards have no total of their own to compare."""
    return F.when(partial, "partial").when(is_sharded & ~is_last, "shard").when(~is_sharded & short_by.isNotNull() & ~short_before, "short").otherwise("collected")


# What an attempt's result does to its endpoint, to the block streak (null: nothing), to a shard gate, and to the task.
TRANSITIONS = (
    ("results", "success", 0, False, "done"),
    ("no results", "success", 0, False, "done"),
    ("not results", "cooldown", 1, False, "requeue"),
    ("blocked", "cooldown", 1, True, "requeue"),
    ("proxy error", "fail", 0, True, "requeue"),
    ("block", "cooldown", 1, True, "requeue"),
    ("application error", "cooldown", 1, True, "requeue"),
    ("maintenance", "none", None, True, "requeue"),
    ("timeout", "soft_fail", None, True, "requeue"),
    ("hiccup", "soft_fail", 0, True, "requeue"),
    ("error", "fail", 0, True, "requeue"),
    ("skip", "cooldown", 1, True, "requeue"),
    ("sleep", "cooldown", 1, False, "retry"),
    ("pause", "cooldown", 1, False, "retry"),
)


def attempt_result(kind: Column, error: Column, rule: Column) -> Column:
    """An attempt's result, for transition(). With results it is that. Else what the first rule (a struct with action, or null) that its page holds
    says, whatever error it ended with; else the class of its error; else its page's kind."""
    action = rule["action"]
    of_rule = F.when(action == "skip", "skip").when(action == "pauseAll", "pause").when(action_seconds(action).isNotNull(), "sleep")
    of_error = F.when(timed_out(error), "timeout").when(hiccup(error), "hiccup").otherwise("error")
    return F.when(error.isNull() & (kind == "results"), kind).otherwise(F.coalesce(of_rule, F.when(error.isNotNull(), of_error), kind, F.lit("error")))


def transition(result: Column, attempts: Column, max_attempts: int) -> Column:
    """struct(effect, streak, resets_gate, state) of an attempt's result; a task that has spent its attempts without an end fails.

    attempts counts the attempts before this one; retries count as well.
    """
    made = lambda e, s, g, t: F.struct(F.lit(e).alias("effect"), F.lit(s).cast("int").alias("streak"), F.lit(g).alias("resets_gate"), F.lit(t).alias("state"))
    chain = F.when(attempts >= max_attempts, made("none", None, False, "failed"))
    for name, *rest in TRANSITIONS:
        chain = chain.when(result == name, made(*rest))
    return chain.otherwise(made("fail", 0, True, "requeue"))


def settled(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """attempts: (query, seq, result), seq from 0 in order. One row per query: its attempts so far, last result and state (done, failed or open).

    The first end wins: what comes after it is ignored.
    """
    seen = attempts.select("query", "seq", "result", transition(F.col("result"), F.col("seq"), max_attempts)["state"].alias("state"))
    ends = F.when(F.col("state").isin("done", "failed"), F.col("seq"))
    found = seen.groupBy("query").agg(F.min(ends).alias("end"), F.max("seq").alias("last"), F.min_by("state", F.coalesce(ends, F.lit(2**31 - 1))).alias("first_state"), F.max_by("result", "seq").alias("last_result"), F.min_by("result", F.coalesce(ends, F.lit(2**31 - 1))).alias("end_result"))
    return found.select("query", (F.coalesce("end", "last") + 1).alias("attempts"), F.when(F.col("end").isNotNull(), F.col("end_result")).otherwise(F.col("last_result")).alias("result"), F.when(F.col("end").isNotNull(), F.col("first_state")).otherwise("open").alias("state"))
