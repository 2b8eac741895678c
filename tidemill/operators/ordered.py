"""Folds of a key's events in order, where one key may hold most of the events: no key is gathered in one row or one task.

Events are sorted by ranges of key and order, so that a hot key spreads over as many partitions as it fills. Each range is folded by itself
to something that composes with the ranges before it:

- a moving average step is an affine map, and so is any run of steps: a run is told by its length, its own average and its first value;
- a gate's next admission, or a part's next end, is a pointer from the moment it opens to the event that comes then. Within a range the pointers
  are followed at once, and between ranges by pointer doubling.

A range's times (8 bytes each) are held in one task; what is brought together is one row for each range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import staged


def changes(columns: list[pa.Array]) -> np.ndarray:
    """Whether each row's key differs from that of the row before; the first row's does. Nulls are equal."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    out[:1] = True
    for c in columns:
        a, b = c[:-1], c[1:]
        out[1:] |= pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return out


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each run of equal keys (the first `keys` columns) of sorted batches, as one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(changes([batch.column(i) for i in range(keys)])).tolist()
        same = held and not changes([pa.concat_arrays([held[-1].column(i)[-1:], batch.column(i)[:1]]) for i in range(keys)])[1]
        if held and not same:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def in_ranges(events: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """events sorted by key and order, over partitions of about equal size; rows that are equal in both are told apart by nothing, so order should have no ties."""
    sorting = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    return events.repartitionByRange(*sorting).sortWithinPartitions(*sorting)


def _fields(frame: DataFrame, names: list[str], more: str) -> T.StructType:
    return T.StructType([*[T.StructField(n, frame.schema[n].dataType) for n in names], *T._parse_datatype_string(more).fields])


def moving_average(events: DataFrame, by: list[str], order: list[str], value: Column, alpha: float) -> DataFrame:
    """(by, samples, ewma) of each key's values in order; the first value starts the average. Null values are left out, and keys without any.

    A key within one range is folded step by step. Of a key over several, each range's run (n values, their average b from the first value v on)
    maps the average m before it to b + (1 - alpha) ** n * (m - v); the runs, one a range, are combined by a window.
    """
    rows = events.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)], *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], value.cast("double").alias("value")).filter("value IS NOT NULL")
    keys, at = [f"k{i}" for i in range(len(by))], [f"o{i}" for i in range(len(order))]
    kept = 1 - alpha

    def run(batches):
        part, out = TaskContext.get().partitionId(), []

        def made():
            columns = [pa.array([r[i].as_py() for r in out], t) for i, t in enumerate(types)] + [pa.array(c) for c in zip(*[r[len(types)] for r in out], strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "part", "n", "b", "v"])

        types: list[pa.DataType] = []
        for table in runs(batches, len(keys)):
            types = [table.schema.field(i).type for i in range(len(keys))]
            values = table.column(len(keys)).to_numpy().tolist()
            m = values[0]
            for v in values[1:]:
                m = alpha * v + kept * m
            out.append((*[table.column(i)[0] for i in range(len(keys))], (part, len(values), m, values[0])))
            if len(out) >= 10_000:
                yield made()
                out.clear()
        if out:
            yield made()

    sorted_ = in_ranges(rows, keys, at).select(*keys, "value")
    found = sorted_.mapInArrow(run, _fields(sorted_, keys, "part long, n long, b double, v double"))
    line = Window.partitionBy(*keys).orderBy("part")
    after = F.coalesce(F.sum("n").over(line.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    first = F.row_number().over(line) == 1
    own = F.when(first, F.col("b")).otherwise(F.col("b") - F.pow(F.lit(kept), F.col("n")) * F.col("v"))
    parts = found.select(*keys, "n", (own * F.pow(F.lit(kept), after)).alias("share"))
    return parts.groupBy(*keys).agg(F.sum("n").alias("samples"), F.sum("share").alias("ewma")).select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], "samples", "ewma")


def walk(at: np.ndarray, opens: np.ndarray, gap: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Of gates that open at each of `opens`: (events let through, when the gate opens next) after the last of the sorted `at`. gap holds for each event.

    The first event at or after the opening is let through, and closes the gate until its own time plus gap. Pointers from event to event are followed by doubling.
    """
    n = len(at)
    again = at + gap
    # n stands for the end: it counts nothing and leads to itself. Of an event's own gap of 0 or less, the next event is the following one.
    to = np.append(np.maximum(np.searchsorted(at, again), np.arange(1, n + 1)), n)
    count, last = np.append(np.ones(n, np.int64), 0), np.append(np.arange(n), -1)
    while (to < n).any():
        further = last[to]
        last = np.where(further >= 0, further, last)
        count = count + count[to]
        to = to[to]
    start = np.searchsorted(at, opens)
    return count[start], np.where(start < n, again[last[start]], opens)


def passed(at: np.ndarray, opens: int, gap: np.ndarray | int) -> np.ndarray:
    """Whether each event is let through by a gate that opens at `opens`."""
    out, n = np.zeros(len(at), bool), len(at)
    again = at + gap
    i = int(np.searchsorted(at, opens))
    to = np.maximum(np.searchsorted(at, again), np.arange(1, n + 1)).tolist()
    while i < n:
        out[i] = True
        i = to[i]
    return out


def _spans(ranged: DataFrame, keys: list[str], total: bool) -> list:
    """Of each key that lies in several ranges: a row for each of them, with the key's number, the first and last `at`, and what to add to its totals."""
    own = Window.partitionBy(*keys)
    line = own.orderBy("part")
    found = ranged.groupBy(*keys, "part").agg(F.max("at").alias("last")).withColumn("n_parts", F.count("*").over(own))
    carry = F.coalesce(F.sum("last").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if total else F.lit(0)
    # Sorted by key, a range shares its first and its last key with others at most.
    rows = found.withColumn("carry", carry.cast("long")).filter("n_parts > 1").collect()
    number: dict[tuple, int] = {}
    return [(r, number.setdefault(tuple(r[k] for k in keys), len(number))) for r in sorted(rows, key=lambda r: r.part)]


def gates(events: DataFrame, by: list[str], order: list[str], at: Column, gap: int, opens: int | None = None, total: bool = False) -> DataFrame:
    """events' columns of by and order, at (long), `let` and `before`: whether a key's gate lets the event through, and how many it has let through before.

    A gate lets the first event through whose `at` is `opens` or more (None: the first of all), then the first that is `gap` or more after that
    one, and so on. Events go by at and order; with total, by order alone, and their `at` is the running total of the values given (0 or more), so that
    what is let through is what fills a part up to gap. Null values are left out, null keys are a key, no events give no rows.

    Where a key lies in several ranges, each range tells for each moment at which the gate may open in it how many events pass and when it opens next;
    such moments are only those that some event before leads to. Pointer doubling from moment to moment finds those that do occur.
    """
    if gap <= 0:
        raise ValueError("a gate is closed for some time")
    keys, last = [f"k{i}" for i in range(len(by))], [f"o{i}" for i in range(len(order))]
    spark = events.sparkSession
    rows = events.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], at.cast("long").alias("at"), *[F.col(c).alias(o) for c, o in zip(order, last, strict=True)]).filter("at IS NOT NULL")

    def numbered(batches):
        part, seen, held, so_far = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = [batch.column(i) for i in range(len(keys))]
            value = batch.column(len(keys)).to_numpy()
            if total:
                starts = changes(own)
                starts[0] = held is None or changes([pa.concat_arrays([a, b[:1]]) for a, b in zip(held, own, strict=True)])[1]
                sums = np.cumsum(value)
                begin = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
                value = sums - np.where(begin < 0, -so_far, np.where(begin > 0, sums[np.maximum(begin - 1, 0)], 0))
                held, so_far = [c[-1:] for c in own], int(value[-1])
            columns = [*own, pa.array(value, pa.int64()), *batch.columns[len(keys) + 1 :], pa.array(np.full(n, part, np.int64)), pa.array(np.arange(seen, seen + n))]
            seen += n
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "idx"])

    ranged = in_ranges(rows, keys, last if total else ["at", *last])
    ranged = staged(ranged.mapInArrow(numbered, _fields(rows, rows.columns, "part long, idx long")), "ranges")
    spans = _spans(ranged, keys, total)
    kinds = T.StructType([*[T.StructField(f"s_{k}", rows.schema[k].dataType) for k in keys], *T._parse_datatype_string("s_part long, kid long, carry long, opens long, n_before long").fields])
    entered: dict[tuple, tuple] = {}
    if spans:
        known = [(*[r[k] for k in keys], r.part, kid, r.carry, None, 0) for r, kid in spans]
        entered = _entered(_beside(ranged, spark.createDataFrame(known, kinds), keys).select("kid", "part", (F.col("at") + F.col("carry")).alias("at"), "idx"), [(kid, r.part, r.last + r.carry) for r, kid in spans], gap, opens)
    entries = spark.createDataFrame([(*[r[k] for k in keys], r.part, kid, r.carry, *entered[kid, r.part]) for r, kid in spans], kinds)
    dealt = _beside(ranged, entries, keys, "left").select("part", *keys, "idx", (F.col("at") + F.coalesce("carry", F.lit(0))).alias("at"), *last, F.when(F.col("kid").isNull(), F.lit(opens)).otherwise(F.col("opens")).cast("long").alias("opens"), F.coalesce("n_before", F.lit(0)).alias("n_before"), F.col("kid").isNotNull().alias("spans"))
    held_ = ["part", *keys]

    def told(batches):
        for table in runs(batches, len(held_)):
            values, at_first = table.column("at").to_numpy(), table.column("opens")[0].as_py()
            if at_first is None:
                # The key's first range, or one in which the gate does not open.
                let = np.zeros(len(values), bool) if table.column("spans")[0].as_py() else passed(values, int(values[0]), gap)
            else:
                let = passed(values, at_first, gap)
            before = table.column("n_before")[0].as_py() + np.cumsum(let) - let
            out = pa.table([*[table.column(c) for c in (*keys, *last)], table.column("at"), pa.array(let), pa.array(before, pa.int64())], names=[*keys, *last, "at", "let", "before"])
            yield from out.to_batches()

    in_order = dealt.repartition("part").sortWithinPartitions("part", "idx")
    found = in_order.mapInArrow(told, _fields(in_order, [*keys, *last], "at long, let boolean, before long"))
    return found.select(*[F.col(k).alias(c) for c, k in zip((*by, *order), (*keys, *last), strict=True)], "at", "let", "before")


def _beside(ranged: DataFrame, known: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """ranged with what is known of its keys' ranges: two rows for each range at most, so they are broadcast."""
    same = [ranged["part"] == known["s_part"], *[ranged[k].eqNullSafe(known[f"s_{k}"]) for k in keys]]
    return ranged.join(F.broadcast(known), same, how)


def _entered(rows: DataFrame, parts: list[tuple[int, int, int]], gap: int, opens: int | None) -> dict[tuple[int, int], tuple[int | None, int]]:
    """For each (key number, range) of `parts` (with its last `at`): when the gate opens that lets its first event through (None: it does not), and how
    many were let through before the range. rows: kid, part, idx, at of those ranges."""
    spark = rows.sparkSession
    of: dict[int, tuple[list[int], list[int]]] = {}
    for kid, part, end in parts:
        own = of.setdefault(kid, ([], []))
        own[0].append(part)
        own[1].append(end)

    def where(kid: int, moments: np.ndarray, after: int) -> np.ndarray:
        """The first range after `after` that reaches each moment; -1: none does."""
        own, ends = (np.array(x) for x in of[kid])
        ends[own <= after] = np.iinfo(np.int64).min
        at = np.searchsorted(np.maximum.accumulate(ends), moments)
        return np.append(own, -1)[at]

    lowest = int(np.iinfo(np.int64).min)
    first = lowest if opens is None else opens
    begins = [(kid, first, int(where(kid, np.array([first + (opens is None)]), -1)[0])) for kid in of]

    def exits(key, frame):
        kid, part = int(key[0]), int(key[1])
        at = np.sort(frame["at"].to_numpy())
        moments = np.unique(walk(at, at, gap)[1])
        to = where(kid, moments, part)
        return pd.DataFrame({"kid": kid, "moment": moments[to >= 0], "part": to[to >= 0]})

    schema = "kid long, moment long, part long"
    moments = rows.groupBy("kid", "part").applyInPandas(exits, schema).union(spark.createDataFrame(begins, schema).filter("part >= 0")).distinct()

    def hops(key, events, asked):
        kid, part = int(key[0]), int(key[1])
        if not len(asked) or not len(events):
            return pd.DataFrame({"kid": [], "moment": [], "part": [], "n": [], "to": [], "to_part": []})
        count, to = walk(np.sort(events["at"].to_numpy()), asked["moment"].to_numpy(), gap)
        return pd.DataFrame({"kid": kid, "moment": asked["moment"], "part": part, "n": count, "to": to, "to_part": where(kid, to, part)})

    step = staged(rows.groupBy("kid", "part").cogroup(moments.groupBy("kid", "part")).applyInPandas(hops, "kid long, moment long, part long, n long, to long, to_part long"), "hops")
    levels, length = [step], 1
    while length < max(len(p) for p, _ in of.values()):
        a, b = levels[-1].alias("a"), levels[-1].alias("b")
        both = a.join(b, (F.col("a.kid") == F.col("b.kid")) & (F.col("a.to") == F.col("b.moment")) & (F.col("a.to_part") == F.col("b.part")))
        levels.append(staged(both.select("a.kid", "a.moment", "a.part", (F.col("a.n") + F.col("b.n")).alias("n"), "b.to", "b.to_part"), "hops"))
        length *= 2
    seen = spark.createDataFrame([(kid, m, p, 0) for kid, m, p in begins if p >= 0], "kid long, moment long, part long, so_far long")
    for level in reversed(levels):
        a, b = seen.alias("a"), level.alias("b")
        there = a.join(b, (F.col("a.kid") == F.col("b.kid")) & (F.col("a.moment") == F.col("b.moment")) & (F.col("a.part") == F.col("b.part"))).filter("b.to_part >= 0")
        seen = staged(seen.union(there.select("a.kid", F.col("b.to"), F.col("b.to_part"), F.col("a.so_far") + F.col("b.n"))).distinct(), "entries")
    # One moment for each range at most: those that do occur.
    met = {(r.kid, r.part): (r.moment, r.so_far, r.n) for r in seen.join(step, ["kid", "moment", "part"]).select("kid", "part", "moment", "so_far", "n").collect()}
    out: dict[tuple[int, int], tuple[int | None, int]] = {}
    for kid, (own, _) in of.items():
        so_far = 0
        for part in own:
            moment, before, n = met.get((kid, part), (None, so_far, 0))
            out[kid, part] = moment, before
            so_far = before + n
    return out


def admitted(events: DataFrame, by: list[str], order: list[str], time: Column, gap: int) -> DataFrame:
    """Events (by, order, at) that a rate gate lets through: the first, then one if the last it let through is `gap` or longer ago."""
    return gates(events, by, order, time, gap).filter("let").drop("let", "before")


def rotated(events: DataFrame, by: list[str], order: list[str], size: Column, cap: int) -> DataFrame:
    """(by, order, part): the part, from 1, that each write goes to; a part that has reached the cap is closed after the write. No cap: one part.
    A null size is 0."""
    if cap <= 0:
        return events.select(*by, *order, F.lit(1).alias("part"))
    found = gates(events, by, order, F.coalesce(size.cast("long"), F.lit(0)), cap, opens=cap, total=True)
    return found.select(*by, *order, (F.col("before") + 1).cast("int").alias("part"))
