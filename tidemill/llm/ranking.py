"""Ranks within groups, ties included, from a histogram of the compared pairs: no group is ever gathered or sorted in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, staged, table

PLACES = ("pos", "rank", "dense")


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Where a row's key differs from that of the row before it (not told for the first); nulls are equal, and so are NaN."""
    changed = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        a, b = c[:-1], c[1:]
        differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(c.type):
            differs &= ~pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False).to_numpy(zero_copy_only=False)
        changed |= differs | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return changed


def _numbered(keys: int, offset: int, top: int | None):
    """For the rows of a sorted partition, whose first `keys` columns are the key: partition, index in it, and `local`, the number within the key
    there. With top, rows that cannot be among the first `top` are left out, but for the partition's last row, which tells how many there were."""

    def run(batches):
        part, seen, local, before = TaskContext.get().partitionId(), 0, 0, None
        last = None

        def out(batch, index, number):
            extra = [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(index, pa.int64()), pa.array(number, pa.int64())]
            return pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "part", "idx", "local"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = [batch.column(i) for i in range(keys)]
            first = True if before is None else bool(_changes([pa.concat_arrays([b, c[:1]]) for b, c in zip(before, own, strict=True)])[0])
            starts = np.concatenate([[first], _changes(own)])
            index = np.arange(n)
            begin = np.maximum.accumulate(np.where(starts, index, -1))
            number = np.where(begin < 0, index + local + 1, index - begin + 1)
            at = np.arange(seen, seen + n)
            seen, local, before = seen + n, int(number[-1]), [c[-1:] for c in own]
            if top is None:
                yield out(batch, at, number)
                continue
            keep = batch.column(offset).to_numpy(zero_copy_only=False) + number <= top
            if keep.any():
                yield out(batch.filter(pa.array(keep)), at[keep], number[keep])
            last = None if keep[-1] else (batch.slice(n - 1), at[-1:], number[-1:])
        if last is not None:
            yield out(*last)

    return run


def ranked(rows: DataFrame, group: Sequence[str], pair: Sequence[tuple[str, str]], ties: Sequence[str], top: int, place: str = "pos", carry: Sequence[str] = ()) -> DataFrame:
    """The rows with a place of at most `top` within their group: columns of group, pair, ties and carry, and pos, place, tied (all long).

    `pair` lists (column, "asc" or "desc"), nulls last and equal to each other; rows with equal pairs are tied, and `tied` tells how many of the
    group there are. `pos` counts the group's rows from 1 in the pair's order, then by `ties`, ascending with nulls last; which of several rows
    that are equal in all of these comes first is not told. `place` is "pos", "rank" (one more than the rows with better pairs) or "dense" (one
    more than the better pairs); with the latter two all rows of a tie are returned, however many.

    A histogram counts the rows of each group and pair; windows run over that table only, and give each pair its place and offset. The rows of
    the pairs that come within `top` are joined to it, sorted by ranges of group, pair, ties and row, so that one group spreads over as many
    partitions as its rows fill, and numbered within each; only one row for each partition (its first and last key and the last one's count)
    is brought together, to find how many rows of a partition's first key stand in earlier ones. Adding that and the offset gives pos.

    So a pair should take few values (a window runs over those of one group); what is finer belongs to ties. A hot pair is one key of the join, which Spark
    splits as it is skewed on the rows' side, and is partially counted before its shuffle. Null groups are groups; repeated rows are ranked separately; other
    columns of rows are not read, whatever their names; an empty table gives no rows. Survivors and their numbers are staged as Parquet, so a
    lost executor costs its own tasks.
    """
    if place not in PLACES or top < 1:
        raise ValueError(f"place is one of {PLACES}, top at least 1")
    names = [*group, *(c for c, _ in pair), *ties, *carry]
    if len(set(names)) < len(names) or {"pos", "place", "tied"} & set(names) or not group or not pair:
        raise ValueError("group and pair are needed, and each column once; pos, place and tied are made here")
    own = {c: f"c{i}" for i, c in enumerate(names)}
    keyed = rows.select(*[F.col(c).alias(a) for c, a in own.items()])
    g, p = [own[c] for c in group], [own[c] for c, _ in pair]
    order = [F.col(own[c]).desc_nulls_last() if way == "desc" else F.col(own[c]).asc_nulls_last() for c, way in pair]

    counts = keyed.groupBy(*g, *p).agg(F.count("*").alias("tied"))
    by_pair = Window.partitionBy(*g).orderBy(*order)
    better = F.coalesce(F.sum("tied").over(by_pair.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = counts.select(*g, *p, "tied", better.alias("offset"), F.row_number().over(by_pair).cast("long").alias("dense"))
    places = places.filter(F.col("dense") <= top if place == "dense" else F.col("offset") < top)

    keys = g + p
    right = places.select(*[F.col(c).alias(f"{c}_r") for c in keys], "tied", "offset", "dense")
    same = [keyed[c].eqNullSafe(right[f"{c}_r"]) for c in keys]
    survivors = staged(keyed.join(right, same, "inner").select(*keys, *[c for c in keyed.columns if c not in keys], "tied", "offset", "dense"), "survivors")

    # Rows that are equal in all else are told apart by where they stand in the staged table, so that they can be dealt out too.
    told = survivors.withColumn("row", F.monotonically_increasing_id())
    sorting = [*[F.col(c).asc_nulls_last() for c in g], *order, *[F.col(own[c]).asc_nulls_last() for c in ties], F.col("row")]
    dealt = told.repartitionByRange(*sorting).sortWithinPartitions(*sorting).drop("row")
    extra = [T.StructField("part", T.IntegerType()), T.StructField("idx", T.LongType()), T.StructField("local", T.LongType())]
    least = top if place == "pos" else None
    numbered = staged(dealt.mapInArrow(lean(_numbered(len(keys), dealt.columns.index("offset"), least)), T.StructType([*dealt.schema.fields, *extra])), "numbered")

    # One row for each partition of the sort: how many rows of its first key stand in those before it.
    key = F.struct(*keys)
    ends = numbered.groupBy("part").agg(F.min_by(key, "idx").alias("first"), F.max_by(F.struct(key.alias("key"), "local"), "idx").alias("last"))
    so_far = F.sum("last.local").over(Window.partitionBy("last.key").orderBy("part"))
    line = Window.orderBy("part")
    summed = ends.select("part", "first", F.col("last.key").alias("key"), so_far.alias("so_far"))
    carried = summed.select(F.col("part").alias("of_part"), "first", F.when(F.col("first").eqNullSafe(F.lag("key").over(line)), F.lag("so_far").over(line)).otherwise(0).alias("earlier"))

    joined = numbered.join(F.broadcast(carried), F.col("part") == F.col("of_part"), "left")
    pos = F.col("offset") + F.col("local") + F.when(key.eqNullSafe(F.col("first")), F.col("earlier")).otherwise(0)
    found = joined.select(*[F.col(a).alias(c) for c, a in own.items()], pos.cast("long").alias("pos"), {"pos": pos, "rank": F.col("offset") + 1, "dense": F.col("dense")}[place].cast("long").alias("place"), F.col("tied").cast("long"))
    return found.filter(F.col("place") <= top)


def sale_lines(spark, sf_dir: str) -> DataFrame:
    """Sale lines with the columns that their ranking compares: groups of vendor, part and month, but one group of all lines whose sale is drawn."""
    lines = table(spark, sf_dir, "sale_lines")
    drawn = F.coalesce(F.crc32(F.col("sale_id").cast("string")) % 5 == 0, F.lit(False))
    part = F.coalesce(F.col("item_id") % 5, F.lit(-1))
    month = F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))
    return lines.select(
        *[F.when(drawn, F.lit(-1)).otherwise(c).cast("long").alias(name) for c, name in ((F.col("vendor_id"), "vendor_id"), (part, "part"), (month, "month"))],
        F.floor(F.col("quantity") / 10).cast("long").alias("tens"),
        F.floor(100 * F.col("discount") + 0.5).cast("long").alias("percent"),
        F.col("sale_id").cast("long").alias("sale_id"), F.col("line_no").cast("long").alias("line_no"), F.col("quantity").cast("long").alias("quantity"),
        F.floor(100 * F.col("amount") + 0.5).cast("long").alias("amount_cents"),
    )
