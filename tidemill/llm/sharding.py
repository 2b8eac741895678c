"""K-d tree sharding: recursive splits at distributed weighted medians along the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_chunks, staged

#: Fixed bytes that a row counts besides its text.
ROW_BYTES = 16
#: Intervals into which a pass divides the keys of a node along a dimension. SAMPLE is no longer used: cuts come from all rows.
BINS, SAMPLE = 1024, 0
#: Sums that a pass brings to the driver, at most about: many nodes have fewer intervals each. Rows that a task sums up at once.
SUMS, SUMMED = 1 << 19, 1 << 18
#: A group of equal texts stays whole up to this share of a shard, and up to the size of the largest document, which cannot be cut either.
GROUP_SHARE = 0.05
#: Share of a node's bytes by which a cut may miss before the next dimension is tried.
OFF = 0.01
#: Rows of a shard that one task numbers.
NUMBERED = 50_000


@dataclass
class Node:
    """A leaf holds shard `first`; an inner node sends keys below `cut` on `dim` to the left."""

    first: int
    leaves: int
    dim: int = -1
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def leaf_of(root: Node, keys: np.ndarray) -> np.ndarray:
    """The first shard of the leaf or open node that each row of keys (one column a dimension) falls into."""
    out = np.zeros(len(keys), np.int64)
    todo = [(root, np.arange(len(keys)))]
    while todo:
        node, rows = todo.pop()
        if node.left is None:
            out[rows] = node.first
        else:
            low = keys[rows, node.dim] < node.cut
            todo += [(node.left, rows[low]), (node.right, rows[~low])]
    return out


def _order(text: F.Column) -> F.Column:
    """A string's place in 0 to 1 by its first six bytes."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double") / float(1 << 48)


def placed(docs: DataFrame, shards: int | None, target_bytes: int | None, id_col: str, text_col: str, dims: tuple[str, ...]) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, group_split, keys: one long a dimension, the rows' order in it), and the number of shards.

    Rows of equal text have equal keys, from the metadata of the group's smallest id, and so share a shard; a group that outweighs
    GROUP_SHARE of a shard, and the largest document, is dealt to parts of that size by its ids.
    """
    types = dict(docs.dtypes)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("group"),
        *[(_order(F.col(c)) if types[c] == "string" else F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"d{i}") for i, c in enumerate(dims)],
    )
    names = [f"d{i}" for i in range(len(dims))]
    rows = staged(rows.withColumn(f"d{len(dims)}", F.log2("size")), "metadata")
    names.append(f"d{len(dims)}")
    total, largest = (x or 0 for x in rows.agg(F.sum("size"), F.max("size")).first())
    shards = shards or max(1, -(-total // target_bytes))
    part = max(1, largest, int(total / shards * GROUP_SHARE))
    own = ["group", "text_crc32", "size"]
    groups = rows.groupBy(*own).agg(F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), *names)).alias("lead"), F.sum("size").alias("weight"))
    groups = groups.select(*own, *[F.col(f"lead.{n}").alias(f"g{n}") for n in names], F.greatest(F.lit(1), F.ceil(F.col("weight") / part)).alias("parts"))
    # Staged, so that both sides of the join are plain exchanges and adaptive execution can split a group that many rows share.
    groups = staged(groups, "groups")
    with_groups = rows.join(groups, own).withColumn("group_split", F.col("parts") > 1)
    tie = F.pmod(F.xxhash64("group", "text_crc32", F.pmod(F.xxhash64("doc_id"), "parts")), F.lit(1 << 31))
    span = groups.agg(*[f(f"g{n}").alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max)]).first()
    keys = []
    for n in names:
        low, high = span[f"min_{n}"] or 0.0, span[f"max_{n}"] or 0.0
        scaled = (F.col(f"g{n}") - low) / ((high - low) or 1.0) * float((1 << 30) - 1)
        keys.append(scaled.cast("long") * (1 << 31) + tie)
    return staged(with_groups.select("doc_id", "size", "text_crc32", "group_split", F.array(*keys).alias("keys")), "placed"), shards


@dataclass
class Gap:
    """Where in a node's order along a dimension the cut must lie: keys of low to high, with `below` bytes before them and `own` bytes in them."""

    low: int
    high: int
    below: int
    own: int


def grown(rows: DataFrame, shards: int, bins: int = BINS) -> Node:
    """The tree. Every cut comes from sums over all rows: a pass adds up the bytes of each open node in `bins` intervals of a dimension's keys, the
    next one those of the interval that holds the wanted share, between the least and the largest key found there, until that is one key. A
    level takes one pass for the dimensions' spreads and some for the cuts; the driver sees at most `bins` sums for a node and dimension, fewer where nodes are many."""
    root = Node(0, shards)
    dims = len((rows.select("keys").first() or [[]])[0])
    open_nodes = [root] if dims and shards > 1 else []
    whole = {(0, d): (0, 1 << 61) for d in range(dims)} if open_nodes else {}
    while open_nodes:
        # The spread of each dimension: from where 5 % of the bytes lie to where 95 % do, to an interval.
        sums = _between(rows, root, whole, bins)
        total, orders = {}, {}
        for node in open_nodes:
            found = [sums.get((node.first, d), []) for d in range(dims)]
            total[node.first] = sum(x[0] for x in found[0])
            spread = [_at_share(f, 0.95).high - _at_share(f, 0.05).low if f else 0 for f in found]
            orders[node.first] = sorted(range(dims), key=lambda d: -spread[d])
        best: dict[int, tuple[float, int, int]] = {}
        # The widest dimension, unless single rows are so heavy that it has no cut near the middle: then the next ones are tried.
        for turn in range(dims):
            todo = [n for n in open_nodes if total[n.first] and (n.first not in best or best[n.first][0] > OFF)]
            if not todo:
                break
            gaps = {n.first: _at_share(sums[n.first, orders[n.first][turn]], n.leaves // 2 / n.leaves) for n in todo}
            while any(g.low < g.high for g in gaps.values()):
                wide = {(k, orders[k][turn]): (g.low, g.high) for k, g in gaps.items() if g.low < g.high}
                found = _between(rows, root, wide, bins)
                for n in todo:
                    part = found.get((n.first, orders[n.first][turn]))
                    if part:
                        g = gaps[n.first]
                        gaps[n.first] = _at_share(part, (total[n.first] * (n.leaves // 2) / n.leaves - g.below) / g.own, g.below)
            for n in todo:
                g, want = gaps[n.first], total[n.first] * (n.leaves // 2) / n.leaves
                # The key with the wanted share goes right, or left.
                away = min((abs(g.below - want), g.low), (abs(g.below + g.own - want), g.low + 1))
                cut = (away[0] / total[n.first], orders[n.first][turn], away[1])
                best[n.first] = min(best.get(n.first, cut), cut)
        after = []
        for node in open_nodes:
            half = node.leaves // 2
            # A node without rows cannot be split: all of it goes left.
            _, node.dim, node.cut = best.get(node.first, (0.0, 0, 1 << 62))
            node.left, node.right = Node(node.first, half), Node(node.first + half, node.leaves - half)
            for child, side in ((node.left, 0), (node.right, 1)):
                if child.leaves > 1:
                    after.append(child)
                    # Within the keys that the parent has, cut where it was cut.
                    held = {d: (min(x[1] for x in f), max(x[2] for x in f)) for d in range(dims) if (f := sums.get((node.first, d)))}
                    for d, (low, high) in held.items():
                        if d == node.dim:
                            low, high = (low, min(high, node.cut - 1)) if not side else (max(low, node.cut), high)
                        whole[child.first, d] = (low, max(low, high))
        open_nodes = after
        firsts = {n.first for n in after}
        whole = {k: v for k, v in whole.items() if k[0] in firsts}
    return root


def _at_share(found: list[tuple[int, int, int]], share: float, below: int = 0) -> Gap:
    """Of intervals (bytes, least key, largest key) in order, the one in which that share of their bytes is reached."""
    total, so_far = sum(x[0] for x in found), 0
    for own, low, high in found:
        if so_far + own >= share * total or so_far + own == total:
            return Gap(low, high, below + so_far, own)
        so_far += own
    raise ValueError("no intervals")


def _keys(column) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def _between(rows: DataFrame, root: Node, ranges: dict[tuple[int, int], tuple[int, int]], bins: int) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
    """For each (node, dimension) and range of keys (low, high): (bytes, least key, largest key) of those of its intervals that hold rows, in order."""
    wanted: dict[int, list[tuple[int, int, int]]] = {}
    for (node, dim), (low, high) in ranges.items():
        wanted.setdefault(node, []).append((dim, low, high))
    schema = "node long, dim long, bin long, size long, low long, high long"

    bins = max(2, min(bins, SUMS // len(ranges)))

    def sums(batches):
        for some in in_chunks(batches, len, SUMMED):
            keys = np.concatenate([_keys(b.column(0)) for b in some])
            size, node = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in some]), leaf_of(root, keys)
            order = np.argsort(node, kind="stable")
            there, start = np.unique(node[order], return_index=True)
            for k, own in zip(there.tolist(), np.split(order, start[1:]), strict=True):
                for dim, low, high in wanted.get(k, ()):
                    at = keys[own, dim]
                    inside = (at >= low) & (at <= high)
                    at, weight = at[inside], size[own][inside]
                    if len(at):
                        by = np.argsort(at, kind="stable")
                        at, weight = at[by], weight[by]
                        bin_ = (at - low) // ((high - low) // bins + 1)
                        first = np.flatnonzero(np.concatenate([[True], bin_[1:] != bin_[:-1]]))
                        n, last = len(first), np.append(first[1:], len(at)) - 1
                        columns = (np.full(n, k), np.full(n, dim), bin_[first], np.add.reduceat(weight, first), at[first], at[last])
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "dim", "bin", "size", "low", "high"])

    parts = rows.select("keys", "size").mapInArrow(sums, schema).groupBy("node", "dim", "bin").agg(F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"))
    out: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for node, dim, _, size, low, high in sorted(zip(*(c.to_pylist() for c in parts.toArrow().columns), strict=True)):
        out.setdefault((node, dim), []).append((size, low, high))
    return out


def sharded(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = ("lang", "source", "doc_id")) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, group_split, shard, slot. Shards are leaves of a k-d tree, near equal in bytes.
    group_split: the group of rows with this text outweighed GROUP_SHARE of a shard and the largest document, and was dealt to several parts.

    Dimensions are the metadata columns in dims and the logarithm of the size. A node of k leaves is split where its left part has
    floor(k/2)/k of its bytes, along the dimension of the widest spread. Slots number a shard's rows from 0 in chunks, each numbered by
    one task. Null texts have no bytes; null metadata counts as empty or 0; repeated rows keep a slot each; an empty table gives no rows.
    """
    rows, shards = placed(docs, shards, target_bytes, id_col, text_col, dims)
    root = grown(rows, shards)
    chunks = max(1, -(-rows.count() // (NUMBERED * shards)))

    def assign(batches):
        for batch in batches:
            shard = leaf_of(root, _keys(batch.column(4)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shard.astype(np.int32))], names=["doc_id", "size", "text_crc32", "group_split", "shard"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("size", T.LongType()), T.StructField("text_crc32", T.LongType()), T.StructField("group_split", T.BooleanType()), T.StructField("shard", T.IntegerType())])
    got = rows.mapInArrow(assign, schema).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(chunks)).cast("int"))
    return numbered(got)


def numbered(rows: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    rows = staged(rows, "shards")
    sizes = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32"))
    return rows.withColumn("place", place).join(before, ["shard", "chunk"]).select("doc_id", "size", "text_crc32", "group_split", "shard", (F.col("before") + F.col("place") - 1).alias("slot"))
