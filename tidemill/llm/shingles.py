"""Near duplicates by exact similarity of word shingles: SimHash fingerprints with anchors propose, the shingle sets themselves decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import FEW, components, in_chunks, lean, staged, trim

#: Words of a shingle; two sets are near from LEAST[0] / LEAST[1] of their union on.
SHINGLE, LEAST = 5, (4, 5)
SEED = 42
#: Bytes of shingle sets in a block; a task compares two blocks at most.
BLOCK = 8 << 20
#: Of the smallest classes of its bands a class is compared with so many, the least first, before blocks are; the rest is left to the blocks.
HUBS = 4
#: A smaller set shares less than that with any other: a set of four lies in one of five at best.
FEWEST = 4


def lesser(s: np.ndarray) -> list[int] | None:
    """Of a set of four its hash, of one of five those of its subsets of four: the one near pair whose fingerprints differ in more than 16 of 100 bits meets here."""
    if len(s) == FEWEST:
        return [xxhash.xxh3_64_intdigest(s.tobytes()) >> 1]
    return [xxhash.xxh3_64_intdigest(np.delete(s, i).tobytes()) >> 1 for i in range(len(s))] if len(s) == FEWEST + 1 else None


def shingle_set(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of each n consecutive words, ascending; a text of fewer words is one shingle, one without words has none."""
    w = text.lower().split()
    joined = map(b" ".join, zip(*(w[i:] for i in range(n)), strict=False)) if len(w) >= n else [b" ".join(w)] if w else []
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in joined), np.uint64))


def roots(sets: list[np.ndarray], least: tuple[int, int] = LEAST) -> np.ndarray:
    """Of each set the first one that is reachable over pairs whose similarity is at least that.

    The search walks from set to set over an index of shingles, which is built anew whenever half of its sets have been reached.
    """
    num, den = least
    size, root = np.array([len(s) for s in sets]), np.full(len(sets), -1)

    def index(alive):
        codes, owner = np.concatenate([sets[i] for i in alive]), np.repeat(alive, size[alive])
        order = np.argsort(codes, kind="stable")
        return codes[order], owner[order], len(alive)

    codes, owner, indexed = index(np.arange(len(sets)))
    left = len(sets)
    for first in range(len(sets)):
        if root[first] >= 0:
            continue
        root[first], front, left = first, [first], left - 1
        while front and left:
            one = front.pop()
            lo, hi = np.searchsorted(codes, sets[one], "left"), np.searchsorted(codes, sets[one], "right")
            n = hi - lo
            met = owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            met, shared = np.unique(met[root[met] < 0], return_counts=True)
            near = met[(den + num) * shared >= num * (size[one] + size[met])]
            root[near] = first
            front += near.tolist()
            left -= len(near)
            if 0 < 2 * left < indexed:
                codes, owner, indexed = index(np.flatnonzero(root < 0))
    return root


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, component_id) of each id that is not the smallest of its component. Documents are linked if the shingle sets of any of
    their texts have a similarity (shared over all) of 0.8 or more, and through other documents; ids must not be null.

    Equal sets become one class first, by a partial aggregation. Bands are groups of classes whose SimHash fingerprints meet at an anchor and
    are close (simhash.bands); those with one smallest class are one band. Each class is compared with the smallest one of at most HUBS of
    its bands. Bands whose classes are all linked by then are settled, as the largest groups of near copies are. What the other bands
    connect is compared in full, in blocks of bounded size: a task holds two blocks, and blocks of classes already linked to each other
    do not meet.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    prints, free = simhash.covering(rows.count())

    def sign(batches):
        for batch in batches:
            both = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for some in in_chunks(both, lambda r: len(r[1]) + 1, 1 << 20):
                sets = [shingle_set(t) for _, t in some]
                full = [i for i, s in enumerate(sets) if len(s) >= FEWEST]
                found: list = [None] * len(some)
                if full:
                    lengths = np.array([len(sets[i]) for i in full])
                    for i, own in zip(full, simhash.several(np.concatenate([sets[i] for i in full]), lengths, prints).view(np.int64), strict=True):
                        found[i] = own
                columns = [pa.array([d for d, _ in some], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array([lesser(s) for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "set", "prints", "lesser"])

    marks = staged(rows.mapInArrow(lean(sign), "doc_id long, set binary, prints array<long>, lesser array<long>"), "shingles")
    classes = staged(marks.groupBy("set").agg(F.min("doc_id").alias("node"), F.first("prints").alias("prints"), F.first("lesser").alias("lesser")), "shingle-classes")
    small = classes.select("node", F.explode("lesser").alias("band"))
    least = small.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most").select("band", "least")
    met = simhash.bands(classes, prints, free).select("node", "least").union(small.join(least, "band").select("node", "least")).distinct()
    own = Window.partitionBy("node").orderBy("least")
    members = staged(met.select("node", "least", F.first("least").over(own).alias("first"), F.row_number().over(own).alias("rank")), "band-members")

    def sets_of(batches):
        for batch in batches:
            both = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for some in in_chunks(both, lambda r: len(r[1]) + 1, 1 << 20):
                sets = pa.array([shingle_set(t).view(np.int64) for _, t in some], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in some], pa.int64()), sets], names=["node", "set"])

    wanted = staged(members.filter("rank = 1").select(F.col("node").alias("doc_id")), "band-nodes")
    texts = rows.join(F.broadcast(wanted) if wanted.count() <= FEW else wanted, "doc_id").select(F.col("doc_id").alias("node"), "text")
    held = staged(texts.mapInArrow(lean(sets_of), "node long, set array<long>").distinct(), "band-sets")

    num, den = LEAST
    sides = members.filter((F.col("rank") <= HUBS) & (F.col("node") != F.col("least"))).select("node", "least").join(held, "node")
    both = sides.join(held.select(F.col("node").alias("least"), F.col("set").alias("other")), "least")
    sizes = F.size("set").cast("long") + F.size("other")
    fits = F.greatest(F.size("set"), F.size("other")).cast("long") * num <= F.least(F.size("set"), F.size("other")).cast("long") * den
    star = both.filter(fits).filter((num + den) * F.size(F.array_intersect("set", "other")) >= num * sizes)
    star = staged(star.select(F.col("node").alias("a"), F.col("least").alias("b")), "band-stars")

    # A class that is linked to none leaves all its bands unsettled, so only the others' bands are looked at.
    groups = components(star)
    linked = staged(members.join(groups, "node").select("node", "least", F.col("component").alias("group")), "band-linked")
    alike = linked.groupBy("least").agg(F.count("*").alias("n"), F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo = hi")
    settled = alike.join(members.groupBy("least").agg(F.count("*").alias("n")), ["least", "n"]).select("least")
    alone = wanted.select(F.col("doc_id").alias("node")).join(groups, "node", "left_anti").select("node", F.col("node").alias("group"))
    unsettled = staged(linked.join(settled, "least", "left_anti").select("node", "group").distinct().union(alone), "band-unsettled")
    # Bands that share a class, or classes that are linked, are connected by few edges: from a class's first band to its others.
    spans = members.select(F.col("first").alias("a"), F.col("least").alias("b")).distinct()
    loose = components(spans.union(members.filter("rank = 1").select("node", "first")).union(groups))
    # Blocks follow the order of groups, so two of them hold one group only if the first's least is the last's greatest.
    order = Window.partitionBy("component").orderBy("group", "node").rowsBetween(Window.unboundedPreceding, 0)
    sized = held.select("node", (8 * F.size("set").cast("long") + 64).alias("bytes")).join(unsettled, "node").join(loose, "node")
    numbered = sized.withColumn("block", F.floor((F.sum("bytes").over(order) - F.col("bytes")) / block))
    blocks = staged(numbered.groupBy("component", "block", "node").agg(F.min("group").alias("group")), "blocks")
    ends = blocks.groupBy("component", "block").agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
    left, right = ends.select("component", F.col("block").alias("i"), "lo"), ends.select("component", F.col("block").alias("j"), "hi")
    meet = staged(left.join(right, "component").filter("i <= j AND lo <> hi").select("component", "i", "j"), "block-pairs")
    sent = meet.select("component", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"), "i", "j").join(blocks, ["component", "block"])

    def judge(part: pa.Table) -> pa.Table:
        trim()
        part = part.sort_by("node")
        node = part["node"].to_numpy()
        root = roots([s.values.to_numpy().view(np.uint64) for s in part["set"]])
        return pa.table({"a": node, "b": node[root]})

    # A node that lies in both blocks of a pair is sent once.
    near = sent.select("component", "i", "j", "node").distinct().join(held, "node").groupBy("component", "i", "j").applyInArrow(judge, "a long, b long")
    same = marks.join(classes.select("set", "node"), "set").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(same.union(star).union(near).filter("a <> b"))
    return found.filter("node <> component").select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
