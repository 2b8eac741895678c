"""SimHash near-duplicates: fingerprints, anchor-point covering, components of linked fingerprints."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, components, id_key, in_chunks, lean, staged

SHINGLE, BITS, SEED = 3, 3, 42
#: Parity checks of the Hamming code of length 31: check k covers the positions (1 to 31) whose number has bit k.
_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)) for k in range(5)]
#: For each syndrome, the masks that lead from a word to its anchors within distance 2 (the last bit of the 32 is outside the code).
_FREE = 1 << 31


def _masks(s: int) -> list[int]:
    if not s:
        return [0, _FREE]
    one = 1 << (s - 1)
    return [one, one | _FREE] + [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i ^ s > i]


_MASKS = [np.array(_masks(s), np.uint64) for s in range(32)]
#: The wider covering, for sets that share 0.8 of their shingles and so differ in some 15 of 100 bits: fingerprints of a set, blocks of each,
#: bits of a block beside the 15 of its code, and bits that another fingerprint of two sets of one band differs in at most.
PRINTS, CUTS, FREE, APART = 26, 6, 2, 14
#: Rows of an anchor up to which all its pairs are compared at once; beyond that a walk drops what it has reached.
PAIRED = 512


def fingerprint_batch(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit fingerprints: bit k is 1 if it is set in over half of the text's shingle hashes; 0 for a text without words."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        w = text.lower().split()
        if len(w) >= shingle:
            got = [digest(x, seed) for x in map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))]
        else:
            got = [digest(b" ".join(w), seed)] if w else []
        hashes.append(np.array(got, np.uint64))
        counts.append(len(got))
    n, out = np.array(counts), np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        out[full] = majorities(np.concatenate([hashes[i] for i in full]), n[full])
    return out


def majorities(h: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each run of lengths (none 0) in h the bits that are set in over half of its hashes."""
    out = np.zeros(len(lengths), np.uint64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    # Byte lanes hold counts of up to 255, so each text is summed in runs of 255 hashes.
    runs = -(-lengths // 255)
    first = np.concatenate([[0], np.cumsum(runs)[:-1]])
    cuts = np.repeat(starts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & np.uint64(0x0101010101010101), cuts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            out |= (2 * ones[:, byte] > lengths).astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for some in in_chunks(rows, lambda r: len(r[1]) + 1, 1 << 21):
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), pa.array(fingerprint_batch([r[1] for r in some], shingle).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).mapInArrow(lean(run), "doc_id long, fp long")


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) of every anchor within covering radius 1 plus threshold 1 of either half; the anchor's top bit tells the half."""
    index, anchor = [], []
    for half in (0, 1):
        word = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        syndrome = np.zeros(len(fp), np.int64)
        for k, check in enumerate(_CHECKS):
            syndrome |= (np.bitwise_count(word & check) & 1).astype(np.int64) << k
        for s in range(32):
            own = np.flatnonzero(syndrome == s)
            if len(own):
                index.append(np.repeat(own, len(_MASKS[s])))
                anchor.append((word[own][:, None] ^ _MASKS[s][None, :]).ravel() | np.uint64(half << 40))
    return np.concatenate(index or [np.zeros(0, np.int64)]), np.concatenate(anchor or [np.zeros(0, np.uint64)])


def stars(fp: np.ndarray, node: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges (node, first node of its local component) among fingerprints at most `most` bits apart: fewer edges than fingerprints, never all pairs."""
    left, edges = np.arange(len(fp)), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = np.bitwise_count(fp[left] ^ fp[front.pop()]) <= most
            if near.any():
                got = left[near]
                edges += [(int(node[i]), int(node[root])) for i in got]
                front += got.tolist()
                left = left[~near]
    return edges


def several(h: np.ndarray, lengths: np.ndarray, count: int) -> np.ndarray:
    """count fingerprints of each run of lengths (none 0) in h, each from the hashes mixed anew."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, (count, 3), np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(lengths), count), np.uint64)
    for j, (mask, one, two) in enumerate(factors):
        mixed = (h ^ mask) * one
        mixed = (mixed ^ (mixed >> np.uint64(32))) * two
        out[:, j] = majorities(mixed ^ (mixed >> np.uint64(29)), lengths)
    return out


def covering(rows: int) -> tuple[int, int]:
    """(fingerprints, free bits of a block) for that many rows: beyond 2 million, blocks get a bit with each doubling, so that anchors hold no
    more rows, and as many more fingerprints as keep the probability that two sets share an anchor."""
    free = max(FREE, (rows - 1).bit_length() - 19)
    return math.ceil(PRINTS * 1.2 ** (free - FREE)), free


class Block:
    """A block of a fingerprint: 15 bits with a perfect Hamming code of radius 1, whose words are the anchors, and free bits, which stay as they are."""

    def __init__(self, places: list[int]):
        bit = [np.uint64(1 << int(p)) for p in places]
        self.mask = np.bitwise_or.reduce(bit)
        self.checks = [np.bitwise_or.reduce([bit[q - 1] for q in range(1, 16) if q >> k & 1]) for k in range(4)]
        self.flips = np.array([0, *bit[:15]], np.uint64)

    def anchors(self, fp: np.ndarray) -> np.ndarray:
        """The one anchor within radius 1 of each fingerprint's block."""
        syndrome = np.zeros(len(fp), np.int64)
        for k, check in enumerate(self.checks):
            syndrome |= (np.bitwise_count(fp & check) & 1).astype(np.int64) << k
        return (fp & self.mask) ^ self.flips[syndrome]


def blocks(free: int) -> list[Block]:
    """CUTS blocks of 15 bits and the free ones, cut from shuffled bits; those of one shuffle share none."""
    rng, size, out = np.random.default_rng(SEED), 15 + free, []
    while len(out) < CUTS:
        order = rng.permutation(64)
        out += [Block(order[at : at + size]) for at in range(0, 64 - size + 1, size)]
    return out[:CUTS]


def joined(anchor: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """Of each row the first one of its anchor (rows are sorted by it) that is reachable over pairs whose fingerprints are at most `most` bits apart."""
    starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    sizes = np.diff(np.append(starts, len(anchor)))
    root, end = np.arange(len(anchor)), np.repeat(starts + sizes, sizes)
    at, d, pairs = np.flatnonzero(np.repeat(sizes <= PAIRED, sizes)), 1, []
    while len(at := at[at + d < end[at]]):
        near = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= most]
        pairs.append((near, near + d))
        d += 1
    if pairs:
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        while True:
            new, low = root.copy(), np.minimum(root[a], root[b])
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
    for start, size in zip(starts[sizes > PAIRED].tolist(), sizes[sizes > PAIRED].tolist(), strict=True):
        left = np.arange(start, start + size)
        while len(left):
            first, left = left[0], left[1:]
            front = [first]
            while front and len(left):
                i = front.pop()
                near = np.bitwise_count(fp[left] ^ fp[i]) <= most
                got = left[near]
                root[got] = first
                front += got.tolist()
                left = left[~near]
    return root


def bands(classes: DataFrame, prints: int, free: int, most: int = APART) -> DataFrame:
    """(node, least) of classes (node, prints: that many fingerprints as longs, or null), once for each anchor at which they meet. A band is
    what fingerprints at most `most` bits apart connect within an anchor, two nodes at least; least is its smallest node.

    Each block of each fingerprint goes to the anchor nearest to it. There the nodes' next fingerprints are compared, whose bits
    have no part in the anchor, so a row carries one. Two sets of
    similarity 0.8 differ in each bit with a probability of 0.15 to 0.16, and share no band with one below 7 in a million.
    """
    cuts = blocks(free)

    def replicate(batches):
        for batch in batches:
            some = batch.filter(batch.column(1).is_valid())
            node, held = some.column(0).to_numpy(zero_copy_only=False), some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, prints)
            for j in range(prints):
                own, other = held[:, j], held[:, (j + 1) % prints]
                mixed = [(cut.anchors(own.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(38) for cut in cuts]
                anchor = np.concatenate([m | np.uint64((j * CUTS + c) << 26) for c, m in enumerate(mixed)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), *(pa.array(np.tile(x, CUTS)) for x in (node, other))], names=["anchor", "node", "fp"])

    def compare(batches):
        for anchor, node, fp in whole_anchors(batches, 1 << 16):
            root = joined(anchor, fp.view(np.uint64), most)
            full = np.flatnonzero(np.bincount(root, minlength=len(root))[root] > 1)
            if len(full):
                least = np.full(len(root), np.iinfo(np.int64).max)
                np.minimum.at(least, root[full], node[full])
                yield pa.RecordBatch.from_arrays([pa.array(node[full]), pa.array(least[root[full]])], names=["node", "least"])

    placed = classes.select("node", "prints").mapInArrow(lean(replicate), "anchor long, node long, fp long")
    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(lean(compare), "node long, least long")


def whole_anchors(batches, least: int = 1):
    """Columns of batches that are sorted by the first one, cut between two of its values, in parts of about `least` rows or more."""
    held, rows, wanted = [], 0, least
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows < wanted:
            continue
        now = [np.concatenate(x) for x in zip(*held, strict=True)]
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last:
            yield [x[:last] for x in now]
        held, rows = [[x[last:] for x in now]], 0
        # An anchor of many batches is put together each time its size has doubled.
        wanted = least if last else len(now[0])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def links(classes: DataFrame, most: int = BITS) -> DataFrame:
    """Star edges (a, b) between the nodes of classes (node, fp: distinct fingerprints) that connect all fingerprints at most `most` (3) bits apart.

    Two fingerprints 3 bits apart differ in at most one bit in one of their 32-bit halves. The anchors are the words of a covering code of
    radius 1 on a half (a perfect Hamming code on 31 bits, the last bit free), and each fingerprint goes to every anchor within radius plus
    threshold, 2, of either half: 17 anchors a half at most. So the anchor nearest to the one is among those of the other. Within an
    anchor the search walks from fingerprint to fingerprint and drops what it has reached.
    """
    if most > 3:
        raise ValueError("the covering reaches 3 differing bits")

    def replicate(batches):
        for batch in batches:
            node, fp = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 4096):
                some = fp[at : at + 4096]
                index, anchor = anchors(some.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int64)), pa.array(node[at : at + 4096][index]), pa.array(some[index])], names=["anchor", "node", "fp"])

    def compare(batches):
        for a, node, fp in whole_anchors(batches):
            yield from edges_of(a, node, fp)

    def edges_of(a, node, fp):
        fp = fp.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(a)))
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= most]
        found = list(zip(node[two].tolist(), node[two + 1].tolist(), strict=True))
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            found += stars(fp[at : at + n], node[at : at + n], most)
        if found:
            found = list(dict.fromkeys(found))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    placed = classes.select("node", "fp").mapInArrow(replicate, "anchor long, node long, fp long")
    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, most: int = BITS) -> DataFrame:
    """One row per document: doc_id, fp, class_id (smallest doc_id with that fingerprint), component_id (smallest doc_id reachable over links).

    Exact copies and equal fingerprints become one class before anything is compared, by a partial aggregation, so thousands of copies
    cost one row. A text of fewer words than a shingle is one shingle; null and empty texts have fingerprint zero and link like any other.
    A null id counts as the largest id, and is given back as null; repeated rows give repeated rows; other columns are not read.
    """
    marks = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = checkpointed(marks.groupBy("fp").agg(F.min(id_key("doc_id")).alias("node")))
    # Rows with one id and different texts may share a node; they are then linked, as one document.
    found = components(links(classes, most))
    named = classes.join(found, "node", "left").select("fp", F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component_id"))
    real = lambda c: F.when(F.col(c) < 2**63 - 1, F.col(c)).alias(c)
    return marks.join(named, "fp").select("doc_id", "fp", real("class_id"), real("component_id"))
