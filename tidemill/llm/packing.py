"""Packing of token ids into sequences: first-fit decreasing on a tournament tree of bin capacities, in randomised groups of pieces."""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Callable, Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_chunks, lean, staged

CAPACITY = 2048
#: Pieces of a group: enough for first-fit decreasing to leave little padding, few enough for one task.
GROUP = 8192
#: How byte-level vocabularies of this kind cut texts before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = "row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def encoder(tokenizer: str) -> Callable[[list[str]], Iterable[bytes]]:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes. A .tiktoken file of ranks gives the same ids as the .json file of its vocabulary, several times as fast; a text on which its regular
    expressions give up, as on a million blanks, is taken to that file."""
    from tokenizers import Tokenizer

    if tokenizer.endswith(".tiktoken"):
        import tiktoken

        with open(tokenizer, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
        slow = cache(lambda: Tokenizer.from_file(tokenizer.removesuffix(".tiktoken") + ".json"))

        def ids(text: str) -> list[int]:
            try:
                return own.encode(text, allowed_special="all")
            except ValueError:
                return slow().encode(text, add_special_tokens=False).ids

        return lambda texts: (array("I", ids(t)).tobytes() for t in texts)
    whole = Tokenizer.from_file(tokenizer)
    return lambda texts: (array("I", x.ids).tobytes() for x in whole.encode_batch(texts, add_special_tokens=False))


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The documents' ids, each text's with end_id behind, cut at multiples of capacity; row_id names the row (ids may repeat or be null)."""

    def run(batches):
        encode = encoder(tokenizer)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for some in in_chunks(rows, lambda r: len(r[2]) + 1, 1 << 20):
                out = []
                for (row, doc, _), ids in zip(some, encode([r[2] for r in some]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        part = ids[4 * start : 4 * (start + capacity)]
                        out.append((row, doc, start, len(part) // 4, zlib.crc32(part), n) + ((part,) if with_ids else ()))
                kinds = [pa.int64()] * 6 + [pa.binary()] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["row_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(kinds)])

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), PIECES + (", ids binary" if with_ids else ""))


class Tournament:
    """The first bin with room for a piece, in logarithmic time: each inner node holds the larger capacity of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """(bin, room that the bin had)."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        had, leaf = free[at], at - self.leaves
        free[at] -= size
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
        return leaf, had


def first_fit_decreasing(sizes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) for each size; sizes are 1 to capacity. Ties keep the given order."""
    tree = Tournament(len(sizes), capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bin_, had = tree.put(sizes[i])
        out[i] = (bin_, capacity - had)
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY, group: int = GROUP, with_ids: bool = False, seed: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian, if with_ids).

    A piece of full capacity is a sequence of its own and is not shuffled by size. The others are dealt at random to groups of about
    `group` pieces, whose number follows the data, and each group is packed by first-fit decreasing in one task; only the pieces' lengths
    decide. A null text is empty and gives its end id only; null ids stay null; repeated rows are packed each; other columns are not
    read; an empty table gives no rows. The pieces are staged once in the shared folder, so they are not tokenised again.
    """
    pieces = staged(token_pieces(docs, tokenizer, id_col, text_col, end_id, capacity, with_ids), "pieces")
    part = F.col("length") < capacity
    groups = max(1, -(-pieces.filter(part).count() // group))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    whole = pieces.filter(~part).select(*columns, (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    schema = "group int, " + PIECES + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row_id", "ascending"), ("start", "ascending")])
        placed = first_fit_decreasing(table["length"].to_pylist(), capacity)
        base = table["group"][0].as_py() << 32
        return table.append_column("sequence_id", pa.array([2 * (base + b) for b, _ in placed], pa.int64())).append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    dealt = pieces.filter(part).withColumn("group", F.pmod(F.xxhash64("row_id", "start", F.lit(seed)), F.lit(groups)).cast("int"))
    packed = dealt.select("group", *pieces.columns).groupBy("group").applyInArrow(run, schema)
    return whole.union(packed.select(*columns, "sequence_id", "offset"))
