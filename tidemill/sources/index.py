"""The older binary index of written rows, for import: blocks of a query and its row hashes, after a magic number.

New state is Parquet; this reads what an earlier collection left, tells whether it is whole enough to use, and rebuilds it from outputs if not.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import query_key, row_key
from ..operators.dedupe import open_keys
from .lists import exists, output_rows

#: Larger values mean that a block is damaged.
LONGEST_QUERY, MOST_HASHES = 64 << 10, 16 << 20
SCHEMA = "query string, row_hash long"


def fnv1a(data: bytes) -> int:
    h = 0xCBF29CE484222325
    for b in data:
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h


def fnv1a_of(texts: list[bytes]) -> np.ndarray:
    """fnv1a() of many texts, a byte of all of them at a time: the longest first, so that those that go on are the first ones."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8).astype(np.uint64)
    starts, h = np.cumsum(sizes) - sizes, np.full(len(texts), 0xCBF29CE484222325, np.uint64)
    # How many are longer than each place.
    for place, n in enumerate(np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0)).tolist()):
        h[:n] = (h[:n] ^ data[starts[:n] + place]) * np.uint64(0x100000001B3)
    out = np.empty(len(texts), np.uint64)
    out[order] = h
    return out


def hashed(query: Column, key: Column) -> Column:
    """The index's hash of a row: FNV-1a of the query, a zero byte and the row key, as a signed long; null if either is."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            known = texts.notna()
            out = pd.Series(None, index=texts.index, dtype="Int64")
            out[known] = fnv1a_of([t.encode() for t in texts[known]]).view(np.int64)
            yield out

    return run(F.concat(query, F.lit("\x00"), key))


def blocks(data: bytes, magic: bytes) -> Iterator[tuple[str, tuple[int, ...]]]:
    """Whole blocks in order; a torn or damaged one ends the index. A wrong magic number is an error."""
    if not data.startswith(magic):
        raise ValueError("not an index")
    at = len(magic)
    while at + 4 <= len(data):
        (length,) = struct.unpack_from("<I", data, at)
        if length > LONGEST_QUERY or at + 8 + length > len(data):
            return
        (n,) = struct.unpack_from("<I", data, at + 4 + length)
        start = at + 8 + length
        if n > MOST_HASHES or start + 8 * n > len(data):
            return
        yield data[at + 4 : at + 4 + length].decode("utf-8", "replace"), struct.unpack_from(f"<{n}q", data, start)
        at = start + 8 * n


def packed(query: str, hashes: list[int]) -> bytes:
    name = query.encode()
    return struct.pack(f"<I{len(name)}sI{len(hashes)}q", len(name), name, len(hashes), *hashes)


def imported(spark: SparkSession, path: str, magic: bytes) -> DataFrame:
    """(query, row_hash) of index files, distinct; a file without the magic number gives no rows."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                if not data.startswith(magic):
                    continue
                for query, hashes in blocks(data, magic):
                    for i in range(0, len(hashes), 1 << 16):
                        part = hashes[i : i + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array([query] * len(part), pa.string()), pa.array(part, pa.int64())], names=["query", "row_hash"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA).distinct()


def usable(spark: SparkSession, path: str, magic: bytes) -> bool:
    if not exists(spark, path):
        return False
    head = spark.read.format("binaryFile").load(path).select((F.substring("content", 1, len(magic)) == F.lit(bytearray(magic))).alias("ok")).collect()
    return all(r.ok for r in head)


def rebuilt(spark: SparkSession, outputs: str, finished: DataFrame) -> DataFrame:
    """The index from the outputs and their parts, without the queries in finished (name): distinct (query, row_hash)."""
    rows = output_rows(spark, outputs, finished)
    key = row_key(*[F.col(c) for c in ("brand", "holder", "reg_number", "reg_date", "number", "record_id")])
    return rows.select(query_key(F.col("query")).alias("query"), key.alias("k")).distinct().select("query", hashed(F.col("query"), F.col("k")).alias("row_hash")).distinct()


def loaded(spark: SparkSession, path: str, outputs: str, magic: bytes, finished: DataFrame) -> DataFrame:
    """The index without finished queries: from its file, or rebuilt where that is missing or of another form."""
    if not usable(spark, path, magic):
        return rebuilt(spark, outputs, finished)
    return open_keys(imported(spark, path, magic), finished.select(F.col("name").alias("query")), "query")
