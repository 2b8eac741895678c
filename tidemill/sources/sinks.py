"""Writers of rows, counts, stores, archives and checkpoints. Parquet is the canonical form; the tab-separated one is an export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import archive_name, day, full_name, query_key, row_key, stamped
from . import storage
from .index import hashed
from .ledger import Append, Done, Drop, Ledger, Put, Replace
from .lists import output_state, values_from_row


def with_key(rows: DataFrame) -> DataFrame:
    """rows with the two columns of identity: query_key and row_key."""
    return rows.withColumns({"query_key": query_key(F.col("query")), "row_key": row_key(*[F.col(c) for c in ("brand", "holder", "reg_number", "reg_date", "number", "record_id")])})


def append_rows(rows: DataFrame, path: str, order: list[str], batch: tuple[str, int] | None = None) -> Done:
    """Appends the rows whose identity is neither written nor earlier in the batch. A write that fails commits nothing, so its keys stay free.
    Other writers may append at the same time: each key is written once. A numbered batch that was committed before is not written again."""
    return Ledger(rows.sparkSession, path).commit([Append("rows", with_key(rows), ["query_key", "row_key"], order)], batch)


def append_indexed(rows: DataFrame, path: str, order: list[str], checkpoints: DataFrame | None = None, batch: tuple[str, int] | None = None, on_step: Callable[[str], None] | None = None) -> Done:
    """In one commit: new rows, their entries in the index (query, row_hash), and the checkpoints (query, shard, page, rows) that they reach, of
    several of one walk the furthest. A crash leaves all of it or none, so a checkpoint never runs ahead of its rows, nor rows of their index."""
    keyed = with_key(rows)
    entries = keyed.select(F.col("query_key").alias("query"), hashed(F.col("query_key"), F.col("row_key")).alias("row_hash"))
    changes = [Append("rows", keyed, ["query_key", "row_key"], order), Append("index", entries, ["query", "row_hash"], ["query"])]
    if checkpoints is not None:
        changes.append(Put("checkpoints", checkpoints.select("query", "shard", "page", "rows"), ["query", "shard"], ["page", "rows"]))
    return Ledger(rows.sparkSession, path, on_step=on_step).commit(changes, batch)


def finish(spark: SparkSession, path: str, finished: DataFrame) -> Done:
    """In one commit: the checkpoints, all shards', and the index entries of finished queries (query) go; their rows stay."""
    ledger, gone = Ledger(spark, path), finished.select("query").distinct()
    now = ledger.snapshot()
    own = {t: ledger.read(t, now.version) for t in ("checkpoints", "index") if t in now.tables}
    keyed = {"checkpoints": gone, "index": gone.select(query_key(F.col("query")).alias("query")).distinct()}
    return ledger.commit([Drop(t, frame.join(keyed[t], "query", "left_semi"), now.tables[t].keys) for t, frame in own.items()])


def written(spark: SparkSession, path: str, table: str = "rows") -> DataFrame | None:
    """What has been committed to a table of a folder; None before the first commit."""
    return Ledger(spark, path).read(table)


def append_first(records: DataFrame, path: str, key: str, order: list[str], batch: tuple[str, int] | None = None) -> Done:
    """Appends records whose key is new; of several the first. For counts and stores, where a later value never replaces one."""
    keyed = records.withColumn("key", query_key(F.col(key)))
    return Ledger(records.sparkSession, path).commit([Append("records", keyed, ["key"], order)], batch)


def counted(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """names that have a count."""
    known = written(spark, path, "records")
    if known is None:
        return names.limit(0)
    return names.join(known.select(F.col("key").alias("_k")), F.lower("name") == F.col("_k"), "left_semi")


def row_lines(rows: DataFrame, at: Column) -> DataFrame:
    """One text line per row: stamp, query and the row's eleven values by tabs; no header, no quoting."""
    return rows.select(F.concat_ws("\t", stamped(at), "query", *values_from_row()).alias("value"))


def count_lines(records: DataFrame, at: Column) -> DataFrame:
    return records.select(F.concat_ws("\t", day(at), "query", F.col("n_results").cast("string")).alias("value"))


def export_rows(rows: DataFrame, at: Column, path: str, per_file: int = 1_000_000) -> None:
    """Files of bounded length take the place of rotation by size."""
    row_lines(rows, at).write.mode("append").option("maxRecordsPerFile", per_file).text(path)


def rotate(spark: SparkSession, path: str, cap: int) -> int | None:
    """After an append: an active output of cap bytes or more becomes the next part, whose number is given back. No cap, or a smaller one: null."""
    part, size = output_state(spark, path)
    return part if 0 < cap <= size and storage.move(spark, path, f"{path}.{part}") else None


def archive(pages: DataFrame, path: str, bucket_pages: int = 10_000) -> Done:
    """Pages (query, page, body) by query and page; those written before are replaced, others stay. Files hold up to about bucket_pages pages
    each, more once there are 256 of them, and only those that hold a page of the batch are written anew."""
    named = pages.withColumns({"query_name": query_key(F.col("query")), "file": archive_name(F.col("query"), F.col("page"))})
    return Ledger(pages.sparkSession, path, bucket_rows=bucket_pages).commit([Put("pages", named, ["query_name", "page"], ["body"])])


def archive_full(pages: DataFrame, path: str, bucket_pages: int = 10_000) -> Done:
    """Whole first pages (query, body), one a query: one that is captured again replaces its own."""
    named = pages.withColumns({"query_name": query_key(F.col("query")), "file": full_name(F.col("query"))})
    return Ledger(pages.sparkSession, path, bucket_rows=bucket_pages).commit([Put("full", named, ["query_name"], ["body"])])


def replace(state: DataFrame, path: str, keys: list[str], seen: int | None = None) -> Done:
    """A state table (checkpoints, a compacted index) as a new generation. Readers see the old one or the new one, whole, at every moment; what a
    crash leaves half written is never seen. With seen (a version), it fails if the state has changed since, so that no change is lost."""
    return Ledger(state.sparkSession, path).commit([Replace("state", state, keys, seen)])


def without_checkpoints(checkpoints: DataFrame, finished: DataFrame) -> DataFrame:
    """Checkpoints, all shards', of queries that are not finished."""
    return checkpoints.join(finished.select("query"), "query", "left_anti")
