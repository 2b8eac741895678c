"""What the training-data operators share: tables, shared storage, words, connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_dir


#: Rows and bytes of an Arrow batch, where the session has Spark's defaults: ten thousand long texts are too much for one batch.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16m")}


def bounded_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at once. Settings other than Spark's defaults are left alone."""
    for key, (default, bound) in BATCH.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, bound)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """frame as a Parquet table in the shared folder: computed once, read again without its lineage."""
    spark = frame.sparkSession
    bounded_batches(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


#: Ids that are broadcast at most; more are joined by a shuffle.
FEW = 1 << 20


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ids (one long column of that name, repeats allowed). The ids are staged and counted: up to FEW (8 MB) are
    broadcast, so the rows, which may hold texts, stay where they are; beyond that both sides are shuffled by key."""
    gone = staged(ids.select(key).distinct(), "ids")
    return rows.join(F.broadcast(gone) if gone.count() <= FEW else gone, key, "left_anti")


def id_key(column: str) -> F.Column:
    """A null id counts as the largest one: it is never the smaller of two documents."""
    return F.coalesce(F.col(column).cast("long"), F.lit(2**63 - 1))


@cache
def _c_library():
    try:
        library = ctypes.CDLL(None)
        return library if hasattr(library, "malloc_trim") else None
    except OSError:
        return None


def trim() -> None:
    """Gives memory that a Python worker no longer uses back to the system: workers live on after a task, beside those of other tasks."""
    pa.default_memory_pool().release_unused()
    if _c_library():
        _c_library().malloc_trim(0)


def lean(work: Callable) -> Callable:
    """work, a generator over batches that runs in a worker, with trim() at its end."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            trim()

    return run


def in_chunks(values: Iterable, size_of, most: int):
    """Lists of consecutive values whose sizes add up to about most at the most."""
    held, total = [], 0
    for value in values:
        held.append(value)
        total += size_of(value)
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for each node of the undirected edges (a, b), both long; component: its smallest node.

    Alternating large-star and small-star steps; each is an aggregation and a join on the node, so the driver sees only a count and a
    checksum. Each round is checkpointed to the shared folder. Loops and repeated edges are allowed; no edges give no rows.
    """
    state = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    mark = None
    for _ in range(rounds):
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(down, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        state = checkpointed(small.distinct())
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(state.select("v", "v").distinct())
