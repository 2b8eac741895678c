"""Planning: what is left to do, its shards of pages, where a walk resumes and how far it goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import query_key


def build(names: DataFrame, done: DataFrame) -> DataFrame:
    """(name, pos): keys of the list (pos, line) in order of first appearance, without those done. What failed before is tried again."""
    listed = names.select(query_key(F.col("line")).alias("name"), "pos").filter("name <> ''").groupBy("name").agg(F.min("pos").alias("pos"))
    return listed.join(done.select("name"), "name", "left_anti")


def sharded(tasks: DataFrame, shards: int) -> DataFrame:
    """Each task once a shard; one shard or fewer leaves them whole."""
    n = max(1, shards)
    return tasks.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(n - 1))), "shard_count": F.lit(n)})


def last_page(count: Column, size: Column) -> Column:
    return F.when(size > 0, F.greatest(F.ceil(count / size), F.lit(1))).otherwise(1).cast("long")


def block(rows: Column, size: Column, shards: Column, shard: Column) -> Column:
    """struct(from, to): the contiguous pages of a shard; null for a shard beyond the pages, or for numbers that make no sense."""
    pages = last_page(rows, size)
    per = F.ceil(pages / shards)
    first = (shard * per + 1).cast("long")
    sane = (rows > 0) & (size > 0) & (shards > 0) & (shard >= 0) & (shard < shards)
    return F.when(sane & (first <= pages), F.struct(first.alias("from"), F.least(first + per - 1, pages).cast("long").alias("to")))


def shard_of_page(page: Column, rows: Column, size: Column, shards: Column) -> Column:
    """The inverse of block(): which shard a page belongs to, by arithmetic instead of a range join."""
    per = F.ceil(last_page(rows, size) / shards)
    return F.floor((page - 1) / per).cast("int")


def resumed(pages: DataFrame, checkpoints: DataFrame, by: list[str], start_page: int = 0, end_page: int = 0) -> DataFrame:
    """pages (with `page`) after each checkpoint's page and within the bounds; no checkpoint is page 0, no end is the last page."""
    at = checkpoints.select(*by, F.col("page").alias("_done"))
    found = pages.join(at, by, "left").filter(F.col("page") > F.coalesce("_done", F.lit(0))).drop("_done")
    found = found.filter(F.col("page") >= max(1, start_page))
    return found.filter(F.col("page") <= end_page) if end_page > 0 else found


def limited(pages: DataFrame, by: list[str], max_pages: int) -> DataFrame:
    """At most max_pages pages of each walk (0: all), in page order, with `partial`: whether more are left."""
    if max_pages <= 0:
        return pages.withColumn("partial", F.lit(False))
    w = Window.partitionBy(*by)
    ranked = pages.withColumns({"_n": F.row_number().over(w.orderBy("page")), "_all": F.count("*").over(w)})
    return ranked.filter(F.col("_n") <= max_pages).withColumn("partial", F.col("_all") > max_pages).drop("_n", "_all")


def in_page_order(pages: DataFrame, query: str = "query", page: str = "page") -> DataFrame:
    """Delivery in order, however pages came: ranges of queries to tasks, sorted within each."""
    return pages.repartitionByRange(query, page).sortWithinPartitions(query, page)


def assembled(parts: DataFrame, by: list[str], order: str, text: Column, between: str = "\n") -> DataFrame:
    """(by, joined): the texts of each key's parts in order, however they came. A key's parts make one text, so they are one row anyway."""
    found = parts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), text.alias("text")))).alias("parts"))
    return found.select(*by, F.array_join("parts.text", between).alias("joined"))
