"""Exact, first-wins removal of repeats: within a batch, against what is written, and of state that is no longer needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the first row by order, which must have no ties for the result to be certain (dropDuplicates keeps any).

    min_by aggregates partially before the shuffle, so a key with very many rows is no large group anywhere; a window would sort them all.
    """
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    if rest == order and len(order) == 1:
        # A plain minimum is hashed; structs are sorted before they are aggregated.
        return rows.groupBy(*keys).agg(F.min(order[0]).alias(order[0])).select(*rows.columns)
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def new_rows(batch: DataFrame, history: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First rows of the batch whose keys the history does not hold. Keys are compared as they are; null keys are one key in a batch and never in a history."""
    return first_of(batch, keys, order).join(history.select(*keys), keys, "left_anti")


def distinct_first(values: DataFrame, value: Column, order: str) -> DataFrame:
    """(value, pos): trimmed values without blanks in order of first appearance."""
    return values.select(F.trim(value).alias("value"), F.col(order).alias("pos")).filter("value <> ''").groupBy("value").agg(F.min("pos").alias("pos"))


def open_keys(state: DataFrame, finished: DataFrame, by: str) -> DataFrame:
    """The distinct keys of queries that are not finished: what a rebuilt or compacted index holds."""
    return state.join(finished.select(by).distinct(), by, "left_anti").distinct()


def totals(state: DataFrame, query: str, key: str) -> DataFrame:
    return state.agg(F.count_distinct(query).alias("queries"), F.count_distinct(query, key).alias("unique_rows"))


def membership(rows: DataFrame, members: DataFrame, by: str, inside: bool = True) -> DataFrame:
    return rows.join(members.select(by), by, "left_semi" if inside else "left_anti")


def numbered_from(rows: DataFrame, partition: list[str], order: list[str], start: int = 0) -> DataFrame:
    return rows.withColumn("number", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1 + start)


def end_of(order: str, value: str, where: Column, last: bool, default: str = "") -> Column:
    """As an aggregate: the value of the first or last row, by order, of those where `where` holds; default if there is none."""
    at = F.when(where, F.col(order))
    return F.coalesce((F.max_by if last else F.min_by)(value, at), F.lit(default))
