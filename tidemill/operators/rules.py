"""Marker rules, the one thing that users program: the first rule whose marker a body holds decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules are written by hand; more than this is taken for a mistake, as each body is searched for each marker.
MOST = 10_000


def listed(rules: DataFrame) -> list[tuple[int, str, str]]:
    """Rules (ord, action, marker) in order, as values for matched()."""
    rows = rules.select("ord", "action", "marker").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} rules")
    return sorted((r.ord, r.action, r.marker) for r in rows)


def matched(body: Column, rules: list[tuple[int, str, str]]) -> Column:
    """struct(ord, action, marker) of the first rule that holds, or null. Case and spaces count."""
    if not rules:
        return F.lit(None).cast("struct<ord:int,action:string,marker:string>")
    made = lambda o, a, m: F.struct(F.lit(o).alias("ord"), F.lit(a).alias("action"), F.lit(m).alias("marker"))
    if len(rules) <= 50:
        return F.coalesce(*[F.when(F.contains(body, F.lit(m)), made(o, a, m)) for o, a, m in rules])
    return F.try_element_at(F.filter(F.array(*[made(*r) for r in rules]), lambda r: F.contains(body, r["marker"])), F.lit(1))
