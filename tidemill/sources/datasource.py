"""Captured pages as a Python data source: spark.read.format("captured_pages").load(folder), for folders that every executor sees.

Blocks of pages are partitions, and filters on query and page are pushed down, so pages outside a walk's bounds are not opened. Folders
that only Spark can read are for pages.captured().
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..schemas import RAW_PAGE

_NAME = re.compile(r"(.*)_p(\d+)\.raw")


@dataclass
class Block(InputPartition):
    files: tuple[tuple[str, int, str], ...]


class CapturedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.block = options.get("path", "."), int(options.get("block", "64"))
        self.query, self.low, self.high = None, 0, 2**31

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("query",):
                self.query = f.value
            elif f.__class__ in (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual) and f.attribute == ("page",):
                if isinstance(f, (EqualTo, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value)
                if isinstance(f, GreaterThan):
                    self.low = max(self.low, f.value + 1)
                if isinstance(f, (EqualTo, LessThanOrEqual)):
                    self.high = min(self.high, f.value)
                if isinstance(f, LessThan):
                    self.high = min(self.high, f.value - 1)
            else:
                yield f

    def partitions(self):
        found = sorted((m[1], int(m[2]), name) for name in os.listdir(self.path) if (m := _NAME.fullmatch(name)))
        found = [x for x in found if (self.query is None or x[0] == self.query) and self.low <= x[1] <= self.high]
        return [Block(tuple(found[i : i + self.block])) for i in range(0, len(found), self.block)] or [Block(())]

    def read(self, partition: Block) -> Iterator[tuple]:
        for query, page, name in partition.files:
            with open(os.path.join(self.path, name), encoding="utf-8", errors="replace") as file:
                yield query, page, file.read()


class CapturedPages(DataSource):
    @classmethod
    def name(cls):
        return "captured_pages"

    def schema(self):
        return RAW_PAGE

    def reader(self, schema):
        return CapturedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CapturedPages)
