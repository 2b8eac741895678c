"""Line lists, stores, output parts, counts, checkpoints and rules as DataFrames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import query_key, store_key
from ..schemas import COLUMNS, ROW
from . import storage

_EDGES = r"^[\s\x{0085}\p{Z}]+|[\s\x{0085}\p{Z}]+$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has files, asked of the file system that it is on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def _numbered(batches):
    """Lines of splits (file, start) with their place in the split, which is read in order."""
    at, seen = None, 0
    for batch in batches:
        files, starts, places = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for split in zip(files, starts, strict=True):
            seen = seen + 1 if split == at else 0
            at = split
            places.append(seen)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=["file", "start", "value", "place"])


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line): the lines of a file, or of all files of a folder or glob in the order of their names, with their position in the whole.

    Files are read in splits, by as many tasks. Lines are numbered within each split, and the number of lines in earlier splits, one row for each split,
    is added; the splits of one session are the same in both readings. Lines end with a line feed, or a carriage return and one; a byte order mark at a file's start is none of it.
    """
    where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    read = spark.read.option("lineSep", "\n").text(path).select(where.alias("at"), "value").select("at.file", "at.start", "value")
    placed = read.mapInArrow(_numbered, "file string, start long, value string, place long")
    sizes = placed.groupBy("file", "start").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("file").alias("f"), F.col("start").alias("s"), before.alias("before"))
    found = placed.join(offsets, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    line = F.regexp_replace("value", "\r$", "")
    first = (F.col("start") == 0) & (F.col("place") == 0)
    return found.select("file", (F.col("before") + F.col("place")).alias("pos"), F.when(first, F.regexp_replace(line, r"^\x{FEFF}", "")).otherwise(line).alias("line"))


def lines(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """(pos, line): trimmed; blank lines and those that start with # are left out. Repeats stay. An empty list is an error if required."""
    found = raw_lines(spark, path).select("pos", F.regexp_replace("line", _EDGES, "").alias("line")).filter("line <> '' AND NOT startswith(line, '#')")
    if required and found.isEmpty():
        raise ValueError(f"{path} has no entries")
    return found


def store(spark: SparkSession, path: str) -> DataFrame:
    """(name, stored): the keys of a store, and each one's first line. A missing file is an empty store; # is no comment here."""
    if not exists(spark, path):
        return spark.createDataFrame([], "name string, stored string")
    found = raw_lines(spark, path).select("pos", store_key(F.col("line")).alias("name"), "line").filter("name <> ''")
    return found.groupBy("name").agg(F.min_by("line", "pos").alias("stored"))


def rules(spark: SparkSession, path: str) -> DataFrame:
    """(ord, action, marker) in file order: lines action@::@marker. Unknown actions, empty and repeated markers are left out, the first stays."""
    from ..functions.text import action_seconds

    parts = F.split("line", "@::@", 2)
    found = lines(spark, path, required=False).select("pos", F.regexp_replace(parts[0], _EDGES, "").alias("action"), F.regexp_replace(F.try_element_at(parts, F.lit(2)), _EDGES, "").alias("marker"))
    known = F.col("action").isin("skip", "pauseAll") | action_seconds(F.col("action")).isNotNull()
    found = found.filter((F.coalesce("marker", F.lit("")) != "") & known)
    return found.groupBy("marker").agg(F.min("pos").cast("int").alias("ord"), F.min_by("action", "pos").alias("action")).select("ord", "action", "marker")


def rows_from_values(values: F.Column) -> list[F.Column]:
    """A row's columns from an array of texts in output order; a number that is none is -1."""
    out = []
    for i, c in enumerate(COLUMNS):
        v = F.get(values, i)
        out.append((F.coalesce(v.try_cast("int"), F.lit(-1)) if c == "number" else v).alias(c))
    return out


def values_from_row(prefix: str = "") -> list[F.Column]:
    """The texts of a row in output order; nulls are written as empty, an absent number as -1."""
    cell = lambda c: F.coalesce(F.col(prefix + c), F.lit(-1 if c == "number" else "")).cast("string")
    return [cell(c) for c in COLUMNS]


def output_rows(spark: SparkSession, path: str, finished: DataFrame | None = None) -> DataFrame:
    """(part, stamp, query, the row's columns) of an output and its rotated parts `path.N`, N from 1, files or folders; the active one is the last part.

    Lines of fewer than 13 fields are left out and further fields ignored; quotes are data. Rows of the queries in finished (name) are
    left out before anything else is done with them. Order among rows is not kept; part is.
    """
    paths = [p for p in (path, f"{path}.[0-9]*") if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], T.StructType([T.StructField("part", T.LongType()), T.StructField("stamp", T.StringType()), T.StructField("query", T.StringType()), *ROW.fields]))
    part = F.coalesce(F.regexp_extract(F.col("_metadata.file_path"), r"\.(\d+)(?:/[^/]+)?$", 1).try_cast("long"), F.lit(2**62))
    fields = F.split("value", "\t")
    read = spark.read.text(paths).select(part.alias("part"), fields.alias("f")).filter("part >= 1 AND size(f) >= 13")
    found = read.select("part", F.get("f", 0).alias("stamp"), F.get("f", 1).alias("query"), *rows_from_values(F.slice("f", 3, 11)))
    if finished is not None:
        found = found.join(finished.select(F.col("name").alias("_done")), query_key(F.col("query")) == F.col("_done"), "left_anti")
    return found


def output_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """(number of the next rotated part, bytes of the active one) of an output, from its folder's listing."""
    folder, _, name = path.rstrip("/").rpartition("/")
    parts = [int(n[len(name) + 1 :]) for n in storage.names(spark, folder) if n.startswith(f"{name}.") and n[len(name) + 1 :].isdigit()]
    return max(parts, default=0) + 1, storage.total_bytes(spark, path)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(day, query, n_results, pos) of count files: lines of three fields or more, read line by line. pos grows along each file."""
    f = F.split("value", "\t")
    read = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("pos")).filter(F.size(f) >= 3)
    return read.select(F.get(f, 0).try_cast("date").alias("day"), query_key(F.get(f, 1)).alias("query"), F.get(f, 2).try_cast("long").alias("n_results"), "pos")


def checkpoint_text(c: F.Column) -> F.Column:
    """struct(page, rows) of a checkpoint's text: page and rows by a tab, or the page alone (rows unknown: null); anything else is page 0."""
    f = F.split(F.regexp_replace(c, _EDGES, ""), "\t")
    page = F.coalesce(F.get(f, 0).try_cast("int"), F.lit(0))
    rows = F.when(page > 0, F.get(f, 1).try_cast("long"))
    return F.struct(page.alias("page"), F.when(rows >= 0, rows).alias("rows"))


def legacy_done(spark: SparkSession, *paths: str) -> DataFrame:
    """Names in the older state files: the first field of each line."""
    out = None
    for p in paths:
        own = store(spark, p).select("name")
        out = own if out is None else out.union(own)
    return out.distinct()
