"""Schemas of result rows, outputs, tasks, checkpoints and captured pages."""

from pyspark.sql import types as T

#: Names of a row's columns in output order, with the wire's ids of them.
COLUMNS = {
    "brand": "BRAND",
    "holder": "HOL",
    "status": "STATUS",
    "origin": "OO",
    "reg_date": "RD",
    "reg_number": "IRN",
    "nice": "NC",
    "vienna": "VCS",
    "record_id": "real_id",
    "record_status": "real_status",
    "number": "result_number",
}

ROW = T.StructType([T.StructField(c, T.IntegerType() if c == "number" else T.StringType()) for c in COLUMNS])
OUTPUT = T.StructType([T.StructField("stamp", T.TimestampType()), T.StructField("query", T.StringType()), *ROW.fields])
COUNTS = "day date, query string, n_results long"
SHORT = "query string, n_results long, n_rows long, day date"
TASK = "name string, last_attempt long, attempts int, shard int, shard_count int"
#: A null number of rows is an unknown one.
CHECKPOINT = "query string, shard int, page int, rows long"
#: A page as it was captured, and what of it the classifier looks at.
RAW_PAGE = "query string, page int, body string"
SNAPSHOT = "url string, title string, text string, grid_rows int, pager string"
#: kind: ok, fail, soft_fail, cooldown, latency, attempt.
EVENT = "endpoint string, ts timestamp, id long, kind string, ms long"

_FLEX = ("ID", "SOURCE", "STATUS", "OO", "RD")
_LISTS = ("IRN", "NC", "VCS", "USC", "BRAND", "BRAND_EN", "HOL", "HOL_EN")
#: Documents' fields come as scalars or lists, numbers or texts, so they are read as variants.
WIRE = "struct<response: struct<numFound: bigint, start: bigint, docs: array<struct<" + ", ".join(f"`{c}`: variant" for c in (*_FLEX, *_LISTS)) + ">>>, highlighting: map<string, map<string, array<string>>>, error: variant>"
