"""WARC archives: revisit resolution by payload digest, writing and reading."""

from __future__ import annotations

import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FEW, shared_dir, staged

EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Smaller payloads are stored again: a revisit record would save little.
MIN_PAYLOAD = 1000
READ_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, digest_ok boolean"


def resolved(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """pages as (page_id, url, payload, payload_bytes, payload_digest, refers_to): refers_to is null for what is written as a response.

    Headers (id, digest, bytes) alone are shuffled: they are aggregated by digest, with map-side partial sums, so a payload that a third of all
    pages share costs one row a task. The digests that occur again, with the page they refer to, are staged and counted; up to FEW are broadcast
    to the pages, whose payloads stay where they are, beyond that both sides are shuffled and adaptive execution splits large partitions. Null payloads count as empty; pages
    without an id are never referred to; rows that repeat the id of a response are responses too.
    """
    full = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    full = full.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    heads = full.filter(F.col("payload_bytes") >= min_payload).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    shared = staged(heads.filter("n > 1 AND keeper IS NOT NULL").select("payload_digest", "payload_bytes", "keeper"), "digests")
    shared = F.broadcast(shared) if shared.count() <= FEW else shared
    revisit = F.when(F.col("page_id").eqNullSafe(F.col("keeper")), None).otherwise(F.col("keeper"))
    return full.join(shared, ["payload_digest", "payload_bytes"], "left").select("page_id", "url", "payload", "payload_bytes", "payload_digest", revisit.alias("refers_to"))


def records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One WARC/1.1 record per row of resolved(), as text without the blank lines that end it. A revisit has the HTTP head only, with the payload's length."""
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL * 2))
    again = F.col("refers_to").isNotNull()
    block = F.when(again, head).otherwise(F.concat(head, "payload"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    text = F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{EOL}WARC-Record-ID: "), name("page_id"),
        F.lit(f"{EOL}WARC-Date: {date}{EOL}WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20]", "%20"),
        F.lit(f"{EOL}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(again, F.concat(F.lit(f"{EOL}WARC-Profile: {PROFILE}{EOL}WARC-Refers-To: "), name("refers_to"))).otherwise(F.lit("")),
        F.lit(f"{EOL}Content-Type: application/http; msgtype=response{EOL}Content-Length: "), F.octet_length(block).cast("string"), F.lit(EOL * 2), block,
    )
    return pages.select(text.alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_file: int = 1000) -> None:
    """Writes the records of resolved() pages as gzipped archives with Spark's own committer: a lost task leaves nothing behind.

    An archive is read back whole, so records_per_file bounds a reader's memory; it must stay below 2 GB unpacked.
    """
    records(pages).write.option("lineSep", EOL * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parsed(data: bytes):
    """(headers, block) of each record of an archive, found by Content-Length alone: payloads may hold anything."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/1."):
            raise ValueError(f"no record starts at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
        n = int(headers[b"content-length"])
        yield headers, data[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def _page(value: bytes) -> int | None:
    return int(value[10:-1]) if len(value) > 11 else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives: types, payload sizes and digests; those of responses are computed anew from the payload, a revisit has them in its headers."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                data, out = data.as_py(), []
                for h, block in parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind, said = h[b"warc-type"].decode(), h[b"warc-payload-digest"].decode().removeprefix("sha1:")
                    if kind == "revisit":
                        size, digest = int(next(x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:]), said
                    else:
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    out.append((_page(h[b"warc-record-id"]), h[b"warc-target-uri"].decode(), kind, size, digest, _page(h[b"warc-refers-to"]) if b"warc-refers-to" in h else None, digest == said))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in READ_SCHEMA.split(", ")])

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, READ_SCHEMA)


def archive_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/archive-{uuid.uuid4().hex[:12]}"
