"""A training corpus in five stages: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontaminate, packing, shingles, substrings, toxicity
from tidemill.llm.common import staged, table, without

#: Bytes of texts that a task of the third stage holds at once: half of what it is where nothing ran before in the same executors.
CHUNK = 3 << 20
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents scored 0.5 or more by a scorer that learned from labels of documents that are not held out (one in five).

    Null and empty texts are scored like any other, long ones whole; repeated rows are scored each; null ids and other columns are kept as
    they are; without documents or labels of both kinds the score is one for all, and an empty table gives no rows.
    """
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id", 5))
    got = toxicity.scored(docs, toxicity.trained(docs, labels), carry=COLUMNS[1:])
    return got.filter(F.col("score") < 0.5).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """With `key`: the id; a document without one gets a number from its text, larger than ids are, so that rows which share it have one text."""
    return docs.select(*COLUMNS).withColumn("key", F.coalesce("doc_id", F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of documents that share 0.8 of their shingles of five words.

    Rows that share an id are one document; of rows without an id that share their text one is kept, the least by lang, source
    and n_chars with nulls first, and such a row yields to any with an id.
    Texts without words, null ones included, are one group; a text of fewer than five words is one shingle, long ones are compared whole;
    an empty table gives no rows.
    """
    keyed = _keyed(docs)
    kept = without(keyed, shingles.near_duplicates(keyed, id_col="key").select(F.col("doc_id").alias("key")), "key")
    unnamed = kept.filter("doc_id IS NULL").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return kept.filter("doc_id IS NOT NULL").select(*COLUMNS).union(unnamed)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the words of passages of 50 words that also start in a document with a smaller id; a document of which nothing is left goes.

    The other words keep their blanks and line ends; a text from which nothing is cut stays as it is (a null one becomes empty). A document
    without an id counts as one with a number from its text, larger than ids are; rows that share an id are one document and do not cut from
    each other; long texts are read whole; an empty table gives no rows.
    """
    got = substrings.without_repeated_passages(_keyed(docs).withColumnRenamed("doc_id", "named"), id_col="key", carry=("named", "lang", "source", "n_chars"), layout=True, chunk_bytes=CHUNK)
    got = got.withColumn("doc_id", F.col("named"))
    cut = F.size("spans") > 0
    left = got.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.filter(~cut | (F.length("text") > 0)).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, renamed or not.

    Null and empty texts hold none; long texts are searched whole; rows that share an id go together, and so do rows without one that share
    their text; without benchmark items all documents stay, and an empty table gives no rows.
    """
    keyed = _keyed(docs)
    found = decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col="key").select(F.col("doc_id").alias("key"))
    return without(keyed, found, "key").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens. Null texts are empty and give their end only; null
    ids stay null; repeated rows are packed each; long texts are cut into pieces; an empty table gives no rows."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("toxicity", toxic), ("near duplicates", near_duplicates), ("repeated passages", passages), ("benchmark passages", benchmark_passages), ("packing", packed)]

#: The scorer of the first stage and the components of the second have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
