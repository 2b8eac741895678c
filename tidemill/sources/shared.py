"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset and Spark runs in one process (tests, one machine) is a local folder set."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemill-"))
    return context.getCheckpointDir()


def staged(frame: DataFrame, name: str) -> DataFrame:
    """frame as a Parquet table in the shared folder: computed once, read again without its lineage."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
