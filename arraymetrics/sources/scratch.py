"""Tables that a later step must find exactly as they were made."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only Spark in one process gets one of its own where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="arraymetrics-")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: what is read from it is the same however often, and after executors are lost. The
    caller's rows depend on it, so it stays until that folder is cleared."""
    path = f"{shared_dir(df.sparkSession)}/points-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
