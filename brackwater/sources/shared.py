"""Tables that cut lineage: written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; on a cluster that would not be shared, so it is refused."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="brackwater-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "table") -> DataFrame:
    """df written as Parquet to the shared folder and read again: later steps don't compute it anew, and lost executors cost nothing."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
