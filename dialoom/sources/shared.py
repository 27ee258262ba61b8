"""Tables in the folder that all executors share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder (spark.checkpoint.dir), else, in local runs, below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return os.path.join(folder, f"dialoom-{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written once and read back, so what uses them twice does not compute them twice."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
