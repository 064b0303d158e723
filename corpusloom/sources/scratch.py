"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a new temporary folder in local mode, and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that nothing above it is computed twice or lost."""
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
