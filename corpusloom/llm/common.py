"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker gets at a time.
BATCH_ROWS = 2000
WORD = r"[^\x20\x09-\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir``. Where it is unset, a new temporary folder in local
    mode, and an error on a cluster, whose machines share no such folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Plans made inside send at most BATCH_ROWS rows at a time to Python, which bounds what a worker holds of long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    had = spark.conf.get(name)
    spark.conf.set(name, str(min(int(had), BATCH_ROWS) if int(had) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, had)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that nothing above is computed twice or lost."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int):
    """crc32 of the column as text, modulo n; null stays null."""
    return F.crc32(F.col(column).cast("string")) % n


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)


def surrogate_key(spark: SparkSession) -> str:
    """The secret key of surrogates, from the session; without one, a public stand-in that protects nothing."""
    found = spark.conf.get("spark.corpusloom.surrogateKey", None)
    if not found:
        logging.getLogger(__name__).warning("spark.corpusloom.surrogateKey is unset: surrogates are made with a public key and can be undone")
    return found or "public-example-key"
