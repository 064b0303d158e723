"""Incremental runs: new files as a stream, each batch merged into a table once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import base_name, canonical_stem
from ..operators.metadata import merge_results
from ..sources.snapshots import Snapshots


def new_markdown(spark: SparkSession, path: str) -> DataFrame:
    """A stream of (filename, stem, text) of Markdown files as they come."""
    files = spark.readStream.schema("value string").option("wholetext", True).option("pathGlobFilter", "*.md").text(path)
    named = files.withColumn("filename", base_name(F.col("_metadata.file_path")))
    return named.select("filename", canonical_stem(F.col("filename")).alias("stem"), F.col("value").alias("text"))


def process_new(stream: DataFrame, step, table_path: str, checkpoint: str, key: str = "stem") -> StreamingQuery:
    """Runs step(batch) on what is new and merges its rows by key into the table of snapshots at table_path.

    Only the key ranges that a batch touches are rewritten. The number of the batch is committed with its rows, so a batch
    that is run again after a failure changes nothing. Stops when everything there is has been read.
    """

    def merge(batch: DataFrame, number: int) -> None:
        Snapshots(batch.sparkSession, table_path, key).merge(step(batch), merge_results, (checkpoint, number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
