"""Conversion of long documents by page ranges, in rounds, and work in batches under limits.

A round sends all ranges that still have to be tried through an adapter at once; what timed out is tried again in the next
round, unless its document has been given up. What a run in page order would have left behind, and which texts make up the
document, follows from the ranges' last outcomes.

Edge cases: a range that an adapter does not answer counts as an error; documents without ranges do not appear; a null text
of a converted range is empty; ranges converted beyond the one at which their document is given up are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.scratch import settled

#: Tries of a range, and ranges that may time out before their document is given up (fixed values).
TRIES, STRIKES = 2, 2
DONE = ("ok", "partial")


def convert_in_rounds(ranges: DataFrame, convert: Callable[[DataFrame], DataFrame], tries: int = TRIES, key: str = "stem") -> DataFrame:
    """(key, page_start, page_end, status, seconds, retries, text) of each range.

    convert: from (key, page_start, page_end, retries) rows to (key, page_start, status, seconds, text) rows, where status is
    ok, partial, timeout or error. A range that timed out is tried again, up to ``tries`` times, unless a range before it in
    its document has ended in an error. Seconds are those of all tries.
    """
    names = [key, "page_start", "page_end"]
    todo, done = settled(ranges.select(*names, F.lit(0.0).alias("spent")), "ranges"), None
    for turn in range(tries):
        told = convert(todo.select(*names, F.lit(turn).alias("retries"))).select(F.col(key).alias("__k"), F.col("page_start").alias("__p"), "status", F.col("seconds").alias("__s"), "text")
        met = todo.join(told, (F.col(key) == F.col("__k")) & (F.col("page_start") == F.col("__p")), "left")
        tried = settled(met.select(*names, F.coalesce("status", F.lit("error")).alias("status"), (F.col("spent") + F.coalesce("__s", F.lit(0.0))).alias("seconds"), F.lit(turn).alias("retries"), "text"), "round")
        failed = tried.where("status = 'error'").groupBy(F.col(key).alias("__k")).agg(F.min("page_start").alias("__p"))
        given_up = (F.col(key) == F.col("__k")) & (F.col("__p") < F.col("page_start"))
        again = tried.where("status = 'timeout'").join(failed, given_up, "left_anti") if turn + 1 < tries else tried.limit(0)
        again = settled(again.select(*names, F.col("seconds").alias("spent")), "again")
        ended = tried.join(again.select(key, "page_start"), [key, "page_start"], "left_anti").select(*tried.columns)
        done = ended if done is None else done.unionByName(ended)
        if again.isEmpty():
            break
        todo = again
    return settled(done, "converted")


def entries(converted: DataFrame, strikes: int = STRIKES, key: str = "stem") -> DataFrame:
    """converted with index (from 1) and counted, whether a run in page order comes to the range: no range before it ended in
    an error, and fewer than ``strikes`` of them timed out."""
    w = W.partitionBy(key).orderBy("page_start")
    before = lambda status: F.coalesce(F.sum((F.col("status") == status).cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return converted.withColumns({"index": F.row_number().over(w), "counted": (before("error") == 0) & (before("timeout") < strikes)})


def assembled(converted: DataFrame, strikes: int = STRIKES, key: str = "stem") -> DataFrame:
    """(key, complete, status, chunk_count, missing, text, manifest) of each document.

    A document is complete if no range ended in an error and fewer than ``strikes`` timed out; its text joins those of its
    ranges in page order with an empty line between them, one that timed out missing. Another has a null text and the status
    of the range at which it was given up. The manifest is JSON: the ranges that were come to, in order.
    """
    judged = entries(converted, strikes, key).where("counted")
    ok = F.col("status").isin(*DONE)
    part = F.struct("index", "page_start", "page_end", "status", F.round("seconds", 3).alias("duration_s"), "retries")
    grouped = judged.groupBy(key).agg(
        F.array_sort(F.collect_list(part)).alias("__parts"), F.array_sort(F.collect_list(F.when(ok, F.struct("index", F.coalesce("text", F.lit("")).alias("text"))))).alias("__texts"),
        F.count_if(F.col("status") == "timeout").alias("missing"), F.count_if(F.col("status") == "error").alias("__errors"), F.max_by("status", "index").alias("__last"), F.count("*").alias("chunk_count"),
    )
    complete = (F.col("__errors") == 0) & (F.col("missing") < strikes)
    text = F.array_join(F.transform("__texts", lambda t: t["text"]), "\n\n")
    manifest = F.to_json(F.struct(F.col(key).alias("file"), F.col("__parts").alias("entries")))
    return grouped.select(key, complete.alias("complete"), F.when(complete, "ok").otherwise(F.col("__last")).alias("status"), "chunk_count", "missing", F.when(complete, text).alias("text"), manifest.alias("manifest"))


def first_rows(df: DataFrame, limit: int, *order: str) -> DataFrame:
    """The first ``limit`` rows by ``order``: rows are dealt into ranges, whole ranges are taken by their counts, and only the
    range that holds the border is sorted. Ties beyond ``order`` are broken by the other columns' hash."""
    if limit <= 0:
        return df.limit(0)
    placed = settled(df.repartitionByRange(*order).withColumn("__b", F.spark_partition_id()), "ranged")
    sizes = placed.groupBy("__b").agg(F.count("*").alias("__n"))
    before = sizes.select("__b", "__n", F.coalesce(F.sum("__n").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    met = placed.join(F.broadcast(before.where(F.col("__before") < limit)), "__b")  # a row a range
    whole = met.where(F.col("__before") + F.col("__n") <= limit)
    border = met.where(F.col("__before") + F.col("__n") > limit).withColumn("__at", F.row_number().over(W.partitionBy("__b").orderBy(*order, F.xxhash64(*df.columns))))
    return whole.select(*df.columns).unionByName(border.where(F.col("__before") + F.col("__at") <= limit).select(*df.columns))


def capped_pages(pages: DataFrame, most: int | None, key: str = "stem", page: str = "page_no") -> DataFrame:
    """The first ``most`` pages of each document (all without a cap)."""
    if most is None:
        return pages
    return pages.withColumn("__at", F.row_number().over(W.partitionBy(key).orderBy(page))).where(F.col("__at") <= most).drop("__at")


def batched(items: DataFrame, size: int, *order: str, key: str = "stem") -> DataFrame:
    """items with batch, from 0 within each document: ``size`` items in ``order`` each, the last batch the rest."""
    at = F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1
    return items.withColumn("batch", F.floor(at / size).cast("int"))


def timed_items(items: DataFrame, batches: DataFrame, key: str = "stem") -> DataFrame:
    """items (key, batch, ...) with time_ms, the whole milliseconds of an equal share of their batch's time.

    batches: (key, batch, batch_ms); a batch without a time has 0.
    """
    sizes = items.groupBy(key, "batch").agg(F.count("*").alias("__n"))
    shares = sizes.join(batches.select(key, "batch", "batch_ms"), [key, "batch"], "left").select(key, "batch", F.floor(F.coalesce("batch_ms", F.lit(0)) / F.col("__n")).alias("time_ms"))
    return items.join(shares, [key, "batch"])


def counted_failures(before: DataFrame | None, attempts: DataFrame, key: str = "url") -> DataFrame:
    """(key, download_retry_count, last_error): failures of earlier runs and of this one added up; a success sets them to 0.

    attempts: (key, success, error) rows of one run, at most a success and any number of failures a key.
    """
    now = attempts.groupBy(key).agg(F.count_if(~F.col("success")).alias("__n"), F.max("success").alias("__ok"), F.max(F.when(~F.col("success"), F.col("error"))).alias("__error"))
    if before is None:
        return now.select(key, F.when(F.col("__ok"), 0).otherwise(F.col("__n")).cast("int").alias("download_retry_count"), F.when(~F.col("__ok"), F.col("__error")).alias("last_error"))
    met = before.select(key, "download_retry_count", "last_error").join(now, key, "full_outer")
    count = F.when(F.coalesce("__ok", F.lit(False)), 0).otherwise(F.coalesce("download_retry_count", F.lit(0)) + F.coalesce("__n", F.lit(0))).cast("int")
    error = F.when(F.coalesce("__ok", F.lit(False)), None).otherwise(F.coalesce("__error", "last_error"))
    return met.select(key, count.alias("download_retry_count"), error.alias("last_error"))


def worth_trying(items: DataFrame, counts: DataFrame | None, most: int = 3, key: str = "url") -> DataFrame:
    """items whose key has failed fewer than ``most`` times so far."""
    if counts is None:
        return items
    return items.join(counts.where(F.col("download_retry_count") >= most).select(key), key, "left_anti")
