"""Mixing sources to target weights by systematic sampling.

Every document has an expected number of copies, its source's target over its source's size. Within a source
the expected copies are summed up in a fixed order, one random offset per source is added, and a document is
emitted once for each whole number that its interval crosses. The order goes by size class first, so a source's
taken words stay close to its target; the prefix sum is made of bucket counts and ranks inside buckets, so no
task holds a whole source.

Edge cases: null texts have size 0 and are never worth a word; a null source is a source of its own that orders
last; rows with null or repeated ids are ranked like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row per source from here on.

    Targets are min(cap x size, level x weight) with one level for all. Sources reach their caps in the order of
    cap x size / weight, so the level follows from running sums in that order, without iterating.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    by_cap = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    ranked = totals.select("source", "source_size", weight.alias("weight"), (F.lit(cap) * F.col("source_size")).alias("most"))
    summed = ranked.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))).alias("left_over"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_over"),
    )
    open_level = F.when(F.col("left_over") / F.col("weight_over") <= F.col("most") / F.col("weight"), F.col("left_over") / F.col("weight_over"))
    level = F.max(open_level).over(everything)  # of those that fit, the first in the order, which is the largest
    return summed.select("source", "source_size", F.coalesce(F.least("most", level * F.col("weight")), "most").alias("target"))


def _draw(column: Column, digits: int) -> Column:
    """A whole number below 16^digits from the text's md5; null counts as a text of its own."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("null")).cast("binary")), 1, digits), 16, 10).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for every row of docs.

    With ``keep``, those columns of docs instead of doc_id and source, for the rows that have copies.
    """
    tie = F.xxhash64("text")  # of rows of one id and size, so that reruns agree on the text
    light = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), tie.alias("tie"))
    light = written(light, "sizes")
    parts = math.ceil(math.sqrt(light.count()) / 4) or 1  # as many buckets as keep both their number and their rows small
    targets = source_targets(light.select("source", "size"), weights, share, cap)
    bucketed = light.withColumn("kind", F.length(F.bin("size"))).withColumn("part", F.pmod(_draw(F.col("doc_id"), 7), F.lit(parts)))
    counts = bucketed.groupBy("source", "kind", "part").agg(F.count("*").alias("n"))
    running = W.partitionBy("source").orderBy("kind", "part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("source", "kind", "part", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    starts = starts.join(targets, starts["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    within = W.partitionBy("source", "kind", "part").orderBy("size", F.col("doc_id").asc_nulls_first(), "tie")
    ranked = bucketed.withColumn("place", F.row_number().over(within))
    s = starts.select(*[F.col(c).alias(f"s_{c}") for c in ("source", "kind", "part", "before", "source_size", "target")])
    joined = ranked.join(s, ranked["source"].eqNullSafe(s["s_source"]) & (ranked["kind"] == s["s_kind"]) & (ranked["part"] == s["s_part"]))
    each = F.when(F.col("s_source_size") > 0, F.col("s_target") / F.col("s_source_size")).otherwise(F.lit(0.0))
    offset = _draw(F.col("source"), 5) / F.lit(float(16**5))
    upto = F.floor(each * (F.col("s_before") + F.col("place")) + offset)
    since = F.floor(each * (F.col("s_before") + F.col("place") - 1) + offset)
    out = joined.withColumn("copies", (upto - since).cast("int"))
    out = out.select(
        "doc_id", "source", "tie", "size", F.col("s_source_size").alias("source_size"), F.col("s_target").alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )
    return out.drop("tie") if not keep else _with_columns(docs, out, keep)


def _with_columns(docs: DataFrame, mixed: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns of docs beside the light rows: texts are shuffled once, and equal rows are told apart by number."""
    number = lambda *by: F.row_number().over(W.partitionBy("__row").orderBy(*by))
    row = lambda *names: F.xxhash64(*names)
    few = mixed.withColumn("__row", row("doc_id", "source", "size", "tie")).withColumn("__nth", number("copies"))
    few = few.where("copies > 0").drop("tie", *[c for c in keep if c in mixed.columns])
    full = docs.select(*[F.col(c).alias(f"__mix_{c}") for c in keep], row("doc_id", "source", word_count(F.col("text")), F.xxhash64("text")).alias("__row"))
    full = full.withColumn("__nth", number(F.lit(0)))
    joined = full.join(few, ["__row", "__nth"]).drop("__row", "__nth")
    return joined.select(*[F.col(f"__mix_{c}").alias(c) for c in keep], *[c for c in few.columns if not c.startswith("__")])
