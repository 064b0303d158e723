"""URL tables: exploding links, marking duplicates, giving out file names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.names import generated_name
from ..functions.urls import canonical_url, links_of
from ..sources.scratch import settled


#: The error of rows left out as duplicates (fixed value).
DUPLICATE_ERROR = "Duplicate URL (skipped)"


def url_column(df: DataFrame, wanted: str = "url") -> str:
    """The wanted column, else the first whose name speaks of a URL; ValueError if there is none."""
    if wanted in df.columns:
        return wanted
    for name in df.columns:
        if any(part in name.lower() for part in ("url", "link", "uri")):
            return name
    raise ValueError(f"no column {wanted!r}, nor one that looks like it")


def explode_links(df: DataFrame, cell: str = "url", row: str = "row_idx") -> DataFrame:
    """One row per link with source_row and url_index; a row without links stays once, with '' and -1."""
    return df.select(*[c for c in df.columns if c != cell], F.col(row).alias("source_row"), F.posexplode_outer(links_of(F.col(cell))).alias("__pos", "__url")).select(
        *[c for c in df.columns if c != cell], "source_row", F.coalesce("__pos", F.lit(-1)).alias("url_index"), F.coalesce("__url", F.lit("")).alias(cell)
    )


def mark_duplicates(df: DataFrame, url: str = "url", order: str = "row_idx") -> DataFrame:
    """Adds url_norm, is_duplicate, duplicate_of (the first row's URL) and, where it is blank, download_error; empty URLs
    are each other's duplicates. ``order`` may be any column that orders, also a struct.

    The first row of a form is found by aggregation and joined back, so a URL of a third of the rows is split like
    any skewed join key instead of filling one window.
    """
    normed = df.withColumn("url_norm", canonical_url(F.col(url)))
    first = normed.groupBy("url_norm").agg(F.min_by(F.struct(F.col(order).alias("o"), F.col(url).alias("u")), F.col(order)).alias("__first"))
    joined = normed.join(first, "url_norm", "left")
    duplicate = F.col(order) != F.col("__first.o")
    had = F.coalesce("download_error", F.lit("")) if "download_error" in df.columns else F.lit("")
    return joined.select(
        *[c for c in df.columns if c != "download_error"], "url_norm", duplicate.alias("is_duplicate"), F.when(duplicate, F.coalesce("__first.u", F.lit(""))).otherwise("").alias("duplicate_of"),
        F.when(duplicate & (had == ""), DUPLICATE_ERROR).otherwise(had).alias("download_error"),
    )


def bucketed_rank(df: DataFrame, order: str, out: str, rows_per_bucket: int = 100_000) -> DataFrame:
    """A global 0-based rank by a column: ranges of the column as Spark finds them, their counts, and ranks inside.

    Ranges follow the rows and not the values, so outliers leave no range with all rows.
    """
    buckets = max(1, df.count() // rows_per_bucket)
    ranged = settled(df.repartitionByRange(buckets, order).withColumn("__bucket", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = sizes.select("__bucket", F.coalesce(F.sum("__n").over(W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    placed = ranged.withColumn("__place", F.row_number().over(W.partitionBy("__bucket").orderBy(order)))
    return placed.join(before, "__bucket").withColumn(out, F.col("__before") + F.col("__place") - 1).drop("__bucket", "__before", "__place")


#: Numbers after which generated names come again (fixed value).
NAME_PERIOD = 2_197_000


def unique_name(index):
    """The generated name of a number, with the round behind it from the second round on."""
    again = F.floor(index / NAME_PERIOD)
    return F.concat(generated_name(index), F.when(again > 0, F.concat(F.lit("_"), again.cast("string"))).otherwise(""))


def assign_names(df: DataFrame, used: DataFrame, order: str = "row_idx", out: str = "filename_base") -> DataFrame:
    """Gives every row without a name the next generated name not in ``used`` (column ``name``), in row order.

    Free numbers are a range as long as rows and used names together, less the used ones, ranked like the rows.
    """
    waiting = df.where(F.coalesce(out, F.lit("")) == "") if out in df.columns else df
    n = waiting.count() + used.count()
    free = df.sparkSession.range(n).withColumn("name", unique_name(F.col("id"))).join(used.select("name").distinct(), "name", "left_anti")
    ranked = bucketed_rank(waiting.drop(out), order, "__rank")
    named = bucketed_rank(free, "id", "__rank").select("__rank", F.col("name").alias(out))
    return ranked.join(named, "__rank").drop("__rank")
