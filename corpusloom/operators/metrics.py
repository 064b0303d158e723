"""Per-page and per-document metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.latex import recommended_phase, sanitized
from ..sources.scratch import settled
from .cleaner import table_counts


def math_density(pages: DataFrame, key: str = "stem", count: str = "formula_count") -> DataFrame:
    """Total, mean, interpolated 90th percentile, pages with formulas and pages, and the recommended phase."""
    n = F.coalesce(F.col(count), F.lit(0))
    out = pages.groupBy(key).agg(
        F.sum(n).alias("formula_total"), F.avg(n).alias("formula_avg_pp"), F.percentile(n, F.lit(0.9)).alias("formula_p90_pp"),
        F.count_if(n > 0).alias("pages_with_formula"), F.count("*").alias("pages_total"),
    )
    return out.withColumn("phase_recommended", recommended_phase(F.col("formula_total")))


def nearest_rank(df: DataFrame, key: str, value: str, share: float, out: str = "p") -> DataFrame:
    """The value at place ceil(share x n) of each group: exact, from counts per value, so large groups stay spread."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    w = W.partitionBy(key).orderBy(value)
    reached = counts.select(key, value, F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(W.partitionBy(key)).alias("all"))
    return reached.where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy(key).agg(F.min(value).alias(out))


def timing_summary(df: DataFrame, key: str, value: str, order: str, rows_per_bucket: int = 100_000) -> DataFrame:
    """Count, sum, mean, and the values at places round((n - 1) q) in arrival order, for q of 0.5 and 0.9.

    Rows are dealt into ranges of (key, order), which also split a key of many rows; places follow from the ranges' counts.
    """
    buckets = max(1, df.count() // rows_per_bucket)
    dealt = df.select(key, value, order).repartitionByRange(buckets, key, order).withColumn("__b", F.spark_partition_id())
    ranged = settled(dealt, "timed")
    sizes = ranged.groupBy(key, "__b").agg(F.count("*").alias("__n"), F.count(value).alias("n"), F.sum(value).alias("total"))
    w = W.partitionBy(key)
    before = sizes.select(F.col(key).alias("__k"), F.col("__b").alias("__c"), F.coalesce(F.sum("__n").over(w.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(w).alias("__all"))
    at = ranged.withColumn("__at", F.row_number().over(W.partitionBy(key, "__b").orderBy(order, value)))
    placed = at.join(before, at[key].eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__c"))).select("__k", value, (F.col("__before") + F.col("__at") - 1).alias("__at"), "__all")
    place = lambda q: F.bround((F.col("__all") - 1) * F.lit(q), 0).cast("long") == F.col("__at")
    places = placed.where(place(0.5) | place(0.9)).groupBy("__k").agg(F.max(F.when(place(0.5), F.col(value))).alias("p50"), F.max(F.when(place(0.9), F.col(value))).alias("p90"))
    sums = sizes.groupBy(key).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).withColumn("mean", F.when(F.col("n") > 0, F.col("total") / F.col("n")))
    return sums.join(places, F.col(key).eqNullSafe(F.col("__k"))).select(key, "n", "total", "mean", "p50", "p90")


#: What page metrics read of a document's nodes.
NODES = "texts array<struct<label string, text string, orig string, prov array<struct<page_no int>>>>"
#: Timings per page and the columns they fill (fixed values).
TIMINGS = {"ocr": "ocr_sec", "page_parse": "parse_sec", "layout": "layout_sec", "table_structure": "table_sec"}


def document_nodes(documents: DataFrame, key: str = "stem") -> DataFrame:
    """(key, page_no, label, chars, dropped): formulas and code of (key, document) rows of nested JSON, once for each page
    of a node's provenance; characters after clamping degenerate formulas, and how many the clamping dropped.

    Of a node without text its original form counts. What cannot be read as JSON has no nodes.
    """
    nodes = documents.select(key, F.inline(F.from_json("document", NODES)["texts"])).where(F.col("label").isin("formula", "code"))
    raw = F.coalesce(F.nullif("text", F.lit("")), "orig", F.lit(""))
    told = nodes.select(key, "label", raw.alias("raw"), "prov").withColumn("kept", F.when(F.col("label") == "formula", F.length(sanitized(F.col("raw"))["latex"])).otherwise(F.length("raw")))
    dropped = F.greatest(F.lit(0), F.length("raw") - F.col("kept"))
    return told.select(key, "label", F.col("kept").alias("chars"), dropped.alias("dropped"), F.explode("prov.page_no").alias("page_no"))


def document_pages(documents: DataFrame, key: str = "stem") -> DataFrame:
    """One row per page of (key, document, page_count, timings, enrich_sec): counts and characters of formulas and code, how
    many formulas were cut and by how much, seconds per page of each timing, and the page's share of the enrichment time.

    ``timings`` maps the names of TIMINGS to seconds in page order; missing ones are 0 and those beyond the pages are left
    out, as are nodes on pages that the document does not have. The enrichment time is split by formula characters, or by
    formulas where there are no characters. Documents without pages have no rows.
    """
    formula = F.col("label") == "formula"
    counted = document_nodes(documents, key).groupBy(key, "page_no").agg(
        F.count_if(formula).alias("formula_count"), F.coalesce(F.sum(F.when(formula, F.col("chars"))), F.lit(0)).alias("formula_chars"), F.count_if(formula & (F.col("dropped") > 0)).alias("formula_truncated"),
        F.coalesce(F.sum(F.when(formula, F.col("dropped"))), F.lit(0)).alias("formula_truncated_chars"), F.count_if(F.col("label") == "code").alias("code_count"),
    )
    counts = [c for c in counted.columns if c not in (key, "page_no")]
    n = F.coalesce("page_count", F.lit(0))
    pages = documents.where(n > 0).select(key, "timings", F.coalesce("enrich_sec", F.lit(0.0)).alias("__enrich"), F.explode(F.sequence(F.lit(1), n)).alias("page_no"))
    seconds = [F.coalesce(F.try_element_at(F.col("timings")[name], F.col("page_no")), F.lit(0.0)).alias(column) for name, column in TIMINGS.items()]
    met = pages.join(counted, [key, "page_no"], "left").select(key, "page_no", "__enrich", *seconds, *(F.coalesce(c, F.lit(0)).alias(c) for c in counts))
    return shared_time(met, F.col("__enrich"), key).withColumnRenamed("time_share", "doc_enrich_share_sec").drop("__enrich")


def page_reports(pages: DataFrame, key: str = "stem") -> DataFrame:
    """(key, report): the rows of document_pages as one JSON object per document, its pages in order."""
    fields = [c for c in pages.columns if c != key]
    grouped = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page_no", *(c for c in fields if c != "page_no")))).alias("pages"), F.sum("doc_enrich_share_sec").alias("__sec"))
    totals = F.struct(F.round("__sec", 9).alias("doc_enrich_total_sec"))
    return grouped.select(key, F.to_json(F.struct(F.col(key).alias("file"), F.size("pages").alias("page_count"), totals.alias("totals"), "pages")).alias("report"))


def per_page(items: DataFrame, key: str = "stem") -> DataFrame:
    """Formula and code counts and formula characters per page from (key, page_no, label, latex) rows."""
    formula = F.col("label") == "formula"
    return items.groupBy(key, "page_no").agg(
        F.count_if(formula).alias("formula_count"), F.count_if(F.col("label") == "code").alias("code_count"), F.coalesce(F.sum(F.when(formula, F.length("latex"))), F.lit(0)).alias("formula_chars"),
    )


def shared_time(pages: DataFrame, total: Column, key: str = "stem") -> DataFrame:
    """pages with the document's time split by formula characters, or by formulas where no characters are known."""
    w = W.partitionBy(key)
    chars, counts = F.sum("formula_chars").over(w), F.sum("formula_count").over(w)
    return pages.withColumn("time_share", F.when(chars > 0, total * F.col("formula_chars") / chars).when(counts > 0, total * F.col("formula_count") / counts).otherwise(0.0))


def domain_summary(attempts: DataFrame, domain: str = "base_domain", ok: str = "success", seconds: str = "seconds") -> DataFrame:
    return attempts.groupBy(domain).agg(F.count("*").alias("attempts"), F.count_if(F.col(ok)).alias("successes"), F.count_if(~F.col(ok)).alias("failures"), F.avg(seconds).alias("mean_seconds"))


def formula_summary(items: DataFrame, key: str = "stem") -> DataFrame:
    return items.groupBy(key).agg(F.count("*").alias("items"), F.count_if(F.col("accept_score") >= 1.0).alias("accepted"), F.sum("time_ms").alias("time_ms"))


def table_summary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, total_tables, malformed_tables) of every file: its tables, as rule lines open them, and their issues."""
    counted = table_counts(F.col(text))
    return docs.select(key, F.coalesce(counted["tables"], F.lit(0)).alias("total_tables"), F.coalesce(counted["issues"], F.lit(0)).alias("malformed_tables"))


def label_shares(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.select(F.count("*").alias("__all"))
    return counts.join(F.broadcast(total), F.lit(True)).select(label, "n", (F.col("n") / F.col("__all")).alias("share"))  # one row beside a row per label


def missing_share(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows whose column is null or blank, and their share; a share of 0 for no rows."""
    blank = F.count_if(F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) == "")
    return df.agg(F.count("*").alias("rows"), blank.alias("missing")).withColumn("share", F.when(F.col("rows") > 0, F.col("missing") / F.col("rows")).otherwise(0.0))


def rolling(attempts: DataFrame, key: str, order: str, error: str, seconds: str, errors: int = 50, durations: int = 200, block: int = 10_000) -> DataFrame:
    """Each attempt with the state of its key at that time: the share of timeouts and of refusals (429, 503 and 403) among
    its last ``errors`` errors, the mean seconds of its last ``durations`` attempts, and whether to ease off: at a fifth of
    either share or beyond a minute, once there has been an error.

    Rows are ranked within their key over ranges of (key, order), so that a busy key is many ranges; windows run over blocks
    of ranks, to which the last rows of the block before are added. A null error is none; shares are null before the first.
    """
    if block < max(errors, durations):
        raise ValueError("a block holds at least a window's rows")
    placed = settled(attempts.repartitionByRange(key, order).withColumn("__b", F.spark_partition_id()), "attempts")
    failed = F.col(error).isNotNull()
    sizes = placed.groupBy(key, "__b").agg(F.count("*").alias("__n"), F.count_if(failed).alias("__m"))
    up = W.partitionBy(key).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(F.col(key).alias("__k"), F.col("__b").alias("__c"), *(F.coalesce(F.sum(c).over(up), F.lit(0)).alias(f"{c}_before") for c in ("__n", "__m")))
    run = W.partitionBy(key, "__b").orderBy(order)
    at = placed.withColumns({"__r": F.row_number().over(run), "__e": F.count_if(failed).over(run.rowsBetween(W.unboundedPreceding, 0))})
    ranked = at.join(before, at[key].eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__c")))
    ranked = settled(ranked.withColumns({"__r": F.col("__r") + F.col("__n_before") - 1, "__e": F.col("__e") + F.col("__m_before")}).select(*attempts.columns, "__r", "__e"), "ranked")

    def windowed(rows: DataFrame, rank: str, n: int, **aggregates: Column) -> DataFrame:
        own = F.floor(F.col(rank) / block)
        copies = F.when(F.col(rank) % block > block - n, F.array(own, own + 1)).otherwise(F.array(own))
        dealt = rows.withColumn("__block", F.explode(copies))
        last = W.partitionBy(key, "__block").orderBy(rank).rowsBetween(1 - n, 0)
        return dealt.withColumns({name: a.over(last) for name, a in aggregates.items()}).where(F.col("__block") == own).drop("__block")

    share = lambda *words: F.avg(F.when(F.rlike(error, F.lit("|".join(words))), 1.0).otherwise(0.0))
    told = windowed(ranked.where(failed).select(key, error, "__e"), "__e", errors, timeout_share=share("Timeout"), refused_share=share("HTTP 429", "HTTP 503", "HTTP 403"))
    told = told.select(F.col(key).alias("__k"), F.col("__e").alias("__f"), "timeout_share", "refused_share")
    timed = windowed(ranked, "__r", durations, mean_seconds=F.avg(seconds))
    met = timed.join(told, timed[key].eqNullSafe(F.col("__k")) & (F.col("__e") == F.col("__f")), "left")
    easing = F.coalesce((F.col("timeout_share") >= 0.2) | (F.col("refused_share") >= 0.2) | (F.col("timeout_share").isNotNull() & (F.col("mean_seconds") > 60)), F.lit(False))
    return met.withColumn("easing", easing).select(*attempts.columns, "timeout_share", "refused_share", "mean_seconds", "easing")
