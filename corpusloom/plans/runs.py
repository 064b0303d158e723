"""Queries on runs: long documents in rounds, limits and batches, failures over runs, tables of snapshots, files as rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metadata, rounds
from ..sources import files, listing
from ..sources.scratch import scratch_folder
from ..sources.snapshots import Snapshots
from .documents import table
from .tables import _META, _meta


def _convert(ranges: DataFrame) -> DataFrame:
    """Stands for a converter: what comes of a range follows from its document and page; some time out once, some twice."""
    kind = F.pmod(F.substring("stem", 2, 20).cast("long") * 31 + F.col("page_start"), F.lit(17))
    slow = kind < F.when(F.col("retries") == 0, 4).otherwise(2)
    status = F.when(kind == 16, "error").when(kind == 15, "partial").when(slow, "timeout").otherwise("ok")
    text = F.when(status.isin(*rounds.DONE), F.concat(F.lit("pages "), F.col("page_start").cast("string"), F.lit(" to "), F.col("page_end").cast("string")))
    return ranges.select("stem", "page_start", status.alias("status"), (F.col("page_end") - F.col("page_start") + F.col("retries") / 2).alias("seconds"), text.alias("text"))


def long_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with as many pages as characters, up to 3,000, converted by ranges of pages in rounds and put together."""
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"), (F.coalesce("n_chars", F.lit(0)) % 3000 + 1).cast("int").alias("page_count"))
    converted = rounds.convert_in_rounds(files.page_ranges(docs.distinct()), _convert)
    return rounds.assembled(converted).select("stem", "complete", "status", "chunk_count", "missing", "text")


LONG_DOCUMENTS_SQL = """
WITH d AS (SELECT DISTINCT doc_id, CAST(coalesce(n_chars, 0) % 3000 + 1 AS INTEGER) AS pages FROM documents WHERE doc_id IS NOT NULL
), r AS (SELECT *, unnest(CASE WHEN pages > 600 THEN range(1, pages + 1, 200) ELSE [1] END) AS page_start FROM d
), s AS (
  SELECT *, CASE WHEN pages > 600 THEN least(page_start + 199, pages) ELSE pages END AS page_end,
    CASE WHEN (doc_id * 31 + page_start) % 17 = 16 THEN 'error' WHEN (doc_id * 31 + page_start) % 17 = 15 THEN 'partial' WHEN (doc_id * 31 + page_start) % 17 < 2 THEN 'timeout' ELSE 'ok' END AS status FROM r
), b AS (
  SELECT *, coalesce(sum(CAST(status = 'error' AS INTEGER)) OVER w, 0) AS errors, coalesce(sum(CAST(status = 'timeout' AS INTEGER)) OVER w, 0) AS timeouts
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY page_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT doc_id, count(*) AS chunk_count, count(*) FILTER (status = 'timeout') AS missing, bool_or(status = 'error') OR count(*) FILTER (status = 'timeout') > 1 AS given_up, arg_max(status, page_start) AS last,
    string_agg('pages ' || page_start || ' to ' || page_end, chr(10) || chr(10) ORDER BY page_start) FILTER (status IN ('ok', 'partial')) AS text FROM b WHERE errors = 0 AND timeouts < 2 GROUP BY doc_id
)
SELECT 'd' || doc_id AS stem, NOT given_up AS complete, CASE WHEN given_up THEN last ELSE 'ok' END AS status, chunk_count, missing, CASE WHEN NOT given_up THEN coalesce(text, '') END AS text FROM g
"""


def batch_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 orders as documents, four lines of each as pages, in batches of three with the time of their batch."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey is not null").select("o_orderdate", F.col("o_orderkey").alias("stem"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("stem"), F.col("l_linenumber").alias("page_no"), "l_partkey", "l_quantity").join(rounds.first_rows(orders, 2000, "o_orderdate", "stem").select("stem"), "stem", "left_semi")
    items = rounds.batched(rounds.capped_pages(lines.dropDuplicates(["stem", "page_no"]), 4), 3, "page_no")
    batches = items.where("batch = 0 or stem % 5 <> 0").groupBy("stem", "batch").agg(F.sum(F.col("page_no") * 37).alias("batch_ms"))
    return rounds.timed_items(items, batches).select("stem", "page_no", "batch", "time_ms")


BATCH_BUDGETS_SQL = """
WITH o AS (SELECT o_orderkey AS stem FROM orders WHERE o_orderkey IS NOT NULL ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 2000
), l AS (SELECT DISTINCT l_orderkey AS stem, l_linenumber AS page_no FROM lineitem WHERE l_orderkey IN (SELECT stem FROM o)
), i AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY page_no) AS nth FROM l
), b AS (SELECT stem, page_no, CAST((nth - 1) // 3 AS INTEGER) AS batch FROM i WHERE nth <= 4)
SELECT stem, page_no, batch, CAST(CASE WHEN batch = 0 OR stem % 5 <> 0 THEN floor(sum(page_no * 37) OVER w / count(*) OVER w) ELSE 0 END AS BIGINT) AS time_ms FROM b WINDOW w AS (PARTITION BY stem, batch)
"""


def failures_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts at their users in three runs: failures that add up, and who is worth another try."""
    attempts = table(spark, sf_dir, "events").where("user_id is not null and value % 3 < 1").select(F.col("user_id").alias("url"), (F.col("event_id") % 3).alias("run"), (F.col("value") % 1 > 0.35).alias("success"), F.col("event_type").alias("error"))
    counts = None
    for run in range(3):
        now = attempts.where(F.col("run") == run)
        counts = rounds.counted_failures(counts, now if counts is None else rounds.worth_trying(now, counts))
    return rounds.worth_trying(counts, counts).select("url", "download_retry_count", "last_error")


FAILURES_SQL = """
WITH a AS (SELECT user_id AS url, event_id % 3 AS run, value % 1 > 0.35 AS ok, event_type AS e FROM events WHERE user_id IS NOT NULL AND value % 3 < 1
), r AS (SELECT url, run, count(*) FILTER (NOT ok) AS n, bool_or(ok) AS ok, max(e) FILTER (NOT ok) AS e FROM a GROUP BY ALL
), x AS (SELECT url, CASE WHEN ok THEN 0 ELSE n END AS n, CASE WHEN NOT ok THEN e END AS e FROM r WHERE run = 0
), y AS (
  SELECT coalesce(x.url, r.url) AS url, CASE WHEN coalesce(r.ok AND coalesce(x.n, 0) < 3, false) THEN 0 ELSE coalesce(x.n, 0) + CASE WHEN coalesce(x.n, 0) < 3 THEN coalesce(r.n, 0) ELSE 0 END END AS n,
    CASE WHEN coalesce(r.ok AND coalesce(x.n, 0) < 3, false) THEN NULL WHEN coalesce(x.n, 0) < 3 THEN coalesce(r.e, x.e) ELSE x.e END AS e FROM x FULL JOIN (SELECT * FROM r WHERE run = 1) r ON x.url = r.url
), z AS (
  SELECT coalesce(y.url, r.url) AS url, CASE WHEN coalesce(r.ok AND coalesce(y.n, 0) < 3, false) THEN 0 ELSE coalesce(y.n, 0) + CASE WHEN coalesce(y.n, 0) < 3 THEN coalesce(r.n, 0) ELSE 0 END END AS n,
    CASE WHEN coalesce(r.ok AND coalesce(y.n, 0) < 3, false) THEN NULL WHEN coalesce(y.n, 0) < 3 THEN coalesce(r.e, y.e) ELSE y.e END AS e FROM y FULL JOIN (SELECT * FROM r WHERE run = 2) r ON y.url = r.url
)
SELECT url, CAST(n AS INTEGER) AS download_retry_count, e AS last_error FROM z WHERE n < 3
"""


def snapshot_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of snapshots made of metadata, over small ranges, merged with updates and new rows; its newest version."""
    meta = _meta(spark, sf_dir)
    rows = Snapshots(spark, f"{scratch_folder(spark)}/snapshots-{uuid.uuid4().hex}", "stem", range_rows=max(100, meta.count() // 20))
    rows.replace(meta.where("doc_id % 4 <> 0").select("stem", "filename", F.lit("old").alias("state")))
    rows.merge(meta.where("quality = 1").select("stem", F.lit("good").alias("state"), F.col("page_count").alias("pages")))
    rows.merge(meta.where("toxic = 1").select("stem", "filename", F.lit("toxic").alias("state")), metadata.merge_results)
    return rows.read()


SNAPSHOTS_SQL = f"""
WITH {_META}, a AS (SELECT stem, filename, 'old' AS state FROM m WHERE doc_id % 4 <> 0), b AS (SELECT stem, 'good' AS state, page_count FROM m WHERE quality = 1
), c AS (SELECT coalesce(a.stem, b.stem) AS stem, filename, coalesce(b.state, a.state) AS state, page_count AS pages FROM a FULL JOIN b ON a.stem = b.stem)
SELECT * FROM c WHERE stem NOT IN (SELECT stem FROM m WHERE toxic = 1) UNION ALL SELECT stem, filename, 'toxic', NULL FROM m WHERE toxic = 1
"""


def probed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes put into a table of half of the documents; the others come in with the file that a listing has of them."""
    meta = _meta(spark, sf_dir)
    i = F.col("doc_id")
    exts = F.filter(F.array(F.when(i % 2 == 0, "md"), F.when(i % 3 == 0, "csv"), F.when(i % 5 == 0, "docx"), F.when(i % 7 == 0, "zip"), F.when(i % 11 == 0, "HTML")), lambda x: x.isNotNull())
    found = meta.select("stem", F.explode(exts).alias("ext")).withColumn("filename", F.concat("stem", F.lit("."), "ext"))
    known = meta.where("doc_id % 2 = 1").select("stem", "filename", F.lit("").alias("processing_stage"), F.lit("").alias("extract_status"))
    saved = metadata.save_state(known, meta.where("quality = 1").select("stem"), meta.where("toxic = 1").select("stem"), found)
    return saved.select("stem", "filename", "file_ext", "download_success", "extract_status")


PROBED_SQL = f"""
WITH {_META}, k AS (SELECT stem, max(r) AS r FROM (SELECT stem, 1 AS r FROM m WHERE quality = 1 UNION ALL SELECT stem, 2 FROM m WHERE toxic = 1) GROUP BY stem
), n AS (
  SELECT m.stem, filename, r, doc_id % 2 = 1 AS known, CASE WHEN doc_id % 5 = 0 THEN 'docx' WHEN doc_id % 11 = 0 THEN 'HTML' WHEN doc_id % 3 = 0 THEN 'csv' WHEN doc_id % 2 = 0 THEN 'md' END AS ext
  FROM m LEFT JOIN k ON m.stem = k.stem WHERE doc_id % 2 = 1 OR r IS NOT NULL
)
SELECT stem, CASE WHEN known THEN filename ELSE stem || '.' || coalesce(ext, 'pdf') END AS filename, CASE WHEN NOT known THEN coalesce(ext, 'pdf') END AS file_ext, CASE WHEN NOT known THEN ext IS NOT NULL END AS download_success,
  CASE r WHEN 2 THEN 'failed' WHEN 1 THEN 'success' ELSE '' END AS extract_status FROM n
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns and kind of the given tables from the footers of their files alone."""
    footers = listing.read_footers(spark, sf_dir).withColumn("name", F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]+)?$", 1))
    names = F.array_sort("columns")
    return footers.where(F.col("name").isin(*TABLES)).groupBy("name").agg(
        F.sum("rows").alias("rows"), F.max(F.array_join(names, ",")).alias("columns"), F.max(F.coalesce(listing.kind_of(F.col("columns"), "text"), F.lit("other"))).alias("kind"), F.min(F.size(listing.lacking(F.col("properties")))).alias("lacking"),
    )


FOOTERS_SQL = "\nUNION ALL ".join(f"SELECT '{t}' AS name, (SELECT CAST(count(*) AS BIGINT) FROM {t}) AS rows, (SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (DESCRIBE {t})) AS columns, 'other' AS kind, 4 AS lacking" for t in TABLES)

QUERIES = {
    "long_documents": (long_documents, LONG_DOCUMENTS_SQL), "batch_budgets": (batch_budgets, BATCH_BUDGETS_SQL), "failures_over_runs": (failures_over_runs, FAILURES_SQL), "snapshot_merges": (snapshot_merges, SNAPSHOTS_SQL),
    "probed_names": (probed_names, PROBED_SQL), "table_footers": (table_footers, FOOTERS_SQL),
}
