"""Queries on what phases leave behind: metrics of pages, results of formulas, states, settings per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import greek_prep, latex, values
from ..operators import export, gates, metadata, metrics
from . import documents, tables
from .documents import table

_META, _meta = tables._META, tables._meta


def page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as formulas and code of pages, and a minute of each order's time split over its pages."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("stem"), F.pmod(F.col("l_linenumber"), F.lit(3)).cast("int").alias("page_no"), F.when(F.col("l_partkey") % 3 == 0, "code").otherwise("formula").alias("label"),
        F.when(F.col("l_orderkey") % 7 != 0, F.repeat(F.lit("x"), F.col("l_quantity").cast("int"))).alias("latex"),
    )
    return metrics.shared_time(metrics.per_page(items), F.lit(60.0))


PAGE_METRICS_SQL = """
WITH p AS (
  SELECT l_orderkey AS stem, CAST(l_linenumber % 3 AS INTEGER) AS page_no, count(*) FILTER (l_partkey % 3 <> 0) AS formula_count, count(*) FILTER (l_partkey % 3 = 0) AS code_count,
    CAST(coalesce(sum(CASE WHEN l_partkey % 3 <> 0 AND l_orderkey % 7 <> 0 THEN CAST(l_quantity AS INTEGER) END), 0) AS BIGINT) AS formula_chars FROM lineitem GROUP BY 1, 2
), s AS (SELECT *, sum(formula_chars) OVER (PARTITION BY stem) AS chars, sum(formula_count) OVER (PARTITION BY stem) AS counts FROM p)
SELECT stem, page_no, formula_count, code_count, formula_chars, CASE WHEN chars > 0 THEN 60.0::DOUBLE * formula_chars / chars WHEN counts > 0 THEN 60.0::DOUBLE * formula_count / counts ELSE 0.0 END AS time_share FROM s
"""


def formula_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of formulas (order lines) summed up by document and put into its metadata; unknown documents add no row."""
    items = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("d"), F.col("l_partkey").cast("string")).alias("stem"), F.when(F.col("l_linenumber") % 2 == 0, 1.0).otherwise(0.0).alias("accept_score"), F.col("l_quantity").cast("int").alias("time_ms")
    )
    results = metrics.formula_summary(items).withColumn("time_sec", F.col("time_ms") / 1000)
    meta = metadata.with_defaults(_meta(spark, sf_dir).select("stem", F.when(F.col("doc_id") % 5 == 0, F.lit(3)).alias("math_items"), (F.col("doc_id") % 5 == 0).alias("math_enriched")))
    return metadata.math_update(meta, results).select("stem", "math_enriched", "math_items", "math_accepted", "math_accept_rate", "math_time_sec")


FORMULA_RESULTS_SQL = f"""
WITH {_META}, r AS (SELECT 'd' || l_partkey AS stem, count(*) AS items, count(*) FILTER (l_linenumber % 2 = 0) AS accepted, sum(CAST(l_quantity AS INTEGER)) / 1000 AS t FROM lineitem GROUP BY 1)
SELECT m.stem, r.stem IS NOT NULL OR doc_id % 5 = 0 AS math_enriched, coalesce(items, CASE WHEN doc_id % 5 = 0 THEN 3 END) AS math_items, accepted AS math_accepted, accepted / items AS math_accept_rate, t AS math_time_sec
FROM m LEFT JOIN r ON m.stem = r.stem
"""


def triage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formula statistics of orders put into the metadata of documents of the same stem; the others come in as rows."""
    pages = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("d"), F.col("l_orderkey").cast("string")).alias("stem"), F.floor(F.col("l_quantity") / 25).alias("formula_count"))
    meta = _meta(spark, sf_dir).select("stem", "filename", F.lit(-1).cast("long").alias("formula_total"))
    return metadata.triage_update(meta, metrics.math_density(pages))


TRIAGE_SQL = f"""
WITH {_META}, p AS (SELECT 'd' || l_orderkey AS stem, CAST(floor(l_quantity / 25) AS BIGINT) AS n FROM lineitem
), d AS (SELECT stem, CAST(sum(n) AS BIGINT) AS total, avg(n) AS mean, quantile_cont(CAST(n AS DOUBLE), 0.9) AS p90, count(*) FILTER (n > 0) AS holding, count(*) AS pages FROM p GROUP BY stem)
SELECT coalesce(m.stem, d.stem) AS stem, coalesce(filename, d.stem || '.pdf') AS filename, coalesce(total, -1) AS formula_total, round_even(mean, 3) AS formula_avg_pp, round_even(p90, 3) AS formula_p90_pp,
  holding AS pages_with_formula, pages AS pages_total, CASE WHEN d.stem IS NULL THEN NULL WHEN total > 0 THEN '2A' ELSE 'stop' END AS phase_recommended FROM m FULL JOIN d ON m.stem = d.stem
"""


def section_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.section_candidates(gates.gate(_meta(spark, sf_dir), 200, 2)).select("stem", "filter", "ocr_success")


SECTION_ROUTING_SQL = f"WITH {_META}, g AS ({tables.CLEAN_GATES_SQL}) SELECT stem, g.filter, ocr_success FROM g JOIN m ON g.filename = m.filename WHERE g.filter = 'ok' OR ocr_success"


def ocr_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for recognition when those done are read again, without skipped ones."""
    skip = table(spark, sf_dir, "labels").where("toxic = 1").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"))
    return gates.ocr_candidates(gates.gate(_meta(spark, sf_dir), 200, 2), skip, reprocess=True).select("stem", "needs_ocr", "ocr_success")


OCR_AGAIN_SQL = f"""
WITH {_META}, g AS ({tables.CLEAN_GATES_SQL})
SELECT stem, g.needs_ocr, ocr_success FROM g JOIN m ON g.filename = m.filename WHERE (g.needs_ocr OR ocr_success) AND stem NOT IN (SELECT 'd' || doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
"""


def settled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of columns that repeated joins leave, made one; scores rounded, old names replaced."""
    i = F.col("doc_id")
    return gates.settle_columns(_meta(spark, sf_dir).select(
        "stem", F.when(i % 3 == 0, i % 6).alias("page_count_x"), F.when(i % 3 != 1, i % 4).alias("page_count_y"), F.col("char_count_no_comments").alias("char_count_no_comments_y"),
        (F.col("greek_badness_score") / 7).alias("greek_badness_score"), ((i % 40) / 9).alias("polytonic_ratio"), ((i % 50) / 3).alias("mojibake_latin_percentage"),
        F.when(i % 2 == 0, "short").alias("rejection_reason"), F.lit(0.5).alias("greek_latin_percentage"),
    ))


SETTLED_SQL = f"""
WITH {_META} SELECT stem, coalesce(CASE WHEN doc_id % 3 = 0 THEN doc_id % 6 END, CASE WHEN doc_id % 3 <> 1 THEN doc_id % 4 END) AS page_count, char_count_no_comments, round_even(greek_badness_score / 7, 3) AS greek_badness_score,
  round_even((doc_id % 40) / 9, 2) AS polytonic_ratio, (doc_id % 50) / 3 AS latin_percentage, CASE WHEN doc_id % 2 = 0 THEN 'short' END AS filter FROM m
"""


def state_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents count as processed and which as problematic, by status words, stages and Markdown there."""
    status = F.element_at(F.array(*[F.lit(x) for x in tables.FORMS]), (F.pmod("doc_id", F.lit(len(tables.FORMS))) + 1).cast("int"))
    meta = _meta(spark, sf_dir).select("doc_id", "filename", status.alias("extract_status"), F.when(F.col("doc_id") % 7 == 0, "download,extract").when(F.col("doc_id") % 7 < 4, "download,extracted").alias("processing_stage"))
    markdown = _meta(spark, sf_dir).where("doc_id % 17 = 0").select("stem")
    processed, problematic = metadata.load_state(meta, markdown)
    return processed.withColumn("state", F.lit("processed")).union(problematic.withColumn("state", F.lit("problematic")))


STATE_STEMS_SQL = f"""
WITH {_META}, s AS (SELECT *, lower(trim([{tables._FORMS}][CAST(doc_id % {len(tables.FORMS)} AS INTEGER) + 1])) AS x FROM m)
SELECT DISTINCT stem, 'processed' AS state FROM s WHERE x IN ('success', 'ok', 'complete', 'completed', 'partial', 'chunked') OR doc_id % 7 = 0 OR doc_id % 17 = 0
UNION ALL SELECT DISTINCT stem, 'problematic' FROM s WHERE x IN ('failed', 'failure', 'error', 'timeout', 'problematic', 'skipped')
"""


def existing_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata made of artefacts under an existing table, whose values win where they are not null."""
    meta = _meta(spark, sf_dir)
    found = meta.where("doc_id % 2 = 0").select("stem", F.lit(1).alias("rank"), F.lit("download").alias("stage"), "filename", F.lit(5).alias("page_count"))
    existing = meta.where("doc_id % 3 = 0").select("stem", F.when(F.col("doc_id") % 9 == 0, F.concat("stem", F.lit(".docx"))).alias("filename"), "page_count", F.when(F.col("doc_id") % 12 == 0, "download,clean").alias("processing_stage"))
    return metadata.synthesize(found, existing).select("stem", "filename", "page_count", "processing_stage", "filter")


EXISTING_SQL = f"""
WITH {_META}, f AS (SELECT * FROM m WHERE doc_id % 2 = 0), e AS (SELECT * FROM m WHERE doc_id % 3 = 0)
SELECT coalesce(e.stem, f.stem) AS stem, coalesce(CASE WHEN e.doc_id % 9 = 0 THEN e.stem || '.docx' END, f.filename, '') AS filename, coalesce(e.page_count, CASE WHEN f.stem IS NOT NULL THEN 5 END) AS page_count,
  CASE WHEN e.doc_id % 12 = 0 THEN 'download,clean' WHEN f.stem IS NOT NULL THEN 'download' ELSE '' END AS processing_stage, 'ok' AS filter FROM f FULL JOIN e ON f.stem = e.stem
"""


def document_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution of a crop as high as the text is long, seconds allowed, and labels of Greek sentences under a mask."""
    meta = _meta(spark, sf_dir)
    mask, label = (F.col("doc_id") % 3).cast("int"), (F.col("doc_id") % 6).cast("int")
    return meta.select(
        "doc_id", latex.crop_dpi(F.pmod("char_count_no_comments", F.lit(1000))).alias("dpi"), values.page_budget(F.col("page_count")).alias("seconds"),
        greek_prep.merged_label(label).alias("merged"), greek_prep.masked_prediction(mask, label).alias("prediction"), greek_prep.masked_label(mask, F.concat(F.lit("l"), label.cast("string"))).alias("label"),
    )


SETTINGS_SQL = f"""
WITH {_META}, h AS (SELECT *, char_count_no_comments % 1000 AS h FROM m)
SELECT doc_id, CASE WHEN h < 40 THEN 280 WHEN h < 120 THEN 240 WHEN h > 800 THEN 180 ELSE 220 END AS dpi, greatest(coalesce(page_count, 1) * 20.0::DOUBLE, 20.0) AS seconds,
  CASE WHEN doc_id % 6 IN (0, 5) THEN 0 WHEN doc_id % 6 IN (1, 4) THEN 1 ELSE doc_id % 6 END AS merged, CASE WHEN doc_id % 3 = 0 THEN -9999 ELSE doc_id % 6 END AS prediction,
  CASE WHEN doc_id % 3 = 1 THEN 'l' || (doc_id % 6) ELSE '---' END AS label FROM h
"""


def source_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with fields of their source's metadata, whose rows are documents', repeated ones and chunks' among them."""
    rows = table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", F.coalesce("lang", F.lit("und")).alias("language"), F.coalesce("n_chars", F.lit(0)).alias("length")).dropDuplicates(["doc_id"])
    i = F.col("doc_id")
    copy = lambda when, suffix, at, language: F.when(when, F.array(F.struct(F.concat(F.lit("d"), i.cast("string"), F.lit(suffix)).alias("stem"), F.lit(at).alias("at"), language.alias("language")))).otherwise(F.array())
    own = F.col("language")
    copies = F.concat(copy(i % 2 == 0, "__p0001-0200", 0, F.concat(F.lit("first of "), own)), copy(i % 3 != 0, "", 1, own), copy(i % 5 == 0, "", 2, F.lit("again")), copy((i % 3 == 0) & (i % 5 != 0), "__p0201-0300", 3, F.concat(F.lit("last of "), own)))
    source = rows.select("length", F.inline(copies))
    return export.source_fields(rows.select(F.concat(F.lit("d"), i.cast("string")).alias("stem")), source, ["language", "length"], order="at")


SOURCE_FIELDS_SQL = """
WITH d AS (SELECT DISTINCT ON (doc_id) doc_id, coalesce(lang, 'und') AS language, CAST(coalesce(n_chars, 0) AS VARCHAR) AS length FROM documents WHERE doc_id IS NOT NULL)
SELECT 'd' || doc_id AS stem, CASE WHEN doc_id % 3 <> 0 THEN language WHEN doc_id % 5 = 0 THEN 'again' WHEN doc_id % 2 = 0 THEN 'first of ' || language ELSE 'last of ' || language END AS language, length FROM d
"""


def table_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and issues of every document."""
    return metrics.table_summary(documents.tables_in_documents(spark, sf_dir))


TABLE_ISSUES_SQL = f"""
WITH {documents._TABLE_BASE}, a AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id), b AS (SELECT doc_id, count(*) AS n FROM issues GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(a.n, 0) AS INTEGER) AS total_tables, CAST(coalesce(b.n, 0) AS INTEGER) AS malformed_tables FROM t LEFT JOIN a ON t.doc_id = a.doc_id LEFT JOIN b ON t.doc_id = b.doc_id
"""

QUERIES = {
    "page_metrics": (page_metrics, PAGE_METRICS_SQL), "formula_results": (formula_results, FORMULA_RESULTS_SQL), "triage_rows": (triage_rows, TRIAGE_SQL), "section_routing": (section_routing, SECTION_ROUTING_SQL),
    "ocr_again": (ocr_again, OCR_AGAIN_SQL), "settled_columns": (settled_columns, SETTLED_SQL), "state_stems": (state_stems, STATE_STEMS_SQL), "existing_wins": (existing_wins, EXISTING_SQL),
    "document_settings": (document_settings, SETTINGS_SQL), "source_fields": (source_fields, SOURCE_FIELDS_SQL), "table_issues": (table_issues, TABLE_ISSUES_SQL),
}
