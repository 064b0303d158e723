"""Queries on nested documents: tidied trees, metrics of pages from provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..sources import nested
from .documents import table


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents two and three levels deep: boxes and confidences rounded, names composed and without
    zero-width characters, metadata merged; every seventh has no object as its metadata, every eleventh is not JSON."""
    events = table(spark, sf_dir, "events")
    name = F.concat("event_type", F.lit("e\u0301\u200bx"))
    node = F.struct(name.alias("label"), F.struct((F.col("value") / 7).alias("l"), (F.col("value") / 3).alias("other"), F.array(F.struct((F.col("value") / 9).alias("confidence"))).alias("cells")).alias("box"))
    text = F.to_json(F.struct(F.col("event_id").alias("event"), F.struct(F.from_json("props", "k long").alias("props"), F.array(node).alias("children")).alias("body"), F.when(F.col("event_id") % 7 != 0, F.struct(F.lit("kept").alias("own"), F.lit("lost").alias("source"))).alias("meta")))
    meta = F.to_json(F.struct(F.lit("events").alias("source")))
    document = F.when(F.col("event_id") % 11 == 0, F.lit("{not json")).otherwise(text)
    return events.where("event_id is not null").select("event_id", nested.tidy_documents(document, meta).alias("document"))


NESTED_SQL = r"""
SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN '{"event":' || event_id || ',"body":{"props":{"k":' || CAST(props->>'k' AS VARCHAR) || '},"children":[{"label":"' || event_type || chr(233) || 'x","box":{"l":'
  || CAST(round(value / 7, 2) AS VARCHAR) || ',"other":' || CAST(value / 3 AS VARCHAR) || ',"cells":[{"confidence":' || CAST(round(value / 9, 2) AS VARCHAR) || '}]}}]},"meta":{'
  || CASE WHEN event_id % 7 <> 0 THEN '"own":"kept",' ELSE '' END || '"source":"events","coord_precision":2,"confid_precision":2,"image_mode":"referenced"}}' END AS document
FROM events WHERE event_id IS NOT NULL
"""


def _tokens(n: Column) -> Column:
    return F.array_join(F.array_repeat(F.lit("x"), n.cast("int")), " ")


def page_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as formulas and code of a document tree per order, whose nodes stand on one or two of its pages; long
    runs of one token are cut; some documents have fewer pages than their nodes say, some no timings."""
    lines = table(spark, sf_dir, "lineitem").where("l_orderkey is not null and l_linenumber is not null")
    page = lambda n: F.struct(n.cast("int").alias("page_no"))
    prov = F.when(F.col("l_linenumber") == 2, F.array(page(F.lit(1)), page(F.lit(3)))).when(F.col("l_linenumber") != 7, F.array(page(F.col("l_linenumber") % 3 + 1)))
    label = F.when(F.col("l_partkey") % 3 == 0, "code").when(F.col("l_partkey") % 3 == 1, "formula").otherwise("text")
    words = _tokens(F.col("l_quantity") * 2)
    node = F.struct(label.alias("label"), F.when(F.col("l_linenumber") % 2 == 0, words).otherwise("").alias("text"), words.alias("orig"), prov.alias("prov"))
    grouped = lines.groupBy(F.col("l_orderkey").alias("stem")).agg(F.collect_list(node).alias("texts"))
    timings = F.when(F.col("stem") % 3 != 0, F.create_map(F.lit("ocr"), F.array(F.lit(0.5), F.lit(0.25)), F.lit("layout"), F.array(*(F.lit(float(i)) for i in range(1, 6)))))
    documents = grouped.select("stem", F.to_json(F.struct("texts")).alias("document"), F.when(F.col("stem") % 11 == 0, 2).otherwise(4).alias("page_count"), timings.alias("timings"), F.when(F.col("stem") % 5 != 0, 60.0).alias("enrich_sec"))
    return metrics.document_pages(documents)


PAGE_TREE_SQL = """
WITH l AS (
  SELECT l_orderkey AS stem, CASE l_partkey % 3 WHEN 0 THEN 'code' WHEN 1 THEN 'formula' END AS label, CAST(l_quantity AS BIGINT) * 2 AS n,
    unnest(CASE WHEN l_linenumber = 2 THEN [1, 3] WHEN l_linenumber <> 7 THEN [l_linenumber % 3 + 1] ELSE [] END) AS page_no FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
), k AS (
  SELECT stem, page_no, label, CASE WHEN label = 'formula' AND n > 50 THEN 23 WHEN n > 0 THEN 2 * n - 1 ELSE 0 END AS chars, CASE WHEN label = 'formula' AND n > 50 THEN 2 * n - 24 ELSE 0 END AS dropped FROM l WHERE label IS NOT NULL
), c AS (
  SELECT stem, page_no, count(*) FILTER (label = 'formula') AS formula_count, coalesce(sum(chars) FILTER (label = 'formula'), 0) AS formula_chars, count(*) FILTER (dropped > 0) AS formula_truncated,
    sum(dropped) AS formula_truncated_chars, count(*) FILTER (label = 'code') AS code_count FROM k GROUP BY ALL
), d AS (SELECT DISTINCT l_orderkey AS stem, CASE WHEN l_orderkey % 11 = 0 THEN 2 ELSE 4 END AS pages FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
), p AS (SELECT stem, CAST(unnest(range(1, pages + 1)) AS INTEGER) AS page_no FROM d
), j AS (
  SELECT p.stem, p.page_no, coalesce(formula_count, 0) AS formula_count, CAST(coalesce(formula_chars, 0) AS BIGINT) AS formula_chars, coalesce(formula_truncated, 0) AS formula_truncated,
    CAST(coalesce(formula_truncated_chars, 0) AS BIGINT) AS formula_truncated_chars, coalesce(code_count, 0) AS code_count FROM p LEFT JOIN c ON p.stem = c.stem AND p.page_no = c.page_no
), s AS (SELECT *, sum(formula_chars) OVER (PARTITION BY stem) AS chars, sum(formula_count) OVER (PARTITION BY stem) AS formulas, CASE WHEN stem % 5 <> 0 THEN 60.0::DOUBLE ELSE 0 END AS total FROM j)
SELECT stem, page_no, CASE WHEN stem % 3 = 0 OR page_no > 2 THEN 0.0 WHEN page_no = 1 THEN 0.5 ELSE 0.25 END AS ocr_sec, 0.0 AS parse_sec, CASE WHEN stem % 3 = 0 THEN 0.0 ELSE page_no END::DOUBLE AS layout_sec, 0.0 AS table_sec,
  formula_count, formula_chars, formula_truncated, formula_truncated_chars, code_count, CASE WHEN chars > 0 THEN total * formula_chars / chars WHEN formulas > 0 THEN total * formula_count / formulas ELSE 0.0 END AS doc_enrich_share_sec FROM s
"""

QUERIES = {"nested_documents": (nested_documents, NESTED_SQL), "page_tree_metrics": (page_tree_metrics, PAGE_TREE_SQL)}
