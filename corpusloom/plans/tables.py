"""Queries on keyed metadata: gates, upserts, resumption, state, metrics, splits, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..operators import annotate, gates, metadata, metrics
from .documents import table


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata rows made of documents and their labels; scores follow from ids, so that SQL can make them too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("char_count_no_comments"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    i = F.col("doc_id")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("d"), i.cast("string"), F.when(i % 11 == 0, ".html").otherwise(".pdf")).alias("filename"), F.concat(F.lit("d"), i.cast("string")).alias("stem"),
        F.when(i % 13 == 0, F.lit(0)).otherwise(F.col("char_count_no_comments")).alias("char_count_no_comments"), ((i % 40) / 200).alias("mojibake_badness_score"),
        F.when(i % 9 != 0, (i % 130).cast("double")).alias("greek_badness_score"), F.when(i % 4 != 0, (i % 6).cast("int")).alias("page_count"), (i % 10 == 0).alias("ocr_success"), "quality", "toxic",
    )


_META = """m AS (
  SELECT d.doc_id, 'd' || d.doc_id || CASE WHEN d.doc_id % 11 = 0 THEN '.html' ELSE '.pdf' END AS filename, 'd' || d.doc_id AS stem, CASE WHEN d.doc_id % 13 = 0 THEN 0 ELSE n_chars END AS char_count_no_comments,
    (d.doc_id % 40) / 200 AS mojibake_badness_score, CASE WHEN d.doc_id % 9 <> 0 THEN CAST(d.doc_id % 130 AS DOUBLE) END AS greek_badness_score, CASE WHEN d.doc_id % 4 <> 0 THEN CAST(d.doc_id % 6 AS INTEGER) END AS page_count,
    d.doc_id % 10 = 0 AS ocr_success, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def clean_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate(_meta(spark, sf_dir), 200, 2).select("filename", "filter", "needs_ocr", "is_empty")


CLEAN_GATES_SQL = f"""
WITH {_META}, f AS (
  SELECT *, ends_with(filename, '.pdf') AS pdf, mojibake_badness_score > 0.1 AS a, coalesce(greek_badness_score > 60, false) AS b,
    coalesce(char_count_no_comments < 200 AND coalesce(page_count, 2) >= 2, false) AS c, coalesce(char_count_no_comments < 200 AND coalesce(page_count, 2) < 2, false) AS d FROM m
)
SELECT filename, CASE WHEN pdf AND (a OR b OR c OR d) THEN concat_ws(';', CASE WHEN a THEN 'mojibake>0.1' END, CASE WHEN b THEN 'non_greek_text' END, CASE WHEN c THEN 'empty_text<200' END, CASE WHEN d THEN 'empty_text<200_short' END) ELSE 'ok' END AS filter,
  pdf AND (a OR b OR c) AND NOT ocr_success AS needs_ocr, coalesce(char_count_no_comments <= 0, false) AS is_empty FROM f
"""


def empty_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = gates.gate(_meta(spark, sf_dir))
    return gates.good_files(gated).groupBy("filter", "is_empty").agg(F.count("*").alias("files"))


EMPTY_GATES_SQL = f"""
WITH {_META}, f AS (SELECT *, ends_with(filename, '.pdf') AS pdf, mojibake_badness_score > 0.1 AS a, coalesce(greek_badness_score > 60, false) AS b, coalesce(char_count_no_comments <= 0, false) AS c FROM m
), g AS (SELECT CASE WHEN pdf AND (a OR b OR c) THEN concat_ws(';', CASE WHEN a THEN 'mojibake>0.1' END, CASE WHEN b THEN 'non_greek_text' END, CASE WHEN c THEN 'is_empty' END) ELSE 'ok' END AS filter, c AS is_empty, pdf AND (a OR b OR c) AND NOT ocr_success AS again FROM f)
SELECT filter, is_empty, count(*) AS files FROM g WHERE NOT again GROUP BY ALL
"""


def ocr_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = gates.gate(_meta(spark, sf_dir), 200, 2)
    skip = table(spark, sf_dir, "labels").where("toxic = 1").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"))
    return gates.ocr_candidates(gated, skip).select("stem")


OCR_ROUTING_SQL = CLEAN_GATES_SQL.replace("SELECT filename, CASE WHEN pdf AND (a OR b OR c OR d)", "SELECT stem FROM f WHERE pdf AND (a OR b OR c) AND NOT ocr_success AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) --", 1).split("--")[0]


def math_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("stem"), F.floor(F.col("value") / 10).alias("formula_count"))
    dense = metrics.math_density(pages)
    return gates.math_candidates(dense).select("stem", "formula_total", "pages_with_formula", "pages_total", "phase_recommended")


MATH_ROUTING_SQL = """
WITH p AS (SELECT 'u' || user_id AS stem, coalesce(CAST(floor(value / 10) AS BIGINT), 0) AS n FROM events)
SELECT stem, CAST(sum(n) AS BIGINT) AS formula_total, count(*) FILTER (n > 0) AS pages_with_formula, count(*) AS pages_total, '2A' AS phase_recommended FROM p GROUP BY stem HAVING sum(n) > 0
"""


def math_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities of orders as formulas of pages: interpolated and nearest-rank percentiles."""
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("stem"), F.col("l_quantity").cast("double").alias("formula_count"))
    dense = metrics.math_density(pages).select("stem", "formula_total", "formula_avg_pp", "formula_p90_pp", "pages_total")
    return dense.join(metrics.nearest_rank(pages, "stem", "formula_count", 0.9, "nearest_p90"), "stem")


MATH_DENSITY_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS stem, sum(CAST(l_quantity AS DOUBLE)) AS formula_total, avg(CAST(l_quantity AS DOUBLE)) AS formula_avg_pp, quantile_cont(CAST(l_quantity AS DOUBLE), 0.9) AS formula_p90_pp,
  count(*) AS pages_total, quantile_disc(CAST(l_quantity AS DOUBLE), 0.9) AS nearest_p90 FROM lineitem GROUP BY 1
"""


def timing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("stem"), "event_id", F.floor(F.col("value") * 1000).alias("ms"))
    return metrics.timing_summary(events, "stem", "ms", "event_id").select("stem", "n", "total", "p50", "p90")


TIMING_SQL = """
WITH e AS (SELECT user_id AS stem, event_id, CAST(floor(value * 1000) AS BIGINT) AS ms FROM events
), t AS (SELECT stem, count(ms) AS n, CAST(sum(ms) AS BIGINT) AS total, list(ms ORDER BY event_id, ms) AS x FROM e GROUP BY stem)
SELECT stem, n, total, x[CAST(round_even((len(x) - 1) * 0.5, 0) AS INTEGER) + 1] AS p50, x[CAST(round_even((len(x) - 1) * 0.9::DOUBLE, 0) AS INTEGER) + 1] AS p90 FROM t
"""


def domain_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = table(spark, sf_dir, "events").select(F.col("event_type").alias("base_domain"), (F.col("value") > 20).alias("success"), F.floor(F.col("value")).alias("seconds"))
    return metrics.domain_summary(attempts).select("base_domain", "attempts", "successes", "failures", "mean_seconds")


DOMAIN_STATS_SQL = "SELECT event_type AS base_domain, count(*) AS attempts, count(*) FILTER (value > 20) AS successes, count(*) FILTER (NOT value > 20) AS failures, avg(CAST(floor(value) AS BIGINT)) AS mean_seconds FROM events GROUP BY 1"


def metadata_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _meta(spark, sf_dir).where("doc_id % 3 <> 0").select("filename", "page_count", F.lit("base").alias("origin"), "quality")
    new = _meta(spark, sf_dir).where("doc_id % 2 = 0").select("filename", F.when(F.col("doc_id") % 8 != 0, F.lit(99)).alias("page_count"), "greek_badness_score")
    return metadata.upsert(base, new)


UPSERT_SQL = f"""
WITH {_META}, b AS (SELECT filename, page_count, 'base' AS origin, quality FROM m WHERE doc_id % 3 <> 0
), n AS (SELECT filename, CASE WHEN doc_id % 8 <> 0 THEN 99 END AS page_count, greek_badness_score FROM m WHERE doc_id % 2 = 0)
SELECT coalesce(b.filename, n.filename) AS filename, coalesce(n.page_count, b.page_count) AS page_count, origin, quality, greek_badness_score FROM b FULL JOIN n ON b.filename = n.filename
"""


def result_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _meta(spark, sf_dir).where("doc_id % 3 = 0").select("filename", F.lit("old").alias("state"), "page_count")
    new = _meta(spark, sf_dir).where("doc_id % 2 = 0").select("filename", F.lit("new").alias("state"))
    return metadata.merge_results(old, new, "filename")


MERGE_SQL = f"""
WITH {_META} SELECT filename, 'old' AS state, page_count FROM m WHERE doc_id % 3 = 0 AND doc_id % 2 <> 0 UNION ALL SELECT filename, 'new', NULL FROM m WHERE doc_id % 2 = 0
"""


def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _meta(spark, sf_dir)
    return metadata.pending(meta.select("stem"), meta.where("quality = 1").select("stem"), meta.where("toxic = 1").select("stem"))


RESUME_SQL = f"WITH {_META} SELECT stem FROM m WHERE NOT coalesce(quality = 1, false) AND NOT coalesce(toxic = 1, false)"


def state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _meta(spark, sf_dir)
    had = meta.where("doc_id % 5 <> 0").select("stem", "filename", F.when(F.col("doc_id") % 2 == 0, "download").otherwise("download,extract").alias("processing_stage"), F.lit("").alias("extract_status"))
    done, bad = meta.where("quality = 1").select("stem"), meta.where("toxic = 1").select("stem")
    return metadata.save_state(had, done, bad).select("stem", "filename", "extract_status", F.coalesce("processing_stage", F.lit("")).alias("processing_stage"))


STATE_SQL = f"""
WITH {_META}, h AS (SELECT stem, filename, CASE WHEN doc_id % 2 = 0 THEN 'download' ELSE 'download,extract' END AS processing_stage FROM m WHERE doc_id % 5 <> 0
), k AS (SELECT stem, max(r) AS r FROM (SELECT stem, 1 AS r FROM m WHERE quality = 1 UNION ALL SELECT stem, 2 FROM m WHERE toxic = 1) GROUP BY stem
), j AS (SELECT coalesce(h.stem, k.stem) AS stem, h.filename, r, processing_stage, h.stem IS NULL AS fresh FROM h FULL JOIN k ON h.stem = k.stem)
SELECT stem, coalesce(filename, stem || '.pdf') AS filename, CASE WHEN r = 2 THEN 'failed' WHEN r = 1 THEN 'success' ELSE '' END AS extract_status,
  CASE WHEN r = 1 THEN (CASE WHEN fresh THEN 'extract' WHEN list_contains(string_split(processing_stage, ','), 'extract') THEN processing_stage ELSE processing_stage || ',extract' END) ELSE coalesce(processing_stage, '') END AS processing_stage FROM j
"""


def artifact_synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata from what is there of each document: a source file, Markdown, metrics, triage."""
    meta = _meta(spark, sf_dir)
    blank = lambda t: F.lit(None).cast(t)
    source = meta.where("doc_id % 2 = 0").select("stem", F.lit(1).alias("rank"), F.lit("download").alias("stage"), "filename", blank("int").alias("page_count"), blank("string").alias("phase_recommended"))
    markdown = meta.where("doc_id % 3 = 0").select("stem", F.lit(2).alias("rank"), F.lit("extract").alias("stage"), blank("string").alias("filename"), blank("int").alias("page_count"), blank("string").alias("phase_recommended"))
    pages = meta.where("doc_id % 5 = 0").select("stem", F.lit(3).alias("rank"), F.lit("extract").alias("stage"), blank("string").alias("filename"), "page_count", F.lit("stop").alias("phase_recommended"))
    triage = meta.where("doc_id % 7 = 0").select("stem", F.lit(4).alias("rank"), F.lit("triage").alias("stage"), blank("string").alias("filename"), F.lit(77).alias("page_count"), F.lit("2A").alias("phase_recommended"))
    every = source.union(markdown).union(pages).union(triage)
    return metadata.synthesize(every).select("stem", "filename", "page_count", "phase_recommended", "processing_stage", "filter", "needs_ocr")


SYNTHESIS_SQL = f"""
WITH {_META}, a AS (
  SELECT stem, 1 AS rank, 'download' AS stage, filename, NULL::INTEGER AS page_count, NULL AS phase FROM m WHERE doc_id % 2 = 0
  UNION ALL SELECT stem, 2, 'extract', NULL, NULL, NULL FROM m WHERE doc_id % 3 = 0 UNION ALL SELECT stem, 3, 'extract', NULL, page_count, 'stop' FROM m WHERE doc_id % 5 = 0
  UNION ALL SELECT stem, 4, 'triage', NULL, 77, '2A' FROM m WHERE doc_id % 7 = 0
)
SELECT stem, coalesce(max(filename), stem || '.pdf') AS filename, arg_max(page_count, rank) FILTER (page_count IS NOT NULL) AS page_count, arg_max(phase, rank) FILTER (phase IS NOT NULL) AS phase_recommended,
  concat_ws(',', CASE WHEN bool_or(stage = 'download') THEN 'download' END, CASE WHEN bool_or(stage = 'extract') THEN 'extract' END, CASE WHEN bool_or(stage = 'triage') THEN 'triage' END) AS processing_stage, 'ok' AS filter, false AS needs_ocr
FROM a GROUP BY stem
"""


#: Forms that words of conversations take in turn, to be read as truth values, numbers and outcomes.
FORMS = ("YES", "n/a", "none", " f ", "NaN", "done", "error", "complete", "partial", " Chunked", "skipped", "timeout", "ok", "1.5", "0.0", "")


def value_coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles, turns and forms of words in conversations read as truth values, numbers and outcomes."""
    form = F.element_at(F.array(*[F.lit(x) for x in FORMS]), (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(FORMS))) + 1).cast("int"))
    words = table(spark, sf_dir, "conversations").select(F.explode(F.array(F.lower("role"), F.concat(F.col("turn").cast("string"), F.lit(" ")), form)).alias("w"), (F.col("turn").cast("double") - 1).alias("d"))
    made = words.select("w", values.strict_bool(F.col("w")).alias("strict"), values.loose_bool(F.col("w")).alias("loose"), values.loose_bool(F.when(F.col("d") > 2, F.lit(float("nan"))).otherwise(F.col("d"))).alias("of_number"), values.as_float(F.col("w")).alias("number"), values.outcome(F.col("w")).alias("outcome"))
    return made.groupBy("w", "strict", "loose", "of_number", "number", "outcome").agg(F.count("*").alias("n"))


_FORMS = ", ".join(f"'{x}'" for x in FORMS)
COERCE_SQL = f"""
WITH w AS (SELECT unnest([lower(role), CAST(turn AS VARCHAR) || ' ', [{_FORMS}][CAST((conv_id + turn) % {len(FORMS)} AS INTEGER) + 1]]) AS w, CAST(turn AS DOUBLE) - 1 AS e FROM conversations
), t AS (SELECT w, e, lower(trim(w)) AS x, TRY_CAST(trim(w) AS DOUBLE) AS d FROM w)
SELECT w, CASE WHEN x IN ('true', '1', 'yes', 'y', 't') THEN true WHEN x IN ('false', '0', 'no', 'n', 'f') THEN false END AS strict,
  CASE WHEN x IN ('', 'na', 'none') OR x IS NULL THEN NULL WHEN x IN ('false', '0', 'no', 'n') THEN false ELSE true END AS loose, CASE WHEN e <= 2 THEN e <> 0 END AS of_number, CASE WHEN isnan(d) THEN NULL ELSE d END AS number,
  CASE WHEN x IN ('success', 'ok', 'complete', 'completed', 'partial', 'chunked') THEN 'success' WHEN x IN ('failed', 'failure', 'error', 'timeout', 'problematic', 'skipped') THEN 'failure' END AS outcome, count(*) AS n FROM t GROUP BY ALL
"""


def doctype_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _meta(spark, sf_dir)
    types = meta.where("quality is not null").select("filename", F.when(F.col("toxic") == 1, "").when(F.col("doc_id") % 2 == 0, "book").otherwise("thesis").alias("document_type"))
    files = meta.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("filename")).when(F.col("doc_id") % 3 == 1, F.col("stem")).otherwise(F.concat("stem", F.lit(".md"))).alias("filename"))
    typed = annotate.with_document_types(files, types)
    return typed.select("doc_id", "document_type", annotate.annotation_method(F.col("document_type"), {"book": "chapter"}).alias("method"))


DOCTYPE_SQL = f"""
WITH {_META} SELECT doc_id, CASE WHEN quality IS NULL OR coalesce(toxic = 1, false) THEN NULL WHEN doc_id % 2 = 0 THEN 'book' ELSE 'thesis' END AS document_type,
  CASE WHEN quality IS NOT NULL AND NOT coalesce(toxic = 1, false) AND doc_id % 2 = 0 THEN 'chapter' ELSE 'text' END AS method FROM m
"""


def label_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 500).cast("int").alias("guess")), "doc_id")
    return annotate.classification_report(annotate.confusion(judged, "quality", "guess"), "quality", "guess")


CONFUSION_SQL = """
WITH j AS (SELECT quality AS t, CAST(n_chars > 500 AS INTEGER) AS g FROM labels JOIN documents USING (doc_id)
), l AS (SELECT DISTINCT t AS label FROM j UNION SELECT DISTINCT g FROM j
), c AS (SELECT label, (SELECT count(*) FROM j WHERE t = label) AS support, (SELECT count(*) FROM j WHERE g = label) AS guessed, (SELECT count(*) FROM j WHERE g = label AND t = label) AS hits FROM l
), p AS (SELECT *, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall FROM c)
SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM p
"""


def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.overall_scores(label_confusion(spark, sf_dir))


LABEL_SCORES_SQL = f"""
WITH r AS ({CONFUSION_SQL})
SELECT CAST(sum(support) AS BIGINT) AS support, sum(recall * support) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall,
  sum(f1 * support) / sum(support) AS weighted_f1 FROM r
"""


def missing_doctypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.missing_share(doctype_join(spark, sf_dir), "document_type")


MISSING_DOCTYPES_SQL = f"SELECT count(*) AS rows, count(*) FILTER (coalesce(trim(document_type), '') = '') AS missing, count(*) FILTER (coalesce(trim(document_type), '') = '') / count(*) AS share FROM ({DOCTYPE_SQL})"


#: What attempts made of events fail with, by a remainder (fixed values).
ERRORS = ("Timeout after 45 s", "HTTP 429", "HTTP 404", "HTTP 403", "HTTP 503")


def rolling_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts of their users, some of which fail: timeouts, refusals, durations, and whether to ease off."""
    kind = F.pmod(F.floor("value"), F.lit(23)).cast("int")
    error = F.when(kind < len(ERRORS), F.element_at(F.array(*map(F.lit, ERRORS)), kind + 1))
    attempts = table(spark, sf_dir, "events").select("event_id", "user_id", error.alias("error"), F.floor("value").alias("seconds"))
    return metrics.rolling(attempts, "user_id", "event_id", "error", "seconds").select("event_id", "timeout_share", "refused_share", "mean_seconds", "easing")


_ERRORS = ", ".join(f"'{e}'" for e in ERRORS)
ROLLING_SQL = f"""
WITH a AS (SELECT event_id, user_id, CAST(floor(value) AS BIGINT) AS s, [{_ERRORS}][CAST(floor(value) AS BIGINT) % 23 + 1] AS e FROM events
), r AS (
  SELECT *, avg(s) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS mean_seconds, count(e) OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM a
), f AS (
  SELECT user_id, n, avg(CASE WHEN contains(e, 'Timeout') THEN 1.0::DOUBLE ELSE 0 END) OVER w AS timeout_share, avg(CASE WHEN e IN ('HTTP 429', 'HTTP 503', 'HTTP 403') THEN 1.0::DOUBLE ELSE 0 END) OVER w AS refused_share
  FROM r WHERE e IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)
)
SELECT event_id, timeout_share, refused_share, mean_seconds, coalesce(timeout_share >= 0.2 OR refused_share >= 0.2 OR (timeout_share IS NOT NULL AND mean_seconds > 60), false) AS easing
FROM r LEFT JOIN f ON r.user_id IS NOT DISTINCT FROM f.user_id AND r.n = f.n
"""


def split_three_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.stratified_split(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id", {"train": 0.7, "validation": 0.15, "test": 0.15})


SPLIT_THREE_SQL = """
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS nth, count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN nth <= round(n * 0.7) THEN 'train' WHEN nth <= round(n * 0.85) THEN 'validation' ELSE 'test' END AS part FROM r
"""


def label_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_shares(table(spark, sf_dir, "documents"), "lang")


LABEL_SHARES_SQL = "SELECT lang, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY lang"


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.stratified_split(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id", 0.8)


SPLIT_SQL = """
SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) <= round(count(*) OVER (PARTITION BY quality) * 0.8) THEN 'train' ELSE 'test' END AS part FROM labels
"""


def global_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.row_ids(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", "turn")


ROW_IDS_SQL = "SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id FROM conversations"

QUERIES = {
    "clean_gates": (clean_gates, CLEAN_GATES_SQL), "empty_gates": (empty_gates, EMPTY_GATES_SQL), "ocr_routing": (ocr_routing, OCR_ROUTING_SQL), "math_routing": (math_routing, MATH_ROUTING_SQL),
    "math_density": (math_density, MATH_DENSITY_SQL), "timing_summary": (timing_summary, TIMING_SQL), "domain_stats": (domain_stats, DOMAIN_STATS_SQL), "metadata_upsert": (metadata_upsert, UPSERT_SQL),
    "result_merge": (result_merge, MERGE_SQL), "resume_antijoin": (resume_antijoin, RESUME_SQL), "state_merge": (state_merge, STATE_SQL), "artifact_synthesis": (artifact_synthesis, SYNTHESIS_SQL),
    "value_coercions": (value_coercions, COERCE_SQL), "doctype_join": (doctype_join, DOCTYPE_SQL), "label_confusion": (label_confusion, CONFUSION_SQL), "label_shares": (label_shares, LABEL_SHARES_SQL), "label_scores": (label_scores, LABEL_SCORES_SQL), "missing_doctypes": (missing_doctypes, MISSING_DOCTYPES_SQL),
    "rolling_failures": (rolling_failures, ROLLING_SQL), "split_three_ways": (split_three_ways, SPLIT_THREE_SQL),
    "split_stratified": (split_stratified, SPLIT_SQL), "global_row_ids": (global_row_ids, ROW_IDS_SQL),
}
