"""Queries on URLs, names and link lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, urls
from ..operators import urls as url_ops
from .documents import table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", F.col("page_id").alias("row_idx"))


def canonical_stem_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names made of page URLs, with chunk ranges and the suffixes of artefacts."""
    ends = F.element_at(F.array(*[F.lit(x) for x in ("", *names.SUFFIXES, ".md.pdf", ".PDF", "__p0001-0200.md")]), (F.col("page_id") % 14 + 1).cast("int"))
    path = F.concat(F.lit("in/"), F.regexp_replace("url", "[^A-Za-z0-9]+", "_"), ends)
    made = _pages(spark, sf_dir).select("page_id", path.alias("path"))
    stem = names.canonical_stem(F.col("path"))
    return made.select("page_id", stem.alias("stem"), names.without_chunk(stem).alias("base"), names.chunk_range(stem)["start"].alias("first_page"))


_SUFFIX_SQL = "(" + "|".join(s.replace(".", r"\.") for s in names.SUFFIXES) + ")"
_SUFFIX_LIST = ", ".join(f"'{s}'" for s in ("", *names.SUFFIXES, ".md.pdf", ".PDF", "__p0001-0200.md"))
CANONICAL_STEM_SQL = rf"""
WITH p AS (SELECT page_id, regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g') || [{_SUFFIX_LIST}][CAST(page_id % 14 AS INTEGER) + 1] AS name FROM pages
), s AS (SELECT page_id, name, regexp_replace(name, '{_SUFFIX_SQL}+$', '') AS stem FROM p
), t AS (SELECT page_id, CASE WHEN stem = '' THEN regexp_replace(name, '\.[^.]*$', '') ELSE stem END AS stem FROM s)
SELECT page_id, stem, regexp_replace(stem, '__p\d{{4}}-\d{{4}}(\.[^.]*)?$', '\1') AS base, coalesce(TRY_CAST(regexp_extract(stem, '__p(\d+)-(\d+)', 1) AS INTEGER), 2147483647) AS first_page FROM t
"""


def _varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs cut down to few paths, in upper-case hosts, double slashes and shuffled queries, and some empty."""
    short = F.regexp_replace(F.regexp_replace("url", r"/\d+", "//1"), "[?]page=2&ref=x", "?ref=x&page=2&a")
    url = F.when(F.col("page_id") % 17 == 0, "").when(F.col("page_id") % 3 == 0, F.regexp_replace(short, r"example", "EXAMPLE")).otherwise(short)
    return _pages(spark, sf_dir).withColumn("url", url)


def url_canonical_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_ops.mark_duplicates(_varied(spark, sf_dir)).select("page_id", "url_norm", "is_duplicate", "duplicate_of", "download_error")


_VARIED = """v AS (
  SELECT page_id, CASE WHEN page_id % 17 = 0 THEN '' WHEN page_id % 3 = 0 THEN replace(s, 'example', 'EXAMPLE') ELSE s END AS url
  FROM (SELECT page_id, replace(regexp_replace(url, '/\\d+', '//1', 'g'), '?page=2&ref=x', '?ref=x&page=2&a') AS s FROM pages)
)"""
URL_DEDUP_SQL = rf"""
WITH {_VARIED}, p AS (
  SELECT page_id, url, regexp_extract(url, '^(https?)://', 1) AS scheme, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS host,
    regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+', '/', 'g') AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q FROM v
), k AS (SELECT *, [struct_pack(k := split_part(x, '=', 1), v := CASE WHEN contains(x, '=') THEN regexp_extract(x, '=(.*)$', 1) ELSE '' END) FOR x IN string_split(q, '&') IF x <> ''] AS kv FROM p
), n AS (SELECT page_id, url, CASE WHEN url = '' THEN '' ELSE scheme || '://' || host || path || CASE WHEN len(kv) > 0 THEN '?' || array_to_string([x.k || '=' || x.v FOR x IN list_sort(kv)], '&') ELSE '' END END AS url_norm FROM k
), f AS (SELECT *, first_value(page_id) OVER w AS fid, first_value(url) OVER w AS furl FROM n WINDOW w AS (PARTITION BY url_norm ORDER BY page_id))
SELECT page_id, url_norm, page_id <> fid AS is_duplicate, CASE WHEN page_id <> fid THEN furl ELSE '' END AS duplicate_of, CASE WHEN page_id <> fid THEN 'Duplicate URL (skipped)' ELSE '' END AS download_error FROM f
"""


def url_extension_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.encode(F.substring("html", 1, 64), "UTF-8")
    disposition = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit('attachment; filename="f'), F.col("page_id"), F.lit('.PDF"')))
    kind = F.when(F.col("page_id") % 3 == 0, "text/html; charset=utf-8").when(F.col("page_id") % 3 == 1, "application/pdf")
    made = table(spark, sf_dir, "pages").select("page_id", "url", disposition.alias("d"), kind.alias("t"), head.alias("h"))
    own = urls.url_extension(F.col("url"))
    return made.select("page_id", own.alias("url_ext"), urls.is_supported(own).alias("supported"), urls.inferred_extension(F.col("url"), F.col("d"), F.col("t"), F.col("h")).alias("ext"))


URL_EXT_SQL = r"""
WITH p AS (
  SELECT page_id, html, coalesce(nullif(lower(regexp_extract(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '[^/.][^/]*\.([^./]+)$', 1)), ''), 'bin') AS url_ext FROM pages
), s AS (SELECT *, url_ext IN ('pdf', 'docx', 'xml', 'html', 'pptx', 'csv', 'md') AS supported FROM p)
SELECT page_id, url_ext, supported, CASE WHEN supported THEN url_ext WHEN page_id % 5 = 0 THEN 'pdf' WHEN page_id % 3 = 0 THEN 'html' WHEN page_id % 3 = 1 THEN 'pdf'
  WHEN starts_with(lower(html), '<!doctype html') OR starts_with(lower(html), '<html') THEN 'html' WHEN starts_with(lower(html), '<?xml') THEN 'xml' ELSE url_ext END AS ext FROM s
"""


def filename_base_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for pages that are not duplicates, where the numbers divisible by seven are taken."""
    rows = url_ops.mark_duplicates(_varied(spark, sf_dir)).where(~F.col("is_duplicate") & (F.col("url") != ""))
    used = _pages(spark, sf_dir).where(F.col("page_id") % 7 == 0).select(names.generated_name(F.col("page_id")).alias("name"))
    return url_ops.assign_names(rows.select("page_id", "row_idx"), used).select("page_id", "filename_base")


FILENAME_SQL = rf"""
WITH {URL_DEDUP_SQL.split("WITH ", 1)[1].rsplit("SELECT page_id, url_norm", 1)[0]}
, w AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS r FROM f WHERE page_id = fid AND url <> ''
), g AS (SELECT i, chr(CAST(65 + (i // 676) % 26 AS INTEGER)) || chr(CAST(65 + (i // 26) % 26 AS INTEGER)) || chr(CAST(65 + i % 26 AS INTEGER)) || '_' || lpad(CAST(i % 1000 AS VARCHAR), 3, '0') AS name FROM (SELECT unnest(range(2 * (SELECT count(*) FROM pages))) AS i)
), u AS (SELECT g.name FROM pages JOIN g ON g.i = page_id WHERE page_id % 7 = 0
), a AS (SELECT name, row_number() OVER (ORDER BY i) AS r FROM g WHERE name NOT IN (SELECT name FROM u))
SELECT page_id, name AS filename_base FROM w JOIN a USING (r)
"""


def links_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with a JSON list, a JSON object, several URLs in a text, one URL, and none."""
    k = F.col("page_id") % 5
    cell = (
        F.when(k == 0, F.to_json(F.array("url", F.concat("url", F.lit("x"))))).when(k == 1, F.to_json(F.struct(F.col("url").alias("href"))))
        .when(k == 2, F.concat("url", F.lit("; "), "url", F.lit(";"))).when(k == 3, F.col("url"))
    )
    return url_ops.explode_links(_pages(spark, sf_dir).withColumn("url", cell)).select("source_row", "url_index", "url")


LINKS_SQL = """
WITH l AS (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN [url, url || 'x'] WHEN 1 THEN [url] WHEN 2 THEN [url, url] WHEN 3 THEN [url] ELSE [] END AS u FROM pages
)
SELECT page_id AS source_row, CAST(generate_subscripts(u, 1) - 1 AS INTEGER) AS url_index, unnest(u) AS url FROM l WHERE len(u) > 0
UNION ALL SELECT page_id, -1, '' FROM l WHERE len(u) = 0
"""


def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(urls.base_domain(F.col("url")).alias("base_domain")).agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page"))


DOMAIN_SQL = """
SELECT regexp_extract(url, '^https?://', 0) || lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS base_domain, count(*) AS pages, min(page_id) AS first_page FROM pages GROUP BY 1
"""

QUERIES = {
    "canonical_stem_map": (canonical_stem_map, CANONICAL_STEM_SQL),
    "url_canonical_dedup": (url_canonical_dedup, URL_DEDUP_SQL),
    "url_extension_infer": (url_extension_infer, URL_EXT_SQL),
    "filename_base_assign": (filename_base_assign, FILENAME_SQL),
    "links_explode": (links_explode, LINKS_SQL),
    "domain_counts": (domain_counts, DOMAIN_SQL),
}
