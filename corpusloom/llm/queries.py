"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import filter_audit, fingerprint_cws, language_id, maxscore, minhash_tensor, packing, pii_surrogates, simhash_dedup, site_style, source_mix, token_alignment, toxicity, url_rules
from .common import surrogate_key, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_cws.fingerprints(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_text(table(spark, sf_dir, "pages"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii_surrogates.replace(table(spark, sf_dir, "documents"), surrogate_key(spark))
    return done.select("doc_id", "text", F.coalesce(F.size("__pii_found"), F.lit(0)).alias("n_entities"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_tensor.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_language_id, op2_toxicity, op3_fingerprints, op4_html_extraction, op5_top_k, op6_source_mix, op7_url_filters, op8_pii_surrogates, op9_simhash_dedup, op10_packing,
        op11_token_alignment, op12_minhash_dedup, op13_filter_audit, pipeline,
    )
    return {f.__name__: f for f in own}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP6_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), n AS (SELECT greatest(1, CAST(ceil(sqrt(count(*)) / 4) AS BIGINT)) AS parts FROM d
), t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM t
), x AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER up, 0) AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER up, 0) AS weight_over
  FROM w WINDOW up AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), y AS (SELECT *, max(CASE WHEN left_over / weight_over <= most / weight THEN left_over / weight_over END) OVER () AS level FROM x
), targets AS (SELECT source, source_size, coalesce(least(most, level * weight), most) AS target FROM y
), o AS (
  SELECT d.*, source_size, target, row_number() OVER (
    PARTITION BY d.source ORDER BY length(bin(size)),
      CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 7) AS BIGINT) % parts, size, doc_id NULLS FIRST) AS place,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each,
    CAST('0x' || substr(md5(coalesce(d.source, 'null')), 1, 5) AS BIGINT) / 1048576.0::DOUBLE AS offs
  FROM d JOIN targets ON d.source IS NOT DISTINCT FROM targets.source, n
)
SELECT doc_id, size, source_size, target, CAST((floor(each * place + offs) - floor(each * (place - 1) + offs)) * size AS BIGINT) AS taken FROM o
"""

OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '(^|[.-])(ads|adserver|tracker|tracking|casino|porn)[.-]') OR regexp_matches(host, '(^|\.)(ad|doubleclick)\.')
    OR regexp_matches(path, '^(.*/)?(banners?|popup)/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w
), g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), l AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), r AS (
  SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a
), c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c ON s.doc_id = c.doc_id
"""

OP13_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), m AS (
  SELECT d.doc_id, part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN labels ON d.doc_id = labels.doc_id
), c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask
), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), p(filter_order, letter, bit, step, before) AS (
  SELECT '', '', 0, 0, 0 UNION ALL
  SELECT p.filter_order || f.letter, f.letter, f.bit, p.step + 1, p.before | p.bit FROM p JOIN f ON (p.before | p.bit) & f.bit = 0
), e AS (
  SELECT part, filter_order AS prefix, letter, step,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM p, c WHERE step > 0 GROUP BY ALL
), o AS (SELECT p.filter_order, e.* FROM p JOIN e ON starts_with(p.filter_order, e.prefix) WHERE p.step = 5
), h AS (SELECT part, letter, sum(removed) AS shapley FROM o GROUP BY ALL)
SELECT o.part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM o JOIN h ON o.part = h.part AND o.letter = h.letter
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_top_k": OP5_SQL, "op6_source_mix": OP6_SQL, "op7_url_filters": OP7_SQL, "op12_minhash_dedup": OP12_SQL, "op13_filter_audit": OP13_SQL}
