"""Queries on document texts: quality, noise, cleaning, tables, recognised text, LaTeX."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import greek_prep, latex, ocr_text
from ..functions.noise import ALLOWED_DOUBLES, IMPOSSIBLE_PAIRS, VOWELS, noise_metrics
from ..functions.text import content_chars, count, latin_letters, script_percentages
from ..operators import artefacts, cleaner
from ..sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Latin letters written as Greek ones, which gives the Greek operators a text (fixed values).
FROM_LATIN = "abgdezhiklmnxoprstyfcvw"
TO_GREEK = "αβγδεζηικλμνξοπρστυφχψω"
SP = r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Lines of text as DuckDB has them, without a last empty one.
_SQL_LINES = "(CASE WHEN ends_with({0}, chr(10)) THEN string_split({0}, chr(10))[:-2] ELSE string_split({0}, chr(10)) END)"
_SQL_BARE = "regexp_replace(regexp_replace({0}, '<!--.*?-->', '', 'g'), '(\\\\\\[.*?\\\\\\])|(\\\\\\(.*?\\\\\\))|(\\$\\$.*?\\$\\$)', '', 'g')"


def doc_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    every = F.split(text, "\n", -1)
    solid = F.filter(every, lambda x: F.rlike(x, F.lit(f"[^{SP}]")))
    tabular = F.filter(solid, lambda x: F.rlike(x, F.lit(rf"^[{SP}]*\|(.*\|)?[{SP}]*$")))
    per = table(spark, sf_dir, "documents").select(
        "lang", content_chars(text).alias("chars"), latin_letters(text).alias("latin"), F.octet_length(text).alias("bytes"), F.size(solid).alias("lines"), F.size(tabular).alias("tabular"),
    )
    flag = F.when(F.col("chars") == 0, "is_empty").when(F.col("chars") < 200, "empty_text<200").otherwise("ok")
    return per.withColumn("filter", flag).groupBy("lang", "filter").agg(
        F.count("*").alias("docs"), F.sum("chars").alias("content_chars"), (F.sum("latin") / F.sum("bytes")).alias("latin_ratio"),
        (F.sum("tabular") / F.greatest(F.sum("lines"), F.lit(1))).alias("table_line_ratio"), F.count_if(F.col("filter") != "ok").alias("needs_ocr"),
    )


DOC_QUALITY_SQL = rf"""
WITH b AS (SELECT lang, coalesce(text, '') AS t FROM documents
), p AS (
  SELECT lang, length(regexp_replace({_SQL_BARE.format("t")}, '[{SP}]', '', 'g')) AS chars,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS latin, strlen(t) AS bytes,
    len([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^{SP}]')]) AS lines,
    len([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '^[{SP}]*\|(.*\|)?[{SP}]*$') AND regexp_matches(x, '[^{SP}]')]) AS tabular FROM b
), f AS (SELECT *, CASE WHEN chars = 0 THEN 'is_empty' WHEN chars < 200 THEN 'empty_text<200' ELSE 'ok' END AS filter FROM p)
SELECT lang, filter, count(*) AS docs, CAST(sum(chars) AS BIGINT) AS content_chars, sum(latin) / sum(bytes) AS latin_ratio,
  sum(tabular) / greatest(sum(lines), 1) AS table_line_ratio, count(*) FILTER (filter <> 'ok') AS needs_ocr
FROM f GROUP BY lang, filter
"""


def _greek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.translate(F.lower(F.coalesce("text", F.lit(""))), FROM_LATIN, TO_GREEK).alias("text"))


def greek_noise_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = ("doc_id", "len_greek", "total_words", "v_pen", "c_pen", "bad_double", "misplaced_sigma", "invalid_bigram", "long_word_count", "longest_word", "short_word_count", "max_run", "score", "short_ratio")
    return noise_metrics(_greek(spark, sf_dir)).select(*keep)


_PAIRS = ", ".join(f"'{p}'" for p in IMPOSSIBLE_PAIRS)
GREEK_NOISE_SQL = rf"""
WITH d AS (SELECT doc_id, translate(lower(coalesce(text, '')), '{FROM_LATIN}', '{TO_GREEK}') AS t FROM documents
), k AS (
  SELECT doc_id, array_to_string([x FOR x IN {_SQL_LINES.format("t")} IF NOT regexp_matches(x, '^[{SP}]*\|(.*\|)?[{SP}]*$')], chr(10)) AS t FROM d
), c AS (SELECT doc_id, unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) AS pos FROM k
), g AS (
  SELECT *, regexp_matches(ch, '^[\x{{370}}-\x{{3FF}}\x{{1F00}}-\x{{1FFF}}]$') AS greek, strpos('{VOWELS}', ch) > 0 AND ch <> '' AS vowel FROM c
  WHERE NOT regexp_matches(ch, '^[\x{{300}}-\x{{36F}}\x{{1DC0}}-\x{{1DFF}}\x{{20D0}}-\x{{20FF}}]$')
), n AS (
  SELECT *, CASE WHEN greek THEN (CASE WHEN vowel THEN 'v' ELSE 'c' END) ELSE 'x' END AS kind,
    lag(ch) OVER w AS prev, lag(CASE WHEN greek THEN 1 ELSE 0 END) OVER w AS prev_greek, lead(CASE WHEN greek THEN 1 ELSE 0 END) OVER w AS next_greek FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), r AS (
  SELECT *, sum(CASE WHEN kind = pk THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run,
    sum(CASE WHEN greek AND coalesce(prev_greek, 0) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS word
  FROM (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY pos) AS pk FROM n)
), runs AS (SELECT doc_id, run, min(kind) AS kind, count(*) AS len, max(pos) AS last FROM r GROUP BY doc_id, run
), runs2 AS (SELECT *, lead(kind) OVER (PARTITION BY doc_id ORDER BY run) AS nk FROM runs
), pens AS (
  SELECT doc_id, sum(CASE WHEN kind = 'v' AND len >= 4 AND coalesce(nk, 'e') <> 'x' THEN len - 3 ELSE 0 END) AS v_pen,
    sum(CASE WHEN kind = 'c' AND len >= 4 AND coalesce(nk, 'e') <> 'x' THEN len - 3 ELSE 0 END) AS c_pen, max(CASE WHEN kind <> 'x' THEN len ELSE 0 END) AS max_run FROM runs2 GROUP BY doc_id
), words AS (SELECT doc_id, word, count(*) AS len FROM r WHERE greek GROUP BY doc_id, word
), ws AS (
  SELECT doc_id, count(*) AS total_words, count(*) FILTER (len >= 21) AS long_word_count, max(len) AS longest_word, count(*) FILTER (len < 3) AS short_word_count,
    coalesce(sum(least(len - 20, 380)) FILTER (len >= 21), 0) AS long_weight FROM words GROUP BY doc_id
), cs AS (
  SELECT doc_id, count(*) FILTER (greek) AS len_greek,
    count(*) FILTER (greek AND prev_greek = 1 AND ch = prev AND strpos('{ALLOWED_DOUBLES}', ch) = 0) AS bad_double,
    count(*) FILTER (ch = 'σ' AND coalesce(next_greek, 0) = 0) AS misplaced_sigma,
    count(*) FILTER (prev_greek = 1 AND greek AND (prev || ch) IN ({_PAIRS})) AS invalid_bigram FROM n GROUP BY doc_id
), j AS (
  SELECT d.doc_id, coalesce(len_greek, 0) AS len_greek, CAST(coalesce(total_words, 0) AS INTEGER) AS total_words, CAST(coalesce(v_pen, 0) AS INTEGER) AS v_pen, CAST(coalesce(c_pen, 0) AS INTEGER) AS c_pen,
    coalesce(bad_double, 0) AS bad_double, coalesce(misplaced_sigma, 0) AS misplaced_sigma, coalesce(invalid_bigram, 0) AS invalid_bigram, CAST(coalesce(long_word_count, 0) AS INTEGER) AS long_word_count,
    CAST(coalesce(longest_word, 0) AS INTEGER) AS longest_word, CAST(coalesce(short_word_count, 0) AS INTEGER) AS short_word_count, CAST(coalesce(max_run, 0) AS INTEGER) AS max_run, coalesce(long_weight, 0) AS long_weight
  FROM d LEFT JOIN cs USING (doc_id) LEFT JOIN pens USING (doc_id) LEFT JOIN ws USING (doc_id)
)
SELECT doc_id, len_greek, total_words, v_pen, c_pen, bad_double, misplaced_sigma, invalid_bigram, long_word_count, longest_word, short_word_count, max_run,
  CASE WHEN len_greek > 0 THEN 1000.0::DOUBLE * v_pen / len_greek + 1.5 * (1000.0::DOUBLE * c_pen / len_greek) + 2.0 * (1000.0::DOUBLE * bad_double / len_greek) + 2.5 * (1000.0::DOUBLE * misplaced_sigma / len_greek)
    + 2.0 * (1000.0::DOUBLE * invalid_bigram / len_greek) + greatest(1000.0::DOUBLE * short_word_count / len_greek - 26.0, 0.0) + 1000.0::DOUBLE * long_weight / len_greek ELSE 0.0 END AS score,
  CASE WHEN total_words > 0 THEN short_word_count / total_words ELSE 0.0 END AS short_ratio
FROM j
"""


def script_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = _greek(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit(" plain latin words"))))
    greek, latin = script_percentages(F.col("text"))
    return mixed.select("doc_id", greek.alias("percentage_greek"), latin.alias("percentage_latin"))


SCRIPT_SHARES_SQL = rf"""
WITH d AS (SELECT doc_id, translate(lower(coalesce(text, '')), '{FROM_LATIN}', '{TO_GREEK}') || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' plain latin words' END AS t FROM documents
), n AS (SELECT doc_id, length(regexp_replace(t, '[{SP}]', '', 'g')) AS total, length(regexp_replace(t, '[^\x{{370}}-\x{{3E1}}\x{{3F0}}-\x{{3FF}}\x{{B5}}]', '', 'g')) AS g, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS l FROM d)
SELECT doc_id, CASE WHEN total = 0 THEN 0.0 ELSE 100.0::DOUBLE * g / total END AS percentage_greek, CASE WHEN total = 0 THEN 0.0 ELSE 100.0::DOUBLE * l / total END AS percentage_latin FROM n
"""


def core_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts, with the marks of maths, entities and tags turned into stars, which leaves letters and lines to clean."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select("doc_id", F.translate("text", "$&<\r", "****").alias("text"))
    done = docs.select("doc_id", cleaner.clean_text(F.col("text")).alias("c"))
    return done.select("doc_id", F.md5(F.col("c.text").cast("binary")).alias("cleaned_md5"), "c.judged_chars", "c.kept_chars", cleaner.badness(F.col("c.judged_chars"), F.col("c.kept_chars")).alias("badness"))


def _char_class(chars: str) -> str:
    """A regex class of characters, with neighbours joined to ranges."""
    codes, out, at = sorted(map(ord, chars)), [], 0
    while at < len(codes):
        end = at
        while end + 1 < len(codes) and codes[end + 1] == codes[end] + 1:
            end += 1
        out.append(f"\\x{{{codes[at]:X}}}-\\x{{{codes[end]:X}}}")
        at = end + 1
    return "[" + "".join(out) + "]"


_UNUSUAL = _char_class(cleaner.unusual_letters())
CORE_CLEAN_SQL = rf"""
WITH d AS (SELECT doc_id, translate(text, '$&<' || chr(13), '****') AS text FROM documents WHERE text IS NOT NULL
), l AS (SELECT doc_id, text, unnest(ls) AS x, generate_subscripts(ls, 1) AS pos FROM (SELECT *, {_SQL_LINES.format("text")} AS ls FROM d)
), c AS (
  SELECT *, regexp_replace(x, '{_UNUSUAL}', '', 'g') AS y,
    length(regexp_replace(regexp_replace(x, '[{SP}]', '', 'g'), '[^{_UNUSUAL[1:-1]}]', '', 'g')) AS lost,
    regexp_matches(x, 'font=/|FontName=|MS-Bold-') AS bad FROM l
), e AS (
  SELECT *, CASE WHEN bad THEN '<!-- text-missing -->' WHEN lost >= 5 AND trim(y) <> '' THEN rtrim(y) || ' <!-- text-missing -->'
    WHEN lost >= 5 THEN '<!-- text-missing -->' ELSE y END AS z,
    CASE WHEN bad THEN 0 WHEN lost >= 5 AND trim(y) <> '' THEN length(rtrim(y)) WHEN lost >= 5 THEN 0 ELSE length(y) END AS kept FROM c
), g AS (SELECT doc_id, any_value(text) AS text, string_agg(z, chr(10) ORDER BY pos) AS t, CAST(sum(length(x)) AS BIGINT) AS judged_chars, CAST(sum(kept) AS BIGINT) AS kept_chars FROM e GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(t, '') || CASE WHEN ends_with(d.text, chr(10)) THEN chr(10) ELSE '' END) AS cleaned_md5, coalesce(judged_chars, 0) AS judged_chars, coalesce(kept_chars, 0) AS kept_chars,
  CASE WHEN judged_chars > 0 THEN greatest(0.0, round(1 - kept_chars / judged_chars, 3)) ELSE 0.0 END AS badness
FROM d LEFT JOIN g USING (doc_id)
"""


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-pass cleaning report over whole documents."""
    return cleaner.quality_report(table(spark, sf_dir, "documents").select("doc_id", "text"))[1]


def tables_in_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a well-formed table behind every fourth, a short row behind every fifth, a headless one behind every seventh."""
    good = "\n| a | b |\n|---|---|\n| 1 | 2 |\nend"
    short = "\n| a | b |\n|---|---|\n| 1 | 2 | 3 |\nend"
    bare = "\nx\n|---|---|\n| 1 | 2 |\nend"
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tail = lambda n, t: F.when(F.col("doc_id") % n == 0, t).otherwise("")
    return docs.withColumn("text", F.concat("text", tail(4, good), tail(5, short), tail(7, bare)))


def malformed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaner.table_issues(tables_in_documents(spark, sf_dir))


def remove_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables_in_documents(spark, sf_dir)
    done = cleaner.remove_tables(docs, cleaner.table_issues(docs))
    return done.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), count(F.col("text"), "<!-- table-removed -->").alias("removed"))


_TABLE_BASE = rf"""
t AS (
  SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 4 = 0 THEN chr(10) || '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || 'end' ELSE '' END
    || CASE WHEN doc_id % 5 = 0 THEN chr(10) || '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 | 3 |' || chr(10) || 'end' ELSE '' END
    || CASE WHEN doc_id % 7 = 0 THEN chr(10) || 'x' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || 'end' ELSE '' END AS text FROM documents
), ls AS (
  SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) - 1 AS pos FROM (SELECT doc_id, {_SQL_LINES.format("text")} AS a FROM t)
), f AS (
  SELECT *, regexp_matches(x, '^\s*\|.*\|\s*$') AS is_row, regexp_matches(x, '^\s*\|\s*[-:]+\s*\|') AS is_rule,
    CASE WHEN regexp_matches(trim(x), '^\|(.*)\|$') THEN length(x) - length(replace(x, '|', '')) - 1 ELSE 0 END AS cols FROM ls
), i AS (
  SELECT *, sum(CASE WHEN is_row AND NOT coalesce(pr, false) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS island
  FROM (SELECT *, lag(is_row) OVER w AS pr, lag(cols) OVER w AS pc FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
), h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY pos) AS nth FROM i WHERE is_rule AND is_row) WHERE nth = 1
), e AS (SELECT h.doc_id, h.island, h.pos, max(b.pos) AS last FROM h JOIN i b ON b.doc_id = h.doc_id AND b.island = h.island AND b.is_row GROUP BY ALL
), issues AS (
  SELECT h.doc_id, h.pos + 1 AS line_number, CASE WHEN NOT coalesce(h.pr, false) THEN 'Table separator without header row' ELSE 'Table header and separator column count mismatch' END AS description, CASE WHEN coalesce(h.pr, false) THEN h.pc END AS expected_columns,
    h.cols AS found_columns, CASE WHEN coalesce(h.pr, false) THEN h.pos - 1 ELSE h.pos END AS start_line, e.last AS end_line
  FROM h JOIN e USING (doc_id, island) WHERE NOT coalesce(h.pr, false) OR h.pc <> h.cols
  UNION ALL
  SELECT h.doc_id, b.pos + 1, 'Table row has inconsistent column count', h.cols, b.cols, CASE WHEN coalesce(h.pr, false) THEN h.pos - 1 ELSE h.pos END, e.last
  FROM h JOIN e USING (doc_id, island) JOIN i b ON b.doc_id = h.doc_id AND b.island = h.island AND b.is_row AND b.pos > h.pos WHERE h.cols > 0 AND b.cols <> h.cols
)"""
MALFORMED_SQL = f"WITH {_TABLE_BASE} SELECT * FROM issues"
REMOVE_TABLES_SQL = f"""WITH {_TABLE_BASE}, m AS (
  SELECT ls.*, EXISTS (SELECT 1 FROM issues s WHERE s.doc_id = ls.doc_id AND ls.pos BETWEEN s.start_line AND s.end_line) AS bad FROM ls
), k AS (SELECT *, lag(bad) OVER (PARTITION BY doc_id ORDER BY pos) AS pb FROM m
), g AS (SELECT doc_id, string_agg(CASE WHEN bad THEN '<!-- table-removed -->' ELSE x END, chr(10) ORDER BY pos) AS y, count(*) FILTER (bad) AS removed FROM k WHERE NOT (bad AND coalesce(pb, false)) GROUP BY doc_id)
SELECT t.doc_id, md5(coalesce(y, '') || CASE WHEN ends_with(t.text, chr(10)) THEN chr(10) ELSE '' END) AS text_md5, coalesce(removed, 0) AS removed FROM t LEFT JOIN g USING (doc_id)
"""


def early_stop_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, every third with a line repeated twelve times and every fifth with a run of one character."""
    text = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 3 == 0, "\nagain" * 12).otherwise(""), F.when(F.col("doc_id") % 5 == 0, "\n" + "x" * 300).otherwise(""))
    cut = ocr_text.early_stop(F.col("t"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("t")).select("doc_id", F.length("t").alias("before"), F.length(cut).alias("after"))


EARLY_STOP_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 3 = 0 THEN repeat(chr(10) || 'again', 12) ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN chr(10) || repeat('x', 300) ELSE '' END AS t FROM documents
), c AS (SELECT doc_id, unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) AS pos FROM t
), r AS (SELECT *, sum(CASE WHEN ch = p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(ch) OVER (PARTITION BY doc_id ORDER BY pos) AS p FROM c)
), a AS (SELECT doc_id, min(start) - 1 + 200 AS by_char FROM (SELECT doc_id, run, min(pos) AS start, count(*) AS n, min(ch) AS ch FROM r GROUP BY doc_id, run) WHERE n >= 200 AND ch <> chr(10) GROUP BY doc_id
), l AS (SELECT doc_id, unnest(x) AS x, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, string_split(t, chr(10)) AS x FROM t)
), s AS (SELECT *, trim(x) AS b, coalesce(sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM l
), q AS (SELECT *, sum(CASE WHEN b = p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(b) OVER (PARTITION BY doc_id ORDER BY pos) AS p FROM s)
), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS nth FROM q
), o AS (SELECT doc_id, min(begins) AS by_line FROM n WHERE nth = 11 GROUP BY doc_id
), u AS (SELECT t.doc_id, t, least(by_char, by_line) AS cut FROM t LEFT JOIN a USING (doc_id) LEFT JOIN o USING (doc_id))
SELECT doc_id, CAST(length(t) AS INTEGER) AS before, CAST(CASE WHEN cut IS NULL THEN length(t) ELSE length(regexp_replace(substr(t, 1, CAST(cut AS INTEGER)), '[{SP}]+$', '')) END AS INTEGER) AS after FROM u
"""


def canonicalize_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("  \n\n\n\nan exam-\nple<sup>3</sup>\xa0&NBSP;\xa0end<sup>12a</sup> of x<sup>[14]</sup> EX-\nAM"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(ocr_text.canonical_markdown(text).cast("binary")).alias("text_md5"))


CANONICALIZE_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') || '  ' || repeat(chr(10), 4) || 'an exam-' || chr(10) || 'ple<sup>3</sup>' || chr(160) || '&NBSP;' || chr(160) || 'end<sup>12a</sup> of x<sup>[14]</sup> EX-' || chr(10) || 'AM' AS t FROM documents
), a AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?i)(\x{{A0}}|&nbsp;)+', ' ', 'g'), '[ \t]+\n', chr(10), 'g') AS t FROM t
), b AS (SELECT doc_id, regexp_replace(t, '(?i)([\p{{L}}\p{{N}}\p{{M}}_])-\n([a-zα-ωά-ώ])', '\1\2', 'g') AS t FROM a
), c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '<sup>(\d{{2,}}([A-Za-z]{{1,2}})?)</sup>', '[^\1]', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM b)
SELECT doc_id, md5(regexp_replace(t, '^[{SP}]+|[{SP}]+$', '', 'g')) AS text_md5 FROM c
"""


#: Cells that words of some lengths become, with what SQL expects their references to stand for (fixed values).
REFERENCE_CELLS = {3: ("&#8212;", "—"), 4: ("<i>&#x2013;</i>", "–"), 5: ("&copy; &notit; &AMP", "© ¬it; &"), 6: ("&#x96;&nbsp", "–"), 7: ("&nosuch;", "&nosuch;")}


def placeholder_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of pages as cells, some with character references: which of them stand for nothing, and their characters."""
    words = table(spark, sf_dir, "pages").select("page_id", F.explode(F.split(F.coalesce("html", F.lit("")), "[ <>]+")).alias("w"))
    cell = F.when(F.length("w") % 12 == 1, "<b>n/</b> ").when(F.length("w") % 12 == 2, " N/A ")
    for length, (given, _) in REFERENCE_CELLS.items():
        cell = cell.when(F.length("w") % 12 == length, given)
    cells = words.groupBy("page_id", cell.otherwise(F.regexp_replace("w", "&", "+")).alias("cell")).agg(F.count("*").alias("n"))  # each cell of a page is judged once
    judged = cells.select("page_id", "n", ocr_text.is_placeholder(F.col("cell")).alias("empty"), F.length(ocr_text.references_decoded(F.col("cell"))).alias("length"))
    return judged.groupBy("page_id").agg(F.sum("n").alias("cells"), F.coalesce(F.sum(F.when(F.col("empty"), F.col("n"))), F.lit(0)).alias("placeholders"), F.sum(F.col("length") * F.col("n")).alias("characters"))


_PLACEHOLDERS = ", ".join(f"'{p}'" for p in ocr_text.PLACEHOLDERS)
_CASES = " ".join(f"WHEN {length} THEN '{want}'" for length, (_, want) in REFERENCE_CELLS.items())
_LENGTHS = " ".join(f"WHEN {length} THEN {len(html.unescape(given))}" for length, (given, _) in REFERENCE_CELLS.items())
PLACEHOLDER_SQL = rf"""
WITH w AS (SELECT page_id, unnest(regexp_split_to_array(coalesce(html, ''), '[ <>]+')) AS w FROM pages
), c AS (SELECT page_id, CASE length(w) % 12 WHEN 1 THEN '<b>n/</b> ' WHEN 2 THEN ' N/A ' {_CASES} ELSE replace(w, '&', '+') END AS cell, CASE length(w) % 12 WHEN 1 THEN 10 WHEN 2 THEN 5 {_LENGTHS} ELSE length(w) END AS n FROM w
), n AS (SELECT page_id, n, lower(trim(regexp_replace(regexp_replace(cell, '(?i)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS x FROM c)
SELECT page_id, count(*) AS cells, count(*) FILTER (x = '' OR x IN ({_PLACEHOLDERS}) OR regexp_replace(x, '[\s._\-\\/]+', '', 'g') IN ({_PLACEHOLDERS})) AS placeholders, CAST(sum(n) AS BIGINT) AS characters FROM n GROUP BY page_id
"""


def nfc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "e", "é​")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(ocr_text.normalized(text).cast("binary")).alias("text_md5"))


NFC_SQL = "SELECT doc_id, md5(nfc_normalize(replace(replace(coalesce(text, ''), 'e', 'e' || chr(769)), chr(8203), ''))) AS text_md5 FROM documents"


def cleaned_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<|User|>  "), F.coalesce("text", F.lit("")), F.lit("\n\n\n\n<center>x</center> <|det|><|left over|>\n  figure_note[[1, 2]] seen\n[[3]] kept"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(ocr_text.cleaned_output(text)).alias("length"))


_BLANK = SP.replace(r"\x09-\x0D", r"\x09\x0B-\x0D")
CLEANED_OUTPUT_SQL = rf"""
WITH t AS (SELECT doc_id, '<|User|>  ' || coalesce(text, '') || repeat(chr(10), 4) || '<center>x</center> <|det|><|left over|>' || chr(10) || '  figure_note[[1, 2]] seen' || chr(10) || '[[3]] kept' AS t FROM documents
), a AS (SELECT doc_id, regexp_replace(regexp_replace(t, '<[|｜][^>]{{0,64}}[|｜]>|<image>|</?s>', '', 'g'), '</?center>', '', 'g') AS t FROM t
), b AS (SELECT doc_id, regexp_replace(t, '(?m)^[ \t]*[A-Za-z_]+\[\[.*?\]\][ \t]*', '', 'g') AS t FROM a
), c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?m)^[{_BLANK}]+|[{_BLANK}]+$', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM b
), d AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\$\^\{{?([A-Za-z0-9+\-]+)\}}?\$', '<sup>\1</sup>', 'g'), '\$_\{{?([A-Za-z0-9+\-]+)\}}?\$', '<sub>\1</sub>', 'g') AS t FROM c)
SELECT doc_id, CAST(length(regexp_replace(t, '^[{SP}]+|[{SP}]+$', '', 'g')) AS INTEGER) AS length FROM d
"""


def latex_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as formulas, with tails of a token repeated as often as the id says."""
    text = F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit(" x"), F.col("doc_id").cast("int") % 80))
    done = latex.sanitized(F.col("t"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("t")).select("doc_id", done.alias("s")).select("doc_id", F.md5(F.col("s.latex").cast("binary")).alias("latex_md5"), "s.truncated_by_repeat", "s.truncated_by_length", "s.tail_run")


LATEX_SANITIZE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') || repeat(' x', CAST(doc_id % 80 AS INTEGER)) AS t FROM documents
), k AS (SELECT *, [w FOR w IN regexp_split_to_array(t, '\s+') IF w <> ''] AS ws FROM t
), r AS (SELECT *, CASE WHEN len(ws) = 0 THEN 0 ELSE coalesce(list_position(list_reverse([w <> ws[-1] FOR w IN ws]), true) - 1, len(ws)) END AS run FROM k
), c AS (SELECT *, (run > 50 OR length(t) > 3000) AND run > 12 AS cutting, CASE WHEN (run > 50 OR length(t) > 3000) AND run > 12 THEN array_to_string(ws[:len(ws) - run + 12], ' ') ELSE t END AS x FROM r
), h AS (SELECT *, substr(x, 1, 3000) AS head, regexp_extract(substr(x, 1, 3000), '(?s)^(.*)[ \n\t\\]', 1) AS brk FROM c)
SELECT doc_id, md5(CASE WHEN length(x) > 3000 THEN regexp_replace(CASE WHEN regexp_matches(head, '[ \n\t\\]') THEN brk ELSE head END, '\s+$', '') ELSE x END) AS latex_md5, cutting AS truncated_by_repeat, length(x) > 3000 AS truncated_by_length, CAST(run AS INTEGER) AS tail_run FROM h
"""


def latex_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as formulas, with braces around every second and one stray behind every third."""
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, "{").otherwise(""), F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 2 == 0, "}").otherwise(""), F.when(F.col("doc_id") % 3 == 0, "}{").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", latex.accept_score(text).alias("accept_score"))


LATEX_ACCEPT_SQL = r"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '{' ELSE '' END || coalesce(text, '') || CASE WHEN doc_id % 2 = 0 THEN '}' ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN '}{' ELSE '' END AS t FROM documents
), b AS (SELECT doc_id, unnest(x) AS ch, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, string_split(regexp_replace(t, '[^{}]', '', 'g'), '') AS x FROM t)
), d AS (SELECT doc_id, sum(CASE WHEN ch = '{' THEN 1 WHEN ch = '}' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS depth, pos FROM b
), e AS (SELECT doc_id, min(depth) AS low, arg_max(depth, pos) AS ends FROM d GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN length(t) > 6000 OR coalesce(low, 0) < 0 OR coalesce(ends, 0) <> 0 OR contains(t, '\includegraphics') OR contains(t, '\write18') THEN 0.0 ELSE 1.0 END AS accept_score FROM t LEFT JOIN e USING (doc_id)
"""


def sentence_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents prepared for the variety classifier, with the mask of the usable ones."""
    docs = _greek(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text")))
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(greek_prep.usable(F.col("line"))).alias("usable"))


SENTENCE_MASK_SQL = rf"""
WITH d AS (SELECT doc_id, unnest(string_split(translate(lower(coalesce(text, '')), '{FROM_LATIN}', '{TO_GREEK}'), chr(10))) AS x FROM documents
), m AS (SELECT doc_id, CASE WHEN x = '' THEN 0 WHEN length(regexp_replace(x, '[^A-Za-z]', '', 'g')) / length(x) > 0.5 THEN 0 WHEN length(regexp_replace(x, '[^0-9]', '', 'g')) / length(x) > 0.5 THEN 0
  WHEN len([w FOR w IN regexp_split_to_array(x, '\s+') IF w <> '']) NOT BETWEEN 4 AND 512 THEN 0 ELSE 1 END AS ok FROM d)
SELECT doc_id, count(*) AS lines, CAST(sum(ok) AS BIGINT) AS usable FROM m GROUP BY doc_id
"""

def formula_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as formula regions on pages of ten lines."""
    rows = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("stem"), F.posexplode(F.split("text", "\n", -1)).alias("seq", "context"))
    regions = rows.where(F.length("context") > 0).select(
        "stem", F.floor(F.col("seq") / 10).alias("page_no"), "seq", F.when(F.col("seq") % 3 == 0, "code").otherwise("formula").alias("label"), "context",
        *[F.lit(v).alias(n) for n, v in (("left", 10.0), ("top", 20.0), ("right", 30.0), ("bottom", 40.0), ("page_width", 100.0))], (F.col("stem") % 2 * 200.0).alias("page_height"),
    )
    made = artefacts.formula_index(regions)
    return made.select("stem", "page_no", "item_index", "label", F.md5(F.col("context").cast("binary")).alias("context_md5"), F.col("box.bottom").alias("bottom"))


FORMULA_INDEX_SQL = """
WITH l AS (SELECT doc_id AS stem, unnest(x) AS context, generate_subscripts(x, 1) - 1 AS seq FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL))
SELECT stem, seq // 10 AS page_no, CAST(row_number() OVER (PARTITION BY stem, seq // 10 ORDER BY seq) - 1 AS INTEGER) AS item_index, CASE WHEN seq % 3 = 0 THEN 'code' ELSE 'formula' END AS label,
  md5(CASE WHEN length(context) > 80 THEN substr(context, 1, 77) || '…' ELSE context END) AS context_md5, CASE WHEN stem % 2 = 1 THEN 40.0 / 200.0 END AS bottom FROM l WHERE context <> ''
"""


def chunk_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut in page ranges by their length, some of which timed out or failed."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("stem"), F.greatest(F.floor(F.col("n_chars") / 4), F.lit(1)).cast("int").alias("page_count"))
    status = F.when((F.col("stem") + F.col("page_start")) % 7 == 1, "timeout").when((F.col("stem") + F.col("page_end")) % 31 == 0, "error").otherwise("ok")
    return artefacts.chunk_manifest(files.page_ranges(docs).withColumn("status", status)).select("stem", "complete", "given_up")


CHUNK_MANIFEST_SQL = """
WITH d AS (SELECT doc_id AS stem, greatest(n_chars // 4, 1) AS p FROM documents
), c AS (SELECT stem, p, unnest(CASE WHEN p > 600 THEN range(1, p + 1, 200) ELSE [1] END) AS s FROM d
), r AS (SELECT *, CASE WHEN p > 600 THEN least(s + 199, p) ELSE p END AS e FROM c
), t AS (SELECT stem, CASE WHEN (stem + s) % 7 = 1 THEN 'timeout' WHEN (stem + e) % 31 = 0 THEN 'error' ELSE 'ok' END AS status FROM r)
SELECT stem, bool_and(status = 'ok') AS complete, bool_or(status = 'error') OR count(*) FILTER (status = 'timeout') > 1 AS given_up FROM t GROUP BY stem
"""

QUERIES = {
    "formula_index": (formula_index, FORMULA_INDEX_SQL),
    "chunk_manifests": (chunk_manifests, CHUNK_MANIFEST_SQL),
    "doc_quality_report": (doc_quality_report, DOC_QUALITY_SQL),
    "greek_noise_score": (greek_noise_score, GREEK_NOISE_SQL),
    "script_shares": (script_shares, SCRIPT_SHARES_SQL),
    "core_clean_lines": (core_clean_lines, CORE_CLEAN_SQL),
    "clean_report": (clean_report, None),
    "malformed_tables": (malformed_tables, MALFORMED_SQL),
    "remove_tables": (remove_tables, REMOVE_TABLES_SQL),
    "early_stop_cut": (early_stop_cut, EARLY_STOP_SQL),
    "canonicalize_md": (canonicalize_md, CANONICALIZE_SQL),
    "placeholder_cells": (placeholder_cells, PLACEHOLDER_SQL),
    "nfc_normalize": (nfc_normalize, NFC_SQL),
    "cleaned_output": (cleaned_output, CLEANED_OUTPUT_SQL),
    "latex_sanitize": (latex_sanitize, LATEX_SANITIZE_SQL),
    "latex_accept": (latex_accept, LATEX_ACCEPT_SQL),
    "sentence_mask": (sentence_mask, SENTENCE_MASK_SQL),
}
