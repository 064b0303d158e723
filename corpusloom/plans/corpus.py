"""Queries on sections, annotation and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate, export, sections
from .documents import _SQL_LINES, SP, table

SHARD_BYTES = 200_000


def _rows(numbers, form: str = "| Chapter {c} ....... | {n} |") -> list[str]:
    return [form.format(c=c, n=n) for c, n in zip("ABCDEFGHIJK", numbers, strict=False)]


#: Contents lists and what only looks like one: rising, with equals that begin anew, too few rising in a row, falling
#: back, ranges and letters behind, and without a table.
CONTENTS = (
    _rows((1, 3, 3, 9, 12, 20, 31, 40, 44)), _rows((1, 1, 1, 1, 1, 1, 1, 2, 3, 4, 5)), _rows((1, 1, 1, 1, 1, 1, 1, 2, 3)), _rows((9, 8, 7, 6, 5, 4, 3, 2)),
    _rows((1, 2, 3, 4, 5, 6, 7), "| Chapter {c} | see {n}-99 |"), _rows((1, 2, 3, 4, 5, 6, 7), "| Chapter {c} | {n} pages |"), _rows((1, 2, 3, 4, 5, 6, 7, 8), "Chapter {c} ....... {n}"),
)
LISTED = (0, 1, 4)


def _markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Markdown: a header first, every seventh line a header, every fifth a bullet, tables and contents at the end of some."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    marked = F.transform(lines, lambda x, i: F.concat(F.when(i % 7 == 0, "## ").when(i % 5 == 0, "- ").otherwise(""), x))
    contents = F.element_at(F.array(*[F.lit("\n".join(["## Contents", *rows]) + "\n") for rows in CONTENTS]), (F.floor(F.col("doc_id") / 6) % len(CONTENTS) + 1).cast("int"))
    text = F.concat(
        F.when(F.col("doc_id") % 9 == 0, "intro line\n").otherwise(""), F.when(F.col("doc_id") % 6 == 0, contents).otherwise(""), F.array_join(marked, "\n"),
        F.when(F.col("doc_id") % 4 == 0, "\n## Data\n| a | b |\n|---|---|\n| 1 | 2 |\n\nshort\nand a line that is longer than twenty").otherwise(""),
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


_CONTENTS = "[" + ", ".join("array_to_string(['## Contents', " + ", ".join(f"'{x}'" for x in rows) + "], chr(10)) || chr(10)" for rows in CONTENTS) + f"][CAST(doc_id // 6 % {len(CONTENTS)} AS INTEGER) + 1]"
_MD = rf"""t AS (
  SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'intro line' || chr(10) ELSE '' END || CASE WHEN doc_id % 6 = 0 THEN {_CONTENTS} ELSE '' END
    || array_to_string([CASE WHEN i % 7 = 1 THEN '## ' WHEN i % 5 = 1 THEN '- ' ELSE '' END || x FOR x, i IN string_split(coalesce(text, ''), chr(10))], chr(10))
    || CASE WHEN doc_id % 4 = 0 THEN array_to_string(['', '## Data', '| a | b |', '|---|---|', '| 1 | 2 |', '', 'short', 'and a line that is longer than twenty'], chr(10)) ELSE '' END AS text FROM documents
), l AS (SELECT doc_id, len(a) AS n_lines, unnest(a) AS line, generate_subscripts(a, 1) - 1 AS pos FROM (SELECT doc_id, {_SQL_LINES.format("text")} AS a FROM t)
), h AS (SELECT *, regexp_replace(line, '^[{SP}]+|[{SP}]+$', '', 'g') AS bare FROM l
), s AS (SELECT *, starts_with(bare, '#') AS head, sum(CASE WHEN starts_with(bare, '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS nth FROM h
), g AS (
  SELECT doc_id, nth, n_lines, min(pos) AS start_line, max(pos) AS end_line, arg_min(bare, pos) AS first, bool_or(head) AS titled, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT head), '') AS content,
    count(*) FILTER (NOT head AND bare <> '') AS section_length FROM s GROUP BY doc_id, nth, n_lines
), sec AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY nth) - 1 AS INTEGER) AS id, start_line, end_line, content, section_length, n_lines,
    CASE WHEN titled THEN coalesce(nullif(regexp_extract(first, '^#+\s*(.+)$', 1), ''), first) WHEN first <> '' THEN first ELSE 'Document' END AS header FROM g
), propo AS (SELECT *, CASE WHEN sum(section_length) OVER w > 0 THEN CAST(round_even(section_length / sum(section_length) OVER w * 1000, 0) AS BIGINT) ELSE 0 END AS section_propo FROM sec WINDOW w AS (PARTITION BY doc_id)
)"""


def sections_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sections.split_sections(_markdown(spark, sf_dir))
    return made.select("doc_id", "id", "header", "start_line", "end_line", F.md5(F.col("content").cast("binary")).alias("content_md5"), "section_length")


SECTIONS_SQL = f"WITH {_MD} SELECT doc_id, id, header, CAST(start_line AS INTEGER) AS start_line, CAST(end_line AS INTEGER) AS end_line, md5(content) AS content_md5, section_length FROM sec"


def section_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_rows(_markdown(spark, sf_dir), fields=("id", "section_length", "section_propo", "has_table", "has_list", "has_other", "has_text"))


_BLOCKS = rf"""bl AS (
  SELECT doc_id, id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM (SELECT doc_id, id, string_split(content, chr(10)) AS a FROM sec)
), bm AS (SELECT *, regexp_replace(line, '^[{SP}]+|[{SP}]+$', '', 'g') AS bare FROM bl
), bk AS (SELECT *, CASE WHEN regexp_matches(bare, '^\|(.*\|)?$') THEN 'table' WHEN bare = '' THEN 'blank' WHEN regexp_matches(bare, '^(-|\d+\.\s+)') THEN 'bullet' END AS mark FROM bm
), bs AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id, id ORDER BY pos) AS since FROM bk
), bt AS (SELECT *, CASE WHEN mark = 'table' THEN 'table' WHEN since = 'bullet' THEN 'list' WHEN bare <> '' AND length(bare) < 20 THEN 'other' ELSE 'text' END AS kind FROM bs
), bn AS (SELECT *, sum(CASE WHEN kind = 'other' OR kind <> coalesce(pk, '') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, id ORDER BY pos) AS nth FROM (SELECT *, lag(kind) OVER (PARTITION BY doc_id, id ORDER BY pos) AS pk FROM bt)
), bb AS (SELECT doc_id, id, nth, kind, string_agg(line, chr(10) ORDER BY pos) AS value FROM bn GROUP BY ALL HAVING bool_or(bare <> '')
)"""
SECTION_STATS_SQL = f"""WITH {_MD}, {_BLOCKS}
SELECT p.doc_id, p.id, section_length, section_propo, coalesce(bool_or(kind = 'table'), false) AS has_table, coalesce(bool_or(kind = 'list'), false) AS has_list, coalesce(bool_or(kind = 'other'), false) AS has_other, coalesce(bool_or(kind = 'text'), false) AS has_text
FROM propo p LEFT JOIN bb USING (doc_id, id) GROUP BY ALL
"""


def section_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sections.blocks(sections.split_sections(_markdown(spark, sf_dir)))
    return made.groupBy("doc_id", "kind").agg(F.count("*").alias("blocks"), F.sum(F.length("value")).alias("chars"))


SECTION_BLOCKS_SQL = f"WITH {_MD}, {_BLOCKS} SELECT doc_id, kind, count(*) AS blocks, CAST(sum(length(value)) AS BIGINT) AS chars FROM bb GROUP BY ALL"


def _labelled(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Sections with labels by their numbers, and the fields given."""
    label = F.when(F.col("id") % 8 == 7, annotate.REFERENCES).when((F.col("id") % 9 == 4) | ((F.col("doc_id") % 5 == 0) & (F.col("id") == 2)), annotate.CONTENTS).otherwise(annotate.OTHER)
    return sections.section_rows(_markdown(spark, sf_dir), fields=("id", *fields)).withColumn("label", label)


_LABELLED = """lab AS (
  SELECT doc_id, id, section_length, section_propo, header, content, CASE WHEN id % 8 = 7 THEN 'β' WHEN id % 9 = 4 OR (doc_id % 5 = 0 AND id = 2) THEN 'π' ELSE 'άλλο' END AS label FROM propo
)"""


def index_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.override_contents(_labelled(spark, sf_dir, "content", "section_length", "section_propo")).groupBy("doc_id", "label").agg(F.count("*").alias("sections"), F.sum("id").alias("ids"))


INDEX_OVERRIDE_SQL = f"""WITH {_MD}, {_LABELLED}, e AS (
  SELECT *, sum(section_length) OVER w <= 300 AND sum(section_propo) OVER w <= 300 AS early, (header = 'Contents' AND doc_id // 6 % {len(CONTENTS)} IN {LISTED}) AS toc FROM lab WINDOW w AS (PARTITION BY doc_id ORDER BY id)
), f AS (SELECT doc_id, id, CASE WHEN early AND toc THEN 'π' WHEN NOT early AND label = 'π' THEN 'άλλο' ELSE label END AS label FROM e)
SELECT doc_id, label, count(*) AS sections, CAST(sum(id) AS BIGINT) AS ids FROM f GROUP BY ALL
"""


def annotate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.annotate_text(_labelled(spark, sf_dir)).select("doc_id", "id", "label")


ANNOTATE_TEXT_SQL = f"""WITH {_MD}, {_LABELLED}, b AS (SELECT doc_id, id, label, min(CASE WHEN label = 'π' THEN id END) OVER w AS f, max(CASE WHEN label = 'β' THEN id END) OVER w AS z FROM lab WINDOW w AS (PARTITION BY doc_id))
SELECT doc_id, id, CASE WHEN coalesce(f <= z, false) AND label = 'άλλο' THEN (CASE WHEN id < f THEN 'ε.σ.' WHEN id > z THEN 'α' ELSE 'κ' END) ELSE label END AS label FROM b
"""


def annotate_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.annotate_chapters(_labelled(spark, sf_dir)).groupBy("doc_id", "label").agg(F.count("*").alias("sections"))


ANNOTATE_CHAPTER_SQL = f"WITH {_MD}, {_LABELLED} SELECT doc_id, CASE WHEN label IN ('π', 'άλλο') THEN 'κ' ELSE label END AS label, count(*) AS sections FROM lab GROUP BY ALL"


def annotate_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = annotate.annotation_method(F.when(F.col("doc_id") % 2 == 0, "book").otherwise("thesis"), {"book": "chapter"})
    return annotate.annotate(_labelled(spark, sf_dir), method).groupBy("doc_id", "label").agg(F.count("*").alias("sections"))


ANNOTATE_AUTO_SQL = f"""WITH {_MD}, {_LABELLED}, b AS (SELECT doc_id, id, label, min(CASE WHEN label = 'π' THEN id END) OVER w AS f, max(CASE WHEN label = 'β' THEN id END) OVER w AS z FROM lab WINDOW w AS (PARTITION BY doc_id)
), r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN (CASE WHEN label IN ('π', 'άλλο') THEN 'κ' ELSE label END)
  WHEN coalesce(f <= z, false) AND label = 'άλλο' THEN (CASE WHEN id < f THEN 'ε.σ.' WHEN id > z THEN 'α' ELSE 'κ' END) ELSE label END AS label FROM b)
SELECT doc_id, label, count(*) AS sections FROM r GROUP BY ALL
"""


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents and turns as their chunks of two hundred pages; the first turn is the document."""
    t, i = F.col("turn").cast("int"), F.col("conv_id")
    stem = F.when(t == 0, F.format_string("c%d", i)).otherwise(F.format_string("c%d__p%04d-%04d", i, t * 200 - 199, t * 200))
    return table(spark, sf_dir, "conversations").dropDuplicates(["conv_id", "turn"]).select(
        stem.alias("stem"), "text", F.length("text").alias("char_count_no_comments"), ((t * 7 + i) % 11 / 4).alias("greek_badness_score"), F.when(t % 2 == 1, (i % 5 / 2)).alias("percentage_greek"),
        (t == 3).alias("needs_ocr"), F.lit(False).alias("is_empty"), F.when(t == 2, "el").alias("language"), F.when(t == 1, "ok").when(t == 2, "a;b").when(t == 4, "b;c").alias("filter"),
    )


def chunk_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = export.gather_chunks(_chunked(spark, sf_dir))
    return made.select("stem", "char_count_no_comments", "needs_ocr", "is_empty", "language", "filter", "chunks", F.round("greek_badness_score", 2).alias("greek_badness_score"), F.round("percentage_greek", 2).alias("percentage_greek"))


_CHUNKED = """u AS (SELECT DISTINCT ON (conv_id, turn) conv_id, turn, text FROM conversations
), c AS (
  SELECT 'c' || conv_id AS stem, turn, turn <> 0 AS chunk, text, length(text) AS w, ((turn * 7 + conv_id) % 11) / 4 AS g, CASE WHEN turn % 2 = 1 THEN (conv_id % 5) / 2 END AS p FROM u
)"""
CHUNK_SQL = f"""WITH {_CHUNKED}, a AS (
  SELECT stem, coalesce(nullif(sum(w) FILTER (chunk), 0), max(w) FILTER (NOT chunk)) AS n, bool_or(turn = 3) AS needs_ocr, bool_or(turn = 2) AS two, bool_or(turn = 4) AS four, bool_or(turn = 3) AS three, count(*) FILTER (chunk) AS chunks,
    coalesce(sum(g * w) FILTER (chunk AND w > 0) / sum(w) FILTER (chunk AND w > 0), avg(g) FILTER (chunk), max(g) FILTER (NOT chunk)) AS g,
    coalesce(sum(p * w) FILTER (chunk AND w > 0 AND p IS NOT NULL) / sum(w) FILTER (chunk AND w > 0 AND p IS NOT NULL), avg(p) FILTER (chunk), max(p) FILTER (NOT chunk)) AS p FROM c GROUP BY stem
)
SELECT stem, CAST(n AS BIGINT) AS char_count_no_comments, needs_ocr, false AS is_empty, CASE WHEN two THEN 'el' END AS language,
  coalesce(nullif(concat_ws(';', CASE WHEN two THEN 'a' END, CASE WHEN two OR four THEN 'b' END, CASE WHEN four THEN 'c' END, CASE WHEN three THEN 'chunk_needs_ocr' END), ''), 'ok') AS filter, chunks,
  round(round_even(g, 3), 2) AS greek_badness_score, round(round_even(p, 3), 2) AS percentage_greek FROM a
"""


def export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export lines of conversations: their chunks joined, with what was gathered about them."""
    chunked = _chunked(spark, sf_dir)
    meta = export.gather_chunks(chunked).select("stem", "filter", "needs_ocr", "language", "chunks")
    lines = export.records(export.joined_texts(chunked), meta)
    parsed = F.from_json("line", "document string, doc_id string, filter string, needs_ocr boolean, language string, chunks long")
    return lines.select("stem", parsed.alias("r")).select("stem", F.md5(F.col("r.document").cast("binary")).alias("document_md5"), "r.doc_id", "r.filter", "r.needs_ocr", "r.language", "r.chunks")


EXPORT_SQL = f"""WITH {_CHUNKED}, a AS (
  SELECT stem, count(*) FILTER (chunk) AS chunks, CASE WHEN count(*) FILTER (chunk) > 0 THEN string_agg(text, chr(10) ORDER BY turn) FILTER (chunk) ELSE max(text) FILTER (NOT chunk) END AS document,
    bool_or(turn = 3) AS three, bool_or(turn = 2) AS two, bool_or(turn = 4) AS four FROM c GROUP BY stem
)
SELECT stem, md5(document) AS document_md5, sha256(stem) AS doc_id, coalesce(nullif(concat_ws(';', CASE WHEN two THEN 'a' END, CASE WHEN two OR four THEN 'b' END, CASE WHEN four THEN 'c' END, CASE WHEN three THEN 'chunk_needs_ocr' END), ''), 'ok') AS filter,
  three AS needs_ocr, CASE WHEN two THEN 'el' END AS language, chunks FROM a
"""


def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as export lines in shards: every shard's rows and bytes."""
    docs = table(spark, sf_dir, "documents").select(F.format_string("d%09d", F.col("doc_id")).alias("stem"), F.col("text").alias("line"))
    placed = export.shard_numbers(docs.where("line is not null"), SHARD_BYTES)
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"), F.min("stem").alias("first_stem"))


SHARD_SQL = f"""
WITH RECURSIVE s AS (SELECT printf('d%09d', doc_id) AS stem, strlen(text) + 1 AS bytes, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL
), f AS (
  SELECT r, CAST(0 AS BIGINT) AS shard, bytes AS used FROM s WHERE r = 1
  UNION ALL SELECT s.r, CASE WHEN used + bytes > {SHARD_BYTES} THEN shard + 1 ELSE shard END, CASE WHEN used + bytes > {SHARD_BYTES} THEN bytes ELSE used + bytes END FROM f JOIN s ON s.r = f.r + 1
)
SELECT shard, count(*) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes, min(stem) AS first_stem FROM f JOIN s USING (r) GROUP BY shard
"""


def section_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of all documents labelled by a classifier that was trained on the hashed half of them."""
    rows = sections.section_rows(_markdown(spark, sf_dir), fields=("id", "header", "content", "has_table", "has_list", "has_other", "has_text")).withColumn("label", F.when(F.col("has_table"), "table").when(F.col("has_list"), "list").otherwise("text"))
    ready = rows.select("doc_id", "id", "label", F.concat_ws(" ", "header", "content").alias("combined"), *[F.col(f"has_{k}").cast("double").alias(f"has_{k}") for k in ("table", "list", "other", "text")])
    train = ready.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    model = annotate.classifier().fit(train)
    return model.transform(ready).select("doc_id", "id", "label", "predicted")


QUERIES = {
    "sections_split": (sections_split, SECTIONS_SQL), "section_stats": (section_stats, SECTION_STATS_SQL), "section_blocks": (section_blocks, SECTION_BLOCKS_SQL), "index_override": (index_override, INDEX_OVERRIDE_SQL),
    "annotate_text": (annotate_text, ANNOTATE_TEXT_SQL), "annotate_chapter": (annotate_chapter, ANNOTATE_CHAPTER_SQL), "annotate_auto": (annotate_auto, ANNOTATE_AUTO_SQL), "chunk_aggregate": (chunk_aggregate, CHUNK_SQL),
    "export_records": (export_records, EXPORT_SQL), "shard_assign": (shard_assign, SHARD_SQL), "section_classifier": (section_classifier, None),
}
