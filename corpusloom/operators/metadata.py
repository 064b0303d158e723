"""Keyed metadata: upserts, merges, resumption, state, synthesis from artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..functions.names import canonical_stem
from ..functions.values import add_stage, outcome
from ..sources.listing import probed
from ..sources.scratch import settled

#: The metadata table's columns, types and defaults (fixed values).
DEFAULTS: dict[str, tuple[str, object]] = {
    "url": ("string", ""), "filename": ("string", ""), "file_ext": ("string", ""), "document_type": ("string", None), "download_success": ("boolean", False),
    "download_error": ("string", ""), "download_retry_count": ("int", 0), "is_duplicate": ("boolean", False), "duplicate_of": ("string", ""), "source_row": ("int", None),
    "url_index": ("int", None), "filename_base": ("string", ""), "filter": ("string", "ok"), "extract_status": ("string", ""), "extract_error": ("string", ""),
    "needs_ocr": ("boolean", False), "ocr_success": ("boolean", False), "processing_stage": ("string", ""), "mojibake_badness_score": ("double", None),
    "mojibake_latin_percentage": ("double", None), "percentage_greek": ("double", None), "char_count_no_comments": ("long", None), "is_empty": ("boolean", False),
    "page_count": ("int", None), "pages_total": ("int", None), "pages_with_formula": ("int", None), "formula_total": ("int", None), "formula_avg_pp": ("double", None),
    "formula_p90_pp": ("double", None), "phase_recommended": ("string", None), "math_enriched": ("boolean", False), "math_items": ("int", None), "math_accepted": ("int", None),
    "math_accept_rate": ("double", None), "math_time_sec": ("double", None),
}
SECTION_FIELDS = "id long, row_id string, filename string, has_table boolean, has_list boolean, has_other boolean, has_text boolean, header string, place string, section string, json_section string, section_length long, section_propo long"


def metadata_schema(url_column: str = "url") -> T.StructType:
    return T._parse_datatype_string(", ".join(f"`{url_column if c == 'url' else c}` {t}" for c, (t, _) in DEFAULTS.items()))


def with_defaults(df: DataFrame, columns: dict | None = None) -> DataFrame:
    """df with missing metadata columns added and nulls of columns with a default filled; other columns stay."""
    out = df
    for name, (kind, value) in (columns or DEFAULTS).items():
        default = F.lit(value).cast(kind)
        out = out.withColumn(name, default if name not in df.columns else F.col(name) if value is None else F.coalesce(F.col(name), default))
    return out


def missing_columns(df: DataFrame, required) -> list[str]:
    return [c for c in required if c not in df.columns]


def table_kind(df: DataFrame, url_column: str = "url") -> str | None:
    """downloads, sections, metadata, or None, by the columns there are."""
    have = set(df.columns)
    if {"filename", "title", "content", "section"} <= have or {"filename", "header", "section", "id"} <= have:
        return "sections"
    if {"download_success", "filename"} <= have:
        return "downloads"
    return "metadata" if {url_column, "filename"} <= have else None


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, by aggregation, so that a key of many rows is combined before it is moved."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("__row")).select("__row.*")


def upsert(base: DataFrame, updates: DataFrame, key: str = "filename") -> DataFrame:
    """Full outer by key: updates' non-null values win, base fills the rest, new keys come in. Keys are unique."""
    b, u = base.alias("b"), updates.alias("u")
    columns = [c for c in base.columns if c != key] + [c for c in updates.columns if c not in base.columns and c != key]

    def pick(c: str) -> Column:
        both = [F.col(f"u.{c}")] * (c in updates.columns) + [F.col(f"b.{c}")] * (c in base.columns)
        return F.coalesce(*both).alias(c)

    return b.join(u, F.col(f"b.{key}") == F.col(f"u.{key}"), "full_outer").select(F.coalesce(f"b.{key}", f"u.{key}").alias(key), *map(pick, columns))


def merge_results(existing: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """Existing rows whose key is not in the new ones, and the new ones."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def pending(items: DataFrame, *done: DataFrame, key: str = "stem") -> DataFrame:
    """Items in none of the tables of keys done, failed or skipped."""
    for keys in done:
        items = items.join(keys.select(key).distinct(), key, "left_anti")
    return items


def load_state(meta: DataFrame, markdown: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(processed, problematic) stems: by status, by the stage extract, and by a Markdown file being there."""
    status = outcome(F.col("extract_status"))
    staged = F.array_contains(F.split(F.coalesce("processing_stage", F.lit("")), ","), "extract")
    stem = canonical_stem(F.col("filename")).alias("stem")
    failed = meta.where(F.coalesce(status, F.lit("")) == "failure").select(stem).distinct()
    fine = meta.where((F.coalesce(status, F.lit("")) == "success") | staged).select(stem).union(markdown.select("stem")).distinct()
    return fine, failed


def save_state(meta: DataFrame, processed: DataFrame, problematic: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """meta (with stem) with the outcome of each stem; unknown stems come in as rows; a problem beats success.

    files: a listing of source files. Rows that come in take their name and extension from it, by the order of extensions,
    and whether there is such a file; without one, and where it has none of a stem, they are named .pdf.
    """
    marks = processed.select("stem", F.lit(1).alias("rank")).union(problematic.select("stem", F.lit(2).alias("rank"))).groupBy("stem").agg(F.max("rank").alias("__rank"))
    joined = meta.withColumn("__known", F.lit(True)).join(marks, "stem", "full_outer")
    if files is not None:
        fresh = probed(joined.where("__known is null").select("stem"), files).toDF("stem", "__name", "__ext", "__found")
        joined = joined.join(fresh, "stem", "left")
        had = lambda c, kind: F.col(c) if c in meta.columns else F.lit(None).cast(kind)
        joined = joined.withColumns({
            "filename": F.coalesce("filename", "__name"), "file_ext": F.coalesce(had("file_ext", "string"), "__ext"),
            "download_success": F.coalesce(had("download_success", "boolean"), "__found"), "filename_base": F.coalesce(had("filename_base", "string"), F.when(F.col("__name").isNotNull(), F.col("stem"))),
        }).drop("__name", "__ext", "__found")
    joined = joined.drop("__known")
    ok, bad = F.col("__rank") == 1, F.col("__rank") == 2
    stages = F.when(ok, add_stage(F.col("processing_stage"), "extract")).otherwise(F.col("processing_stage"))
    return joined.withColumns({
        "filename": F.coalesce("filename", F.concat("stem", F.lit(".pdf"))), "extract_status": F.when(bad, "failed").when(ok, "success").otherwise(F.col("extract_status")), "processing_stage": stages,
    }).drop("__rank")


def synthesize(artefacts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One metadata row per stem from (stem, rank, stage, fields...) rows of artefacts.

    Of each field the value of the highest-ranked artefact that has one counts, stages are joined in rank order,
    defaults fill the rest, and an existing table's non-null values win over all.
    """
    fields = [c for c in artefacts.columns if c not in ("stem", "rank", "stage")]
    ordered = F.array_sort(F.collect_set(F.struct("rank", "stage")))
    found = artefacts.groupBy("stem").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("rank"))).alias(c) for c in fields], F.array_join(F.array_distinct(F.transform(ordered, lambda s: s["stage"])), ",").alias("processing_stage"))
    found = found.withColumn("filename", F.coalesce(*[F.col(c) for c in ("filename",) if c in fields], F.concat("stem", F.lit(".pdf"))))
    return with_defaults(upsert(found, existing, "stem") if existing is not None else found)


def triage_update(meta: DataFrame, density: DataFrame) -> DataFrame:
    """meta by stem with formula statistics rounded to three places; missing stems come in as rows."""
    fresh = density.select("stem", "formula_total", F.bround("formula_avg_pp", 3).alias("formula_avg_pp"), F.bround("formula_p90_pp", 3).alias("formula_p90_pp"), "pages_with_formula", "pages_total", "phase_recommended")
    return upsert(meta, fresh, "stem").withColumn("filename", F.coalesce("filename", F.concat("stem", F.lit(".pdf"))))


def math_update(meta: DataFrame, results: DataFrame) -> DataFrame:
    """Existing rows of meta with items, accepted and their rate."""
    r = results.select("stem", F.col("items").alias("__i"), F.col("accepted").alias("__a"), F.col("time_sec").alias("__t"))
    rate = F.when(F.col("__i") > 0, F.col("__a") / F.col("__i")).when(F.col("__i").isNotNull(), 0.0)
    return meta.join(r, "stem", "left").withColumns({
        "math_items": F.coalesce("__i", "math_items"), "math_accepted": F.coalesce("__a", "math_accepted"), "math_accept_rate": F.coalesce(rate, F.col("math_accept_rate")),
        "math_time_sec": F.coalesce("__t", "math_time_sec"), "math_enriched": F.col("__i").isNotNull() | F.coalesce("math_enriched", F.lit(False)),
    }).drop("__i", "__a", "__t")


def row_ids(df: DataFrame, *order: str) -> DataFrame:
    """Adds row_id, the rank of each row by ``order`` over all rows, from 0.

    Rows are dealt into ranges and sorted there, so a group of many rows is split too; a row's place follows from the
    rows of the ranges before its own, one number a range.
    """
    inside = 33  # bits of a row's place in its range
    placed = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranged")
    sizes = placed.groupBy(F.shiftright("__at", inside).alias("__range")).agg(F.count("*").alias("__n"))
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ranked = placed.withColumn("__range", F.shiftright("__at", inside)).join(F.broadcast(before), "__range")  # a row a range
    return ranked.withColumn("row_id", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << inside) - 1))).drop("__at", "__range", "__before")
