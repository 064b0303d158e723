"""Routing after cleaning: which documents are flagged and which are read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Limits above which a document is flagged (fixed values).
BADNESS_LIMIT, GREEK_LIMIT = 0.1, 60.0
COUNT_VARIANTS = ("page_count", "char_count_no_comments")


def gate(meta: DataFrame, empty_char_threshold: int = 0, empty_min_pages: int = 0) -> DataFrame:
    """meta with filter, needs_ocr and is_empty set anew.

    Only PDF files can be flagged. Flags are joined in a fixed order; documents recognised already keep their flags
    but are not sent back; comparisons with null are false.
    """
    chars, pages = F.col("char_count_no_comments"), F.coalesce(F.col("page_count"), F.lit(empty_min_pages if empty_min_pages > 0 else 0))
    pdf = F.coalesce(F.endswith(F.lower("filename"), F.lit(".pdf")), F.lit(False))
    true = lambda c: F.coalesce(c, F.lit(False))
    rules = [(true(F.col("mojibake_badness_score") > BADNESS_LIMIT), f"mojibake>{BADNESS_LIMIT}", True), (true(F.col("greek_badness_score") > GREEK_LIMIT), "non_greek_text", True)]
    if empty_char_threshold <= 0:
        rules.append((true(chars <= 0), "is_empty", True))
    else:
        few, token = true(chars < empty_char_threshold), f"empty_text<{empty_char_threshold}"
        rules.append((few & (pages >= max(1, empty_min_pages)), token, True))
        if empty_min_pages > 0:
            rules.append((few & (pages < empty_min_pages), f"{token}_short", False))
    flags = F.concat_ws(";", *[F.when(pdf & c, token) for c, token, _ in rules])
    asks = F.lit(False)
    for c, _, again in rules:
        asks = asks | c if again else asks
    done = true(F.col("ocr_success")) if "ocr_success" in meta.columns else F.lit(False)
    return meta.withColumns({
        "filter": F.when(flags == "", "ok").otherwise(flags), "needs_ocr": pdf & asks & ~done,
        "is_empty": true(F.col("is_empty")) | true(chars <= 0) if "is_empty" in meta.columns else true(chars <= 0),
    })


def settle_columns(meta: DataFrame) -> DataFrame:
    """Variants of count columns (name_x, name_y, ...) coalesced into one, Latin share renamed, leftovers dropped."""
    out = meta
    for base in COUNT_VARIANTS:
        variants = [c for c in out.columns if c == base or c.startswith(f"{base}_")]
        if variants:
            out = out.withColumn(base, F.coalesce(*[F.col(c) for c in sorted(variants)])).drop(*[c for c in variants if c != base])
    for name, digits in (("greek_badness_score", 3), ("polytonic_ratio", 2)):
        if name in out.columns:
            out = out.withColumn(name, F.bround(name, digits))
    if "latin_percentage" not in out.columns:
        out = out.withColumnRenamed("mojibake_latin_percentage", "latin_percentage")
    return out.withColumnRenamed("rejection_reason", "filter").drop("greek_latin_percentage")


def good_files(meta: DataFrame, drop_bad: bool = True) -> DataFrame:
    return meta.where(~F.coalesce("needs_ocr", F.lit(False))) if drop_bad else meta


def ocr_candidates(meta: DataFrame, skip: DataFrame, reprocess: bool = False) -> DataFrame:
    """Rows that need recognition, without those done (unless asked for again, which adds them) and those skipped.

    skip has a column stem; it stays on the disk side of the join unless Spark's own size check broadcasts it.
    """
    done = F.coalesce("ocr_success", F.lit(False))
    wanted = meta.where(done | F.coalesce("needs_ocr", F.lit(False))) if reprocess else meta.where(F.coalesce("needs_ocr", F.lit(False)) & ~done)
    return wanted.join(skip.select("stem").distinct(), "stem", "left_anti")


def math_candidates(meta: DataFrame) -> DataFrame:
    have = set(meta.columns)
    tests = [t for c, t in (("phase_recommended", F.col("phase_recommended") == "2A" if "phase_recommended" in have else None), ("formula_total", F.col("formula_total") > 0 if "formula_total" in have else None), ("math_equations_detected", F.col("math_equations_detected") > 0 if "math_equations_detected" in have else None)) if c in have]
    found = F.lit(False)
    for t in tests:
        found = found | F.coalesce(t, F.lit(False))
    return meta.where(found)


def section_candidates(meta: DataFrame) -> DataFrame:
    """Rows that passed or were recognised; without such columns those extracted well, else all."""
    have = set(meta.columns)
    if "filter" in have:
        done = F.coalesce(F.col("ocr_success"), F.lit(False)) if "ocr_success" in have else F.lit(False)
        return meta.where((F.coalesce("filter", F.lit("")) == "ok") | done)
    return meta.where(F.col("extraction") == "good") if "extraction" in have else meta
