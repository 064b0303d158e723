"""Coercions and small state columns of metadata tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words for truth values and stage outcomes (fixed values).
TRUE_WORDS, FALSE_WORDS = ("true", "1", "yes", "y"), ("false", "0", "no", "n")
SUCCESS_WORDS = ("success", "ok", "complete", "completed", "partial", "chunked")
FAILURE_WORDS = ("failed", "failure", "error", "timeout", "problematic", "skipped")
NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def strict_bool(value: Column) -> Column:
    """True or false words (t and f too); anything else is null."""
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS, "t"), True).when(word.isin(*FALSE_WORDS, "f"), False)


def loose_bool(value: Column) -> Column:
    """False words are false, empty ones (none, na) null, and anything else true; of numbers, 0 is false and NaN null."""
    word, number = F.lower(F.trim(value.cast("string"))), value.cast("string").try_cast("double")
    by_number = F.when(F.isnan(number), F.lit(None).cast("boolean")).otherwise(number != 0)
    return F.when(F.typeof(value).isin(*NUMBER_TYPES), by_number).when(word.isin("", "na", "none") | word.isNull(), F.lit(None).cast("boolean")).when(word.isin(*FALSE_WORDS), False).otherwise(True)


def as_float(value: Column) -> Column:
    """A double, null where it is blank, not a number or unreadable."""
    number = F.trim(value.cast("string")).try_cast("double")
    return F.when(F.isnan(number), None).otherwise(number)


def outcome(status: Column) -> Column:
    word = F.lower(F.trim(status))
    return F.when(word.isin(*SUCCESS_WORDS), "success").when(word.isin(*FAILURE_WORDS), "failure")


def add_stage(stages: Column, stage: str) -> Column:
    """A comma-joined list with the stage appended unless it is in it."""
    own = F.coalesce(stages, F.lit(""))
    return F.when(own == "", stage).when(F.array_contains(F.split(own, ","), stage), own).otherwise(F.concat(own, F.lit(f",{stage}")))


def page_budget(pages: Column, per_page: float = 20.0) -> Column:
    """Seconds allowed for a document of so many pages; one page's where the number is unknown."""
    return F.greatest(F.coalesce(pages, F.lit(1)) * per_page, F.lit(per_page))
