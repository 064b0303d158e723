"""File and document names: canonical stems, chunk names, generated names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of files that belong to a document, the longest first (fixed values).
SUFFIXES = (".docling.json.zst", ".docling.json", ".latex_map.jsonl", ".per_page.metrics.json", ".metrics.json", ".jsonl", ".json", ".md", ".pdf", ".html", ".htm")
_SUFFIX = "(?:" + "|".join(s.replace(".", r"\.") for s in SUFFIXES) + ")"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*\z", 0)


def canonical_stem(path: Column) -> Column:
    """The base name without its known suffixes, however many; if nothing is left, without its last extension."""
    name = base_name(path)
    stem = F.regexp_replace(name, f"{_SUFFIX}+\\z", "")
    plain = F.regexp_replace(name, r"(?s)(?<=.)\.[^.]*\z", "")
    return F.when(stem == "", plain).otherwise(stem)


def without_chunk(stem: Column) -> Column:
    """Without a chunk's page range at the end, for a stem or a file name with extension."""
    return F.regexp_replace(stem, r"__p\d{4}-\d{4}(\.[^.]*)?\z", "$1")


def chunk_range(stem: Column) -> Column:
    """(start, end, stem): the page range anywhere in a stem, last of all where there is none."""
    last = F.lit(2**31 - 1)
    page = lambda i: F.coalesce(F.regexp_extract(stem, r"__p(\d+)-(\d+)", i).try_cast("int"), last)
    return F.struct(page(1).alias("start"), page(2).alias("end"), stem.alias("stem"))


def generated_name(index: Column) -> Column:
    """AAA_000, AAB_001, ...: three base-26 letters of the number and its last three decimal digits."""
    digit = lambda power: F.char(F.lit(65) + F.pmod(F.floor(index / power), F.lit(26)))
    return F.concat(digit(676), digit(26), digit(1), F.lit("_"), F.lpad(F.pmod(index, F.lit(1000)).cast("string"), 3, "0"))
