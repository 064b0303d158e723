"""Artefacts of extraction: formula indexes, chunk manifests, sidecars, page images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .metadata import upsert

#: Longest context of a formula and what of it is kept; tolerance, share and sampling of blank pages (fixed values).
CONTEXT_LIMIT, CONTEXT_KEPT = 80, 77
TOLERANCE, BLANK_SHARE, FULL_PIXELS, SAMPLE_STEP = 8, 0.0015, 65536, 64


def shortened(context: Column) -> Column:
    return F.when(F.length(context) > CONTEXT_LIMIT, F.concat(F.substring(context, 1, CONTEXT_KEPT), F.lit("…"))).otherwise(context)


def formula_index(regions: DataFrame, key: str = "stem") -> DataFrame:
    """(key, page_no, item_index, label, context, box): regions numbered inside their pages in order of appearance.

    regions: (key, page_no, seq, label, context, left, top, right, bottom, page_width, page_height); the box is in
    shares of the page where its size is known, else null.
    """
    place = F.row_number().over(W.partitionBy(key, "page_no").orderBy("seq")) - 1
    share = lambda v, of: F.when(F.col(of) > 0, F.col(v) / F.col(of))
    box = F.struct(share("left", "page_width").alias("left"), share("top", "page_height").alias("top"), share("right", "page_width").alias("right"), share("bottom", "page_height").alias("bottom"))
    known = (F.col("page_width") > 0) & (F.col("page_height") > 0)
    return regions.select(key, "page_no", place.alias("item_index"), "label", shortened(F.col("context")).alias("context"), F.when(known, box).alias("box"))


def wanted_items(items: DataFrame, targets: DataFrame) -> DataFrame:
    """Items whose (page_no, item_index) is among the targets."""
    return items.join(targets.select("page_no", "item_index").distinct(), ["page_no", "item_index"], "left_semi")


def chunk_manifest(chunks: DataFrame, key: str = "stem") -> DataFrame:
    """(key, manifest): one JSON object per document with its page ranges in order and how each ended.

    chunks: (key, page_start, page_end, status). A document counts as complete if every range is ok, and is given up
    after an error or a second timeout.
    """
    timeouts, errors = F.count_if(F.col("status") == "timeout"), F.count_if(F.col("status") == "error")
    parts = F.array_sort(F.collect_list(F.struct("page_start", "page_end", "status")))
    grouped = chunks.groupBy(key).agg(parts.alias("chunks"), timeouts.alias("timeouts"), ((errors > 0) | (timeouts > 1)).alias("given_up"), (F.count_if(F.col("status") == "ok") == F.count("*")).alias("complete"))
    return grouped.select(key, "complete", "given_up", F.to_json(F.struct("chunks", "timeouts", "complete", "given_up")).alias("manifest"))


def merge_sidecars(existing: DataFrame, fresh: DataFrame, key: str = "stem") -> DataFrame:
    """Sidecar fields by key, fresh values over existing ones."""
    return upsert(existing, fresh, key)


def matching_names(files: DataFrame, patterns: list[str], name: str = "filename") -> DataFrame:
    """Files whose name is one of the patterns, or fits one with * and ?, each once."""
    fits = F.lit(False)
    for p in patterns:
        last = p.rsplit("/", 1)[-1]
        regex = "".join(".*" if c == "*" else "." if c == "?" else rf"\Q{c}\E" for c in last)
        fits = fits | F.rlike(F.col(name), F.lit(f"^(?:{regex})$"))
    return files.where(fits).dropDuplicates([name])


def is_mostly_blank(pixels: Column, alpha: bool = False) -> Column:
    """Whether hardly any pixel of an 8-bit page image differs from its first one in any colour.

    Pixels are three bytes, or four with an alpha channel, which does not count; large images are sampled; an image
    without a whole pixel is blank.
    """
    width = 4 if alpha else 3

    @F.pandas_udf("boolean")
    def blank(images: pd.Series) -> pd.Series:
        def one(data: bytes) -> bool:
            every = np.frombuffer(data, np.uint8, len(data) // width * width).reshape(-1, width)[:, :3]
            some = (every[::SAMPLE_STEP] if len(every) > FULL_PIXELS else every).astype(np.int16)
            return not len(some) or float((np.abs(some - some[0]) > TOLERANCE).any(axis=1).mean()) <= BLANK_SHARE

        return images.map(one, na_action="ignore")

    return blank(pixels)
