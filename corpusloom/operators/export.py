"""Export: metadata of chunks gathered per document, records, shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import chunk_range, without_chunk
from ..functions.values import as_float, loose_bool
from ..sources.scratch import settled

#: Fields averaged over chunks by their characters, with the digits kept (fixed values).
WEIGHTED = {"mojibake_badness_score": 6, "greek_badness_score": 3, "percentage_greek": 3, "latin_percentage": 3, "polytonic_ratio": 2}
SHARD_BYTES = 500 * 1024 * 1024
#: Most key ranges that shards are filled in.
MAX_RANGES = 2000


def rounded(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def gather_chunks(meta: DataFrame, stem: str = "stem") -> DataFrame:
    """One row per document from rows of documents and chunks (by the page range in their stems).

    Characters are summed over chunks (or the document's own), scores averaged with them as weights, plainly where
    no weight is known; flags are or-ed; the language is the document's or the first chunk's that has one; filter
    tokens are joined in order, with chunk_needs_ocr where a chunk needs recognition.
    """
    own = without_chunk(F.col(stem))
    rows = meta.withColumns({"__base": own, "__chunk": F.col(stem) != own, "__order": chunk_range(F.col(stem)), "__w": as_float(F.col("char_count_no_comments"))})
    chunk, weight = F.col("__chunk"), F.greatest(F.coalesce("__w", F.lit(0.0)), F.lit(0.0))
    truth = lambda c: F.coalesce(loose_bool(F.col(c)), F.lit(False))
    aggregated = []
    for name, digits in WEIGHTED.items():
        if name in meta.columns:
            v = as_float(F.col(name))
            use = chunk & v.isNotNull() & (weight > 0)
            average = F.sum(F.when(use, v * weight)) / F.sum(F.when(use, weight))
            plain = F.avg(F.when(chunk, v))
            aggregated.append(rounded(F.coalesce(average, plain, F.max(F.when(~chunk, v))), digits).alias(name))
    tokens = F.array_sort(F.collect_list(F.when(F.coalesce(F.trim("filter"), F.lit("")) != "", F.struct(chunk.alias("c"), F.col("__order"), F.col("filter").alias("f")))))
    spoken = F.when(F.coalesce(F.trim("language"), F.lit("")) != "", F.struct(chunk.alias("c"), F.col("__order"), F.col("language").alias("l")))
    grouped = rows.groupBy(F.col("__base").alias(stem)).agg(
        F.coalesce(F.when(F.sum(F.when(chunk, weight)) > 0, F.sum(F.when(chunk, weight))), F.max(F.when(~chunk, F.col("__w")))).cast("long").alias("char_count_no_comments"),
        F.max(truth("needs_ocr")).alias("needs_ocr"), F.max(truth("is_empty")).alias("is_empty"), F.max(chunk & truth("needs_ocr")).alias("__again"),
        F.min(spoken)["l"].alias("language"), tokens.alias("__tokens"), F.count_if(chunk).alias("chunks"), *aggregated,
    )
    every = F.flatten(F.transform("__tokens", lambda t: F.split(t["f"], ";")))
    real = F.array_distinct(F.filter(F.transform(every, lambda t: F.trim(t)), lambda t: (t != "") & (t != "ok")))
    named = F.when(F.col("__again"), F.array_distinct(F.concat(real, F.array(F.lit("chunk_needs_ocr"))))).otherwise(real)
    return grouped.withColumn("filter", F.when(F.size(named) > 0, F.array_join(named, ";")).otherwise("ok")).drop("__tokens", "__again")


def joined_texts(files: DataFrame, stem: str = "stem", text: str = "text") -> DataFrame:
    """(stem, text): chunks joined by newlines in page order where there are any, else the document's own text."""
    own = without_chunk(F.col(stem))
    rows = files.select(own.alias("__base"), (F.col(stem) != own).alias("__chunk"), chunk_range(F.col(stem)).alias("o"), F.col(text).alias("t"))
    parts = F.transform(F.array_sort(F.collect_list(F.when(F.col("__chunk"), F.struct("o", "t")))), lambda x: x["t"])
    grouped = rows.groupBy("__base").agg(parts.alias("p"), F.max(F.when(~F.col("__chunk"), F.col("t"))).alias("own"))
    return grouped.select(F.col("__base").alias(stem), F.when(F.size("p") > 0, F.array_join("p", "\n")).otherwise(F.col("own")).alias(text))


def source_rows(source: DataFrame, fields: list[str], key: str = "stem", order: str | None = None) -> DataFrame:
    """(key, fields...) of each document of a source table: of rows of the document and of chunks of it (by the page range in
    their stems) the first that is not a chunk's, else the first, in ``order``, or as the table is read."""
    own = without_chunk(F.col(key))
    at = F.monotonically_increasing_id() if order is None else F.col(order)
    rows = source.where(F.coalesce(F.trim(key), F.lit("")) != "").select(own.alias("__base"), F.struct((F.col(key) != own).alias("chunk"), at.alias("at")).alias("__order"), F.struct(*fields).alias("__row"))
    best = rows.groupBy("__base").agg(F.min_by("__row", "__order").alias("__row"))
    return best.select(F.col("__base").alias(key), *(F.col("__row")[f].alias(f) for f in fields))


def source_fields(docs: DataFrame, source: DataFrame, fields: list[str], key: str = "stem", order: str | None = None) -> DataFrame:
    """docs with the fields of a source table, one row of it a document (``source_rows``); a missing key or a blank field
    stops the job."""
    lacking = [f for f in fields if f not in source.columns]
    if lacking:
        raise ValueError(f"source metadata lacks {', '.join(lacking)}")
    joined = docs.join(source_rows(source, fields, key, order).withColumn("__there", F.lit(True)), key, "left")
    known = F.when(F.col("__there").isNull(), F.raise_error(F.concat(F.lit("no source metadata for "), F.col(key))))
    checked = {f: F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) == "", F.coalesce(known, F.raise_error(F.concat(F.lit(f"blank {f} for "), F.col(key))))).otherwise(F.col(f).cast("string")) for f in fields}
    return joined.withColumns(checked).drop("__there")


def records(docs: DataFrame, meta: DataFrame, metrics: DataFrame | None = None, text_key: str = "document", metadata_key: str | None = None, fields: list[str] | None = None, key: str = "stem", text: str = "text") -> DataFrame:
    """(stem, line): one JSON object per document with metadata; doc_id is the SHA-256 of its stem.

    metrics: optional (stem, page_count, formula_total, code_total); nulls are written, non-numbers become null.
    """
    inner = docs.select(key, text).join(meta.drop(text), key)
    if metrics is not None:
        m = metrics.select(key, *[F.col(c).alias(f"__m_{c}") for c in ("page_count", "formula_total", "code_total")])
        inner = inner.join(m, key, "left")
        for c in ("page_count", "formula_total", "code_total"):
            had = F.col(c) if c in meta.columns else F.lit(None).cast("long")
            inner = inner.withColumn(c, F.coalesce(F.col(f"__m_{c}"), had, F.lit(None if c == "page_count" else 0).cast("long")))
        inner = inner.drop(*[f"__m_{c}" for c in ("page_count", "formula_total", "code_total")])
    names = fields if fields is not None else [c for c in inner.columns if c not in (key, text)]
    kinds = dict(inner.dtypes)
    plain = lambda c: (F.when(F.isnan(c), None).otherwise(F.col(c)) if kinds[c] in ("double", "float") else F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if kinds[c].startswith("timestamp") else F.col(c)).alias(c)
    rest = [F.struct(*map(plain, names)).alias(metadata_key)] if metadata_key else list(map(plain, names))
    record = F.struct(F.col(text).alias(text_key), F.sha2(F.col(key), 256).alias("doc_id"), *rest)
    return inner.select(key, F.to_json(record, {"ignoreNullFields": "false"}).alias("line"))


def _parts(batches, columns: list[str]):
    """The rows of each part as arrays, from batches sorted by part."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for part, rows in batch.groupby("part", sort=True):
            if held and held[0]["part"].iloc[0] != part:
                whole = pd.concat(held)
                yield int(whole["part"].iloc[0]), [whole[c].to_numpy() for c in columns]
                held = []
            held.append(rows)
    if held:
        whole = pd.concat(held)
        yield int(whole["part"].iloc[0]), [whole[c].to_numpy() for c in columns]


def shard_numbers(lines: DataFrame, limit: int = SHARD_BYTES, key: str = "stem") -> DataFrame:
    """(key, bytes, shard): lines in key order fill shards up to limit bytes (newlines included), a larger line its own.

    The greedy fill over all lines, at any size. Each key range works out, for every line at which its first new
    shard may start, how many shards start from there on and how full the last one is left; neighbours with the same
    outcome are one row. These few rows are written, so that ranges are sorted in tasks of their own, and chained in
    range order, and then every range numbers its lines from the fill that comes in. No task holds a line's text.
    """
    sized = lines.select(key, (F.octet_length("line") + 1).cast("long").alias("bytes"))
    total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    ranges = int(min(max(1, total // (16 * limit)), MAX_RANGES))
    placed = settled(sized.repartitionByRange(ranges, key).withColumn("part", F.spark_partition_id()), "sized")
    ordered = placed.repartition(ranges, "part").sortWithinPartitions("part", key, "bytes")

    def starts(batches):
        for part, (sizes,) in _parts(batches, ["bytes"]):
            before = np.concatenate(([0], np.cumsum(sizes)))
            n = len(sizes)
            after = np.maximum(np.searchsorted(before, before[:-1] + limit, "right") - 1, np.arange(1, n + 1)).tolist()
            count, left = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
            for i in range(n - 1, -1, -1):
                count[i] = count[after[i]] + 1
                left[i] = left[after[i]] if after[i] < n else before[n] - before[i]
            m = int(np.searchsorted(before[:n], limit, "right"))
            # Of neighbours with the same outcome the last one counts: a fill starts there if the lines up to its end do not fit.
            ends = np.flatnonzero(np.append((np.diff(count[:m]) != 0) | (np.diff(left[:m]) != 0), True))
            # A shard that comes in may hold the whole range: the last row says how many bytes that is.
            yield pd.DataFrame({"part": part, "upto": [*before[ends + 1], before[n]], "count": [*count[ends], 0], "left": [*left[ends], 0], "last": [False] * len(ends) + [True]})

    def chain(batches):
        shard, used = -1, limit + 1
        for part, (upto, count, left, last) in _parts(batches, ["upto", "count", "left", "last"]):
            yield pd.DataFrame({"part": [part], "shard": [shard], "used": [used]})
            over = np.flatnonzero((used + upto > limit) & ~last)
            if len(over):
                shard, used = shard + int(count[over[0]]), int(left[over[0]])
            else:
                used += int(upto[last][0])

    small = settled(ordered.mapInPandas(starts, "part int, upto long, count long, left long, last boolean"), "starts")
    chained = settled(small.coalesce(1).sortWithinPartitions("part", "last", "upto").mapInPandas(chain, "part int, shard long, used long"), "chained")
    incoming = {r["part"]: (r["shard"], r["used"]) for r in chained.collect()}

    def fill(batches):
        part, shard, used = None, -1, 0
        for batch in batches:
            numbers = []
            for here, size in zip(batch["part"].tolist(), batch["bytes"].tolist(), strict=True):
                if here != part:
                    part, (shard, used) = here, incoming[here]
                if used + size > limit:
                    shard, used = shard + 1, 0
                used += size
                numbers.append(shard)
            yield pd.DataFrame({key: batch[key], "bytes": batch["bytes"], "shard": numbers})

    return ordered.mapInPandas(fill, f"{key} string, bytes long, shard long")


def assign_shards(lines: DataFrame, limit: int = SHARD_BYTES, key: str = "stem") -> DataFrame:
    """Adds shard, as ``shard_numbers`` has it."""
    return lines.join(shard_numbers(lines, limit, key).drop("bytes"), key)
