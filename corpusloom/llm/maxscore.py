"""Exact top-k search by MaxScore over vectors of whole-numbered components.

Each dimension is a query term with a posting list of the candidates' components, kept by dimension in shards of
candidates. For a query and a block of a shard, a term's score bound is the most that any posting of the block
can add. Terms are ordered by bound; those whose bounds together cannot lift a candidate over the k-th best score
so far are non-essential. The postings of the essential terms are traversed; only candidates that could still
win are probed in the other terms, the largest bound first. The shards' best k are merged by a window.

Edge cases: vectors that are null or hold null or non-finite components take no part; missing trailing
components count as zero; rows with the query's own vec_id are its own row; a repeated query is one query, and
repeated candidates are ranked each; rows with a null vec_id take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import written

TOP = 20
SHARD_ROWS, QUERY_ROWS, BLOCK = 16384, 4096, 2048


def whole_components(embedding: Column, scale: int = 64) -> Column:
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))


def _finite(embedding: Column) -> Column:
    sound = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(sound, F.lit(False))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def search_shard(query: np.ndarray, query_id: int, postings: np.ndarray, ids: np.ndarray, high: np.ndarray, low: np.ndarray, top: int) -> list[tuple[int, int]]:
    """The best (score, -vec_id) of a shard; postings: by dimension, candidates in ascending id; bounds by block."""
    best: list[tuple[int, int]] = []
    for b in range(high.shape[0]):
        begin = b * BLOCK
        block = postings[:, begin : begin + BLOCK]
        bound = np.maximum(np.where(query > 0, query * high[b], query * low[b]), 0)
        order = np.argsort(bound, kind="stable")
        summed = np.cumsum(bound[order])
        least = best[0][0] if len(best) == top else None
        if least is not None and summed[-1] <= least:
            continue
        split = 0 if least is None else int(np.searchsorted(summed, least, "right"))
        essential = order[split:]
        score = query[essential] @ block[essential]
        if least is None:
            alive = np.arange(block.shape[1])
        else:
            alive = np.flatnonzero(score + (summed[split - 1] if split else 0) > least)
            score = score[alive]
            for at in range(split, 0, -8):
                terms = order[max(0, at - 8) : at]
                score = score + query[terms] @ block[np.ix_(terms, alive)]
                rest = summed[at - 9] if at > 8 else 0
                keep = score + rest > least
                alive, score = alive[keep], score[keep]
        if len(alive) > 4 * top:
            cut = np.partition(score, len(score) - top - 1)[len(score) - top - 1]
            alive, score = alive[score >= cut], score[score >= cut]
        for s, i in zip(score.tolist(), ids[begin + alive].tolist(), strict=True):
            if i == query_id:
                continue
            item = (int(s), -i)
            if len(best) < top:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
    return best


def top_k(vectors: DataFrame, top: int = TOP, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` best inner products of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    sound = written(vectors.where(F.col("vec_id").isNotNull() & _finite(F.col("embedding"))).select(F.col("vec_id").cast("long"), whole_components(F.col("embedding"), scale).alias("v")), "vectors")
    asked = sound.where(F.col("vec_id") % every == 0)
    rows, width = sound.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    shards = max(2 * spark.sparkContext.defaultParallelism, -(-rows // SHARD_ROWS))
    blocks = max(1, -(-rows // every // QUERY_ROWS))
    salt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    left = asked.dropDuplicates(["vec_id"]).select("vec_id", "v", salt(blocks, 1).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    right = sound.select("vec_id", "v", salt(shards, 2).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        candidates = candidates.sort_values("vec_id", kind="stable")
        q, x = _matrix(queries["v"], width), _matrix(candidates["v"], width)
        largest = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * width
        kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object
        ids, n = candidates["vec_id"].to_numpy(), len(x)
        high = np.array([x[a : a + BLOCK].max(0) for a in range(0, n, BLOCK)]).reshape(-1, width).astype(kind)
        low = np.array([x[a : a + BLOCK].min(0) for a in range(0, n, BLOCK)]).reshape(-1, width).astype(kind)
        postings, q = np.ascontiguousarray(x.T.astype(kind)), q.astype(kind)
        found = [(qid, -i, s) for qid, v in zip(queries["vec_id"].tolist(), q, strict=True) for s, i in search_shard(v, qid, postings, ids, high, low, top)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search, "query_id long, vec_id long, score long")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
