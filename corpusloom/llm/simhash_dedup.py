"""SimHash near-duplicates with pivot distance tables.

Fingerprints are 64-bit SimHashes of word shingles. Equal fingerprints collapse to one row first, so a group of
exact copies, however large, costs one row. Pairs are enumerated inside buckets of equal masked bits, and inside
a bucket every fingerprint has a row of Hamming distances to fixed reference fingerprints (the pivot table): by
the triangle inequality two fingerprints within r bits differ by at most r in every coordinate, so pairs whose
largest coordinate difference exceeds r are discarded and only the survivors are compared bit by bit.

Distances of 64-bit fingerprints to any reference gather around 32, so pivots alone cannot enumerate pairs in
less than quadratic time; that is what the buckets are for. With ``exact_masks`` they lose nothing: five blocks
of bits, and two fingerprints within three bits agree on at least two whole blocks.

Edge cases: null or wordless texts have fingerprint zero and link like any other; null ids are kept and order
before all others; repeated rows share a class; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import minhash_tensor
from .common import parallelism, written
from .graph import components, labels_of
from .minhash_tensor import shingle_hashes

MAX_BITS = 3
PIVOTS = 16
#: Largest bucket compared in one piece; larger ones are compared block against block, in many tasks.
BLOCK_ROWS = 4096
#: Pairs that a task holds at a time, which bounds its memory.
PAIRS_AT_ONCE = 200_000
#: Sketches of a collection of similar_documents: at 0.8 more are needed than at 0.85.
SKETCHES = 28


def bits_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half of 64-bit hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[low : low + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The SimHash of one text: bit i is set if it is set in over half of the shingles' hashes."""
    return bits_of(shingle_hashes(text, shingle))


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The SimHash of a text column as a signed 64-bit integer."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return simhash(text)


def exact_masks(max_bits: int = MAX_BITS, keep: int = 2) -> list[int]:
    """Masks of which every pair within max_bits agrees on at least one: ``keep`` of ``max_bits + keep`` blocks."""
    n = max_bits + keep
    cuts = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(x) for x in itertools.combinations(blocks, keep)]


def sampled_masks(bits: int, tables: int, seed: int = 5) -> list[int]:
    """Masks of random bit positions, for radii at which whole blocks no longer agree."""
    rng = np.random.default_rng(seed)
    return [sum(1 << int(i) for i in rng.choice(64, bits, replace=False)) for _ in range(tables)]


def pivot_fingerprints(n: int = PIVOTS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * 2 + 1


def near_pairs(left: np.ndarray, right: np.ndarray | None, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and distances of pairs within max_bits, of one list or between two, found by pivot tables."""
    same = right is None
    right = left if same else right
    table_l = np.bitwise_count(left[:, None] ^ pivots[None, :]).astype(np.int8)
    table_r = table_l if same else np.bitwise_count(right[:, None] ^ pivots[None, :]).astype(np.int8)
    order = np.argsort(table_r[:, 0], kind="stable")
    first = table_r[order, 0]
    low = np.searchsorted(first, table_l[:, 0] - max_bits, "left")
    high = np.searchsorted(first, table_l[:, 0] + max_bits, "right")
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, PAIRS_AT_ONCE // max(1, len(right)))
    for at in range(0, len(left), step):
        lengths = (high - low)[at : at + step]
        i = np.repeat(np.arange(at, at + len(lengths)), lengths)
        if not len(i):
            continue
        begin = np.repeat(low[at : at + step] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        j = order[begin + np.arange(len(i))]
        if same:
            i, j = i[i < j], j[i < j]
        for p in range(1, len(pivots)):
            if not len(i):
                break
            fits = np.abs(table_l[i, p] - table_r[j, p]) <= max_bits
            i, j = i[fits], j[fits]
        apart = np.bitwise_count(left[i] ^ right[j])
        near = apart <= max_bits
        found.append((i[near], j[near], apart[near]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def _forest(n: int, i: np.ndarray, j: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Positions of pairs that connect as much as all pairs do, the closest first.

    At each distance every component that has a pair to a lower one takes the first such pair, until none is left;
    all components at a time, so a dense bucket costs a few passes over its pairs.
    """
    labels, kept = np.arange(n), []
    for level in np.unique(apart):
        open_ = np.flatnonzero(apart == level)
        while True:
            a, b = labels[i[open_]], labels[j[open_]]
            differ = a != b
            if not differ.any():
                break
            open_, a, b = open_[differ], a[differ], b[differ]
            high, first = np.unique(np.maximum(a, b), return_index=True)
            kept.append(open_[first])
            parent = np.arange(n)
            parent[high] = np.minimum(a, b)[first]
            while (parent[parent] != parent).any():
                parent = parent[parent]
            labels = parent[labels]
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _bucket_links(fp: np.ndarray, side: np.ndarray, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one bucket: among its rows (side 0), or between the blocks of sides 1 and 2."""
    if side.max() == 0:
        left = np.unique(fp)
        i, j, apart = near_pairs(left, None, max_bits, pivots)
        kept = _forest(len(left), i, j, apart)
        return left[i[kept]], left[j[kept]], apart[kept]
    left, right = np.unique(fp[side == 1]), np.unique(fp[side == 2])
    i, j, apart = near_pairs(left, right, max_bits, pivots)
    kept = _forest(len(left) + len(right), i, j + len(left), apart)
    return left[i[kept]], right[j[kept]], apart[kept]


def link_fingerprints(distinct: DataFrame, masks: list[int], max_bits: int = MAX_BITS, pivots: np.ndarray | None = None) -> DataFrame:
    """Links (a, b, apart) between distinct fingerprints (column ``fp``) that connect whatever all links connect."""
    spark = distinct.sparkSession
    pivots = pivot_fingerprints() if pivots is None else pivots
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keyed = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("mask", "bits"),
    ).select("fp", F.xxhash64("mask", "bits").alias("bucket"))
    shared = written(keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    large = shared.where(F.col("n") > BLOCK_ROWS).select("bucket", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    small = keyed.join(shared.where(F.col("n") <= BLOCK_ROWS).select("bucket"), "bucket", "left_semi").select("bucket", F.lit(0).alias("side"), "fp")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = keyed.join(large, "bucket").select("bucket", "blocks", "fp", block.alias("own"))
    dealt = placed.select("bucket", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    blocked = dealt.select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        "fp",
    )

    def links(batches):
        kept: pd.DataFrame | None = None
        for batch in itertools.chain(batches, [None]):
            rows = kept if batch is None else batch if kept is None else pd.concat([kept, batch])
            if rows is None or not len(rows):
                continue
            bucket = rows["bucket"].to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            if batch is None:
                kept, cuts = None, np.append(cuts, len(rows))
            else:
                kept = rows.iloc[cuts[-1] :]
            fp, side = rows["fp"].to_numpy().view(np.uint64), rows["side"].to_numpy()
            out = [_bucket_links(fp[a:b], side[a:b], max_bits, pivots) for a, b in itertools.pairwise(cuts.tolist()) if b - a > 1]
            out = [x for x in out if len(x[0])]
            if out:
                a, b, apart = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), "apart": apart.astype(np.int32)})

    dealt_out = small.unionByName(blocked).repartition(parallelism(spark), "bucket").sortWithinPartitions("bucket")
    return dealt_out.mapInPandas(links, "a long, b long, apart int").distinct()


def _classes(hashed: DataFrame, distinct: DataFrame, links: DataFrame, columns: list[str] | None = None) -> DataFrame:
    joined = components(links, distinct.where("least is not null"))
    linked = distinct.join(joined.withColumnRenamed("least", "low"), "fp", "left").select("fp", F.coalesce("low", "least").alias("component_id"))
    linked = written(linked, "classes")  # so that both sides of the next join are plain exchanges, whose hot keys Spark splits
    return hashed.join(linked, "fp").select("doc_id", *(columns or ["fp"]), "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of docs: doc_id, fp (signed), component_id, the smallest doc_id linked directly or through others.

    Links are all pairs of fingerprints within max_bits, exactly.
    """
    hashed = written(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "simhash")
    distinct = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    return _classes(hashed, distinct, link_fingerprints(distinct.select("fp"), exact_masks(max_bits), max_bits))


def signed_documents(text: Column, shingle: int) -> Column:
    """(fp, digest, size, u, v) of a text column in one pass: its SimHash, and what ``minhash_tensor`` makes of its set."""
    family = minhash_tensor.hash_family(SKETCHES)

    @F.pandas_udf("fp long, digest binary, size long, u array<long>, v array<int>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        fps, sets = np.zeros(len(texts), np.uint64), []
        for i, t in enumerate(texts):
            hashes = shingle_hashes(t, shingle)
            fps[i] = bits_of(hashes)
            sets.append(np.unique(hashes))
        return pd.DataFrame({"fp": fps.view(np.int64), **minhash_tensor.signatures(sets, family)})

    return sign(text)


def similar_documents(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Like near_duplicates, but links are pairs of documents whose shingle sets reach the similarity, verified on the full
    sets, and equal fingerprints.

    Pairs of fingerprints within MAX_BITS, found by pivot tables as in near_duplicates, come first and make one label of each
    group of close copies. Similar sets whose fingerprints lie further apart (at a similarity of 0.8 ten bits and more are
    common) are found by ``minhash_tensor``'s tables: each set against one leader, and then every pair of different labels
    that shares a key, once. A pair at 0.8 shares none with a probability below one in a million; all found are verified.
    """
    hashed = written(docs.select("doc_id", signed_documents(F.col("text"), shingle).alias("h")).select("doc_id", "h.*"), "simhash")
    grouped = hashed.groupBy("digest").agg(F.min("doc_id").alias("least"), F.min("fp").alias("fp"), *(F.first(c).alias(c) for c in ("size", "u", "v")))
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "sets")
    # Equal sets may have different fingerprints, as repeated shingles count in these: all of a set's fingerprints link.
    by_fp = written(hashed.select("fp", "digest").distinct().join(classes.select("digest", "node"), "digest").select("fp", "node"), "fingerprints")
    heads = written(by_fp.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    equal = by_fp.join(heads, "fp").where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    close = link_fingerprints(heads.select("fp"), exact_masks(), MAX_BITS).select(F.col("a").alias("fa"), F.col("b").alias("fb"))
    ends = [heads.select(F.col("fp").alias(f"f{x}"), F.col("head").alias(x)) for x in "ab"]
    near = written(close.join(ends[0], "fa").join(ends[1], "fb").where("a != b").select("a", "b").distinct(), "candidates")
    full = classes.where("size > 0")
    met = written(minhash_tensor.meetings(full), "meetings")
    nodes = met.select("node").union(near.select(F.explode(F.array("a", "b")))).distinct()
    sets = written(minhash_tensor.sets_of(nodes, classes, docs, shingle), "sets")
    verified = lambda pairs: minhash_tensor.verified(pairs, sets, percent)
    links = written(verified(near).union(equal), "similar")
    led = minhash_tensor.across_labels(minhash_tensor.leader_pairs(met, full), labels_of(links))
    links = written(links.union(verified(written(led, "leaders"))), "similar")
    rest = written(minhash_tensor.candidate_pairs(met, full, sets, labels_of(links), percent), "candidates")
    links = written(links.union(verified(written(minhash_tensor.popular_first(rest), "candidates"))), "similar")
    # A node of null ids only links like any other and takes the least id that it reaches.
    last = F.lit(2**63 - 1)
    joined = components(links, classes.select(F.col("node").alias("fp"), F.coalesce("least", last).alias("least"))).select(F.col("fp").alias("node"), F.col("least").alias("low"))
    known = written(classes.select("digest", "node", "least").join(joined, "node", "left").select("digest", F.coalesce("low", "least").alias("low")), "classes")
    return hashed.select("doc_id", "fp", "digest").join(known, "digest").select("doc_id", "fp", F.nullif("low", last).alias("component_id"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
