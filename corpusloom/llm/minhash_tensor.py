"""MinHash near-duplicates with tensored tables.

A document's set holds the 64-bit hashes of its distinct word shingles. Two collections of ``SKETCHES`` sketches, each
of ``WIDTH`` minhashes, are computed per set, and every pair of a sketch of the first and one of the second collection
is a table key: SKETCHES squared tables of 2 x WIDTH minhashes each for 2 x SKETCHES x WIDTH minhashes, about the square
root of what separate tables would compute. Two sets of similarity s share no key with a probability of at most
2 (1 - s^WIDTH)^SKETCHES, below one in a million at 0.85.

Equal sets are one node, so that exact copies, however many, cost one row. Table keys are not all written out: nodes
meet by sketches of the first collection, and those of the second are paired with them where at least two nodes meet.
Each node is first verified against one leader, the most popular node with a key in common, so that a large group of near
copies becomes one label at a linear cost. Then all pairs of nodes with a key in common and different labels are
enumerated, each once, at the first key that they share; pairs of equal labels are passed over without being visited, and
a meeting of many nodes is compared block by block in many tasks. There, common 32-bit hashes are counted by bit sets;
what fell together when hashes were cut is added, so the count is never below the true one, and a pair too far apart by it
goes no further. All other pairs are verified on the full sets of 64-bit hashes.

Edge cases: null, empty and wordless texts have empty sets and are linked with nothing, not with each other; fewer words
than a shingle are one shingle; null ids order after all others, and rows that have one take the least id they reach;
repeated rows share a component; an empty table gives an empty result; further columns take no part.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parallelism, written
from .graph import components, labels_of

SHINGLE, PERCENT = 3, 85
#: Sketches of a collection, and minhashes of a sketch.
SKETCHES, WIDTH = 20, 4
#: Most rows of a meeting that are compared in one piece, and pairs that a task holds at a time.
BLOCK_ROWS, PAIRS_AT_ONCE = 2048, 30_000
#: Texts whose sets a task holds at a time.
TEXTS_AT_ONCE = 500
#: Bytes of bit sets that are compared at a time.
BITS_AT_ONCE = 4_000_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of a text's word shingles, repeats included; of fewer words than a shingle that of all of them."""
    data = b" ".join(_WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)))
    if not data:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32).tolist()
    starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(data)]
    if len(starts) <= shingle:
        return np.array([xxhash.xxh64_intdigest(data, 42)], np.uint64)
    digest = xxhash.xxh64_intdigest
    grams = (digest(data[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :], strict=False))
    return np.fromiter(grams, np.uint64, len(starts) - shingle + 1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles."""
    return np.unique(shingle_hashes(text, shingle))


def hash_family(sketches: int = SKETCHES, seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    n = 2 * sketches * WIDTH
    return rng.integers(0, 2**64, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * 2 + 1


def minhashes(s: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    least = np.full(len(family[0]), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 512):
        np.minimum(least, ((s[at : at + 512, None] ^ family[0]) * family[1]).min(0), out=least)
    return least


def sketches(least: np.ndarray) -> np.ndarray:
    """One 64-bit value for each WIDTH minhashes; rows are sets."""
    parts = least.reshape(len(least), -1, WIDTH)
    mixed = np.zeros(parts.shape[:2], np.uint64)
    for i in range(WIDTH):
        mixed = (mixed ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def signatures(sets: list[np.ndarray], family: tuple[np.ndarray, np.ndarray]) -> dict[str, list]:
    """digest, size, u and v of sets: 128 bits that tell sets apart, sizes, and the two collections of sketches."""
    least = np.zeros((len(sets), len(family[0])), np.uint64)
    for i, s in enumerate(sets):
        if len(s):
            least[i] = minhashes(s, family)
    both = sketches(least).view(np.int64)
    half = both.shape[1] // 2
    return {"digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "size": [len(s) for s in sets], "u": list(both[:, :half]), "v": list((both[:, half:] >> 32).astype(np.int32))}


def sketched(text: Column, shingle: int = SHINGLE) -> Column:
    """(digest, size, u, v) of a text column's sets."""
    family = hash_family()

    @F.pandas_udf("digest binary, size long, u array<long>, v array<int>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(signatures([shingle_set(t, shingle) for t in texts], family))

    return sketch(text)


def sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, s, w): the sets of some nodes, made from the texts again, as sorted 64-bit hashes and as 32-bit ones.

    A map over batches, unlike a function in a select, stays behind the semi-join, so that only their texts are cut up.
    """
    known = classes.join(nodes, "node", "left_semi").select("node", "digest", "least")

    def sets(batches):
        for text in (batch["text"].iloc[k : k + TEXTS_AT_ONCE] for batch in batches for k in range(0, len(batch), TEXTS_AT_ONCE)):
            every = [shingle_set(t, shingle) for t in text]
            short = [np.unique((s >> np.uint64(32)).astype(np.uint32)).view(np.int32) for s in every]
            yield pd.DataFrame({"digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in every], "s": [s.view(np.int64) for s in every], "w": short})

    texts = docs.select("doc_id", "text").join(known.select("least"), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    made = texts.select("text").mapInPandas(sets, "digest binary, s array<long>, w array<int>").join(known.select("digest", "node"), "digest")
    return made.select("node", "s", "w").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes with 100 x common >= percent x all shingles, counted on the full sets.

    The set that moves with a pair is that of the end with fewer pairs (the caller's b); the other end's meets it where its
    pairs are.
    """
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b").join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def meetings(classes: DataFrame) -> DataFrame:
    """(bucket, node): nodes by equal sketches of the first collection, where at least two nodes meet."""
    keyed = classes.select("node", F.posexplode("u").alias("i", "u")).select("node", "i", F.xxhash64("i", "u").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(shared, "bucket")


def leader_pairs(met: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): each node b with the most popular node a that has a table key in common with it, of equal ones the greater.

    A node's popularity is how many nodes it meets, over all meetings: in a group of versions the one that most are near to.
    """
    popular = met.groupBy("node").agg(F.sum("n").alias("popularity"))
    keys = met.select("node", "bucket").join(classes.select("node", "v"), "node").join(popular, "node").select("node", "popularity", "bucket", F.posexplode("v").alias("j", "v"))
    keys = written(keys.select("node", "popularity", F.xxhash64("bucket", "j", "v").alias("key")), "keys")
    best = keys.groupBy("key").agg(F.max(F.struct("popularity", "node")).alias("best"), F.count("*").alias("n")).where("n > 1")
    led = keys.select("node", "key").join(best.select("key", "best"), "key").groupBy(F.col("node").alias("b")).agg(F.max("best")["node"].alias("a"))
    return led.where("a != b").select("a", "b")


def across_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose labels differ; a node without a label is its own."""
    named = pairs
    for x in "ab":
        named = named.join(labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")), x, "left")
    return named.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def in_common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many values the sets at places x and y have in common, pair by pair, by bit sets over values of several sets."""
    used, place = np.unique(np.concatenate((x, y)), return_inverse=True)
    held = [sets[k] for k in used.tolist()]
    sizes = np.array([len(h) for h in held], np.int64)
    _, column, count = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    width = int(shared[-1]) + 1
    bits = np.zeros((len(held), max(1, -(-width // 64)) * 8), np.uint8)
    keep = count[column] > 1
    row, at = np.repeat(np.arange(len(held)), sizes)[keep], shared[column[keep]]
    np.bitwise_or.at(bits, (row, at >> 3), np.left_shift(1, at & 7).astype(np.uint8))
    words = bits.view(np.uint64)
    out, step = np.empty(len(x), np.int64), max(1, BITS_AT_ONCE // (8 * words.shape[1]))
    left, right = place[: len(x)], place[len(x) :]
    for k in range(0, len(x), step):
        out[k : k + step] = np.bitwise_count(words[left[k : k + step]] & words[right[k : k + step]]).sum(1, dtype=np.int64)
    return out


def cross_pairs(rows: pd.DataFrame, percent: int):
    """Frames (a, b) of pairs of one batch of whole meetings: a second sketch in common, other labels, sizes and common 32-bit
    hashes that allow the similarity, and this meeting and this second sketch the first that both nodes have in common.

    Sides: rows of side 0 pair with each other, those of 1 and 2 between the sides.
    """
    bucket, label, side, size, node, i = (rows[c].to_numpy() for c in ("bucket", "label", "side", "size", "node", "i"))
    u, v, sets = np.stack(rows["u"].to_numpy()), np.stack(rows["v"].to_numpy()), rows["w"].tolist()
    merged = size - np.array([len(w) for w in sets])  # hashes that fell together when cut to 32 bits
    label_rank = np.unique(label, return_inverse=True)[1].astype(np.int64)
    width = int(label_rank.max()) + 1
    bucket_rank = np.unique(bucket, return_inverse=True)[1].astype(np.int64)
    for j in range(v.shape[1]):
        second = np.unique(v[:, j], return_inverse=True)[1].astype(np.int64)
        group = np.unique(bucket_rank * (int(second.max()) + 1) + second, return_inverse=True)[1].astype(np.int64)
        place = (group * 3 + side) * width + label_rank
        order = np.argsort(place, kind="stable")
        placed = place[order]
        many = np.flatnonzero(side[order] < 2)
        other = group[order][many] * 3 + np.where(side[order][many] == 1, 2, 0)
        same = other * width + label_rank[order][many]
        begin, end = np.searchsorted(placed, other * width, "left"), np.searchsorted(placed, (other + 1) * width, "left")
        low, high = np.searchsorted(placed, same, "left"), np.searchsorted(placed, same, "right")
        begin = np.where(side[order][many] == 0, low, begin)  # within one side each pair is met from its lower label only
        before, after = low - begin, end - high
        held = np.cumsum(before + after)
        cut = 0
        while cut < len(many):
            stop = max(cut + 1, int(np.searchsorted(held, (held[cut - 1] if cut else 0) + PAIRS_AT_ONCE, "right")))
            n = (before + after)[cut:stop]
            if n.sum():
                p = np.repeat(np.arange(cut, stop), n)
                step = np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
                q = np.where(step < before[p], begin[p] + step, high[p] + step - before[p])
                x, y = order[many[p]], order[q]
                fits = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
                x, y = x[fits], y[fits]
                first = ~((u[x] == u[y]) & (np.arange(u.shape[1]) < i[x][:, None])).any(1) & ~(v[x, :j] == v[y, :j]).any(1)
                x, y = x[first], y[first]
                if len(x):
                    common = in_common(sets, x, y) + np.minimum(merged[x], merged[y])
                    near = 100 * common >= percent * (size[x] + size[y] - common)
                    x, y = x[near], y[near]
                if len(x):
                    yield pd.DataFrame({"a": node[x], "b": node[y]})
            cut = stop


def candidate_pairs(met: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of nodes of different labels with a table key in common that may reach the similarity."""
    named = met.join(labels, "node", "left").select("node", "bucket", "i", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    mixed = written(mixed.select("bucket", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "mixed")
    left = named.join(mixed, "bucket").join(classes.select("node", "size", "u", "v"), "node").join(sets.select("node", "w"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = left.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = spread.select(
        F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("bucket"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "node", "label", "size", "i", "u", "v", "w",
    )

    def pairs(batches):
        kept: pd.DataFrame | None = None
        for batch in itertools.chain(batches, [None]):
            part = kept if batch is None else batch if kept is None else pd.concat([kept, batch])
            if part is None or not len(part):
                continue
            bucket = part["bucket"].to_numpy()
            end = len(bucket) if batch is None else int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1 if bucket[0] != bucket[-1] else 0
            kept, part = (None if batch is None else part.iloc[end:]), part.iloc[:end]
            if len(part):
                yield from cross_pairs(part, percent)

    sorted_ = dealt.repartition(parallelism(dealt.sparkSession), "bucket").sortWithinPartitions("bucket")
    return sorted_.mapInPandas(pairs, "a long, b long")


def popular_first(pairs: DataFrame) -> DataFrame:
    """The pairs with the end that has more of them as a."""
    counted = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    both = pairs.join(counted.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(counted.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    swap = F.col("na") < F.col("nb")
    return both.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id and kept.

    Links join documents whose sets have 100 x common >= percent x all shingles; a component is all that links reach, named
    by its least id, which is kept.
    """
    hashed = written(docs.select("doc_id", sketched(F.col("text"), shingle).alias("h")).select("doc_id", "h.*"), "minhash")
    last = F.lit(2**63 - 1)
    grouped = hashed.where("size > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("size", "u", "v")))
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "sets_of_documents")
    met = written(meetings(classes), "meetings")
    sets = written(sets_of(met.select("node").distinct(), classes, docs, shingle), "sets")
    led = written(leader_pairs(met, classes), "leaders")
    first = written(verified(led, sets, percent), "near")
    rest = written(popular_first(written(candidate_pairs(met, classes, sets, labels_of(first), percent), "candidates")), "candidates")
    links = written(first.union(verified(rest, sets, percent)), "near")
    joined = components(links, classes.select(F.col("node").alias("fp"), F.coalesce("least", last).alias("least"))).select(F.col("fp").alias("node"), F.col("least").alias("low"))
    known = written(classes.select("digest", "node", "least").join(joined, "node", "left").select("digest", F.coalesce("low", "least").alias("low")), "classes")
    told = hashed.where("size > 0").select("doc_id", "size", "digest").join(known, "digest").select("doc_id", "size", F.nullif("low", last).alias("component_id"))
    told = told.unionByName(hashed.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id")))
    return told.select("doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
