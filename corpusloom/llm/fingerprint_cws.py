"""Document fingerprints by consistent weighted sampling.

A document is a bag of words weighted by their counts. For each of ``SAMPLES`` samples every word draws gamma
variates r and c of shape two and a uniform b that depend on the word and the sample alone; with weight w it yields
t = floor(ln w / r + b) and the value c * exp(r * b - r * t - r), and the word of the least value with its t is
the sample. Two documents agree on a sample with a probability equal to their generalised Jaccard similarity.

The three variates are drawn by way of three exponential ones, f, g and e: c = f + g, r = ln(1 + g / f) + e and
b = e / r have the distributions asked for and are independent. The value of a word that comes once is then f
alone, so such words, which are most, cost one hash a sample and no logarithm. Everything comes from a word's
64-bit hash and the sample's number: no table of variates, and no ceiling on distinct words.

Edge cases: a null text is empty; wordless texts share a fingerprint of their own; rows are taken in ascending
doc_id, nulls first, equal ids by text; a table of one row is its own next document; an empty table gives none.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism, written

SAMPLES, SEED = 128, 29
#: Words taken at a time.
BLOCK = 256
_STEPS = np.arange(1, 3 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def hashes(words: np.ndarray, lane: int) -> np.ndarray:
    """One 64-bit hash for every word (by its own hash) and sample; lanes 0 to 2 are independent."""
    x = words[:, None] + _STEPS[None, lane * SAMPLES : (lane + 1) * SAMPLES]
    y = np.empty_like(x)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        np.right_shift(x, np.uint64(shift), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint64(factor), out=x)
    return x


def exponential(hashed: np.ndarray) -> np.ndarray:
    """Exponential variates from the upper 48 bits of hashes; the lower 16 bits are free for a sample's code."""
    return -np.log(((hashed >> np.uint64(16)).astype(np.float64) + 0.5) * 2.0**-48)


def variates(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """r, b and the logarithm of the value at t = 0, by word and sample; ``first`` are the words' hashes of lane 0."""
    f, g, e = exponential(first), exponential(hashes(words, 1)), exponential(hashes(words, 2))
    r = np.log1p(g / f) + e
    return r, e / r, np.log(f + g) + e - r


class Known:
    """Variates of words that come several times in a text: those of the first KEPT are kept, others drawn anew."""

    KEPT = 8192

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.table = np.empty((self.KEPT, 4, SAMPLES), np.float32)

    def __call__(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """1 / r, b, r and the logarithm of the value at t = 0, by word and sample."""
        at = np.fromiter((self.rows.get(w, -1) for w in words.tolist()), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        out = self.table[at]
        if len(new):
            r, b, start = variates(words[new], first[new])
            out[new] = fresh = np.stack((1 / r, b, r, start), 1).astype(np.float32)
            kept, begin = min(len(new), self.KEPT - len(self.rows)), len(self.rows)
            self.table[begin : begin + kept] = fresh[:kept]
            self.rows |= zip(words[new[:kept]].tolist(), range(begin, begin + kept), strict=True)
        return out


@functools.lru_cache(maxsize=1)
def _known() -> Known:
    return Known()


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # of bytes, at ASCII white space alone


def signatures(left: str, right: str, alike: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The samples of two texts as 16-bit codes of (word, t).

    What the texts have in common is drawn once; their first ``alike`` characters, which are equal, are read once.
    """
    alike = max((left.rfind(c, 0, alike) for c in " \n\t"), default=-1) + 1
    shared = Counter(_words(left[:alike]))
    counts = [shared.copy(), shared]
    for count, text in zip(counts, (left, right), strict=True):
        count.update(_words(text[alike:]))
    words = list(counts[0].keys() | counts[1].keys())
    hashed = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], np.uint64)
    weights = np.stack([np.fromiter(map(c.get, words, itertools.repeat(0)), np.int64, len(words)) for c in counts])
    once = weights == 1
    # Words that come once in both texts, in the left or in the right one alone, and several times in one.
    group = np.where((weights > 1).any(0), 3, np.where(once.all(0), 0, np.where(once[0], 1, 2)))
    # The least f is the greatest uniform, and so the greatest hash; its lower bits are the code.
    top = np.zeros((2, SAMPLES), np.uint64)
    for kind, sides in ((0, (0, 1)), (1, (0,)), (2, (1,))):
        of_kind = hashed[group == kind]
        for at in range(0, len(of_kind), BLOCK):
            most = hashes(of_kind[at : at + BLOCK], 0).max(0)
            for side in sides:
                np.maximum(top[side], most, out=top[side])
    best, code, pick = np.full((2, SAMPLES), np.inf), np.zeros((2, SAMPLES), np.uint64), np.arange(SAMPLES)
    several = np.flatnonzero(group == 3)
    for at in range(0, len(several), BLOCK):
        some = several[at : at + BLOCK]
        first = hashes(hashed[some], 0)
        inverse, b, r, start = _known()(hashed[some], first).transpose(1, 0, 2)
        with np.errstate(divide="ignore"):
            logs = np.log(weights[:, some].astype(np.float32))  # a word that a text lacks has an endless value
        for side, log in enumerate(logs):
            t = np.floor(log[:, None] * inverse + b)
            values = start - r * t
            least = values.argmin(0)
            value, chosen = values[least, pick], first[least, pick]
            step = np.where(np.isfinite(value), t[least, pick], 0).astype(np.uint64)
            named = np.where(step == 0, chosen & np.uint64(0xFFFF), ((chosen ^ step) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48))
            better = value < best[side]
            best[side, better], code[side, better] = value[better], named[better]
    by_once = (top > 0) & (np.log(exponential(top)) < best)
    found = np.where(by_once, top & np.uint64(0xFFFF), code).astype(np.uint16)
    return found[0], found[1]


def signature(text: str) -> np.ndarray:
    return signatures(text, "")[0]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _bytes(sig: np.ndarray) -> bytes:
    return sig.astype(">u2").tobytes()


def edited(text: str, following: str) -> str:
    """The text with the last quarter of its code points replaced by as many of the following text's first."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _begun(doc, text: str, following: str) -> tuple[list, np.ndarray]:
    """A row but for its likeness to the following text, and the text's signature."""
    changed = edited(text, following)
    sig, other = signatures(text, changed, len(text) - len(text) // 4) if changed != text else [signature(text)] * 2
    return [doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), _bytes(sig), _bytes(other), likeness(sig, other)], sig


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likeness to it and to the next document.

    Rows are range-partitioned by doc_id and, for ids that many rows share, by how the text begins, so all
    neighbours but those across a partition border meet in one task. For each border the last row of one partition is joined with the first of the next non-empty one.
    """
    spark = docs.sparkSession
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = light.repartitionByRange(parallelism(spark), F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 64)).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ranged = ranged.withColumn("part", F.spark_partition_id())
    columns = [c.split()[0] for c in _RESULT.split(", ")]

    def walk(batches):
        last, begun, first, part = None, None, None, 0
        for batch in batches:
            rows = []
            for doc, text, part in zip(batch["doc_id"], batch["text"], batch["part"], strict=True):
                if last is None:
                    first = text
                else:
                    now = _begun(*last, text)
                    if begun is not None:
                        rows.append((*begun[0], likeness(begun[1], now[1]), part, None, None))
                    begun = now
                last = (doc, text)
            if rows:
                yield _frame(rows, [*columns, "part", "head", "tail"])
        if last is not None:
            rows = [] if begun is None else [(*begun[0], likeness(begun[1], signature(last[1])), part, None, None)]
            rows.append((last[0], len(last[1]), None, None, None, None, None, part, first, last[1]))
            yield _frame(rows, [*columns, "part", "head", "tail"])

    walked = written(ranged.mapInPandas(walk, f"{_RESULT}, part int, head string, tail string"), "fingerprints")
    ends = walked.where("tail is not null")
    parts = sorted(r["part"] for r in ends.select("part").collect())
    if not parts:
        return _readable(walked.select(*columns))
    order = spark.createDataFrame([(a, b) for a, b in itertools.pairwise([*parts, parts[0]])], "part int, after int")
    heads = ends.select(F.col("part").alias("after"), F.col("head").alias("following"))
    borders = ends.select("doc_id", "part", "tail").join(order, "part").join(heads, "after").select("doc_id", "tail", "following")

    def close(batches):
        for batch in batches:
            rows = []
            for doc, text, following in zip(batch["doc_id"], batch["tail"], batch["following"], strict=True):
                row, sig = _begun(doc, text, following)
                rows.append((*row, likeness(sig, signature(following))))
            yield _frame(rows, columns)

    return _readable(walked.where("tail is null").select(*columns).unionByName(borders.mapInPandas(close, _RESULT)))


def _readable(rows: DataFrame) -> DataFrame:
    """Fingerprints as lower-case hex, which the table between keeps as bytes."""
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    return out.assign(doc_id=pd.array([None if pd.isna(x) else int(x) for x in out["doc_id"]], "Int64"))
