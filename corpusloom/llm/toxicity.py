"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicons (insults, profanity, threats, and words or word beginnings that
labelled rows show to be toxic), closeness of lexicon words to the second person, capitals, punctuation and
obfuscation rates. The trees and the calibration are pyspark.ml models, fitted on a bounded sample: at most
``PER_CLASS`` labelled rows of each class, by hash; of each class every fourth row calibrates, the others fit
lexicon and trees.

Edge cases: null and empty texts have zero features and are scored like any other; rows without a label, with a
null label or a null id are scored and never learned from; several labels of one id count as toxic if any is;
without labels of both classes every score is 0, and with fewer than four of one class the trees' own
probability stands uncalibrated; of several documents of one id the first text in order is learned from.
"""

from __future__ import annotations

import functools
import itertools
import math
import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import crc_mod, written

PER_CLASS = 5000
LEXICON_WORDS = 400
THRESHOLD = 0.7
#: Lexicons and pronouns (fixed values).
LEXICONS = {
    "insult": "idiot idiots moron morons stupid dumb loser losers clown clowns scum trash pathetic disgusting worthless fool fools imbecile garbage filth filthy vermin parasite creep coward freak retard retarded ugly imbecil idiota estupido estúpido basura asqueroso payaso idiote imbécile ordure dégoûtant crétin stupide dummkopf abschaum widerlich trottel blödmann",
    "profanity": "damn crap shit shitty bullshit fuck fucking fucker bastard bitch asshole arschloch scheisse scheiße merde putain connard mierda puta cabrón",
    "threat": "kill hurt destroy punch stab shoot murder hang töten sterben tuer mourir matar morir",
}
SECOND_PERSON = "you your yours yourself yourselves u ur du dich dir dein deine euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
_PUNCTUATION = ".,;:!?\"'()[]{}<>«»„“”‚‘’…-–—*#%&$"
_LEET = str.maketrans("@013457$!", "aoieastsi")
_TRIPLE = re.compile(r"(.)\1\1")
WIDTH = 21


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """For each code point: 1 capital, 2 other letter, 3 exclamation mark, 4 question mark, 5 other mark, 6 blank, or 0."""
    out = np.zeros(0x110000, np.uint8)
    for i in itertools.chain(range(0xD800), range(0xE000, 0x32000)):
        c = chr(i)
        out[i] = 1 if c.isupper() else 2 if c.isalpha() else 6 if c.isspace() else 0
    for c in _PUNCTUATION:
        out[ord(c)] = {"!": 3, "?": 4}.get(c, 5)
    return out


class TokenKinds(dict):
    """Maps a token to the number of its kind: a row of (insult, profanity, threat, learned weight, second person,
    capitals, masked, obfuscated, stretched). There are few kinds; known tokens are cleared when they are CACHE."""

    CACHE = 100_000

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned
        self.words = {w: k for k, words in enumerate(LEXICONS.values()) for w in words.split()}
        self.second = set(SECOND_PERSON.split())
        self.prefixes = sorted({len(w) - 1 for w in learned if w.endswith("*")})
        self.numbers: dict[tuple, int] = {}
        self.table = np.zeros((0, 9))

    def _weight(self, low: str) -> float:
        found = self.learned.get(low, 0.0)
        for n in self.prefixes:
            if len(low) >= n:
                found = max(found, self.learned.get(low[:n] + "*", 0.0))
        return found

    def __missing__(self, token: str) -> int:
        word = token.strip(_PUNCTUATION)
        low = word.lower()
        plain, masked, obfuscated = low, 0, 0
        if not low.isalpha() and any(c.isalpha() for c in low):
            bare = "".join(c for c in low.translate(_LEET) if c.isalpha())
            masked = int("*" in low or "#" in low)
            obfuscated = int(any(c in "@$!0134578" for c in low) or len(bare) * 2 < len(low) + 1)
            plain = bare if bare in self.words else low
        group = self.words.get(plain, -1)
        kind = (
            int(group == 0), int(group == 1), int(group == 2), self._weight(low), int(low in self.second), int(len(word) > 1 and word.isupper()), masked, obfuscated,
            int(_TRIPLE.search(low) is not None),
        )
        number = self.numbers.get(kind)
        if number is None:
            number = self.numbers[kind] = len(self.numbers)
            self.table = np.vstack((self.table, kind))
        self[token] = number
        return number


def text_features(text: str | None, tokens: TokenKinds) -> np.ndarray:
    """The dense feature vector of one text."""
    out = np.zeros(WIDTH)
    words = (text or "").split()
    if not words:
        return out
    kinds = np.fromiter(map(tokens.__getitem__, words), np.int64, len(words))
    table, n = tokens.table, len(words)
    counts = np.bincount(kinds, minlength=len(table))
    sums = counts @ table
    marks = np.zeros(7, np.int64)
    for at in range(0, len(text), 1 << 20):
        marks += np.bincount(_classes()[np.frombuffer(text[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=7)
    learned = table[:, 3] > 0
    words_learned = counts @ learned
    chars = max(1, len(text) - marks[6])
    out[:4], out[4] = sums[:4] / n, words_learned / n
    out[5], out[6], out[10:13] = sums[4] / n, sums[5] / n, sums[6:9] / n
    out[7], out[8], out[9] = marks[3] / n, marks[4] / n, marks[3:6].sum() / chars
    out[13], out[14], out[15] = marks[1] / max(1, marks[1] + marks[2]), chars / n, math.log1p(n)
    out[16], out[17] = math.log1p(sums[:3].sum()), math.log1p(words_learned)
    out[18] = table[counts > 0, 3].max()
    of_lexicon = learned | (table[:, :3].sum(1) > 0)
    if sums[4] and (counts @ of_lexicon):
        at, to = np.flatnonzero(of_lexicon[kinds]), np.flatnonzero(table[kinds, 4] > 0)
        k = np.searchsorted(to, at)
        gap = np.minimum(np.abs(at - to[np.clip(k, 0, len(to) - 1)]), np.abs(at - to[np.clip(k - 1, 0, len(to) - 1)]))
        out[19], out[20] = 1 / (1 + gap.min()), (1 / (1 + gap)).mean()
    return out


@functools.lru_cache(maxsize=1)
def _tokens(learned: tuple[tuple[str, float], ...]) -> TokenKinds:
    return TokenKinds(dict(learned))


def _features(learned: dict[str, float]):
    known = tuple(sorted(learned.items()))

    @F.pandas_udf("array<double>")
    def vectors(texts: pd.Series) -> pd.Series:
        tokens, rows = _tokens(known), []
        for text in texts:
            if len(tokens) > tokens.CACHE:  # asked before every text, as a batch may hold far more new tokens
                tokens.clear()
            rows.append(text_features(text, tokens))
        return pd.Series(rows)

    return vectors


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words, and word beginnings of 4 to 6 letters (ending in *), with their log-odds of toxic over other rows."""
    n = {int(r["label"]): r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    least = max(4, math.ceil(0.004 * toxic))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}{3,}"), 0))
    begins = lambda k: F.transform(F.filter(words, lambda w: F.length(w) >= k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))
    terms = sample.select("label", F.explode(F.array_distinct(F.concat(words, begins(4), begins(5), begins(6)))).alias("term"))
    counted = terms.groupBy("term").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (toxic + 1.0)) - F.log((F.col("neg") + 0.5) / (clean + 1.0))
    kept = counted.where((F.col("pos") >= least) & (odds >= 2.5)).select("term", odds.alias("odds"), "pos")
    rows = kept.orderBy(F.col("pos").desc(), "term").limit(LEXICON_WORDS).collect()
    return {r["term"]: float(r["odds"]) for r in rows}


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, per_class: int = PER_CLASS) -> DataFrame:
    """(text, label, calibrates) of at most per_class labelled rows of a class outside the fold, drawn by hash."""
    learn = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod("doc_id", folds) != fold))
    label = learn.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    n = {r["label"]: r["n"] for r in label.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limit = F.when(F.col("label") == 1, F.lit(int(min(1.0, per_class / max(1, n.get(1, 0))) * (1 << 30)))).otherwise(F.lit(int(min(1.0, per_class / max(1, n.get(0, 0))) * (1 << 30))))
    by_hash = W.partitionBy("label").orderBy(draw, "doc_id")  # over at most about per_class rows each
    picked = label.where(draw <= limit).select(F.col("doc_id").alias("__id"), "label", (F.row_number().over(by_hash) % 4 == 0).alias("calibrates"))
    few = F.broadcast(picked)  # at most about 2 x per_class rows, whatever the input
    found = docs.select(F.col("doc_id").alias("__id"), "text").join(few, "__id")
    return found.groupBy("__id", "label", "calibrates").agg(F.min("text").alias("text")).select("text", "label", "calibrates")


class Model:
    def __init__(self, docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1):
        sample = written(labelled_sample(docs, labels, folds, fold), "labelled")
        self.trees = self.calibration = None
        self.learned: dict[str, float] = {}
        kinds = {r["label"] for r in sample.where("not calibrates").select("label").distinct().collect()}
        if kinds != {0, 1}:
            return
        self.learned = learn_lexicon(sample.where("not calibrates"))
        named = sample.select(array_to_vector(_features(self.learned)(F.col("text"))).alias("__tox_features"), F.col("label").cast("double").alias("__tox_label"), "calibrates")
        ready = written(named, "toxicity")
        fit = ready.where("not calibrates").coalesce(4).cache()
        trees = GBTClassifier(
            featuresCol="__tox_features", labelCol="__tox_label", predictionCol="__tox_tree",
            maxIter=20, maxDepth=4, stepSize=0.2, seed=17, maxBins=32, minInstancesPerNode=2,
        ).setRawPredictionCol("__tox_raw").setProbabilityCol("__tox_probability")
        self.trees = trees.fit(fit)
        fit.unpersist()
        judged = self.trees.transform(ready.where("calibrates"))
        if judged.select("__tox_label").distinct().count() == 2:
            iso = IsotonicRegression(featuresCol="__tox_probability", featureIndex=1, labelCol="__tox_label", predictionCol="__tox_score")
            self.calibration = iso.fit(judged.select("__tox_probability", "__tox_label"))

    def score(self, docs: DataFrame) -> DataFrame:
        """docs with a column __tox_score."""
        if self.trees is None:
            return docs.withColumn("__tox_score", F.lit(0.0))
        vectors = docs.withColumn("__tox_features", array_to_vector(_features(self.learned)(F.col("text"))))
        judged = self.trees.transform(vectors)
        raw = F.element_at(vector_to_array(F.col("__tox_probability")), 2)
        if self.calibration is None:
            return judged.withColumn("__tox_score", raw).select(*docs.columns, "__tox_score")
        fitted = self.calibration.transform(judged).withColumn("__tox_score", F.least(F.greatest("__tox_score", F.lit(0.0)), F.lit(1.0)))
        return fitted.select(*docs.columns, "__tox_score")


def judge(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    scored = Model(docs, labels, folds, fold).score(docs.select("doc_id", "text"))
    held = F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), F.col("__tox_score").alias("score"), (F.col("__tox_score") >= threshold).cast("int").alias("predicted"))
