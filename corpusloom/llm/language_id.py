"""Hierarchical language identification: the family first, then one-versus-one linear SVMs within it.

Texts become hashed counts of letter n-grams (1 to 3, with word edges), square-rooted and scaled to length one.
One linear SVM per family decides the family; inside it every pair of languages has its own linear SVM, and the
language with the most wins, then the largest sum of margins, is predicted. The SVMs are fitted by dual
coordinate descent on a bounded sample: at most ``PER_LANGUAGE`` rows of a language and ``SAMPLE_ROWS`` in all,
taken by hash. Prediction reads every text whole.

Edge cases: a text that is null or has no letter is ``und`` with score 0; without any labelled row every text is
``und``; with one language everything else is that language; null ids are never held out and never learned from.
"""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod

BUCKETS = 4096
PER_LANGUAGE, SAMPLE_ROWS = 600, 6000
#: Language families by code (fixed values); a code not listed belongs to the family "other".
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "hellenic": "el",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "semitic": "ar he mt am",
    "indo-aryan": "hi bn ur mr gu pa ne si",
    "iranian": "fa ku ps tg",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue",
    "japonic": "ja",
    "koreanic": "ko",
    "austronesian": "id ms tl jv mg",
    "austroasiatic": "vi km",
    "tai": "th lo",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], "other")


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for i in itertools.chain(range(0xD800), range(0xE000, 0x32000)):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def features(text: str | None) -> np.ndarray | None:
    """The text's n-gram vector, or None if it has no letter."""
    counts = np.zeros(BUCKETS, np.int64)
    seen, last = False, np.array([32], np.uint32)
    for at in range(0, len(text or ""), 1 << 20):
        codes = _letters()[np.frombuffer(text[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)]
        c = np.concatenate((last, codes, [np.uint32(32)] if at + (1 << 20) >= len(text) else []), dtype=np.uint32)
        blank = c == 32
        seen = seen or not blank.all()
        keep = np.ones(len(c), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        c = c[keep].astype(np.uint64)
        two = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        three = two[:-1] * np.uint64(0x165667B19E3779F9) + c[2:] * np.uint64(0x27D4EB2F165667C5)
        one = c * np.uint64(0xD6E8FEB86659FD93)
        for h in (one, two, three):
            counts += np.bincount((h >> np.uint64(52)).astype(np.int64), minlength=BUCKETS)
        last = c[-2:].astype(np.uint32)
    if not seen:
        return None
    v = np.sqrt(counts).astype(np.float32)
    return v / np.linalg.norm(v)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Weights with a last one for the bias: L1-loss linear SVM by dual coordinate descent; y is 1 or -1."""
    x = np.hstack((x, np.ones((len(x), 1), x.dtype)))
    w, alpha, norm = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1)
    rng = np.random.default_rng(seed)
    share = np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum())) * c
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            was = alpha[i]
            alpha[i] = min(max(was - (y[i] * (w @ x[i]) - 1) / norm[i], 0.0), share[i])
            if alpha[i] != was:
                w += (alpha[i] - was) * y[i] * x[i]
    return w


@dataclass
class Model:
    families: list[str]
    languages: dict[str, list[str]]
    family_weights: np.ndarray
    pair_weights: dict[str, tuple[list[tuple[int, int]], np.ndarray]]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores of feature rows."""
        x = np.hstack((x, np.ones((len(x), 1), x.dtype)))
        margins = x @ self.family_weights.T
        family = margins.argmax(1) if len(self.families) > 1 else np.zeros(len(x), np.int64)
        ordered = np.sort(margins, 1)
        sure = _sigmoid(2 * (ordered[:, -1] - ordered[:, -2])) if len(self.families) > 1 else np.ones(len(x))
        out = np.empty(len(x), object)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            langs = self.languages[name]
            if len(langs) == 1:
                out[rows] = langs[0]
                continue
            pairs, weights = self.pair_weights[name]
            m = x[rows] @ weights.T
            wins, total = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
            for k, (a, b) in enumerate(pairs):
                wins[:, a] += m[:, k] >= 0
                wins[:, b] += m[:, k] < 0
                total[:, a] += m[:, k]
                total[:, b] -= m[:, k]
            best = (wins + 1e-3 * np.tanh(total)).argmax(1)
            out[rows] = [langs[i] for i in best]
            sure[rows] *= _sigmoid(4 * total[np.arange(len(rows)), best] / (len(langs) - 1))
        return out.tolist(), np.clip(sure, 0.0, 1.0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sampled(labelled: DataFrame, per_language: int, most: int) -> pd.DataFrame:
    """At most per_language rows of each language, and ``most`` in all, in the order of a hash of id and text."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return pd.DataFrame({"lang": [], "v": []})
    bound = max(2, min(per_language, most // len(counts)))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    limit = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(min(1.0, 1.25 * bound / n + 30 / n) * (1 << 30))))])
    picked = labelled.withColumn("draw", draw).where(F.col("draw") < F.element_at(limit, F.col("lang")))

    def vectors(batches):
        for batch in batches:
            v = [features(t) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "draw": batch["draw"], "v": [None if x is None else x.astype(np.float16).tobytes() for x in v]})

    rows = picked.select("lang", "draw", "text").mapInPandas(vectors, "lang string, draw long, v binary").where("v is not null").toPandas()
    return rows.sort_values(["lang", "draw", "v"]).groupby("lang").head(bound)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, most: int = SAMPLE_ROWS) -> Model | None:
    """A model from (doc_id, text, lang) rows with non-null lang, or None if no text has a letter."""
    rows = _sampled(labelled, per_language, most)
    if rows.empty:
        return None
    x = np.vstack([np.frombuffer(v, np.float16) for v in rows["v"]]).astype(np.float32)
    lang = rows["lang"].to_numpy()
    family = np.array([family_of(v) for v in lang])
    families = sorted(set(family))
    languages = {f: sorted(set(lang[family == f])) for f in families}
    weights = np.array([fit_svm(x, np.where(family == f, 1, -1)) if len(families) > 1 else np.zeros(BUCKETS + 1) for f in families], np.float32)
    pairs = {}
    for f, langs in languages.items():
        combos = list(itertools.combinations(range(len(langs)), 2))
        fitted = []
        for a, b in combos:
            of = (lang == langs[a]) | (lang == langs[b])
            fitted.append(fit_svm(x[of], np.where(lang[of] == langs[a], 1, -1)))
        pairs[f] = (combos, np.array(fitted, np.float32).reshape(len(combos), BUCKETS + 1))
    return Model(families, languages, weights, pairs)


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        for at in range(0, len(texts) if model else 0, 512):
            found = [(at + i, v) for i, t in enumerate(texts.iloc[at : at + 512]) if (v := features(t)) is not None]
            if found:
                names, sure = model.predict(np.vstack([v for _, v in found]))
                for (i, _), n, s in zip(found, names, sure, strict=True):
                    lang[i], score[i] = n, s
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return docs.select(*keep, judged(F.col("text")).alias("__judged")).select(*keep, "__judged.lang_pred", "__judged.score")


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows outside the fold that have a language."""
    held = F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(False))
    learn = docs.where(F.col("doc_id").isNotNull() & ~held & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = fit(learn.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), model, ("doc_id", "held_out"))
