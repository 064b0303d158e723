"""Greek noise metrics of a text, counted over its code points."""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .text import latin_ratio

#: Letters by class, permitted doubles and impossible pairs (fixed values). What is not listed as a vowel, accented
#: letters of the extended block among it, counts as a consonant.
VOWELS = "ΑαΆάΕεΈέΗηΉήΙιΊίϊϋΟοΌόυΰύΥΎΩωΏώ"
ALLOWED_DOUBLES = "λμνρστκπγ"
IMPOSSIBLE_PAIRS = ("κξ", "γξ", "χξ", "πψ", "βψ", "φψ", "ρλ", "μρ", "γβ", "δτ", "τδ", "βπ", "πβ")
SHORT_BASELINE, SHORT_WORD, LONG_WORD, LONG_WEIGHT = 26.0, 3, 21, 380
FIELDS = (
    "score", "latin_pct", "table_ratio", "poly_ratio", "len_greek", "total_words", "v_pen", "c_pen", "bad_double", "misplaced_sigma", "invalid_bigram", "long_word_count",
    "longest_word", "short_word_count", "max_run", "v_rate", "c_rate", "d_rate", "sigma_end_rate", "bigram_rate", "long_word_rate", "short_ratio", "short_excess_per_1000", "flags",
)


_COUNTS = ("solid", "tabular", "poly", "greek_words", "len_greek", "total_words", "v_pen", "c_pen", "bad_double", "misplaced_sigma", "invalid_bigram", "long_word_count", "longest_word", "short_word_count", "max_run", "long_weight")
_POLYTONIC = re.compile("[\u1f00-\u1fff\u0300-\u036f\u1dc0-\u1dff\u20d0-\u20ff]")
_GREEK = re.compile("[\u0370-\u03ff\u1f00-\u1fff]")


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: 1 for a vowel, 2 for another Greek letter, 3 for a combining mark; may double; lower case."""
    kinds, doubles, low = np.zeros(0x2101, np.uint8), np.zeros(0x2101, bool), np.arange(0x2101)
    kinds[0x370:0x400] = kinds[0x1F00:0x2000] = 2
    kinds[[ord(c) for c in VOWELS]] = 1
    kinds[0x300:0x370] = kinds[0x1DC0:0x1E00] = kinds[0x20D0:0x2100] = 3
    doubles[[ord(c) for c in ALLOWED_DOUBLES]] = True
    low[0x391:0x3AA] += 0x20
    return kinds, doubles, low


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of ``_COUNTS`` for one text, each in one pass over its code points."""
    solid = tabular = poly = greek_words = 0
    kept = text
    if "|" in text:
        every = [x.removesuffix("\r") for x in text.split("\n")]
        every = every[:-1] if every[-1] == "" else every
        bare = [x.strip() for x in every]
        solid = sum(map(bool, bare))
        flags = [b.startswith("|") and b.endswith("|") for b in bare]
        tabular = sum(flags)
        kept = "\n".join(x for x, flag in zip(every, flags, strict=True) if not flag) if tabular else text
    if _POLYTONIC.search(kept):
        greek = [w for w in kept.split() if _GREEK.search(w)]
        greek_words, poly = len(greek), sum(_POLYTONIC.search(w) is not None for w in greek)
    kinds, doubles, low = _tables()
    code = np.minimum(np.frombuffer(kept.encode("utf-32-le", "surrogatepass"), np.uint32), 0x2100).astype(np.int32)
    kind = kinds[code]
    if (kind == 3).any():
        code, kind = code[kind != 3], kind[kind != 3]
    letter = kind > 0
    if not letter.any():
        return (solid, tabular, poly, greek_words, *[0] * 12)

    def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        return begin, np.diff(np.append(begin, len(values)))

    begin, length = runs(kind)
    of, after = kind[begin], np.append(kind[begin[1:]], 9)
    excess = np.where((length >= 4) & (after != 0), length - 3, 0)
    starts, sizes = runs(letter)
    sizes = sizes[letter[starts]]
    both = letter[1:] & letter[:-1]
    pair = low[code[:-1]] * 0x10000 + low[code[1:]]
    ends = (code == 0x3C3) & ~np.append(letter[1:], False)
    over = sizes[sizes >= LONG_WORD]
    return (
        solid, tabular, poly, greek_words, int(letter.sum()), len(sizes), int(excess[of == 1].sum()), int(excess[of == 2].sum()), int((both & (code[1:] == code[:-1]) & ~doubles[code[1:]]).sum()), int(ends.sum()),
        int((both & np.isin(pair, [ord(a) * 0x10000 + ord(b) for a, b in IMPOSSIBLE_PAIRS])).sum()), len(over), int(sizes.max()), int((sizes < SHORT_WORD).sum()), int(length[of > 0].max()), int(np.minimum(over - (LONG_WORD - 1), LONG_WEIGHT).sum()),
    )


def noise_metrics(df, text: str = "text"):
    """df with one column per name in ``FIELDS``; null texts count as empty. One pass over each text, no shuffle."""
    source = F.coalesce(F.col(text), F.lit(""))

    @F.pandas_udf("array<bigint>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(counts_of(t), np.int64) for t in texts])

    n = {name: F.col("__counts")[i] for i, name in enumerate(_COUNTS)}
    whole = ("total_words", "v_pen", "c_pen", "long_word_count", "longest_word", "short_word_count", "max_run")
    staged = df.withColumn("__counts", counted(source)).select(
        *df.columns,
        latin_ratio(source).alias("latin_pct"),
        F.when(n["solid"] > 0, n["tabular"] / n["solid"]).otherwise(0.0).alias("table_ratio"),
        *[(n[c].cast("int") if c in whole else n[c]).alias(c) for c in _COUNTS[4:15]],
        n["long_weight"].alias("__long_weight"), n["poly"].alias("__poly"), n["greek_words"].alias("__greek_words"), (n["tabular"] > 0).alias("__had_tables"),
    )
    rate = lambda name: F.when(F.col("len_greek") > 0, 1000.0 * F.col(name) / F.col("len_greek")).otherwise(0.0)
    poly = F.when((F.col("len_greek") > 0) & (F.col("__greek_words") > 0), F.col("__poly") / F.col("__greek_words")).otherwise(0.0)
    rated = staged.withColumns({
        "v_rate": rate("v_pen"), "c_rate": rate("c_pen"), "d_rate": rate("bad_double"), "sigma_end_rate": rate("misplaced_sigma"), "bigram_rate": rate("invalid_bigram"), "long_word_rate": rate("__long_weight"),
        "short_ratio": F.when(F.col("total_words") > 0, F.col("short_word_count") / F.col("total_words")).otherwise(0.0),
        "short_excess_per_1000": F.greatest(rate("short_word_count") - SHORT_BASELINE, F.lit(0.0)), "poly_ratio": poly,
    })
    flags = F.concat_ws(",", F.when(F.col("poly_ratio") > 0, "polytonic"), F.when(F.col("__had_tables"), "had_tables"))
    score = sum((w * F.col(c) for w, c in ((1.5, "c_rate"), (2.0, "d_rate"), (2.5, "sigma_end_rate"), (2.0, "bigram_rate"), (1.0, "short_excess_per_1000"), (1.0, "long_word_rate"))), F.col("v_rate"))
    return rated.withColumns({"flags": flags, "score": score}).select(*df.columns, *FIELDS)
