"""Preparation of sentences for telling varieties of Greek apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, count, strip

#: Sentences are left out with too much Latin or too many digits, or with too few or too many words (fixed values).
LATIN_SHARE, DIGIT_SHARE, FEWEST_WORDS, MOST_WORDS = 0.5, 0.5, 4, 512
#: Class labels that others are merged into (fixed values).
MERGED_LABELS = {5: 0, 4: 1}
UNSURE = -9999


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _roman(n: int) -> str:
    return "X" * (n // 10) + ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")[n % 10]


#: What is taken out of or joined in a sentence, in this order (fixed values).
RULES = (
    (r"\(?\d+\)|\d+\.", ""), (r"\{\d+\}", ""),
    (r"(?<!\S)\(?(?:στ|[α-ω]|ΣΤ|[Α-Ω])[ʹ'´).](?!\S)", ""),
    (r"[↩\[\]—―]", ""),
    (r"(\S+)&(\S+)", "$1$2"), (r"&(\S+)", "$1"), (r"(\S+)&", "$1"),
    (r"/\d+/", ""),
    (rf"\b(?:{'|'.join(_roman(n) for n in range(1, 21))})[.)]", ""),
)


def cleaned_sentence(text: Column) -> Column:
    """Without list numbers, Greek and Roman numerals and odd marks; & joins words; at last without brackets."""
    out = F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))
    for pattern, by in RULES:
        out = F.regexp_replace(out, f"(?U){pattern}", by)
    return F.regexp_replace(strip(out), r"[<>\[\](){}]", "")


def usable(text: Column) -> Column:
    """1 for a sentence to judge, 0 for an empty, mostly Latin or numeric, short or long one."""
    size = F.length(text)
    n = F.size(words(text))
    bad = (size == 0) | (count(text, "[A-Za-z]") / size > LATIN_SHARE) | (count(text, r"\d") / size > DIGIT_SHARE) | (n < FEWEST_WORDS) | (n > MOST_WORDS)
    return F.when(F.coalesce(bad, F.lit(True)), 0).otherwise(1)


def masked_prediction(mask: Column, prediction: Column) -> Column:
    return F.when(mask == 0, UNSURE).otherwise(prediction)


def masked_label(mask: Column, label: Column) -> Column:
    return F.when(F.coalesce(mask, F.lit(0)) != 1, "---").otherwise(label)


def merged_label(label: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MERGED_LABELS.items() for x in kv]), label), label)
