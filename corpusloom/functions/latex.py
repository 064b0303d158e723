"""LaTeX of recognised formulas: cutting degenerate output, accepting, routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE

#: Limits (fixed values).
TAIL_LIMIT, TAIL_KEPT, LENGTH_LIMIT, ACCEPT_LENGTH = 50, 12, 3000, 6000
FORBIDDEN = (r"\includegraphics", r"\write18")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda t: t != "")


def _run(tokens: Column) -> Column:
    same = F.aggregate(tokens, F.struct(F.lit("").alias("last"), F.lit(0).alias("n")), lambda a, t: F.struct(t.alias("last"), F.when(t == a["last"], a["n"] + 1).otherwise(1).alias("n")))
    return same["n"]


def tail_run(text: Column) -> Column:
    """How often the last token stands in a row at the end."""
    return _run(_tokens(text))


def sanitized(text: Column) -> Column:
    """struct(latex, truncated_by_repeat, truncated_by_length, tail_run): repeated tails clamped, then cut to length.

    Only texts with a long tail run or over the length limit are touched; of these a tail is clamped wherever it is
    longer than what is kept of one. The cut is at the last blank or backslash before the limit, if there is one.
    """

    def clamp(tokens: Column, run: Column) -> Column:
        gate = (run > TAIL_LIMIT) | (F.length(text) > LENGTH_LIMIT)
        repeats = gate & (run > TAIL_KEPT)
        clamped = F.when(repeats, F.array_join(F.slice(tokens, F.lit(1), F.size(tokens) - run + TAIL_KEPT), " ")).otherwise(text)
        return F.struct(clamped.alias("text"), repeats.alias("repeats"))

    def cut(done: Column, run: Column) -> Column:
        head = F.substring(done["text"], 1, LENGTH_LIMIT)
        at_break = F.when(F.rlike(head, F.lit(r"[ \n\t\\]")), F.regexp_extract(head, r"(?s)^(.*)[ \n\t\\]", 1)).otherwise(head)
        too_long = F.length(done["text"]) > LENGTH_LIMIT
        out = F.when(too_long, F.regexp_replace(at_break, rf"[{SPACE}]+\z", "")).otherwise(done["text"])
        return F.struct(out.alias("latex"), done["repeats"].alias("truncated_by_repeat"), too_long.alias("truncated_by_length"), run.alias("tail_run"))

    measured = F.struct(_tokens(text).alias("t"), tail_run(text).alias("n"))
    return _let(measured, lambda m: _let(clamp(m["t"], m["n"]), lambda c: cut(c, m["n"])))


def accept_score(text: Column) -> Column:
    """1.0 for LaTeX of bearable length with braces that balance and nothing forbidden, else 0.0."""
    braces = F.regexp_extract_all(text, F.lit(r"[{}]"), 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("below"))
    step = lambda a, b: F.struct((a["depth"] + F.when(b == "{", 1).otherwise(-1)).alias("depth"), (a["below"] | ((b == "}") & (a["depth"] == 0))).alias("below"))
    end = F.aggregate(braces, start, step)
    bad = (F.length(text) > ACCEPT_LENGTH) | (end["depth"] != 0) | end["below"]
    for word in FORBIDDEN:
        bad = bad | F.contains(text, F.lit(word))
    return F.when(F.coalesce(bad, F.lit(True)), 0.0).otherwise(1.0)


def crop_dpi(height: Column, base: int = 220, least: int = 180, most: int = 320) -> Column:
    """The resolution for a formula crop by its height in pixels: more for small crops, less for tall ones, in bounds."""
    return F.when(height < 40, min(most, max(base + 60, least))).when(height < 120, min(most, max(base + 20, least))).when(height > 800, max(least, base - 40)).otherwise(base)


def recommended_phase(total: Column) -> Column:
    return F.when(F.coalesce(total, F.lit(0)) > 0, "2A").otherwise("stop")


def is_math_heavy(pages_with: Column, pages: Column, p90: Column, most: Column, total: Column) -> Column:
    share = F.when(pages > 0, pages_with / pages).otherwise(0.0)
    return (share >= 0.15) | (p90 >= 2) | (most >= 4) | (total >= 10)
