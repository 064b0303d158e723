"""Character classes and line helpers as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, written out so that every regex dialect reads it alike.
SPACE = r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_BLANKS = "".join(map(chr, (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: LaTeX environments left out of character counts (fixed values).
MATH_ENVIRONMENTS = ("equation", "equation*", "align", "align*", "gather", "gather*", "multline", "multline*", "eqnarray", "eqnarray*", "comment")
#: Script classes for percentages and cleaning (fixed values).
GREEK_LETTERS = r"\x{370}-\x{3E1}\x{3F0}-\x{3FF}\x{B5}"


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """What ``of`` makes of a value, which is worked out once however often ``of`` names it."""
    return F.element_at(F.transform(F.array(value), of), 1)


def count(text: Column, pattern: str) -> Column:
    """Matches of a pattern; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def lines(text: Column) -> Column:
    """Lines at newlines, each without one trailing carriage return, without a last empty one."""
    split = F.split(F.regexp_replace(text, r"\r\n", "\n"), "\n", -1)
    return F.when(F.element_at(split, -1) == "", F.slice(split, F.lit(1), F.size(split) - 1)).otherwise(split)


def python_lines(text: Column) -> Column:
    """Lines at every line boundary that Python's splitlines knows."""
    split = F.split(text, "\r\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]", -1)
    return let(split, lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def is_table_line(line: Column) -> Column:
    """Whether a stripped line starts and ends with a pipe."""
    return F.rlike(line, F.lit(rf"^[{SPACE}]*\|(?:(?s:.*)\|)?[{SPACE}]*\z"))


def chars_of(text: Column, characters: str) -> Column:
    """How many characters of a class a text has, by what is left without its runs; 0 for null."""
    return F.coalesce(F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", "")), F.lit(0)).cast("long")


def solid_chars(text: Column) -> Column:
    """Characters that are not white space; 0 for null."""
    return F.coalesce(F.length(F.regexp_replace(text, f"[{SPACE}]+", "")), F.lit(0)).cast("long")


def latin_letters(text: Column) -> Column:
    return chars_of(text, "A-Za-z")


def latin_ratio(text: Column) -> Column:
    """ASCII letters per byte; NaN for an empty text."""
    size = F.octet_length(text)
    return F.when(size == 0, F.lit(float("nan"))).otherwise(latin_letters(text) / size)


def without_markup(text: Column) -> Column:
    """Without one-line comments, LaTeX environments and display or inline maths that open and close on a line."""
    out = F.regexp_replace(text, "(?d)<!--.*?-->", "")
    for env in MATH_ENVIRONMENTS:
        name = env.replace("*", r"\*")
        out = F.regexp_replace(out, rf"(?d)\\begin\{{{name}\}}.*?\\end\{{{name}\}}", "")
    out = F.regexp_replace(out, r"(?d)(\\\[.*?\\\])|(\\\(.*?\\\))|(\$\$.*?\$\$)", "")
    return F.when(F.rlike(text, F.lit(r"<!--|\\|\$\$")), out).otherwise(text)


def content_chars(text: Column) -> Column:
    """Characters that are not white space, outside comments and maths."""
    return solid_chars(without_markup(text))


def script_percentages(text: Column) -> tuple[Column, Column]:
    """Greek and Latin shares of what is not white space, in percent; 0 if nothing is there."""
    total = solid_chars(text)
    share = lambda n: F.when(total == 0, F.lit(0.0)).otherwise(100.0 * n / total)
    return share(chars_of(text, GREEK_LETTERS)), share(latin_letters(text))
