"""Document cleaning: lines with foreign artefacts, tags and letters; malformed tables; scores of what was lost."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.slices import slices
from ..functions.text import SPACE, content_chars, lines, script_percentages
from ..sources.scratch import settled

#: Placeholders, artefacts of broken extraction and letters by script (fixed values).
TEXT_MISSING, TABLE_REMOVED = "<!-- text-missing -->", "<!-- table-removed -->"
ARTEFACTS = ("glyph<c=", "glyph&lt;c=", "GLYPH<", "GLYPH&lt;", "MS-Bold-", "font=/", "FontName=")
LEAST_REMOVED = 5
FRENCH = "àâçéèêëîïôùûüÿæœÀÂÇÉÈÊËÎÏÔÙÛÜŸÆŒ«»"
SPANISH = "áéíóúüñÁÉÍÓÚÜÑ¿¡"
ACCENTED_GREEK = "άέήίόύώΆΈΉΊΌΎΏϊϋΪΫΐΰ"
PUNCTUATION = ".,;:!?()[]{}'\"&@#$%^*_-+=|\\<>/~`"
SYMBOLS = "€£¥©®™°§"
UNUSUAL_BLOCKS = ((0x80, 0xFF), (0x100, 0x17F), (0x180, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x3E2, 0x3EF), (0x2C80, 0x2CFF), (0x400, 0x4FF), (0x500, 0x52F))
SCRIPTS = {
    "latin": frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "greek": frozenset(map(chr, (*range(0x370, 0x3E2), *range(0x3F0, 0x400)))) | frozenset(ACCENTED_GREEK + "\xb5"),
    "french": frozenset(FRENCH),
    "spanish": frozenset(SPANISH),
    "punctuation": frozenset(PUNCTUATION),
    "numbers": frozenset("0123456789"),
    "common_symbols": frozenset(SYMBOLS),
}
ALWAYS_KEPT = ("punctuation", "numbers", "common_symbols")


def available_scripts() -> list[str]:
    return sorted(SCRIPTS)


def unusual_letters(scripts=("greek", "latin")) -> str:
    """The characters that cleaning takes out: unusual ones that no wanted script has."""
    spared = {0x80: FRENCH + SPANISH + ACCENTED_GREEK + SYMBOLS + PUNCTUATION, 0x100: FRENCH + SPANISH}
    wanted = frozenset().union(*(SCRIPTS[s] for s in (*scripts, *ALWAYS_KEPT)))
    every = (chr(c) for low, high in UNUSUAL_BLOCKS for c in range(low, high + 1) if chr(c) not in spared.get(low, ""))
    return "".join(c for c in every if c not in wanted)


_PIECE = re.compile(r"<!--.*?-->|<(?!!--)[^>]*>|<")


def _untagged(line: str) -> tuple[str, int]:
    """The line without tags but with comments, and how many characters that are not blank the tags held."""
    out, removed, at = [], 0, 0
    for m in iter(lambda: _PIECE.search(line, at), None):
        out.append(line[at : m.start()])
        piece = m[0]
        if piece == "<" or piece.startswith("<!--"):
            out.append(piece)
        else:
            removed += len("".join(piece[1:-1].split()))
        at = m.end()
    return "".join(out) + line[at:], removed


class Letters:
    """The characters that cleaning takes out, and a pattern of all that a line needs a closer look for."""

    def __init__(self, unwanted: str):
        some = "".join(map(re.escape, unwanted))
        self.gone = re.compile(f"[{some}]+") if unwanted else re.compile(r"(?!)")
        self.odd = re.compile("[<&$\r]|" + "|".join(re.escape(a) for a in ARTEFACTS if "<" not in a and "&" not in a) + (f"|[{some}]" if unwanted else ""))
        self.blank = [c for c in unwanted if c.isspace()]


def cleaned(text: str, letters: Letters) -> tuple[str, int, int]:
    """The cleaned text, the characters judged and the characters kept of them.

    Maths between $$ is copied and not judged; whether it is open carries over lines, but a rejected line does not
    open or close it.
    """
    if not letters.odd.search(text):
        n = len(text) - text.count("\n")
        return text, n, n
    out, judged, kept, maths = [], 0, 0, False
    for raw in re.split(r"\r?\n", text[:-1] if text.endswith("\n") else text) if text else []:
        if not maths and not letters.odd.search(raw):
            judged, kept = judged + len(raw), kept + len(raw)
            out.append(raw)
            continue
        bare = raw.strip()
        if bare == TEXT_MISSING:
            judged += len(raw)
            out.append(raw)
            continue
        marks = raw.count("$$")
        if not maths and bare != "$$" and not (marks and marks % 2 == 0) and any(a in raw for a in ARTEFACTS):
            judged += len(raw)
            out.append(TEXT_MISSING)
            continue
        line, lost = _untagged(html.unescape(raw))
        parts = line.split("$$")
        text_parts, in_maths, plain = [], 0, 0
        for i, part in enumerate(parts):
            if maths:
                in_maths += len(part)
                text_parts.append(part)
            else:
                stays = letters.gone.sub("", part)
                lost += len(part) - len(stays) - sum(map(part.count, letters.blank))
                plain += len(part)
                text_parts.append(stays)
            if i + 1 < len(parts):
                in_maths += 2
                maths = not maths
        done = "$$".join(text_parts)
        if in_maths and not plain:
            out.append(done)
            continue
        spare = in_maths
        if not re.fullmatch(r"<!--.*?-->", done.strip()) and lost >= LEAST_REMOVED:
            if done.strip():
                done = f"{done.rstrip()} {TEXT_MISSING}"
                spare += len(TEXT_MISSING) + 1
            elif bare:
                done = TEXT_MISSING
                spare += len(TEXT_MISSING)
        elif done == TABLE_REMOVED:
            spare += len(TABLE_REMOVED)
        judged += max(0, len(raw) - in_maths)
        kept += max(0, len(done) - spare)
        out.append(done)
    return "\n".join(out) + ("\n" if text.endswith("\n") else ""), judged, kept


def clean_text(text: Column, scripts=("greek", "latin")) -> Column:
    """struct(text, judged_chars, kept_chars) of the line cleaner; null for null."""
    letters = Letters(unusual_letters(scripts))

    @F.arrow_udf("text string, judged_chars long, kept_chars long")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (some for batch in batches for some in slices(batch)):
            rows = [(None, None, None) if t is None else cleaned(t, letters) for t in texts]
            columns = zip(*rows, strict=True)
            kinds = {"text": pa.string(), "judged_chars": pa.int64(), "kept_chars": pa.int64()}
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    return clean(text)


def badness(judged: Column, kept: Column) -> Column:
    return F.when(judged > 0, F.greatest(F.lit(0.0), F.round(1 - kept / judged, 3))).otherwise(0.0)


def badness_of_letters(raw: Column, done: Column) -> Column:
    """The share of characters that are not blank that cleaning took out; 0 for a text without any."""
    solid = lambda c: F.length(F.regexp_replace(c, f"[{SPACE}]+", ""))
    return F.when(solid(raw) > 0, F.greatest(solid(raw) - solid(done), F.lit(0)) / solid(raw)).otherwise(0.0)


_ROW, _RULE = re.compile(r"\s*\|.*\|\s*\Z"), re.compile(r"\s*\|\s*[-:]+\s*\|")
RULED = r"(?m)^\s*\|\s*[-:]+\s*\|"
_ISSUE = "line_number int, description string, expected_columns int, found_columns int, start_line int, end_line int"


def _columns(line: str) -> int:
    bare = line.strip()
    return bare.count("|") - 1 if len(bare) > 1 and bare[0] == bare[-1] == "|" else 0


def ruled_tables(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """A text's lines, and its tables as (rule line, first line behind the body): a rule line opens a table, the rows below
    it are its body, and the search goes on behind the body."""
    every = text.split("\n")
    every = [x.removesuffix("\r") for x in (every[:-1] if every[-1] == "" else every)]
    tables, free = [], 0
    for at in (i for i, x in enumerate(every) if _RULE.match(x)):
        if at >= free:
            free = next((i for i in range(at + 1, len(every)) if not _ROW.match(every[i])), len(every))
            tables.append((at, free))
    return every, tables


def malformed(text: str) -> list[tuple]:
    """The issues of a text's tables, as ``table_issues`` has them. The row right above a rule line is its header."""
    every, tables = ruled_tables(text)
    found = []
    for at, free in tables:
        headed, expected = at > 0 and _ROW.match(every[at - 1]) is not None, _columns(every[at])
        span = (at - 1 if headed else at, free - 1)
        if not headed:
            found.append((at + 1, "Table separator without header row", None, expected, *span))
        elif _columns(every[at - 1]) != expected:
            found.append((at + 1, "Table header and separator column count mismatch", _columns(every[at - 1]), expected, *span))
        odd = [(i + 1, n) for i in range(at + 1, free) if expected and (n := _columns(every[i])) != expected]
        found += [(line, "Table row has inconsistent column count", expected, n, *span) for line, n in odd]
    return found


def table_counts(text: Column) -> Column:
    """(tables, issues) of a text; null where it has no rule line."""

    @F.pandas_udf("tables int, issues int")
    def counts(texts: pd.Series) -> pd.DataFrame:
        known = [t or "" for t in texts]
        return pd.DataFrame({"tables": [len(ruled_tables(t)[1]) for t in known], "issues": [len(malformed(t)) for t in known]}).astype("int32")

    return F.when(F.rlike(text, F.lit(RULED)), counts(text))


def table_issues(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_number, description, expected_columns, found_columns, start_line, end_line) of malformed tables.

    line_number counts from 1, start_line and end_line from 0. Expected is what the table should have by the line
    above: the header's columns for the rule line (null without one), the rule line's for the rows. Every document is
    judged where it is; texts without a rule line never reach Python.
    """

    @F.pandas_udf(f"array<struct<{_ISSUE.replace(' int', ':int').replace(' string', ':string')}>>")
    def issues(texts: pd.Series) -> pd.Series:
        names = [c.split()[0] for c in _ISSUE.split(", ")]
        return pd.Series([[dict(zip(names, x, strict=True)) for x in malformed(t)] for t in texts])

    ruled = docs.where(F.rlike(text, F.lit(RULED)))
    return ruled.select(key, F.explode(issues(F.col(text))).alias("i")).select(key, "i.*")


def remove_tables(docs: DataFrame, issues: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with each run of lines inside an issue's range replaced by one placeholder line."""
    ranges = issues.groupBy(key).agg(F.collect_set(F.struct("start_line", "end_line")).alias("__ranges"))
    bad = lambda i: F.exists("__ranges", lambda r: (i >= r["start_line"]) & (i <= r["end_line"]))
    split = lines(F.col(text))
    marked = F.transform(split, lambda x, i: F.struct(F.when(~bad(i), x).when((i > 0) & bad(i - 1), F.lit(None).cast("string")).otherwise(TABLE_REMOVED).alias("x")))
    kept = F.array_join(F.transform(F.filter(marked, lambda m: m["x"].isNotNull()), lambda m: m["x"]), "\n")
    ended = F.concat(kept, F.when(F.endswith(F.col(text), F.lit("\n")), F.lit("\n")).otherwise(F.lit("")))
    return docs.join(ranges, key, "left").withColumn(text, F.when(F.col("__ranges").isNotNull(), ended).otherwise(F.col(text))).drop("__ranges")


def quality_report(docs: DataFrame, scripts=("greek", "latin"), key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(cleaned documents, report): clean, remove malformed tables, clean again, and score the second cleaning."""
    once = settled(docs.withColumn(text, clean_text(F.col(text), scripts)["text"]), "cleaned")
    without = settled(remove_tables(once, table_issues(once, key, text), key, text), "untabled")
    twice = without.withColumn("__c", clean_text(F.col(text), scripts))
    greek, latin = script_percentages(F.col("__c.text"))
    report = twice.select(
        key, badness(F.col("__c.judged_chars"), F.col("__c.kept_chars")).alias("badness_score_all_chars"), F.round(greek, 3).alias("percentage_greek_cleaned"),
        F.round(latin, 3).alias("percentage_latin_cleaned"), content_chars(F.col("__c.text")).alias("char_count_no_comments"),
    )
    return without, report.withColumn("is_empty", F.col("char_count_no_comments") == 0)


def readable(files: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """(texts, rejects) of binary files: those that are valid UTF-8 with a text column, and the others."""
    valid = F.is_valid_utf8(F.col(content).cast("string"))
    return files.where(valid).withColumn("text", F.col(content).cast("string")), files.where(~valid)
