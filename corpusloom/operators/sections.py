"""Markdown into sections and content blocks."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.slices import cuts
from ..functions.text import strip

#: Longest stripped line that counts as "other" (fixed value).
SHORT_LINE = 20
KINDS = ("table", "list", "other", "text")
_TITLE, _NUMBERED, _TABLE = re.compile(r"#+\s*(.+)\Z"), re.compile(r"\d+\.\s+"), re.compile(r"\|(?:.*\|)?\Z")
_SECTION = "id:int,header:string,start_line:int,end_line:int,place:string,content:string,section_length:bigint"
_ROW = _SECTION + ",section_propo:bigint," + ",".join(f"has_{k}:boolean" for k in KINDS) + ",json_section:string"


def is_bullet(line: Column) -> Column:
    return F.rlike(strip(line), F.lit(r"^(?:-|\d+\.\s+)"))


def sections_of(text: str) -> list[dict]:
    """A text's sections, as ``split_sections`` has them."""
    every = text.splitlines()
    found: list[dict] = []
    bodies: list[list[str]] = []
    for at, line in enumerate(every):
        bare = line.strip()
        head = bare.startswith("#")
        if head or not found:
            title = _TITLE.match(bare) if head else None
            found.append({"id": len(found), "header": title[1] if title else bare or "Document", "start_line": at, "end_line": at, "section_length": 0})
            bodies.append([])
        found[-1]["end_line"] = at
        if not head:
            bodies[-1].append(line)
            found[-1]["section_length"] += bare != ""
    for row, body in zip(found, bodies, strict=True):
        row["place"] = f"{row['start_line'] / max(1, len(every)):.2f}-{row['end_line'] / max(1, len(every)):.2f}"
        row["content"] = "\n".join(body)
    return found


def blocks_of(content: str) -> list[tuple[int, str, str]]:
    """The blocks of a section's content, as ``blocks`` has them."""
    found: list[tuple[int, str, list[str]]] = []
    since, last = None, None
    for line in content.split("\n"):
        bare = line.strip()
        mark = "blank" if not bare else "table" if _TABLE.match(bare) else "bullet" if bare[0] == "-" or _NUMBERED.match(bare) else None
        since = mark or since
        kind = "table" if mark == "table" else "list" if since == "bullet" and mark in (None, "bullet") else "other" if bare and len(bare) < SHORT_LINE else "text"
        if kind == "other" or kind != last:
            found.append((len(found) + 1, kind, []))
        found[-1][2].append(line)
        last = kind
    return [(nth, kind, value) for nth, kind, of in found if (value := "\n".join(of)).strip()]


def rows_of(text: str, fields=tuple(f.split(":")[0] for f in _ROW.split(","))) -> list[dict]:
    """A text's sections with their blocks' kinds, the blocks as JSON and the share of the document, as far as ``fields`` has
    them."""
    found = sections_of(text)
    total = sum(row["section_length"] for row in found)
    kinds, as_json = any(f.startswith("has_") for f in fields), "json_section" in fields
    for row in found:
        if kinds or as_json:
            made = blocks_of(row["content"])
            row |= {f"has_{k}": any(kind == k for _, kind, _ in made) for k in KINDS}
            if as_json:
                row["json_section"] = json.dumps([{kind: value} for _, kind, value in made], ensure_ascii=False, indent=2)
        row["section_propo"] = round(row["section_length"] / total * 1000) if total else 0
    return found


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _each(docs: DataFrame, key: str, text: str, of, schema: str) -> DataFrame:
    """(key, one row per item that ``of`` finds in the text): every document stays where it is.

    A worker holds the items of a slice of texts only, however many rows Spark sends it at a time.
    """
    fields = dict(f.split(":") for f in schema.split(","))

    def found(batches):
        for batch in batches:
            keys, texts = batch.columns
            for first, n in cuts(texts):
                items = [of(t) for t in texts.slice(first, n).to_pylist()]
                rows = [row for each in items for row in each]
                owner = pa.array(np.repeat(np.arange(first, first + n), [len(each) for each in items]))
                columns = [pa.array([row[name] for row in rows], _ARROW[kind]) for name, kind in fields.items()]
                yield pa.RecordBatch.from_arrays([keys.take(owner), *columns], [key, *fields])

    made = StructType([docs.schema[key], *StructType.fromDDL(",".join(f"{name} {kind}" for name, kind in fields.items()))])
    return docs.where(F.col(text).isNotNull()).select(key, text).mapInArrow(found, made)


def split_sections(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, id, header, start_line, end_line, place, content, section_length): one row per section.

    A header is a stripped line that begins with #. Leading lines make section 0, titled by the first line, which
    also stays in its body; other headers are not in the body.
    """
    return _each(docs, key, text, sections_of, _SECTION)


def blocks(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, id, nth, kind, value): the blocks of each section, tables before lists before other before text.

    A table is a run of lines between pipes. A list begins with a bullet and goes on over lines that are neither
    blank nor bullets' end nor table. A short line alone is "other", and the lines between make a text.
    """
    of = lambda content: [{"nth": nth, "kind": kind, "value": value} for nth, kind, value in blocks_of(content)]
    keyed = sections.select(F.struct(key, "id").alias("__of"), "content")
    made = _each(keyed, "__of", "content", of, "nth:int,kind:string,value:string")
    return made.select(f"__of.{key}", "__of.id", "nth", "kind", "value")


def section_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", fields: tuple[str, ...] | None = None) -> DataFrame:
    """Sections with has_table, has_list, has_other, has_text, json_section and the share of the document in 1/1000.

    ``fields``: the columns that are wanted besides the key; the others are not made.
    """
    wanted = [f for f in _ROW.split(",") if fields is None or f.split(":")[0] in fields]
    names = tuple(f.split(":")[0] for f in wanted)
    return _each(docs, key, text, lambda t: rows_of(t, names), ",".join(wanted))
