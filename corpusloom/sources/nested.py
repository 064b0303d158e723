"""Converted documents as nested JSON: tidied, written as compact (compressed) files, read again.

Documents are JSON objects of unknown depth, as layout converters give them: ``texts`` with labels and provenance, boxes,
tables, pages. A walk over each document inside one Arrow pass rounds coordinates and confidences, normalises every string,
and merges metadata; everything else about a document's nodes is done by column expressions (``operators.metrics``).

Edge cases: a null text stays null; what is not JSON, or nests deeper than the parser goes, becomes null (files: no row is
written, and the outcome says so); a document that is not an object is tidied but takes no metadata; a ``meta`` that is not
an object is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_compressed_json, read_files
from .listing import arrow_folder
from .scratch import settled

#: Keys whose numbers are coordinates: sides of boxes, corners, sizes; and those of confidences (fixed values).
COORDINATES = ("l", "t", "r", "b", "x", "y", "width", "height", "r_x0", "r_y0", "r_x1", "r_y1", "r_x2", "r_y2", "r_x3", "r_y3")
CONFIDENCES = ("confidence", "score")
_UNSEEN = re.compile("[\u200B-\u200D\uFEFF]")


def tidied(value, places: dict[str, int], key: str | None = None):
    """A parsed JSON value with numbers under keys of ``places`` rounded and strings in form C without zero-width characters."""
    if isinstance(value, dict):
        return {k: tidied(v, places, k) for k, v in value.items()}
    if isinstance(value, list):
        return [tidied(v, places, key) for v in value]
    if isinstance(value, str):
        return _UNSEEN.sub("", unicodedata.normalize("NFC", value))
    return round(value, places[key]) if isinstance(value, float) and key in places else value


def tidy_documents(document: Column, meta: Column | None = None, coordinate_places: int = 2, confidence_places: int = 2, image_mode: str = "referenced") -> Column:
    """Compact JSON of a column of JSON documents, tidied, with the fields of ``meta`` (a JSON object) and of the settings
    under its key meta; fields of ``meta`` win over settings, and both over what the document has."""
    places = dict.fromkeys(COORDINATES, coordinate_places) | dict.fromkeys(CONFIDENCES, confidence_places)
    settings = {"coord_precision": coordinate_places, "confid_precision": confidence_places, "image_mode": image_mode}

    def one(text: str | None, more: str | None) -> str | None:
        try:
            value = tidied(json.loads(text), places) if text is not None else None
        except (ValueError, RecursionError):
            return None
        if text is None:
            return None
        if isinstance(value, dict):
            own = value.get("meta")
            told = json.loads(more) if more else {}
            fields = settings | told
            order = [*told, *(k for k in settings if k not in told)]
            value["meta"] = (own if isinstance(own, dict) else {}) | {k: fields[k] for k in order}
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))

    @F.pandas_udf("string")
    def tidy(texts: pd.Series, metas: pd.Series) -> pd.Series:
        return pd.Series([one(t, m) for t, m in zip(texts, metas, strict=True)], dtype=object)

    return tidy(document, meta if meta is not None else F.lit(None).cast("string"))


def write_documents(documents: DataFrame, path: str, compress: bool = True, level: int = 3) -> DataFrame:
    """Writes (stem, document) rows as files {stem}.docling.json[.zst] below a path that all executors reach.

    A file is written under a draft name and then moved, so that a repeated task replaces it and no reader meets half of
    one. Returns (stem, name, bytes); null documents have no file, a null name and no bytes.
    """

    def write(batches):
        system, root = arrow_folder(path)
        system.create_dir(root)
        packer = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            names, sizes = [], []
            for stem, text in zip(batch["stem"], batch["document"], strict=True):
                if text is None:
                    names.append(None)
                    sizes.append(0)
                    continue
                data = packer.compress(text.encode()) if compress else text.encode()
                name = f"{stem}.docling.json{'.zst' if compress else ''}"
                draft = f"{root}/.{uuid.uuid4().hex}"
                with system.open_output_stream(draft, compression=None) as out:
                    out.write(data)
                system.move(draft, f"{root}/{name}")
                names.append(name)
                sizes.append(len(data))
            yield pd.DataFrame({"stem": batch["stem"], "name": names, "bytes": sizes})

    return settled(documents.select("stem", "document").mapInPandas(write, "stem string, name string, bytes long"), "documents")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(stem, filename, document) of the .json and .json.zst files of a folder."""
    found = read_files(spark, path, "json,zst").where(F.rlike("filename", F.lit(r"\.json(\.zst)?$")))
    stem = F.regexp_replace("filename", r"(?:\.docling)?\.json(?:\.zst)?$", "")
    return found.select(stem.alias("stem"), "filename", read_compressed_json(found).alias("document"))
