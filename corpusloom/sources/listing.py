"""Files as rows, without their contents, and what footers of Parquet files say.

A listing holds a path, a size and a time per file; extensions are probed, tables found and first files taken by joins and
aggregates over it. Footers are read in tasks, a file each, and never the data pages behind them.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import base_name, canonical_stem
from .scratch import settled

#: Extensions of source files in the order in which a stem's file is chosen (fixed values).
PRIORITY = ("pdf", "docx", "xml", "html", "pptx", "csv", "md")
#: Key-value metadata that tables of a corpus should have (fixed values).
REQUIRED = ("pipeline_version", "created_at", "source_file", "processing_stage")


def arrow_folder(path: str):
    """(file system, folder) of Arrow for a path or URI that tasks reach."""
    from pyarrow import fs

    uri = path if "://" in path else re.sub("^file:/*", "/", path)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def list_files(spark: SparkSession, path: str, recursive: bool = True, pattern: str = "*") -> DataFrame:
    """(path, filename, stem, ext, length, modified) of the files below a folder, or right in it; contents are not read.
    Spark leaves out names that begin with a dot or an underscore. Names of folders are not taken for columns."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    if not recursive:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
        found = found.where(F.regexp_replace("path", "/[^/]*$", "") == folder)
    named = found.select("path", base_name(F.col("path")).alias("filename"), "length", F.col("modificationTime").alias("modified"))
    return named.select("path", "filename", canonical_stem(F.col("filename")).alias("stem"), F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1)).alias("ext"), "length", "modified")


def rank_of(ext: Column, priority: tuple[str, ...] = PRIORITY) -> Column:
    """The place of an extension in the order of priority; null for others."""
    return F.nullif(F.array_position(F.array(*map(F.lit, priority)), F.lower(ext)), F.lit(0))


def probed(stems: DataFrame, files: DataFrame, priority: tuple[str, ...] = PRIORITY, key: str = "stem") -> DataFrame:
    """stems with filename, file_ext and found: of a stem's files the one whose extension comes first, by name where several
    have it; a stem without one is named as if it had a file of the first extension."""
    best = files.where(rank_of(F.col("ext"), priority).isNotNull()).groupBy(F.col("stem").alias("__stem")).agg(F.min(F.struct(rank_of(F.col("ext"), priority).alias("rank"), "filename", "ext")).alias("__file"))
    met = stems.join(best, stems[key] == F.col("__stem"), "left")
    return met.withColumns({
        "filename": F.coalesce("__file.filename", F.concat(key, F.lit(f".{priority[0]}"))), "file_ext": F.coalesce("__file.ext", F.lit(priority[0])), "found": F.col("__stem").isNotNull(),
    }).drop("__stem", "__file")


def first_table(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """The first Parquet file by name of the first folder that has one, with the places of its rows as row_idx."""
    for folder in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            first = list_files(spark, folder, recursive=False, pattern="*.parquet").agg(F.min_by("path", "filename")).first()[0]
            if first:
                rows = spark.read.parquet(first)
                return rows if "row_idx" in rows.columns else rows.select("*", F.col("_metadata.row_index").alias("row_idx"))
    return None


def read_footers(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, filename, columns, kinds, properties, rows, group_rows, bytes) of the Parquet files below a folder: names and
    Arrow types of top-level columns, key-value metadata without the writers' own schemas, and rows of each row group.

    One task opens a file's footer alone. Files that are not Parquet, cut ones too, have nulls.
    """
    files = list_files(spark, path, pattern=pattern).select("path", "filename", F.col("length").alias("bytes"))

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for where in batch["path"]:
                system, name = arrow_folder(where)
                try:
                    with system.open_input_file(name) as file:
                        told = pq.read_metadata(file)
                except pa.ArrowInvalid:
                    out.append((None, None, None, None, None))
                    continue
                schema = told.schema.to_arrow_schema()
                pairs = {k.decode(): v.decode("utf-8", "replace") for k, v in (told.metadata or {}).items() if k not in (b"ARROW:schema", b"org.apache.spark.sql.parquet.row.metadata")}
                out.append((schema.names, [str(t) for t in schema.types], pairs, told.num_rows, [told.row_group(i).num_rows for i in range(told.num_row_groups)]))
            told = pd.DataFrame(out, columns=["columns", "kinds", "properties", "rows", "group_rows"], index=batch.index)
            told["rows"] = told["rows"].astype("Int64")
            yield pd.concat([batch[["path", "filename"]], told, batch[["bytes"]]], axis=1)

    return files.mapInPandas(footers, "path string, filename string, columns array<string>, kinds array<string>, properties map<string,string>, rows long, group_rows array<long>, bytes long")


def kind_of(columns: Column, url_column: str = "url") -> Column:
    """downloads, sections, metadata or null for an array of column names."""
    has = lambda *names: F.size(F.array_intersect(columns, F.array(*map(F.lit, names)))) == len(names)
    return F.when(has("filename", "title", "content", "section") | has("filename", "header", "section", "id"), "sections").when(has("download_success", "filename"), "downloads").when(has(url_column, "filename"), "metadata")


def lacking(properties: Column, required: tuple[str, ...] = REQUIRED) -> Column:
    """The required keys that a file's key-value metadata lacks."""
    return F.array_except(F.array(*map(F.lit, required)), F.coalesce(F.map_keys(properties), F.array().cast("array<string>")))


def write_row_groups(df: DataFrame, path: str, group: str, *order: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Writes df as Parquet files with a row group for each value of ``group``, in the order of group and ``order``, and
    with key-value metadata in their footers. Returns (name, groups, rows) of the files.

    Each file is a range of groups, streamed group by group, written under a draft name and then moved, so that a repeated
    task replaces it. A task holds the rows of one group; null groups are one group. A table without rows has no file.
    """
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        system, root = arrow_folder(path)
        system.create_dir(root)
        name = f"part-{TaskContext.get().partitionId():05d}.parquet"
        draft, writer, held, groups, rows = f"{root}/.{name}.{uuid.uuid4().hex}", None, [], 0, 0

        def flush():
            nonlocal writer, groups, rows
            whole = pa.Table.from_batches(held)
            if writer is None:
                schema = whole.schema.with_metadata({**(whole.schema.metadata or {}), **{k.encode(): v.encode() for k, v in (properties or {}).items()}})
                writer = pq.ParquetWriter(draft, schema, filesystem=system)
            writer.write_table(whole.cast(writer.schema), row_group_size=max(1, whole.num_rows))
            groups, rows = groups + 1, rows + whole.num_rows

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(group))
            at, changes = 0, pc.fill_null(pc.not_equal(keys.slice(1), keys.slice(0, max(0, len(keys) - 1))), False).to_pylist() if len(keys) > 1 else []
            nulls = keys.is_null().to_pylist()
            for i in range(1, len(keys) + 1):
                if i == len(keys) or changes[i - 1] or nulls[i] != nulls[i - 1]:
                    piece = batch.slice(at, i - at)
                    first = piece.column(piece.schema.get_field_index(group))[0]
                    if held and held[0].column(held[0].schema.get_field_index(group))[0] != first:
                        flush()
                        held = []
                    held.append(piece)
                    at = i
        if held:
            flush()
        if writer is not None:
            writer.close()
            system.move(draft, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"name": [name], "groups": pa.array([groups], pa.int64()), "rows": pa.array([rows], pa.int64())})

    return settled(ranged.mapInArrow(write, "name string, groups long, rows long"), "row_groups")


def table_properties(properties: dict, config: dict | None = None, required: tuple[str, ...] = REQUIRED) -> dict[str, str]:
    """Key-value metadata of a table: its properties, the configuration's other keys with config_ before them, and a note
    for each required key that is missing."""
    known = {k: str(v) for k, v in properties.items()}
    return known | {f"config_{k}": str(v) for k, v in (config or {}).items() if k not in known} | {k: f"MISSING: {k}" for k in required if k not in known}
