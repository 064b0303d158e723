"""Files of a corpus as DataFrames, and back."""

from __future__ import annotations

import io
import uuid

import pandas as pd
import zstandard

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import base_name, canonical_stem
from ..functions.urls import SUPPORTED
from .listing import arrow_folder
from .scratch import settled
from .snapshots import Snapshots

PAGE = "page_no int, formula_count int, code_count int, formula_chars long, formula_truncated int, parse_sec double, time_sec double"
METRICS = f"file string, page_count int, totals map<string,double>, pages array<struct<{', '.join(f.replace(' ', ':', 1) for f in PAGE.split(', '))}>>"
LATEX_MAP = "page_no int, item_index int, latex string, accept_score double, time_ms double"


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("filename", base_name(F.col("_metadata.file_path"))).withColumn("stem", canonical_stem(F.col("filename")))


def read_markdown(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(filename, stem, text) of the Markdown files of a folder."""
    reader = spark.read.option("wholetext", True).option("pathGlobFilter", "*.md").option("recursiveFileLookup", recursive)
    return _named(reader.text(path)).select("filename", "stem", F.col("value").alias("text"))


def read_files(spark: SparkSession, path: str, formats: str = "all", names: DataFrame | None = None) -> DataFrame:
    """(filename, stem, ext, content) of files of the wanted formats: all, one, or a comma list; old Word files never."""
    wanted = SUPPORTED if formats == "all" else tuple("xml" if f.strip() == "xml_jats" else f.strip() for f in formats.split(","))
    df = _named(spark.read.format("binaryFile").load(path)).withColumn("ext", F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1)))
    df = df.where(F.col("ext").isin(*[f for f in wanted if f != "doc"])).select("filename", "stem", "ext", "content")
    return df if names is None else df.join(names.select("filename").distinct(), "filename", "left_semi")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(stem, page_count, formula_total, code_total, pages) of metrics files; plain metrics before per-page ones."""
    files = _named(spark.read.schema(METRICS).option("multiLine", True).option("pathGlobFilter", "*metrics.json").json(path))
    plain = F.endswith("filename", F.lit(".per_page.metrics.json")).cast("int")
    best = files.groupBy("stem").agg(F.min_by(F.struct("page_count", "pages"), plain).alias("m"))
    total = lambda c: F.aggregate(F.coalesce("m.pages", F.array()), F.lit(0).cast("long"), lambda a, p: a + F.coalesce(p[c], F.lit(0)))
    return best.select("stem", F.coalesce("m.page_count", F.size("m.pages")).alias("page_count"), total("formula_count").alias("formula_total"), total("code_count").alias("code_total"), "m.pages")


def read_latex_maps(spark: SparkSession, path: str) -> DataFrame:
    """(stem, page_no, item_index, latex, accept_score, time_ms); unreadable lines are skipped."""
    rows = _named(spark.read.schema(LATEX_MAP).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.latex_map.jsonl").json(path))
    return rows.drop("filename")


def read_sidecars(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _named(spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(path))


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_compressed_json(files: DataFrame) -> Column:
    """The text of .json and .json.zst contents (column content of read_files)."""

    @F.pandas_udf("string")
    def text(contents: pd.Series) -> pd.Series:
        def one(data: bytes) -> str:
            if data[:4] == b"\x28\xb5\x2f\xfd":  # the mark of a zstd frame
                data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
            return data.decode("utf-8")

        return contents.map(one, na_action="ignore")

    return text(files["content"])


def page_ranges(docs: DataFrame, pages: str = "page_count", longest: int = 600, step: int = 200) -> DataFrame:
    """(…, page_start, page_end): documents over the limit cut in ranges, others whole."""
    starts = F.when(F.col(pages) > longest, F.sequence(F.lit(1), F.col(pages), F.lit(step))).otherwise(F.array(F.lit(1)))
    cut = docs.withColumn("page_start", F.explode(starts))
    return cut.withColumn("page_end", F.when(F.col(pages) > longest, F.least(F.col("page_start") + step - 1, F.col(pages))).otherwise(F.col(pages)))


def write_jsonl(lines: DataFrame, path: str, single: bool = False) -> None:
    """JSON Lines in stem order, in parts whose names keep the order; ``single`` has one task write one part.

    An empty table writes an empty part.
    """
    ordered = lines.orderBy("stem").select("line")
    (ordered.coalesce(1) if single else ordered).write.mode("overwrite").text(path)


def write_shards(lines: DataFrame, path: str, prefix: str = "train", compression: str = "zstd", level: int = 3) -> DataFrame:
    """Writes (stem, line, shard) rows as files {prefix}-{shard}.jsonl[.zst] below a path that all executors reach.

    A shard is a sorted stretch of one partition. It is streamed line by line into a file of another name, which is
    then moved to its own, so that a repeated task replaces a file and never leaves half of one. Returns (shard, name,
    rows, bytes) of the files.
    """
    name = F.format_string(f"{prefix}-%06d.jsonl" + (".zst" if compression == "zstd" else ""), "shard")
    columns = lines.select("shard", "stem", "line", name.alias("name"))
    n = max(1, lines.agg(F.coalesce(F.max("shard"), F.lit(0)) + 1).first()[0])
    ordered = columns.repartitionByRange(n, "shard").sortWithinPartitions("shard", "stem")

    def write(batches):
        system, root = arrow_folder(path)
        system.create_dir(root)

        class Shard:
            def __init__(self, number: int, label: str):
                self.number, self.label, self.rows, self.draft = number, label, 0, f"{root}/.{label}.{uuid.uuid4().hex}"
                self.file = system.open_output_stream(self.draft, compression=None)
                self.out = zstandard.ZstdCompressor(level=level).stream_writer(self.file) if compression == "zstd" else self.file

            def close(self) -> pd.DataFrame:
                self.out.close()
                system.move(self.draft, f"{root}/{self.label}")
                return pd.DataFrame([(self.number, self.label, self.rows, system.get_file_info(f"{root}/{self.label}").size)], columns=["shard", "name", "rows", "bytes"])

        shard = None
        for batch in batches:
            for number, label, line in zip(batch["shard"], batch["name"], batch["line"], strict=True):
                if shard is not None and shard.number != number:
                    yield shard.close()
                    shard = None
                shard = shard or Shard(number, label)
                shard.out.write(f"{line}\n".encode())
                shard.rows += 1
        if shard is not None:
            yield shard.close()

    return settled(ordered.mapInPandas(write, "shard long, name string, rows long, bytes long"), "shards")


def write_report(report: DataFrame, path: str, key: str = "file_name") -> None:
    """The per-file report as CSV, sorted by name, with fixed decimals and N/A."""
    show = lambda c, form: F.coalesce(F.format_string(form, F.col(c)), F.lit("N/A"))
    report.orderBy(key).select(F.col(key).alias("File Name"), show("badness_score_all_chars", "%.4f").alias("Badness"), show("percentage_greek_cleaned", "%.2f%%").alias("Greek Percentage"), show("percentage_latin_cleaned", "%.2f%%").alias("Latin Percentage")).write.mode("overwrite").option("header", True).csv(path)


def metadata_folders(folder: str) -> list[str]:
    """Where the metadata of a folder's documents may lie, in order: the folder, its downloads, and the same of its parent."""
    inner = folder.rstrip("/")
    parent = inner.rpartition("/")[0]
    return [f"{base}{part}" for base in ([inner, parent] if parent and not parent.endswith("/") else [inner]) for part in ("", "/download_results")]


def find_metadata(spark: SparkSession, folders: list[str], url_column: str = "url") -> DataFrame | None:
    """The first metadata table among the folders' Parquet files: with quality columns first, then downloads, then any."""
    from ..operators.metadata import table_kind

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    tables = []
    for folder in folders:
        where = jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(conf)
        if fs.exists(where):
            paths = sorted(s.getPath().toString() for s in fs.listStatus(where) if s.getPath().getName().endswith(".parquet"))
            table = Snapshots(spark, folder)
            tables += ([table.read()] if table.latest() is not None else []) + [spark.read.parquet(p) for p in paths]
    quality = {"mojibake_badness_score", "greek_badness_score", "filter", "needs_ocr"}
    for fits in (lambda d: bool(quality & set(d.columns)), lambda d: table_kind(d, url_column) == "downloads", lambda d: True):
        for d in tables:
            if "filename" in d.columns and table_kind(d, url_column) != "sections" and fits(d):
                return d
    return None
