"""The corpus as one object: phases that read and write tables below a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import canonical_stem
from ..functions.noise import noise_metrics
from ..functions.values import add_stage
from ..operators import annotate, cleaner, export, gates, metadata, metrics, rounds, sections
from ..operators import urls as url_ops
from ..sources import files, listing
from ..sources.scratch import settled
from ..sources.snapshots import Snapshots

#: What an adapter gets and returns: a DataFrame of files or pages in, one of texts or formulas out.
Adapter = Callable[[DataFrame], DataFrame]
#: Keys of the tables; the others have stems.
KEYS = {"download_results": "url", "download_failures": "url"}


def conversion_backend(wanted: str | None = None, recognise: bool = False, enrich: bool = False) -> str:
    """safe (text layer alone) or docling (layout models) for ``wanted``, which may be auto: recognition and enrichment
    need the layout models, whatever is wanted."""
    choice = (wanted or "auto").strip().lower()
    if choice not in ("auto", "safe", "docling"):
        raise ValueError(f"unknown backend {wanted!r}: auto, safe or docling")
    return "docling" if choice == "docling" or recognise or enrich else "safe"


def _added_up(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Failures of earlier runs and of this one; keys without a failure in this run have succeeded and start anew."""
    met = before.select(key, F.col("download_retry_count").alias("__before"), F.col("last_error").alias("__error")).join(now, key, "full_outer")
    count = F.when(F.col("download_retry_count") == 0, 0).otherwise(F.coalesce("__before", F.lit(0)) + F.coalesce("download_retry_count", F.lit(0))).cast("int")
    return met.select(key, count.alias("download_retry_count"), F.when(F.col("download_retry_count") == 0, None).otherwise(F.coalesce("last_error", "__error")).alias("last_error"))


class Corpus:
    """Phases over output folders: downloads, markdown, clean_markdown, sections, export and the metadata table.

    Documents live as (stem, filename, text) rows; external readers, recognisers and fetchers are adapters.
    """

    def __init__(self, spark: SparkSession, input_dir: str, output_dir: str, url_column: str = "url"):
        self.spark, self.input_dir, self.output_dir, self.url_column = spark, input_dir, output_dir, url_column

    def path(self, name: str) -> str:
        return f"{self.output_dir}/{name}"

    def snapshots(self, name: str) -> Snapshots:
        return Snapshots(self.spark, self.path(name), KEYS.get(name, "stem"))

    def has(self, name: str) -> bool:
        return self.snapshots(name).latest() is not None

    def table(self, name: str) -> DataFrame:
        return self.snapshots(name).read()

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        """The table with these rows alone; whoever reads an older version keeps it."""
        self.snapshots(name).replace(rows)
        return self.table(name)

    def merge(self, name: str, rows: DataFrame, how=metadata.merge_results) -> DataFrame:
        """Merges rows by key into the table, which others may change at the same time."""
        self.snapshots(name).merge(rows, how)
        return self.table(name)

    def metadata(self) -> DataFrame:
        """The metadata table; one row per Markdown document where there is none yet."""
        if self.has("metadata"):
            return self.table("metadata")
        found = files.find_metadata(self.spark, [self.path("download_results"), *files.metadata_folders(self.input_dir)], self.url_column)
        base = found if found is not None else self.table("markdown").select("filename")
        return metadata.with_defaults(base.withColumn("stem", canonical_stem(F.col("filename"))))

    def update(self, rows: DataFrame) -> None:
        """Merges rows by stem into the metadata table."""
        if not self.has("metadata"):
            self.merge("metadata", self.metadata(), metadata.upsert)  # another writer's first table is merged with, not replaced
        self.merge("metadata", rows, metadata.upsert)

    def download(self, fetch: Adapter, urls: DataFrame | None = None, most_failures: int = 3) -> DataFrame:
        """Expands link lists, leaves out what is done, repeats or has failed too often, names the rest, fetches and merges
        results, and adds up failures by URL for the runs to come.

        Without ``urls`` the first Parquet file of the input folder is taken. fetch: from (url, filename_base, ...) rows to
        (url, download_success, download_error, ...) rows.
        """
        if urls is None:
            urls = listing.first_table(self.spark, [self.input_dir])
            if urls is None:
                raise ValueError(f"no Parquet file in {self.input_dir}")
        column = url_ops.url_column(urls, self.url_column)
        numbered = urls if "row_idx" in urls.columns else settled(urls.withColumn("row_idx", F.monotonically_increasing_id()), "urls")
        rows = url_ops.explode_links(numbered.withColumnRenamed(column, "url"), "url")
        rows = rows.withColumn("row_idx", F.col("source_row") * 2**31 + F.col("url_index") + 1)  # a cell has fewer than 2^31 links
        marked = url_ops.mark_duplicates(rows)
        done = self.table("download_results").where("download_success") if self.has("download_results") else None
        counts = self.table("download_failures") if self.has("download_failures") else None
        todo = rounds.worth_trying(marked.where(~F.col("is_duplicate") & (F.col("url") != "")), counts, most_failures)
        todo = todo if done is None else metadata.pending(todo, done, key="url")
        used = done.select(F.col("filename_base").alias("name")) if done is not None else self.spark.createDataFrame([], "name string")
        results = settled(fetch(url_ops.assign_names(todo, used)), "downloads")
        error = F.col("download_error") if "download_error" in results.columns else F.lit(None).cast("string")
        failures = rounds.counted_failures(None, results.select("url", F.coalesce("download_success", F.lit(False)).alias("success"), error.alias("error")))
        self.merge("download_failures", failures, _added_up)
        return self.merge("download_results", results)

    def extract(self, convert: Adapter | None = None, formats: str = "all") -> DataFrame:
        """Turns files into Markdown rows, without those that are done or skipped. Text formats need no adapter."""
        found = files.read_files(self.spark, self.input_dir, formats)
        if self.has("markdown"):
            found = metadata.pending(found, self.table("markdown"))
        if self.has("skiplist"):
            found = metadata.pending(found, self.table("skiplist"))
        fine, rejects = cleaner.readable(found)
        texts = fine.where(F.col("ext").isin("md", "csv", "xml", "html")).select("stem", "filename", "text") if convert is None else convert(found)
        self.reject(rejects.where(F.col("ext").isin("md", "csv", "xml", "html")).select("stem")) if convert is None else None
        self.merge("markdown", texts)
        self.update(self.table("markdown").select("stem", "filename", F.lit("success").alias("extract_status")))
        return self.table("markdown")

    def reject(self, stems: DataFrame) -> None:
        """Adds stems to the skip list."""
        self.merge("skiplist", stems.select("stem").distinct())

    def clean(self, drop_bad: bool = True, empty_char_threshold: int = 0, empty_min_pages: int = 0, scripts=("greek", "latin")) -> DataFrame:
        """Cleans and scores documents, gates them, and returns the metadata of the good ones."""
        cleaned, report = cleaner.quality_report(self.table("markdown"), scripts, "stem")
        noise = noise_metrics(self.put("clean_markdown", cleaned).select("stem", "text"))
        scored = report.withColumnsRenamed({"badness_score_all_chars": "mojibake_badness_score", "percentage_greek_cleaned": "percentage_greek", "percentage_latin_cleaned": "latin_percentage"})
        both = scored.join(noise.select("stem", F.bround("score", 3).alias("greek_badness_score"), F.bround("poly_ratio", 2).alias("polytonic_ratio")), "stem")
        gated = gates.gate(gates.settle_columns(metadata.upsert(self.metadata(), both, "stem")), empty_char_threshold, empty_min_pages)
        return gates.good_files(self.put("metadata", gated), drop_bad)

    def ocr(self, recognise: Adapter, reprocess: bool = False, limit: int | None = None, max_pages: int | None = None) -> DataFrame:
        """Sends flagged documents through recognition (stem, filename, max_pages to stem, text), takes its texts, and cleans
        again. At most ``limit`` documents are taken, the first by stem; of each the adapter reads ``max_pages`` pages."""
        skip = self.table("skiplist") if self.has("skiplist") else self.spark.createDataFrame([], "stem string")
        todo = gates.ocr_candidates(self.metadata(), skip, reprocess)
        todo = todo if limit is None else rounds.first_rows(todo.select("stem", "filename"), limit, "stem")
        texts = settled(recognise(todo.select("stem", "filename", F.lit(max_pages).cast("int").alias("max_pages"))), "recognised")
        named = texts.join(todo.select("stem", "filename"), "stem")
        self.merge("markdown", named.select("stem", "filename", "text"))
        stage = self.metadata().join(named.select("stem"), "stem").select("stem", F.lit("ok").alias("filter"), F.lit(False).alias("needs_ocr"), F.lit(True).alias("ocr_success"), add_stage(F.col("processing_stage"), "ocr").alias("processing_stage"))
        self.update(stage)
        return self.clean(drop_bad=False)

    def triage_math(self, pages: DataFrame) -> DataFrame:
        """Formula density from (stem, formula_count) page rows into the metadata."""
        return gates.math_candidates(self.put("metadata", metadata.triage_update(self.metadata(), metrics.math_density(pages))))

    def formula_enrich(self, items: DataFrame) -> DataFrame:
        """Results of formula recognition, (stem, accept_score, time_ms) rows, into the metadata."""
        done = metrics.formula_summary(items).withColumn("time_sec", F.col("time_ms") / 1000)
        return self.put("metadata", metadata.math_update(self.metadata(), done))

    def section(self) -> DataFrame:
        good = gates.section_candidates(self.metadata())
        name = "clean_markdown" if self.has("clean_markdown") else "markdown"
        rows = sections.section_rows(self.table(name).join(good.select("stem"), "stem", "left_semi"), "stem")
        return self.put("sections", rows)

    def annotate(self, label: Adapter, methods: dict[str, str] | None = None, types: DataFrame | None = None) -> DataFrame:
        """Labels sections (an adapter adds the column label), corrects contents lists, and annotates by document type."""
        labelled = annotate.override_contents(label(self.table("sections")), "stem")
        typed = self.metadata().select("stem", "filename", "document_type")
        typed = typed if types is None else annotate.with_document_types(typed, types)
        joined = labelled.join(typed.select("stem", "document_type"), "stem", "left")
        return self.put("annotated", annotate.annotate(joined, annotate.annotation_method(F.col("document_type"), methods or {}), "stem"))

    def export_lines(self, **options) -> DataFrame:
        name = "clean_markdown" if self.has("clean_markdown") else "markdown"
        gathered = export.gather_chunks(self.metadata().withColumn("language", F.lit(None).cast("string")))
        return export.records(export.joined_texts(self.table(name)), gathered, **options)

    def jsonl(self, path: str, single: bool = False, **options) -> None:
        files.write_jsonl(self.export_lines(**options), path, single)

    def jsonl_sharded(self, path: str, limit: int = export.SHARD_BYTES, prefix: str = "train", compression: str = "zstd") -> DataFrame:
        return files.write_shards(export.assign_shards(self.export_lines(), limit), path, prefix, compression)

    def process_all(self, label: Adapter, convert: Adapter | None = None, urls: DataFrame | None = None, fetch: Adapter | None = None) -> DataFrame:
        if fetch is not None:
            self.download(fetch, urls)
        self.extract(convert)
        self.section()
        return self.annotate(label)
