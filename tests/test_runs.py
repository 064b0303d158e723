"""Rounds, limits, failures over runs, listings, footers, ids and rolling states, against plain loops."""

import json
import random

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import export, metadata, metrics, rounds
from corpusloom.plans.pipeline import Corpus
from corpusloom.sources import files, listing


def sequential(ranges, outcome, tries=2, strikes=2):
    """One document's ranges converted one after the other: (complete, status, counted, missing, text)."""
    entries, struck = [], 0
    for start, end in ranges:
        status = "timeout"
        for turn in range(tries):
            status = outcome(start, turn)
            if status != "timeout":
                break
        entries.append((status, f"{start}-{end}"))
        struck += status == "timeout"
        if status == "error" or struck >= strikes:
            return False, status, len(entries), struck, None
    return True, "ok", len(entries), struck, "\n\n".join(t for s, t in entries if s in ("ok", "partial"))


def test_rounds_equal_a_run_in_page_order(spark):
    rng = random.Random(4)
    plans = {f"d{k}": {s: [rng.choice(["ok", "ok", "partial", "timeout", "timeout", "error" if rng.random() < 0.3 else "ok"]) for _ in range(2)] for s in range(1, 1400, 200)} for k in range(40)}
    docs = spark.createDataFrame([(s, 1400) for s in plans] + [("short", 3), ("unanswered", 5)], "stem string, page_count int")
    ranges = files.page_ranges(docs)
    rows = [(d, s, turn, status) for d, p in plans.items() for s, both in p.items() for turn, status in enumerate(both)] + [("short", 1, 0, "ok")]
    told = spark.createDataFrame(rows, "stem string, page_start int, retries int, status string")
    calls = []

    def convert(todo):
        calls.append(todo.count())
        met = todo.join(told, ["stem", "page_start", "retries"])
        return met.select("stem", "page_start", "status", F.lit(1.5).alias("seconds"), F.when(F.col("status").isin("ok", "partial"), F.concat_ws("-", "page_start", "page_end")).alias("text"))

    got = {r["stem"]: r for r in rounds.assembled(rounds.convert_in_rounds(ranges, convert)).collect()}
    assert len(calls) == 2 and calls[1] < calls[0] / 2
    for d, plan in plans.items():
        want = sequential([(s, min(s + 199, 1400)) for s in sorted(plan)], lambda s, t, plan=plan: plan[s][t])
        assert (got[d]["complete"], got[d]["status"], got[d]["chunk_count"], got[d]["missing"], got[d]["text"]) == want, d
        told_entries = json.loads(got[d]["manifest"])["entries"]
        assert [e["index"] for e in told_entries] == list(range(1, want[2] + 1)) and all(e["duration_s"] == 1.5 * (e["retries"] + 1) for e in told_entries)
    assert got["short"]["text"] == "1-3" and (got["unanswered"]["complete"], got["unanswered"]["status"]) == (False, "error")
    none = rounds.convert_in_rounds(ranges.limit(0), convert)
    assert rounds.assembled(none).count() == 0


def test_limits_and_batches(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 500).alias("k"), "id").repartition(7)
    for limit in (0, 1, 333, 1000, 5000):
        got = [(r["k"], r["id"]) for r in rounds.first_rows(rows, limit, "k", "id").collect()]
        assert sorted(got) == sorted(((i * 7919) % 500, i) for i in range(1000))[:limit]
    assert rounds.first_rows(rows, 501, "k").count() == 501
    items = spark.createDataFrame([("a", p) for p in range(7)] + [("b", 0)], "stem string, page_no int")
    assert rounds.capped_pages(items, None) is items and rounds.capped_pages(items, 2).count() == 3
    batches = rounds.batched(items, 3, "page_no")
    times = spark.createDataFrame([("a", 0, 100), ("a", 2, 9)], "stem string, batch int, batch_ms long")
    assert sorted((r["stem"], r["page_no"], r["batch"], r["time_ms"]) for r in rounds.timed_items(batches, times).collect()) == [("a", p, p // 3, {0: 33, 1: 0, 2: 9}[p // 3]) for p in range(7)] + [("b", 0, 0, 0)]


def test_failures_over_runs(spark):
    runs = [[("u", False), ("v", False), ("w", True)], [("u", False), ("v", True), ("v", False)], [("u", False), ("x", False)]]
    counts = None
    for run in runs:
        counts = rounds.counted_failures(counts, spark.createDataFrame([(k, ok, None if ok else "gone") for k, ok in run], "url string, success boolean, error string"))
    assert {r["url"]: (r["download_retry_count"], r["last_error"]) for r in counts.collect()} == {"u": (3, "gone"), "v": (0, None), "w": (0, None), "x": (1, "gone")}
    urls = spark.createDataFrame([(k,) for k in "uvwxy"], "url string")
    assert {r["url"] for r in rounds.worth_trying(urls, counts).collect()} == set("vwxy") and rounds.worth_trying(urls, None) is urls


def test_listing_and_probing(spark, tmp_path):
    for name in ("a.md", "a.docx", "b.CSV", "sub/c.html", "sub/c.pdf", "d.zip", "e.xml", "e.pptx"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    found = listing.list_files(spark, str(tmp_path))
    assert {(r["filename"], r["ext"], r["length"]) for r in found.collect()} >= {("b.CSV", "csv", 1), ("c.pdf", "pdf", 1)}
    stems = spark.createDataFrame([(s,) for s in "abcdef"], "stem string")
    got = {r["stem"]: (r["filename"], r["file_ext"], r["found"]) for r in listing.probed(stems, found.withColumn("stem", F.substring_index("filename", ".", 1))).collect()}
    assert got == {"a": ("a.docx", "docx", True), "b": ("b.CSV", "csv", True), "c": ("c.pdf", "pdf", True), "d": ("d.pdf", "pdf", False), "e": ("e.xml", "xml", True), "f": ("f.pdf", "pdf", False)}
    meta = spark.createDataFrame([("a", "a.pdf", "", "")], "stem string, filename string, processing_stage string, extract_status string")
    saved = metadata.save_state(meta, stems, stems.limit(0), found.withColumn("stem", F.substring_index("filename", ".", 1)))
    assert {r["stem"]: (r["filename"], r["download_success"]) for r in saved.collect()} == {"a": ("a.pdf", None), "b": ("b.CSV", True), "c": ("c.pdf", True), "d": ("d.pdf", False), "e": ("e.xml", True), "f": ("f.pdf", False)}


def test_first_table(spark, tmp_path):
    assert listing.first_table(spark, [str(tmp_path / "nowhere"), str(tmp_path)]) is None
    for name, n in (("z.parquet", 2), ("b.parquet", 1)):
        pd.DataFrame({"url": ["u"] * n}).to_parquet(tmp_path / name)
    assert listing.first_table(spark, [str(tmp_path / "nowhere"), str(tmp_path)]).count() == 1
    assert files.metadata_folders("/a/b/") == ["/a/b", "/a/b/download_results", "/a", "/a/download_results"]


def test_row_groups_and_footers(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 23:02}" if i % 29 else None, i, "x" * (i % 5)) for i in range(400)], "stem string, at int, text string").repartition(5)
    properties = listing.table_properties({"pipeline_version": "1", "source_file": "é"}, {"limit": 3, "source_file": "config"})
    made = listing.write_row_groups(rows, str(tmp_path / "out"), "stem", "at", properties=properties)
    assert made.agg(F.sum("rows"), F.sum("groups")).first() == (400, 24)
    for path in (tmp_path / "out").glob("*.parquet"):
        told = pq.ParquetFile(path)
        for g in range(told.num_row_groups):
            group = told.read_row_group(g).to_pandas()
            assert group["stem"].nunique(dropna=False) == 1 and group["at"].is_monotonic_increasing
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400
    (tmp_path / "out" / "cut.parquet").write_bytes(b"PAR1 and no more")
    footers = {r["filename"]: r for r in listing.read_footers(spark, str(tmp_path)).collect()}
    good = [r for name, r in footers.items() if name != "cut.parquet"]
    assert footers["cut.parquet"]["columns"] is None and sum(r["rows"] for r in good) == sum(n for r in good for n in r["group_rows"]) == 400
    assert good[0]["properties"] == {"pipeline_version": "1", "source_file": "é", "config_limit": "3", "created_at": "MISSING: created_at", "processing_stage": "MISSING: processing_stage"}
    kinds = spark.createDataFrame([(["url", "filename"],), (["filename", "download_success"],), (["id", "header", "section", "filename"],), (["text"],)], "c array<string>")
    assert [r[0] for r in kinds.select(listing.kind_of(F.col("c"))).collect()] == ["metadata", "downloads", "sections", None]
    assert listing.write_row_groups(rows.limit(0), str(tmp_path / "none"), "stem").count() == 0


def test_row_ids_over_many_groups(spark):
    """As many groups as rows, and one group of most rows."""
    for key in (F.col("id") * 7919 % 10007, F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5)):
        rows = spark.range(10007).select(key.alias("g"), "id").repartition(6)
        got = [(r["g"], r["id"]) for r in metadata.row_ids(rows, "g", "id").orderBy("row_id").collect()]
        assert got == sorted((r["g"], r["id"]) for r in rows.collect())
        assert metadata.row_ids(rows, "g", "id").agg(F.min("row_id"), F.max("row_id"), F.countDistinct("row_id")).first() == (0, 10006, 10007)
    assert metadata.row_ids(spark.range(0), "id").count() == 0


def test_easing_over_blocks(spark):
    """A busy key over many ranges and blocks, a key without errors, one of slow attempts, a null key."""
    rng = random.Random(6)
    errors = ["Timeout", "HTTP 429", "HTTP 503", "HTTP 403", "HTTP 404", "reset"]
    made = [(i, rng.choice(["hot"] * 8 + ["slow", "calm", None]), None, 0.0) for i in range(3000)]
    made = [(i, k, rng.choice(errors) if k != "calm" and rng.random() < 0.3 else None, rng.uniform(70, 90) if k == "slow" else rng.uniform(0, 50)) for i, k, _, _ in made]
    rows = spark.createDataFrame(made, "at long, k string, error string, seconds double").repartition(5)
    got = {r["at"]: r for r in metrics.rolling(rows, "k", "at", "error", "seconds", errors=5, durations=20, block=32).collect()}
    assert len(got) == 3000
    for key in ("hot", "slow", "calm", None):
        seen, took = [], []
        for at, _, error, seconds in (m for m in made if m[1] == key):
            took.append(seconds)
            seen += [error] if error else []
            last, mean = seen[-5:], sum(took[-20:]) / len(took[-20:])
            r = got[at]
            assert r["mean_seconds"] == pytest.approx(mean)
            if not last:
                assert r["timeout_share"] is None and not r["easing"]
                continue
            shares = sum("Timeout" in e for e in last) / len(last), sum(e in ("HTTP 429", "HTTP 503", "HTTP 403") for e in last) / len(last)
            assert (r["timeout_share"], r["refused_share"]) == pytest.approx(shares)
            assert r["easing"] == (max(shares) >= 0.2 or mean > 60)
    with pytest.raises(ValueError):
        metrics.rolling(rows, "k", "at", "error", "seconds", block=10)


def test_source_rows_prefer_documents(spark):
    source = spark.createDataFrame([("a__p0001-0200", "chunk", 1), ("a", "own", 2), ("a", "later", 3), ("b__p0201-0300", "second", 4), ("b__p0001-0200", "third", 5), (None, "x", 6), (" ", "y", 7)], "stem string, language string, at int")
    assert {r["stem"]: r["language"] for r in export.source_rows(source, ["language"], order="at").collect()} == {"a": "own", "b": "second"}
    docs = spark.createDataFrame([("a",), ("b",)], "stem string")
    assert export.source_fields(docs, source, ["language"], order="at").count() == 2


def test_downloads_over_runs(spark, tmp_path):
    """The first table of the folder, another column's name, and URLs that fail in every run until they are left out."""
    source = tmp_path / "in"
    source.mkdir()
    pd.DataFrame({"pdf_url": ["http://a.org/x", "http://a.org/bad", "http://a.org/x#again", "http://a.org/late"]}).to_parquet(source / "a.parquet")
    pd.DataFrame({"pdf_url": ["http://z.org/never"]}).to_parquet(source / "z.parquet")
    tried = []

    def fetch(rows):
        tried.append({r["url"] for r in rows.collect()})
        good = F.when(F.col("url").endswith("late"), len(tried) == 3).otherwise(~F.col("url").endswith("bad"))
        return rows.select("url", "filename_base", good.alias("download_success"), F.when(~good, "HTTP 404").alias("download_error"))

    corpus = Corpus(spark, str(source), str(tmp_path / "out"), "pdf_url")
    for _ in range(4):
        results = corpus.download(fetch)
    bad, late = "http://a.org/bad", "http://a.org/late"
    assert tried == [{"http://a.org/x", bad, late}, {bad, late}, {bad, late}, set()]
    assert {r["url"]: r["download_success"] for r in results.collect()} == {"http://a.org/x": True, bad: False, late: True}
    assert {r["url"]: r["download_retry_count"] for r in corpus.table("download_failures").collect()} == {"http://a.org/x": 0, bad: 3, late: 0}
    with pytest.raises(ValueError):
        Corpus(spark, str(tmp_path / "out"), str(tmp_path / "other")).download(fetch)


def test_recognition_takes_a_limit(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("a", "b", "c"):
        (source / f"{name}.md").write_text("GLYPH<c=1,font=/X>\nGLYPH<c=2,font=/X>\n")
    corpus = Corpus(spark, str(source), str(tmp_path / "out"))
    corpus.extract()
    corpus.update(corpus.metadata().select("stem", F.concat("stem", F.lit(".pdf")).alias("filename")))
    corpus.clean()
    seen = []

    def recognise(rows):
        seen.extend((r["stem"], r["max_pages"]) for r in rows.collect())
        return rows.select("stem", F.lit("plain words of a page").alias("text"))

    corpus.ocr(recognise, limit=2, max_pages=7)
    assert sorted(seen) == [("a", 7), ("b", 7)]
    assert {r["stem"] for r in corpus.metadata().where("ocr_success").collect()} == {"a", "b"}
