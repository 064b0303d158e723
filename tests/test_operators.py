"""Operators on small tables with results worked out by hand."""

import pyarrow as pa
import pytest
import zstandard
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import slices
from corpusloom.operators import annotate, artefacts, cleaner, export, gates, metadata, metrics, sections, urls
from corpusloom.sources import files
from corpusloom.sources.snapshots import Snapshots
from corpusloom.streaming import resume


def clean(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", cleaner.clean_text(F.col("text")).alias("c")).orderBy("i").collect()
    return [tuple(r["c"]) for r in rows]


def test_clean_lines(spark):
    got = clean(spark, "<b>hello</b>", "Grüße äöß", "a <longer tag> b", "GLYPH<c=1>", "$$ GLYPH< $$ x", None, "", "x\n<!-- keep -->\n", "<!-- text-missing -->")
    assert got[0] == ("hello", 12, 5)
    assert got[1][0] == "Grüe "
    assert got[2][0] == "a  b <!-- text-missing -->"
    assert got[3] == ("<!-- text-missing -->", 10, 0)
    assert got[4][0] == "$$ GLYPH< $$ x"
    assert got[5] == (None, None, None) and got[6] == ("", 0, 0)
    assert got[7][0] == "x\n<!-- keep -->\n"
    assert got[8] == ("<!-- text-missing -->", 21, 0)


def test_maths_carries_over_lines(spark):
    text, judged, kept = clean(spark, "a $$ x\nü <b> y\n$$ ü")[0]
    assert text == "a $$ x\nü  y\n$$ ü"
    assert judged == len("a ") + len(" ü")


def test_tables(spark):
    docs = spark.createDataFrame([(1, "| a | b |\n|---|---|\n| 1 | 2 | 3 |\nend\n"), (2, "t\n|---|\n| 1 | 2 |"), (3, "| a | b |\n|---|---|\n| 1 | 2 |"), (4, None)], "doc_id int, text string")
    issues = cleaner.table_issues(docs)
    got = sorted(tuple(r) for r in issues.collect())
    assert got == [
        (1, 3, "Table row has inconsistent column count", 2, 3, 0, 2), (2, 2, "Table separator without header row", None, 1, 1, 2), (2, 3, "Table row has inconsistent column count", 1, 2, 1, 2),
    ]
    texts = {r["doc_id"]: r["text"] for r in cleaner.remove_tables(docs, issues).collect()}
    assert texts == {1: "<!-- table-removed -->\nend\n", 2: "t\n<!-- table-removed -->", 3: "| a | b |\n|---|---|\n| 1 | 2 |", 4: None}


def test_second_cleaning_is_scored(spark):
    docs = spark.createDataFrame([(1, "fine line\nGLYPH<c=1,font=/X>\n"), (2, "plain words only")], "doc_id int, text string")
    report = {r["doc_id"]: r for r in cleaner.quality_report(docs)[1].collect()}
    assert report[1]["badness_score_all_chars"] == round(1 - 9 / 30, 3)
    assert report[2]["badness_score_all_chars"] == 0 and not report[2]["is_empty"]


def test_gates(spark):
    rows = [("a.pdf", 0, 0.0, None, None), ("b.pdf", 9, 0.2, 70.0, 1), ("c.html", 9, 0.2, None, 1), ("d.PDF", None, None, None, None)]
    meta = spark.createDataFrame(rows, "filename string, char_count_no_comments long, mojibake_badness_score double, greek_badness_score double, page_count int")
    got = {r["filename"]: (r["filter"], r["needs_ocr"]) for r in gates.gate(meta).collect()}
    assert got == {"a.pdf": ("is_empty", True), "b.pdf": ("mojibake>0.1;non_greek_text", True), "c.html": ("ok", False), "d.PDF": ("ok", False)}
    short = {r["filename"]: (r["filter"], r["needs_ocr"]) for r in gates.gate(meta, 10, 2).collect()}
    assert short["a.pdf"] == ("empty_text<10", True) and short["b.pdf"][0] == "mojibake>0.1;non_greek_text;empty_text<10_short"


def test_duplicates_and_names(spark):
    rows = spark.createDataFrame([(0, "http://u1"), (1, "http://u1#t"), (2, ""), (3, ""), (4, "http://u2")], "row_idx long, url string")
    marked = {r["row_idx"]: (r["is_duplicate"], r["duplicate_of"]) for r in urls.mark_duplicates(rows).collect()}
    assert marked == {0: (False, ""), 1: (True, "http://u1"), 2: (False, ""), 3: (True, ""), 4: (False, "")}
    used = spark.createDataFrame([("AAA_000",), ("AAC_002",)], "name string")
    named = {r["row_idx"]: r["filename_base"] for r in urls.assign_names(rows.drop("url"), used).collect()}
    assert named == {0: "AAB_001", 1: "AAD_003", 2: "AAE_004", 3: "AAF_005", 4: "AAG_006"}
    with pytest.raises(ValueError):
        urls.url_column(rows.select("row_idx"))


def test_links_keep_rows_without_any(spark):
    rows = spark.createDataFrame([(0, '["u1","u2"]'), (1, None)], "row_idx long, url string")
    got = sorted((r["source_row"], r["url_index"], r["url"]) for r in urls.explode_links(rows).collect())
    assert got == [(0, 0, "u1"), (0, 1, "u2"), (1, -1, "")]


def test_upsert_and_synthesis(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "filename string, n int, keep string")
    new = spark.createDataFrame([("a", None, 5.0), ("c", 3, 6.0)], "filename string, n int, more double")
    got = {r["filename"]: tuple(r)[1:] for r in metadata.upsert(base, new).collect()}
    assert got == {"a": (1, "x", 5.0), "b": (2, "y", None), "c": (3, None, 6.0)}
    parts = spark.createDataFrame([("a", 1, "download", None), ("a", 3, "extract", 7), ("a", 2, "extract", 4)], "stem string, rank int, stage string, page_count int")
    row = metadata.synthesize(parts).first()
    assert (row["page_count"], row["processing_stage"], row["filename"], row["filter"], row["needs_ocr"]) == (7, "download,extract", "a.pdf", "ok", False)
    kept = metadata.synthesize(parts, spark.createDataFrame([("a", 9)], "stem string, page_count int")).first()
    assert kept["page_count"] == 9


def test_state(spark):
    meta = spark.createDataFrame([("a", "a.pdf", "download", "")], "stem string, filename string, processing_stage string, extract_status string")
    ok, bad = spark.createDataFrame([("a",), ("b",)], "stem string"), spark.createDataFrame([("b",)], "stem string")
    got = {r["stem"]: (r["filename"], r["extract_status"], r["processing_stage"]) for r in metadata.save_state(meta, ok, bad).collect()}
    assert got == {"a": ("a.pdf", "success", "download,extract"), "b": ("b.pdf", "failed", None)}
    fine, failed = metadata.load_state(metadata.save_state(meta, ok, bad), spark.createDataFrame([("m",)], "stem string"))
    assert {r["stem"] for r in fine.collect()} == {"a", "m"} and {r["stem"] for r in failed.collect()} == {"b"}


def test_sections(spark):
    text = "intro\n\n# One\n- x\nmore\n\nshort\n| a |\na line that is longer than twenty\n## \nlast"
    rows = {r["id"]: r for r in sections.section_rows(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()}
    assert [rows[i]["header"] for i in range(3)] == ["intro", "One", "#"]
    assert (rows[0]["content"], rows[0]["place"], rows[0]["section_length"]) == ("intro\n", "0.00-0.09", 1)
    assert [rows[1][f"has_{k}"] for k in ("table", "list", "other", "text")] == [True] * 4
    assert sum(r["section_length"] for r in rows.values()) == 7 and rows[1]["section_propo"] == 714


def test_annotation(spark):
    labels = ["άλλο", "π", "άλλο", "β", "άλλο", "β", "άλλο"]
    rows = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(labels)] + [(2, 1, "β"), (2, 2, "π"), (2, 3, "άλλο")], "doc_id int, id int, label string")
    got = [r["label"] for r in annotate.annotate_text(rows).where("doc_id = 1").orderBy("id").collect()]
    assert got == ["ε.σ.", "π", "κ", "β", "κ", "β", "α"]
    assert [r["label"] for r in annotate.annotate_text(rows).where("doc_id = 2").orderBy("id").collect()] == ["β", "π", "άλλο"]
    assert {r["label"] for r in annotate.annotate_chapters(rows).collect()} == {"κ", "β"}


def test_contents_lists(spark):
    of = lambda *numbers, form="| Title {c} ........ | {p} |": "\n".join(form.format(c=c, p=p) for c, p in zip("ABCDEFGHIJK", numbers, strict=False))
    cases = [
        (of(1, 3, 3, 5, 9, 12, 20, 44), True, [1, 3, 3, 5, 9, 12, 20, 44]), (of(8, 7, 6, 5, 4, 3, 2, 1), False, [8, 7, 6, 5, 4, 3, 2, 1]), ("no numbers", False, []), (None, False, None),
        (of(1, 1, 1, 1, 1, 1, 1, 2, 3, 4, 5), True, [1] * 7 + [2, 3, 4, 5]), (of(1, 1, 1, 1, 1, 1, 1, 2, 3), False, [1] * 7 + [2, 3]),  # the fifth equal one begins anew
        (of(1, 2, 5, 9), True, [1, 2, 5, 9]), (of(1, 2, 5, 9) + "\nand\nwords", False, [1, 2, 5, 9]), (of(1, 2, 9, 5), False, [1, 2, 9, 5]), (of(1, 2, 5), False, [1, 2, 5]),
        (of(1, 2, 3, 4, 5, 6, 7, 8, form="Title {c} ........ {p}"), False, []), (of(1, 2, 3, 4, form="| Title {c} | from {p}-99 |"), True, [1, 2, 3, 4]),
        (of(1, 2, 3, 4, form="| Title {c} | {p} pages |"), False, []), (of(1, 2, 3, 4, form="| {p} | 1.5 {p} 400 |"), False, []), (of(1, 2, 3, 4, form="| Title {c} | {p} 400 1.5 |"), True, [1, 2, 3, 4]),
        (of(1, 2, 3, 4, form="| Title {c}\nmore | {p} |"), False, [1, 2, 3, 4]),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, t string")
    got = rows.orderBy("i").select(annotate.is_contents_list(F.col("t")), annotate.page_numbers(F.col("t"))).collect()
    assert [(r[0], r[1]) for r in got] == [(listed, numbers) for _, listed, numbers in cases]


def test_percentiles(spark):
    rows = spark.createDataFrame([("a", v) for v in (0, 0, 1, 2, 3, 4, 5, 9, 10, 11)], "stem string, formula_count int")
    dense = metrics.math_density(rows).first()
    assert (dense["formula_p90_pp"], dense["formula_total"], dense["pages_with_formula"], dense["phase_recommended"]) == (pytest.approx(10.1), 45, 8, "2A")
    assert metrics.nearest_rank(rows, "stem", "formula_count", 0.9).first()["p"] == 10


def test_chunks(spark):
    rows = [("d", 0, None, None, None, "ok"), ("d__p0001-0200", 100, 0.2, "false", None, "a"), ("d__p0201-0400", 300, 0.4, "true", "el", "a;b"), ("e", 5, 0.1, None, "en", "ok")]
    meta = spark.createDataFrame(rows, "stem string, char_count_no_comments long, mojibake_badness_score double, needs_ocr string, language string, filter string").withColumn("is_empty", F.lit(None).cast("boolean"))
    got = {r["stem"]: r for r in export.gather_chunks(meta).collect()}
    d = got["d"]
    assert (d["char_count_no_comments"], d["mojibake_badness_score"], d["needs_ocr"], d["language"], d["filter"], d["chunks"]) == (400, 0.35, True, "el", "a;b;chunk_needs_ocr", 2)
    assert (got["e"]["filter"], got["e"]["char_count_no_comments"]) == ("ok", 5)


def test_shards_and_records(spark):
    lines = spark.createDataFrame([("a", "x" * 29), ("b", "x" * 29), ("c", "x" * 49), ("d", "x" * 9)], "stem string, line string")
    assert [r["shard"] for r in export.assign_shards(lines, 50).orderBy("stem").collect()] == [0, 1, 2, 3]
    assert [r["shard"] for r in export.assign_shards(lines, 60).orderBy("stem").collect()] == [0, 0, 1, 1]
    docs = spark.createDataFrame([("a", "té")], "stem string, text string")
    meta = spark.createDataFrame([("a", None, float("nan"), "kept")], "stem string, page_count int, score double, extra_meta string")
    line = export.records(docs, meta).first()["line"]
    assert line.startswith('{"document":"té","doc_id":"ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"')
    assert '"score":null' in line and '"extra_meta":"kept"' in line


def test_source_fields_stop_on_gaps(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "stem string")
    source = spark.createDataFrame([("a", "el")], "stem string, language string")
    assert export.source_fields(docs.where("stem = 'a'"), source, ["language"]).first()["language"] == "el"
    with pytest.raises(PySparkException):
        export.source_fields(docs, source, ["language"]).collect()
    with pytest.raises(ValueError):
        export.source_fields(docs, source, ["missing"])


def test_stream_resumes(spark, tmp_path):
    files, table = tmp_path / "in", str(tmp_path / "table")
    files.mkdir()
    (files / "a.md").write_text("first")
    step = lambda batch: batch.select("stem", F.length("text").alias("n"))
    for name, text in ((None, None), ("b.md", "second one"), (None, None)):
        if name:
            (files / name).write_text(text)
        query = resume.process_new(resume.new_markdown(spark, str(files)), step, table, str(tmp_path / "state"))
        query.awaitTermination()
    assert {r["stem"]: r["n"] for r in Snapshots(spark, table).read().collect()} == {"a": 5, "b": 10}


def test_artefacts(spark):
    chunks = spark.createDataFrame([("a", 1, 200, "ok"), ("a", 201, 300, "timeout"), ("b", 1, 9, "error"), ("c", 1, 5, "ok")], "stem string, page_start int, page_end int, status string")
    assert {r["stem"]: (r["complete"], r["given_up"]) for r in artefacts.chunk_manifest(chunks).collect()} == {"a": (False, False), "b": (False, True), "c": (True, False)}
    names = spark.createDataFrame([("a.pdf",), ("b1.pdf",), ("b1.pdf",), ("c.md",)], "filename string")
    assert sorted(r["filename"] for r in artefacts.matching_names(names, ["a.pdf", "x/b?.pdf"]).collect()) == ["a.pdf", "b1.pdf"]
    grey, speck = [128, 130, 126] * 2000, [0, 0, 0]
    pages = spark.createDataFrame([(bytearray(x),) for x in (grey, grey[3:] + speck, grey[60:] + speck * 20, [])] + [(None,)], "p binary")
    assert [r[0] for r in pages.select(artefacts.is_mostly_blank(F.col("p"))).collect()] == [True, True, False, True, None]
    see_through = spark.createDataFrame([(bytearray([9, 9, 9, 0, 9, 9, 9, 255]),)], "p binary")
    assert see_through.select(artefacts.is_mostly_blank(F.col("p"), alpha=True)).first()[0]


def test_shards_of_many_ranges_are_one_greedy_fill(spark):
    sizes = [(i * 7919) % 90 + (200 if i % 97 == 0 else 0) for i in range(1500)]
    rows = [(f"{i:05}", "x" * n) for i, n in enumerate(sizes)]
    want, shard, used = [], -1, 101
    for n in sizes:
        if used + n + 1 > 100:
            shard, used = shard + 1, 0
        used += n + 1
        want.append(shard)
    got = export.assign_shards(spark.createDataFrame(rows, "stem string, line string"), 100).orderBy("stem").collect()
    assert [r["shard"] for r in got] == want


@pytest.mark.parametrize("compression", ["zstd", "none"])
def test_shard_files(spark, tmp_path, compression):
    """Real files of compressed lines, filled greedily in stem order; a larger line has a shard of its own."""
    sizes = [30, 30, 50, 10, 120, 5]
    rows = spark.createDataFrame([(f"s{i}", "x" * (n - 1)) for i, n in enumerate(sizes)], "stem string, line string")
    made = files.write_shards(export.assign_shards(rows, 50), str(tmp_path), "part", compression).orderBy("shard").collect()
    names = [f"part-{i:06d}.jsonl" + (".zst" if compression == "zstd" else "") for i in range(6)]
    assert [r["name"] for r in made] == names and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == names
    for r, n in zip(made, sizes, strict=True):
        data = (tmp_path / r["name"]).read_bytes()
        text = zstandard.ZstdDecompressor().stream_reader(data).read() if compression == "zstd" else data
        assert (len(data), text) == (r["bytes"], b"x" * (n - 1) + b"\n")


def test_names_past_their_period(spark):
    row = spark.range(1).select(urls.unique_name(F.lit(5)).alias("a"), urls.unique_name(F.lit(urls.NAME_PERIOD + 5)).alias("b")).first()
    assert (row["a"], row["b"]) == ("AAF_005", "AAF_005_1")
    ranks = urls.bucketed_rank(spark.createDataFrame([(i,) for i in [*range(50), 10**15]], "row_idx long"), "row_idx", "r", rows_per_bucket=10)
    assert [r["r"] for r in ranks.orderBy("row_idx").collect()] == list(range(51))


def test_letters_lost(spark):
    rows = spark.createDataFrame([("ab c d", "ab d"), ("  ", ""), ("", ""), ("x", "x")], "a string, b string")
    assert [r[0] for r in rows.select(cleaner.badness_of_letters(F.col("a"), F.col("b"))).collect()] == [0.25, 0.0, 0.0, 0.0]


def test_timing_summary_over_ranges(spark):
    """A key of most rows, a null key and null values, over many ranges, against a plain list."""
    made = [("hot" if i % 10 else None, i, None if i % 7 == 0 else (i * 37) % 101) for i in range(600)] + [("one", 0, 5), ("none", 1, None)]
    got = {r["k"]: r for r in metrics.timing_summary(spark.createDataFrame(made, "k string, at int, ms long"), "k", "ms", "at", rows_per_bucket=40).collect()}
    assert set(got) == {"hot", None, "one", "none"}
    for key, r in got.items():
        held = [v for k, _, v in sorted((m for m in made if m[0] == key), key=lambda m: m[1])]
        known = [v for v in held if v is not None]
        assert (r["n"], r["total"]) == (len(known), sum(known) if known else None)
        assert [r["p50"], r["p90"]] == [held[round((len(held) - 1) * q)] for q in (0.5, 0.9)]
    assert metrics.timing_summary(spark.createDataFrame([], "k string, at int, ms long"), "k", "ms", "at").count() == 0


def test_split_limits_are_exact(spark):
    """45 rows at 0.7 make 31.5, which is 32 as a decimal and 31 as a double; null labels and keys are rows as well."""
    rows = spark.createDataFrame([(i, 1) for i in range(45)] + [(i, None) for i in range(9)] + [(None, None)], "k long, y int")
    got = annotate.stratified_split(rows, "y", "k", {"train": 0.7, "validation": 0.15, "test": 0.15}).groupBy("y", "part").count().collect()
    assert {(r["y"], r["part"]): r["count"] for r in got} == {(1, "train"): 32, (1, "validation"): 6, (1, "test"): 7, (None, "train"): 7, (None, "validation"): 2, (None, "test"): 1}


def test_shard_ranges_are_not_sorted_in_the_chain(spark, monkeypatch):
    """The one task that chains ranges reads what they wrote, instead of sorting all of them itself."""
    plans, settled = {}, export.settled
    monkeypatch.setattr(export, "settled", lambda df, name: (plans.__setitem__(name, df._jdf.queryExecution().executedPlan().toString()), settled(df, name))[1])
    lines = spark.createDataFrame([(f"{i:05}", "x" * (i % 90)) for i in range(1500)], "stem string, line string")
    assert export.assign_shards(lines, 100).count() == 1500
    assert plans["chained"].count("MapInPandas") == 1 and plans["chained"].count("Sort [") == 1


def test_sections_are_made_slice_by_slice(spark):
    """A worker makes the rows of a few texts at a time, and only the fields that are wanted."""
    big = pa.array(["x" * 400_000] * 5 + ["", None, "y" * 3_000_000, "z"])
    assert list(slices.cuts(big)) == [(0, 2), (2, 2), (4, 3), (7, 1), (8, 1)]
    assert [len(x) for x in slices.slices(big)] == [2, 2, 3, 1, 1]
    docs = spark.createDataFrame([(1, "# A\n- one\n\nx\n# B\n| a |"), (None, "# C"), (3, None), (4, "")], "doc_id int, text string")
    every = sections.section_rows(docs)
    some = sections.section_rows(docs, fields=("id", "has_list", "section_propo"))
    assert some.columns == ["doc_id", "id", "section_propo", "has_list"]
    assert sorted(map(str, some.collect())) == sorted(map(str, every.select(some.columns).collect()))
    assert every.count() == 3


SLICED = {
    "section_stats": "id,section_length,section_propo,has_table,has_list,has_other,has_text", "index_override": "id,content,section_length,section_propo",
    "section_classifier": "id,header,content,has_table,has_list,has_other,has_text",
}


@pytest.mark.parametrize("name", SLICED)
def test_a_query_takes_sections_slice_by_slice(spark, tiny, monkeypatch, name):
    """Of a large batch a worker has cut no more than a slice before it passes rows on, and makes the query's fields only."""
    from corpusloom.plans import corpus

    class Caught(Exception):
        pass

    def caught(df, found, schema):
        raise Caught(found)

    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", caught)
    with pytest.raises(Caught) as error:
        getattr(corpus, name)(spark, tiny)
    cut, sections_of = [], sections.sections_of
    monkeypatch.setattr(sections, "sections_of", lambda text: (cut.append(len(text)), sections_of(text))[1])
    text = "# A\n- one\n# B\n| a |\n" * 15_000
    made = []
    for batch in error.value.args[0](iter([pa.record_batch({"doc_id": list(range(12)), "text": [text] * 12})])):
        made.append(batch)
        assert sum(cut) <= len(made) * slices.SLICE_BYTES
    assert len(made) == 4 and pa.Table.from_batches(made)["doc_id"].to_pylist() == [i for i in range(12) for _ in range(30_000)]
    assert sorted(made[0].schema.names) == sorted(["doc_id", *SLICED[name].split(",")])


def test_cells_of_a_page_are_judged_once(spark, tiny):
    """Repeated cells are counted before they are decoded."""
    from corpusloom.plans import documents

    plan = documents.placeholder_cells(spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2


def test_cleaning_by_slices(spark):
    """Texts of several slices, nulls among them, come back in order; a worker passes each slice on at once."""
    big = "ж" * 300_000 + "\nkept line\n"
    texts = [None, "", big, "plain", None, big, "GLYPH<c=1>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", cleaner.clean_text(F.col("text")).alias("c"))
    assert [r["c"]["text"] for r in rows.orderBy("i").collect()] == [None, "", "<!-- text-missing -->\nkept line\n", "plain", None, "<!-- text-missing -->\nkept line\n", "<!-- text-missing -->"]
