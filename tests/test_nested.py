"""Nested documents: tidying, files there and back, metrics of pages."""

import json

import pytest
import zstandard
from pyspark.sql import functions as F

from corpusloom.operators import metrics
from corpusloom.sources import files, nested


def tidy(spark, *texts, meta=None):
    rows = spark.createDataFrame([(i, t, meta) for i, t in enumerate(texts)], "i int, t string, m string")
    return [r[0] for r in rows.select(nested.tidy_documents(F.col("t"), F.col("m")).alias("d"), "i").orderBy("i").collect()]


def test_tidy(spark):
    deep = '{"a":' * 40 + '{"l":1.005,"n":1.005,"t":[2.999,{"r":"é​"}],"confidence":0.987}' + "}" * 40
    flat, odd, none, wrong, listed, bad = tidy(spark, deep, '{"meta":{"own":1,"source":0}}', None, "{", '[{"b":1.239}]', '{"meta":3}', meta='{"source":"s"}')
    inner = json.loads(flat)
    for _ in range(40):
        inner = inner["a"]
    assert inner == {"l": 1.0, "n": 1.005, "t": [3.0, {"r": "é"}], "confidence": 0.99}
    settings = {"coord_precision": 2, "confid_precision": 2, "image_mode": "referenced"}
    assert json.loads(odd)["meta"] == {"own": 1, "source": "s"} | settings and ", " not in odd
    assert (none, wrong, listed) == (None, None, '[{"b":1.24}]')
    assert json.loads(bad)["meta"] == {"source": "s"} | settings
    assert tidy(spark, "{" * 5, '{"x":' * 100_000 + "1" + "}" * 100_000) == [None, None]


@pytest.mark.parametrize("compress", [True, False])
def test_files_there_and_back(spark, tmp_path, compress):
    rows = spark.createDataFrame([("a", '{"x":"é"}'), ("b.c", "[]"), ("gone", None), ("long", json.dumps({"t": "y" * 3_000_000}))], "stem string, document string")
    made = {r["stem"]: (r["name"], r["bytes"]) for r in nested.write_documents(rows, str(tmp_path / "out"), compress).collect()}
    assert made["gone"] == (None, 0) and made["a"][0] == "a.docling.json" + ".zst" * compress
    assert (made["long"][1] < 5000) is compress
    back = {r["stem"]: r["document"] for r in nested.read_documents(spark, str(tmp_path / "out")).collect()}
    assert back == {r["stem"]: r["document"] for r in rows.where("document is not null").collect()}


def test_compressed_json_of_several_frames(spark, tmp_path):
    pack = zstandard.ZstdCompressor().compress
    (tmp_path / "x.json.zst").write_bytes(pack(b'{"a":') + pack(b"1}"))
    (tmp_path / "y.json").write_text("{}")
    found = files.read_files(spark, str(tmp_path), "json,zst")
    assert sorted(r[0] for r in found.select(files.read_compressed_json(found)).collect()) == ["{}", '{"a":1}']


def test_pages(spark, tmp_path):
    node = lambda label, text, *pages, **more: {"label": label, "text": text, "prov": [{"page_no": p, "bbox": {"l": 1}} for p in pages], **more}
    tree = {"texts": [node("formula", "x " * 60, 1, 2), node("formula", "", 2, orig="ab"), node("code", "c", 2), node("formula", "zz", 9), {"label": "formula", "text": "no page"}], "body": {"deep": [[1]]}}
    rows = [("a", json.dumps(tree), 3, {"ocr": [1.0]}, 10.0), ("b", "{", 1, None, None), ("c", None, 1, {}, 5.0), ("d", json.dumps(tree), 0, None, 1.0), ("e", json.dumps({"texts": [node("formula", "", 1), node("formula", None, 2)]}), 2, None, 8.0)]
    docs = spark.createDataFrame(rows, "stem string, document string, page_count int, timings map<string,array<double>>, enrich_sec double")
    pages = metrics.document_pages(docs)
    got = {(r["stem"], r["page_no"]): r.asDict() for r in pages.collect()}
    assert sorted(got) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1), ("e", 1), ("e", 2)]
    one, two = got["a", 1], got["a", 2]
    assert (one["formula_count"], one["formula_chars"], one["formula_truncated"], one["formula_truncated_chars"], one["ocr_sec"]) == (1, 23, 1, 97, 1.0)
    assert (two["formula_count"], two["formula_chars"], two["code_count"], two["ocr_sec"]) == (2, 25, 1, 0.0)
    assert one["doc_enrich_share_sec"] == pytest.approx(10 * 23 / 48) and got["a", 3]["formula_count"] == 0
    assert [got["e", p]["doc_enrich_share_sec"] for p in (1, 2)] == [4.0, 4.0]
    for r in metrics.page_reports(pages).collect():
        (tmp_path / f"{r['stem']}.metrics.json").write_text(r["report"])
    read = {r["stem"]: (r["page_count"], r["formula_total"], r["code_total"]) for r in files.read_metrics(spark, str(tmp_path)).collect()}
    assert read == {"a": (3, 3, 1), "b": (1, 0, 0), "c": (1, 0, 0), "e": (2, 2, 0)}
