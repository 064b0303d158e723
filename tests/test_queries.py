"""Registered queries against their SQL, and the pipeline over a folder of files."""

import numbers

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from corpusloom import catalogue
from corpusloom.plans.pipeline import Corpus, conversion_backend

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return con


def rows(df):
    cell = lambda v: "" if v is None or v is pd.NA or v != v else f"{float(v):.9g}" if isinstance(v, numbers.Number | np.bool_) else str(v)
    return sorted(tuple(cell(v) for v in r) for r in df.astype(object)[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, tiny, duck, name):
    got = catalogue.queries()[name](spark, tiny).toPandas()
    if name in catalogue.oracle_sql():
        want = duck.sql(catalogue.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def stub_recognition(rows):
    """Stands for a recognition model: a fixed note per document."""
    return rows.select("stem", F.concat(F.lit("[recognised text of "), F.col("stem"), F.lit("]")).alias("text"))


def test_corpus_phases(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.md").write_text("# One\nsome plain words in a line\n# Two\nmore words here")
    (source / "b.md").write_text("GLYPH<c=1,font=/X>\nGLYPH<c=2,font=/X>\n")
    (source / "bad.md").write_bytes(b"\xff\xfe\xfa")
    corpus = Corpus(spark, str(source), str(tmp_path / "out"))
    assert {r["stem"] for r in corpus.extract().collect()} == {"a", "b"}
    assert {r["stem"] for r in corpus.table("skiplist").collect()} == {"bad"}
    corpus.update(corpus.metadata().select("stem", F.concat("stem", F.lit(".pdf")).alias("filename")))
    assert {r["stem"] for r in corpus.clean().collect()} == {"a"}
    corpus.ocr(stub_recognition)
    assert corpus.metadata().where("ocr_success").first()["stem"] == "b"
    assert corpus.section().where("stem = 'a'").count() == 2
    labelled = corpus.annotate(lambda s: s.withColumn("label", F.lit("άλλο")))
    assert labelled.count() == corpus.table("sections").count()
    shards = corpus.jsonl_sharded(str(tmp_path / "shards"), limit=1000)
    assert shards.agg(F.sum("rows")).first()[0] == 2
    corpus.jsonl(str(tmp_path / "jsonl"))
    assert spark.read.json(str(tmp_path / "jsonl")).count() == 2


def test_conversion_backend():
    assert [conversion_backend(w) for w in (None, "auto", " Safe ", "docling")] == ["safe", "safe", "safe", "docling"]
    assert conversion_backend("safe", recognise=True) == conversion_backend(enrich=True) == "docling"
    with pytest.raises(ValueError, match="unknown backend"):
        conversion_backend("fast")
