"""The pipeline's stages one by one against brute force, and the whole on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import simhash_dedup, source_mix, toxicity
from test_llm_operators import AWKWARD, DOCS

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_return_documents_and_take_effect(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tiny).cache()
        assert out.columns == docs.columns, name
        if name == "toxicity":
            scored = toxicity.Model(docs, spark.read.parquet(f"{tiny}/labels.parquet")).score(docs)
            assert out.count() == scored.where(F.col("__tox_score") < toxicity.THRESHOLD).count()
        elif name == "near_duplicates":
            assert out.select("text").distinct().count() == out.count() < docs.count()
        elif name == "personal_data":
            assert out.count() == docs.count() and out.where(F.length("text") != F.col("n_chars")).count() == 0
        else:
            assert 0 < out.count() != docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tiny)
    assert packed.where("piece = 0").count() == docs.count()


def test_run_gives_sequences(spark, tiny):
    rows = corpus_pipeline.run(spark, tiny).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert rows and all(r["n"] <= 4096 for r in rows)


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stage_on_awkward_and_empty_tables(spark, tiny, name):
    """Null ids and texts, empty, long, equal and repeated rows, extra columns: defined results, no crash."""
    docs = spark.createDataFrame(AWKWARD, DOCS)
    got = STAGES[name](spark, docs, tiny)
    assert got.columns == docs.columns
    rows = got.collect()
    by_id = {r["doc_id"]: r for r in rows}
    if name in ("toxicity", "personal_data"):
        assert sorted(map(repr, rows)) == sorted(map(repr, docs.collect()))  # nothing toxic, nothing personal
    elif name == "near_duplicates":
        # 1, 2 and 9 have no word, 5 equals both rows of 6; one row of each group stays, and every lone one.
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted([(False, 1), (False, 4), (False, 5), (False, 7), (False, 8), (True, 0)])
    else:
        assert len(by_id[8]["text"]) == 300000 and set(rows) <= set(docs.collect())
    assert STAGES[name](spark, docs.limit(0), tiny).count() == 0


def test_packing_stage_on_awkward_and_empty_tables(spark, tiny):
    docs = spark.createDataFrame(AWKWARD, DOCS)
    pieces = STAGES["packing"](spark, docs, tiny).collect()
    assert sum(r["piece"] == 0 for r in pieces) == len(AWKWARD) and max(r["offset"] + r["length"] for r in pieces) <= 4096
    assert STAGES["packing"](spark, docs.limit(0), tiny).count() == 0


def test_near_duplicate_stage_equals_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id is not null")
    kept = {r["doc_id"] for r in STAGES["near_duplicates"](spark, docs, tiny).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    words = [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split() for _, t in rows]
    sets = [{b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    fps = [simhash_dedup.fingerprint_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, fa) in enumerate(zip(sets, fps, strict=True)):
        for j in range(i):
            if a == sets[j] or fa == fps[j] or (a and len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    assert kept == {rows[i][0] for i in range(len(rows)) if root(i) == i}


def test_mixing_stage_repeats_whole_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    copies = {r["doc_id"]: r["copies"] for r in source_mix.mix(docs).collect()}
    got = {r["doc_id"]: r["n"] for r in STAGES["mixing"](spark, docs, tiny).groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    assert got == {d: n for d, n in copies.items() if n}
