"""Tables of snapshots: commits, conflicts, ranges, streams."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.metadata import merge_results
from corpusloom.plans.pipeline import Corpus
from corpusloom.sources.snapshots import Snapshots

KINDS = "stem string, n int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def made(spark, *pairs):
    return spark.createDataFrame(list(pairs), KINDS)


def test_concurrent_upserts_both_survive(spark, tmp_path):
    path = str(tmp_path / "t")
    Snapshots(spark, path).replace(made(spark, *((f"s{i:02}", 0) for i in range(20))))

    def upsert(k):
        return Snapshots(spark, path).merge(made(spark, *((f"s{i:02}", k) for i in range(k, 20, 4)), (f"new{k}", k)))

    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(upsert, range(4))) == [2, 3, 4, 5]
    assert rows(Snapshots(spark, path).read()) == sorted([(f"s{i:02}", i % 4) for i in range(20)] + [(f"new{k}", k) for k in range(4)])


def test_concurrent_first_writes(spark, tmp_path):
    """Several writers of a table that is not there yet; none of their rows is lost."""
    source = tmp_path / "in"
    source.mkdir()
    for name in ("alpha", "beta"):
        (source / f"{name}.md").write_text("some text")
    Corpus(spark, str(source), str(tmp_path / "out")).extract()

    def add(k):
        corpus = Corpus(spark, str(source), str(tmp_path / "out"))
        corpus.update(made(spark, ("alpha", k)).withColumnRenamed("n", f"c{k}"))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(add, range(3)))
    meta = Corpus(spark, str(source), str(tmp_path / "out")).metadata()
    assert {r["stem"]: (r["c0"], r["c1"], r["c2"]) for r in meta.collect()} == {"alpha": (0, 1, 2), "beta": (None, None, None)}


def test_an_upsert_rewrites_touched_ranges_only(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), "stem", range_rows=10)
    table.replace(made(spark, *((f"k{i:03}", i) for i in range(100))))
    before = table.manifest(1)["ranges"]
    assert len(before) > 5
    table.merge(made(spark, ("k005", -1), ("k0051", -2), (None, -3)))
    after = table.manifest(2)["ranges"]
    changed = [r for r in after if r not in before]
    assert len(changed) == 1 and changed[0]["low"] is None
    assert set(table.read().where("n < 0").toPandas()["n"]) == {-1, -2, -3}
    assert table.read().count() == 102 and table.read(1).count() == 100
    table.merge(made(spark, *((f"k050{i:02}", i) for i in range(60))))  # one range grows beyond twice its size and is cut
    assert len(table.manifest(3)["ranges"]) > len(after)
    assert table.read().count() == 162
    assert [r["low"] for r in table.manifest(3)["ranges"]][1:] == sorted(r["low"] for r in table.manifest(3)["ranges"][1:])


def test_writers_of_other_ranges_do_not_merge_again(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), "stem", range_rows=10)
    table.replace(made(spark, *((f"k{i:03}", i) for i in range(40))))
    merges = []

    def slow(old, new, key):
        merges.append(1)
        if len(merges) == 1:  # somebody else commits meanwhile, far away
            Snapshots(spark, table.path, "stem", 10).merge(made(spark, ("k039", -1)))
        return merge_results(old, new, key)

    assert table.merge(made(spark, ("k000", -2)), slow) == 3 and len(merges) == 1
    assert set(table.read().where("n < 0").toPandas()["n"]) == {-1, -2}

    def clash(old, new, key):
        merges.append(1)
        if len(merges) == 2:
            Snapshots(spark, table.path, "stem", 10).merge(made(spark, ("k001", -3)))
        return merge_results(old, new, key)

    table.merge(made(spark, ("k000", -4)), clash)
    assert len(merges) == 3 and set(table.read().where("n < 0").toPandas()["n"]) == {-1, -3, -4}


def test_marks_columns_and_cleaning_up(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.merge(made(spark, ("a", 1)), merge_results, ("stream", 0)) == 1
    assert table.merge(made(spark, ("a", 2)), merge_results, ("stream", 0)) == 1  # done before
    assert table.merge(made(spark, ("b", 3)).withColumn("m", F.lit("x")), merge_results, ("stream", 1)) == 2
    assert rows(table.read()) == [("a", 1, None), ("b", 3, "x")] and rows(table.read(1)) == [("a", 1)]
    with pytest.raises(TypeError):
        table.merge(spark.createDataFrame([("c", "text")], "stem string, n string"), merge_results)
    assert table.merge(made(spark), merge_results, ("stream", 2)) == 3
    assert table.vacuum(1) == [3] and rows(table.read()) == [("a", 1, None), ("b", 3, "x")]
    empty = Snapshots(spark, str(tmp_path / "e"))
    empty.replace(made(spark))
    assert empty.read().count() == 0
    empty.merge(made(spark, ("z", 1)))
    assert rows(empty.read()) == [("z", 1)]
