"""Keyed Parquet tables whose versions are committed by one atomically created file.

A table is a folder of immutable data files and of manifests, one per version. A manifest names the version it follows,
the schema, and the key ranges that tile the key's whole space, each with its files and rows. A writer first writes data
files that nothing refers to, and then creates the next manifest, which fails if another writer has created it: readers
take the newest manifest and so never find the table gone or half written, and of two writers one loses and tries again.
The loser whose key ranges the winner did not touch only renews its manifest; otherwise it merges again.

An upsert rewrites only the ranges that its keys fall in. Ranges that grow beyond ``RANGE_ROWS`` are cut anew. What the
driver holds is the manifest, a few numbers per range; the rows of a range are never in one place but in their file's task.

Creation is atomic by hard links on file systems of one machine, and by renaming without overwriting elsewhere (as HDFS
does); a store that has neither is not fit for tables of this kind.

Edge cases: null keys belong to the first range and are never matched; an empty first write leaves a table without rows; an
upsert without rows changes nothing but its mark; columns that come later are null in older files.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metadata import upsert
from .scratch import settled

#: Rows that a range aims at; one of twice as many is cut.
RANGE_ROWS = 1_000_000
#: Types that hold all values of a type, of which a merge makes columns without asking.
WIDER = {"byte": ("short", "integer", "long", "double"), "short": ("integer", "long", "double"), "integer": ("long", "double"), "float": ("double",), "date": ("timestamp",)}
#: Attempts to commit before a writer gives up.
ATTEMPTS = 50


class Conflict(RuntimeError):
    """No commit after many attempts."""


def range_of(key: Column, lows: list) -> Column:
    """The number of the range of a key; lows are the ranges' least keys, of which the first is null."""
    bounds = list(lows[1:])

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series([0 if k is None or k != k else bisect_right(bounds, k) for k in keys], dtype="int32")

    return place(key)


class Snapshots:
    """A table of versions at ``path``, keyed by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "stem", range_rows: int = RANGE_ROWS):
        self.spark, self.path, self.key, self.range_rows = spark, path.rstrip("/"), key, range_rows
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        where = self._at("manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int) -> dict:
        stream = self._fs.open(self._at(f"manifests/{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest unless one is named."""
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        told = self.manifest(version)
        return self._rows(told, told["ranges"])

    def _rows(self, told: dict, ranges: list[dict]) -> DataFrame:
        schema = T.StructType.fromJson(told["schema"])
        files = [f"{self.path}/{f}" for r in ranges for f in r["files"]]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def replace(self, df: DataFrame) -> int:
        """A version that holds the rows of df alone, after whatever is the newest when it is committed."""
        ranges = self._cut(df, None)
        for _ in range(ATTEMPTS):
            version = self.latest()
            marks = self.manifest(version)["marks"] if version else {}
            if self._publish({"version": (version or 0) + 1, "follows": version, "key": self.key, "schema": df.schema.jsonValue(), "ranges": ranges, "marks": marks}):
                return (version or 0) + 1
        raise Conflict(f"{self.path}: no commit in {ATTEMPTS} attempts")

    def merge(self, updates: DataFrame, how: Callable[[DataFrame, DataFrame, str], DataFrame] = upsert, mark: tuple[str, int] | None = None) -> int:
        """Commits how(rows, updates, key), where rows are those of the key ranges that updates touch.

        ``mark`` is the name of a source and a rising number: a merge whose number is not above the committed one of its
        source has been done before and is left out.
        """
        fresh = settled(updates, "updates")
        written = None
        for _ in range(ATTEMPTS):
            version = self.latest()
            base = self.manifest(version) if version else None
            if base and mark and base["marks"].get(mark[0], -1) >= mark[1]:
                return version
            if base is None:
                schema, gone, ranges = fresh.schema, [], self._cut(fresh, None)
            elif written and all(r in base["ranges"] for r in written[1]):
                schema, gone, ranges = written  # nobody else has changed these ranges
            else:
                schema, gone, ranges = written = self._merged(base, fresh, how)
            marks = (base["marks"] if base else {}) | ({mark[0]: mark[1]} if mark else {})
            kept = [r for r in base["ranges"] if r not in gone] if base else []
            every = sorted(kept + ranges, key=lambda r: (r["low"] is not None, r["low"] if r["low"] is not None else 0))
            told = {"version": (version or 0) + 1, "follows": version, "key": self.key, "schema": self._joined(base, schema).jsonValue(), "ranges": every, "marks": marks}
            if self._publish(told):
                return told["version"]
        raise Conflict(f"{self.path}: no commit in {ATTEMPTS} attempts")

    def _joined(self, base: dict | None, schema: T.StructType) -> T.StructType:
        """The base's columns, with new ones behind them."""
        old = T.StructType.fromJson(base["schema"]) if base else T.StructType([])
        kinds = {f.name: f.dataType for f in old}
        if clash := [f.name for f in schema if f.name in kinds and kinds[f.name] != f.dataType]:
            raise TypeError(f"columns of another type than in {self.path}: {', '.join(clash)}")
        return T.StructType([T.StructField(f.name, f.dataType) for f in [*old, *(f for f in schema if f.name not in kinds)]])

    def _fitted(self, base: dict, fresh: DataFrame) -> DataFrame:
        """fresh with columns that the base has in a wider type in that type; an error for those of another kind."""
        kinds = {f.name: f.dataType for f in T.StructType.fromJson(base["schema"])}
        wider = {f.name: F.col(f.name).cast(kinds[f.name]) for f in fresh.schema if kinds.get(f.name, f.dataType) != f.dataType and kinds[f.name].typeName() in WIDER.get(f.dataType.typeName(), ())}
        fitted = fresh.withColumns(wider)
        self._joined(base, fitted.schema)
        return fitted

    def _merged(self, base: dict, fresh: DataFrame, how) -> tuple[T.StructType, list[dict], list[dict]]:
        lows = [r["low"] for r in base["ranges"]]
        touched = sorted(r[0] for r in fresh.select(range_of(F.col(self.key), lows)).distinct().collect())  # at most one a range
        gone = [base["ranges"][i] for i in touched]
        if not gone:
            return T.StructType.fromJson(base["schema"]), [], []
        rows = how(self._rows(base, gone), self._fitted(base, fresh), self.key)
        name = f"data/{uuid.uuid4().hex}"
        placed = rows.withColumn("__range", range_of(F.col(self.key), lows))
        placed.repartition(min(len(touched), 10_000), "__range").write.partitionBy("__range").parquet(f"{self.path}/{name}")
        out = []
        sizes = {r["__range"]: r["n"] for r in self.spark.read.parquet(f"{self.path}/{name}").groupBy("__range").agg(F.count("*").alias("n")).collect()}
        for i in touched:
            files = self._files(f"{name}/__range={i}")
            if sizes.get(i, 0) > 2 * self.range_rows:
                out += self._cut(self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}/__range={i}"), lows[i])
            else:
                out.append({"low": lows[i], "files": files, "rows": sizes.get(i, 0)})
        return rows.schema, gone, out

    def _files(self, name: str) -> list[str]:
        where = self._at(name)
        found = [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted(f"{name}/{n}" for n in found if n.endswith(".parquet"))

    def _cut(self, df: DataFrame, low) -> list[dict]:
        """Writes df into files of ranges of keys; the first takes all keys from ``low`` on."""
        rows = settled(df, "rows")
        n = max(1, -(-rows.count() // self.range_rows))
        name = f"data/{uuid.uuid4().hex}"
        (rows.repartitionByRange(n, self.key) if n > 1 else rows.coalesce(1)).write.parquet(f"{self.path}/{name}")
        held = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(self.key).alias("low"), F.count("*").alias("rows")).collect()
        ordered = sorted(held, key=lambda r: (r["low"] is not None, r["low"] if r["low"] is not None else 0))
        return [{"low": r["low"] if i else low, "files": [f"{name}/{r['file']}"], "rows": r["rows"]} for i, r in enumerate(ordered)] or [{"low": low, "files": [], "rows": 0}]

    def _publish(self, told: dict) -> bool:
        """Creates the manifest of a version, whole at once; false if there is one already."""
        jvm, fs = self._jvm, self._fs
        draft, final = self._at(f"manifests/.{uuid.uuid4().hex}"), self._at(f"manifests/{told['version']:012d}.json")
        fs.mkdirs(final.getParent())
        out = fs.create(draft, True)
        out.write(json.dumps(told, ensure_ascii=False).encode())
        out.close()
        real = fs.resolvePath(draft)
        try:
            if real.toUri().getScheme() == "file":
                paths = jvm.java.nio.file.Paths
                target = paths.get(real.getParent().toUri()).resolve(final.getName())
                jvm.java.nio.file.Files.createLink(target, paths.get(real.toUri()))
            else:
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, final, none)
        except Exception as e:  # noqa: BLE001
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            fs.delete(draft, False)
        return True

    def vacuum(self, keep: int = 5) -> list[int]:
        """Deletes all but the newest manifests and the data files that none of those names; returns the versions left.

        Files of merges not yet committed would go too: call it while no writer is at work.
        """
        every = self.versions()
        left = every[-keep:]
        used = {f.rsplit("/", 1)[0].split("/")[1] for v in left for r in self.manifest(v)["ranges"] for f in r["files"]}
        for v in every[:-keep]:
            self._fs.delete(self._at(f"manifests/{v:012d}.json"), False)
        where = self._at("data")
        for s in self._fs.listStatus(where) if self._fs.exists(where) else []:
            if s.getPath().getName() not in used:
                self._fs.delete(s.getPath(), True)
        return left
