"""Keyed writes to stored tables: update, delete, insert-if-absent and insert-else-update by key.

A stored table is dealt into buckets by the hash of some of its key columns, and a version
says for every bucket which folder holds its rows::

    <root>/data/<commit>/bucket=<b>/part-*.parquet
    <root>/versions/<number>.json        {"commit of each bucket", keys, schema}

A write finds the buckets that its changes fall into, reads and rewrites only these into a
folder of its own, and then publishes the next version's file by one rename that fails if
another writer was first. Readers see the last published version, whole, and a write that
dies before the rename leaves files that no version names. Folders that no kept version
names are removed by ``vacuum``.

The changes are dealt like the table, so no task sees more than its part of a bucket: the
join on the key is Spark's (with skew splitting), and the rows of a large bucket are written by
several tasks (``rebalance``). The driver holds one name per bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.session import scratch_path

BUCKET = "bucket"
BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer published the version first."""


class StoredTable:
    """A bucketed, versioned table. Its rows have one row per key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ files

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.root}/versions") if n.endswith(".json")]

    def version(self, number: int | None = None) -> dict:
        """What a version (the last by default) says."""
        number = self.versions()[-1] if number is None else number
        stream = self._fs().open(self._path(f"{self.root}/versions/{number:012d}.json"))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def _publish(self, number: int, said: dict) -> None:
        fs, target = self._fs(), self._path(f"{self.root}/versions/{number:012d}.json")
        draft = self._path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(said | {"number": number}).encode()))
        out.close()
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(draft, target):
            raise Conflict(f"{self.root}: version {number} is there already")

    # ------------------------------------------------------------ writes

    @classmethod
    def create(cls, df: DataFrame, root: str, keys: Sequence[str], by: Sequence[str] | None = None, buckets: int = BUCKETS) -> StoredTable:
        """Store ``df``. ``by``: the key columns that say the bucket (all by default)."""
        self = cls(df.sparkSession, root)
        said = {"keys": list(keys), "by": list(by or keys), "buckets": buckets, "schema": df.schema.json()}
        commit = self._write(df.withColumn(BUCKET, self._bucket(said)))
        self._publish(0, said | {"commits": {b: commit for b in self._written(commit)}})
        return self

    @staticmethod
    def _bucket(said: dict) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in said["by"]]), F.lit(said["buckets"])).cast("int")

    def _write(self, rows: DataFrame) -> str:
        commit = uuid.uuid4().hex
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{commit}")
        return commit

    def _written(self, commit: str) -> list[str]:
        return [n.split("=")[1] for n in self._names(f"{self.root}/data/{commit}") if n.startswith(f"{BUCKET}=")]

    def _rewrite(self, changes: DataFrame, rows_of) -> int:
        """Rewrite the buckets that ``changes`` (with the key columns) fall into as
        ``rows_of(their rows, the changes)``; gives the number of the new version."""
        said = self.version()
        staged = scratch_path(self.spark, "changes")
        changes.withColumn(BUCKET, self._bucket(said)).write.parquet(staged)
        changes = self.spark.read.parquet(staged)
        repeated = changes.groupBy(*said["keys"]).count().filter("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"several changes of one key: {repeated[0].asDict()}")
        touched = [str(r[0]) for r in changes.select(BUCKET).distinct().collect()]  # a bucket's number each
        if not touched:
            return said["number"]
        columns = T.StructType.fromJson(json.loads(said["schema"])).fieldNames()
        new = rows_of(self._rows(said, touched), changes.drop(BUCKET), said["keys"], columns).select(*columns)
        commit = self._write(new.withColumn(BUCKET, self._bucket(said)))
        commits = {b: c for b, c in said["commits"].items() if b not in set(touched)}
        self._publish(said["number"] + 1, said | {"commits": commits | {b: commit for b in self._written(commit)}})
        return said["number"] + 1

    def update(self, changes: DataFrame) -> int:
        """Rows whose key is in ``changes`` get its other columns; other keys are ignored."""
        return self._rewrite(changes, lambda old, new, keys, columns: _replaced(old, new, keys, columns))

    def delete(self, gone: DataFrame) -> int:
        """Rows whose key is in ``gone`` go."""
        return self._rewrite(gone, lambda old, new, keys, columns: old.join(new.select(*keys), keys, "left_anti"))

    def insert_if_absent(self, rows: DataFrame) -> int:
        """Rows whose key isn't there are added."""
        def merged(old, new, keys, columns):
            return old.unionByName(new.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)
        return self._rewrite(rows, merged)

    def upsert(self, rows: DataFrame) -> int:
        """Rows whose key is there get the other columns of ``rows``; the rest are added."""
        def merged(old, new, keys, columns):
            added = new.join(old.select(*keys), keys, "left_anti")
            return _replaced(old, new, keys, columns).unionByName(added, allowMissingColumns=True)
        return self._rewrite(rows, merged)

    def delete_by(self, column: str, values: DataFrame) -> int:
        """Rows whose ``column`` is among ``values`` (one column of that name) go. Where the
        table is bucketed by that column alone only the buckets of the values are read; else all
        are read for the keys to delete, and only the buckets with such keys rewritten."""
        said = self.version()
        values = values.filter(F.col(column).isNotNull()).distinct()
        buckets = None
        if said["by"] == [column]:
            buckets = [str(r[0]) for r in values.select(self._bucket(said)).distinct().collect()]
        return self.delete(self._rows(said, buckets).join(values, column, "left_semi").select(*said["keys"]))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the folders that none of the last ``keep`` versions names, and the files of
        the versions before; gives the folders removed."""
        numbers = self.versions()
        live = {f"{c}/{BUCKET}={b}" for n in numbers[-keep:] for b, c in self.version(n)["commits"].items()}
        gone = [f"{c}/{b}" for c in self._names(f"{self.root}/data") for b in self._names(f"{self.root}/data/{c}")
                if b.startswith(f"{BUCKET}=") and f"{c}/{b}" not in live]
        for n in numbers[:-keep]:
            self._fs().delete(self._path(f"{self.root}/versions/{n:012d}.json"), False)
        for folder in gone:
            self._fs().delete(self._path(f"{self.root}/data/{folder}"), True)
        return gone

    # ------------------------------------------------------------ reads

    def _rows(self, said: dict, buckets: Sequence[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(said["schema"]))
        wanted = said["commits"].items() if buckets is None else [(b, said["commits"][b]) for b in buckets if b in said["commits"]]
        paths = [f"{self.root}/data/{c}/{BUCKET}={b}" for b, c in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a published version, the last by default."""
        return self._rows(self.version(version))


def _replaced(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    own = [c for c in new.columns if c not in keys and c in columns]
    hits = new.select(*keys, F.struct(F.lit(True).alias("there"), *own).alias("__new"))
    return old.join(hits, keys, "left").select(*[
        F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in columns])
