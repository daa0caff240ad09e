"""State of a stream as a log of keyed rows with snapshots.

Every micro-batch writes the rows that it changes to ``log/epoch=<e>``; the row of the latest
epoch is a key's state. Every ``every`` epochs the latest row of each key is written as
``snap/epoch=<e>``, and what no replay needs any more is deleted: a reader takes the last
snapshot and at most ``every`` epochs of the log, however long the stream has run. Folders are
written with overwrite, and a micro-batch reads only what is before it, so one that is run again
writes the same rows again.

Rows are bucketed by a hash of ``by``, and a reader names the buckets it needs. A bucket's
file isn't one task's work: large ones are split when they are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, EPOCH = "bucket", "epoch"


class KeyedLog:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int, every: int = 8,
                 by: Sequence[str] | None = None):
        self.spark, self.root, self.schema, self.keys = spark, root, schema, list(keys)
        self.buckets, self.every, self.by = buckets, every, list(by or keys)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.by]), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of ``rows``, a number each."""
        return [r[0] for r in rows.select(self.bucket()).distinct().collect()]

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _epochs(self, kind: str) -> list[int]:
        path, fs = self._fs()
        folder = path(f"{self.root}/{kind}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.split("=")[1]) for n in names if fs.exists(path(f"{self.root}/{kind}/{n}/_SUCCESS")))

    def _write(self, kind: str, epoch: int, rows: DataFrame) -> None:
        rows = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, self.bucket())
        rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{kind}/{EPOCH}={epoch}")

    def folders(self, epoch: int | None = None) -> list[str]:
        """What a reader of the state before ``epoch`` (at the end by default) takes."""
        snaps = [e for e in self._epochs("snap") if epoch is None or e < epoch]
        since = snaps[-1] if snaps else -1
        log = [e for e in self._epochs("log") if e > since and (epoch is None or e < epoch)]
        return [f"{self.root}/snap/{EPOCH}={e}" for e in snaps[-1:]] + [f"{self.root}/log/{EPOCH}={e}" for e in log]

    def read(self, epoch: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The latest row of each key before ``epoch`` (at the end by default), of some buckets only
        where these are given."""
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = None
        for folder in self.folders(epoch):
            part = self.spark.read.schema(schema).parquet(folder)
            part = part if buckets is None else part.where(F.col(BUCKET).isin(list(buckets)))
            part = part.drop(BUCKET).withColumn(EPOCH, F.lit(int(folder.rsplit("=", 1)[1])))
            rows = part if rows is None else rows.unionByName(part)
        if rows is None:
            # an empty relation that the optimizer sees through, joins with it included
            return self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]).limit(0)
        values = [c for c in self.schema.fieldNames() if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), F.col(EPOCH)).alias("__row"))
        return last.select(*self.keys, *[F.col(f"__row.{c}") for c in values]).select(*self.schema.fieldNames())

    def put(self, epoch: int, rows: DataFrame) -> None:
        """The rows that the micro-batch changes, one per key; a snapshot when it is due."""
        self._write("log", epoch, rows)
        if (epoch + 1) % self.every:
            return
        self._write("snap", epoch, self.read(epoch + 1))
        path, fs = self._fs()  # this epoch may be run again: it reads the snapshot before it and the log since
        snaps = [e for e in self._epochs("snap") if e < epoch]
        need = snaps[-1] if snaps else -1
        for e in snaps[:-1]:
            fs.delete(path(f"{self.root}/snap/{EPOCH}={e}"), True)
        for e in self._epochs("log"):
            if e <= need:
                fs.delete(path(f"{self.root}/log/{EPOCH}={e}"), True)


def known_state(log: KeyedLog, first: KeyedLog, epoch: int, rows: DataFrame) -> DataFrame:
    """The state of the keys of ``rows`` before the epoch: the log's row, else the one that the
    stream began with (``first``). Only the buckets of these keys are read."""
    buckets = log.buckets_of(rows)
    ids = rows.select(*log.keys).distinct()
    later = log.read(epoch, buckets).join(ids, log.keys, "left_semi")
    early = first.read(None, buckets).join(ids, log.keys, "left_semi").join(later.select(*log.keys), log.keys, "left_anti")
    return later.unionByName(early, allowMissingColumns=True)
