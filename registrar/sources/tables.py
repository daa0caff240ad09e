"""Parquet sources: the driver's test tables, read lazily with pruning left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Source:
    """``src.lineitem`` -> ``spark.read.parquet(f"{sf_dir}/lineitem.parquet")``.

    Reads are lazy; selecting columns and filtering afterwards reaches the parquet
    scan as ReadSchema / PushedFilters.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TEST_TABLES:
            return self.table(name)
        raise AttributeError(name)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read one stored table (parquet by default, any Spark file format otherwise)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None, fmt: str = "parquet"):
    """Write a table version (the sink of the ingest operators)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
