"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.session import scratch_path


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the value as text, modulo ``m`` (null for null)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(m)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor costs no recomputation of what is above."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table. Python workers are told where this package lies; on a cluster
    it is installed or sent with the job."""
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), home)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_frames(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Cut the batches of ``mapInPandas`` into frames of at most ``rows`` rows."""
    for pdf in batches:
        for i in range(0, len(pdf), rows):
            yield pdf.iloc[i:i + rows]
