"""Running balance per student from a stream of charges (the tuition/fee rule
as a Structured Streaming aggregate).

``stream_balances`` is the streaming plan: ``groupBy(student).agg(sum, count)``;
Spark keeps the per-student sums in its checkpointed state store. ``run_balances``
drives it with ``foreachBatch`` in ``update`` mode: each micro-batch's changed balances go
to a :class:`~registrar.streaming.keyed_log.KeyedLog`, whose snapshots keep what is stored
and read from growing with the number of micro-batches; a replayed one (after a lost executor or
driver restart) rewrites the same folder. The current balances are the log's latest rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.schema import MONEY_TYPE, REQUEST_SCHEMAS
from registrar.session import scratch_path
from registrar.streaming.keyed_log import KeyedLog

CHARGE_SCHEMA = REQUEST_SCHEMAS["charge"]
BATCH_BYTES = 8 << 30


def stream_balances(charges: DataFrame) -> DataFrame:
    """Streaming aggregate: balance = sum of charges, per student."""
    return charges.groupBy("student_id").agg(F.sum("amount").alias("balance"), F.count("*").alias("n_charges"))


def balance_log(spark: SparkSession, root: str, every: int = 8) -> KeyedLog:
    """The stored balances: student_id, balance, n_charges by student."""
    schema = T.StructType([T.StructField("student_id", T.LongType()), T.StructField("balance", T.DecimalType(20, 2)),
                           T.StructField("n_charges", T.LongType())])
    return KeyedLog(spark, root, schema, ["student_id"], session_buckets(spark), every)


def session_buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def paced(reader, files_per_trigger: int | None):
    """A file stream's micro-batch: so many files, or by default so many bytes."""
    if files_per_trigger:
        return reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("maxBytesPerTrigger", BATCH_BYTES)


def run_balances(spark: SparkSession, source_dir: str, work_dir: str, files_per_trigger: int | None = None, every: int = 8) -> DataFrame:
    """Process every charge file under ``source_dir`` (``availableNow``) and return
    the resulting balances (read back from the log)."""
    stream = paced(spark.readStream.schema(CHARGE_SCHEMA), files_per_trigger).parquet(source_dir)
    log = balance_log(spark, f"{work_dir}/balances", every)

    def sink(batch: DataFrame, epoch: int) -> None:
        log.put(epoch, batch.withColumn("balance", F.col("balance").cast(T.DecimalType(20, 2))))

    q = (stream_balances(stream).writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", f"{work_dir}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return log.read().withColumn("balance", F.col("balance").cast(MONEY_TYPE))


def stage_charges(charges: DataFrame, path: str, files: int | None = None) -> None:
    """Write a charge table as parquet files: the stream's input. The table's own
    partitions become files; with ``files`` it is dealt into so many, by charge, so one
    student's charges arrive over several micro-batches."""
    rows = charges.select(*CHARGE_SCHEMA.fieldNames())
    (rows.repartition(files, "charge_id") if files else rows).write.mode("overwrite").parquet(path)


def balances_from_table(spark: SparkSession, charges: DataFrame, files: int | None = None) -> DataFrame:
    """Stage ``charges`` under the shared checkpoint folder and stream it; with ``files``,
    one micro-batch a file."""
    work = scratch_path(spark, "stream_balances")
    stage_charges(charges, f"{work}/source", files)
    return run_balances(spark, f"{work}/source", work, 1 if files else None)
