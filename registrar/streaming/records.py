"""Running average and passed count per student from a stream of grade
changes, where the latest grade per (student, offering) wins.

A regrade must withdraw the old grade, so a plain streaming ``avg`` is wrong; and a student's
other grades need not be read again for it. Each micro-batch (``foreachBatch``):

1. keeps the latest change per (student, offering) of the batch (``max_by`` by (batch_id, pos));
2. looks up the grade that each of these enrolments has (the log of applied changes, else the
   initial grades) and drops changes that are older than the one applied;
3. adds up, per student, what the new grades bring and the old ones take away (signed cents
   and passes, ``grading.deltas_of``), and adds that to the student's sums;
4. writes the applied changes and the new sums to their logs
   (:class:`~registrar.streaming.keyed_log.KeyedLog`: snapshots, bounded reads, replay-safe).

Enrolments are bucketed by (student, offering), so a student with very many is in many
buckets. The record of a student is made from the latest sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.functions.columns import rounded_mean_from_cents
from registrar.operators.grading import added_sums, deltas_of, passing_sums
from registrar.schema import GRADE_TYPE, REQUEST_SCHEMAS
from registrar.session import scratch_path
from registrar.streaming.balances import paced, session_buckets
from registrar.streaming.keyed_log import KeyedLog, known_state

CHANGE_SCHEMA = REQUEST_SCHEMAS["grade_change"]
SUMS = T.StructType([T.StructField(n, T.LongType()) for n in ("student_id", "cents", "n")])
PAIR = ["student_id", "edition_id"]


def _latest_in_batch(batch: DataFrame) -> DataFrame:
    order = F.struct("batch_id", "pos")
    last = batch.groupBy(*PAIR).agg(F.max_by(F.struct("grade", "batch_id", "pos"), order).alias("c"))
    return last.select(*PAIR, F.col("c.grade").cast(GRADE_TYPE).alias("grade"), "c.batch_id", "c.pos")


class RecordState:
    """What the stream keeps: applied changes, sums of the touched students, and the grades and
    sums that it began with, all by bucket."""

    def __init__(self, spark: SparkSession, root: str, every: int = 8):
        buckets = session_buckets(spark)
        log = lambda name, schema, keys: KeyedLog(spark, f"{root}/{name}", schema, keys, buckets, every)
        grades = T.StructType([f for f in CHANGE_SCHEMA.fields if f.name in (*PAIR, "grade")])
        self.applied, self.sums = log("applied", CHANGE_SCHEMA, PAIR), log("sums", SUMS, ["student_id"])
        self.first_grades, self.first_sums = log("first_grades", grades, PAIR), log("first_sums", SUMS, ["student_id"])

    def begin(self, initial: DataFrame) -> None:
        """Store the grades (student_id, edition_id, grade) that the stream changes."""
        self.first_grades.put(0, initial)
        self.first_sums.put(0, passing_sums(initial))

    def apply(self, batch: DataFrame, epoch: int) -> None:
        work = batch.sparkSession
        known = known_state(self.applied, self.first_grades, epoch, batch)
        known = known.select(*PAIR, F.col("grade").alias("was"), F.col("batch_id").alias("b0"), F.col("pos").alias("p0"))
        fresh = F.col("b0").isNull() | (F.struct("batch_id", "pos") > F.struct(F.col("b0").alias("batch_id"), F.col("p0").alias("pos")))
        both = _latest_in_batch(batch).join(known, PAIR, "left").where(fresh)
        staged = scratch_path(work, "applied_changes")
        both.write.mode("overwrite").parquet(staged)
        both = work.read.schema(both.schema).parquet(staged)
        self.sums.put(epoch, added_sums(known_state(self.sums, self.first_sums, epoch, both), deltas_of(both)))
        self.applied.put(epoch, both)

    def records(self) -> DataFrame:
        """student_id, average, approved_courses of the students with an applied change."""
        return self.sums.read().select("student_id", rounded_mean_from_cents("cents", "n").alias("average"), F.col("n").alias("approved_courses"))


def run_academic_record(spark: SparkSession, state: RecordState, source_dir: str, work_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the change files in ``source_dir`` into ``state``; return each touched student's record."""
    stream = paced(spark.readStream.schema(CHANGE_SCHEMA), files_per_trigger).parquet(source_dir)
    q = (stream.writeStream.foreachBatch(state.apply).option("checkpointLocation", f"{work_dir}/checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return state.records()


def records_from_changes(spark: SparkSession, initial: DataFrame, changes: DataFrame, files: int | None = None, every: int = 8) -> DataFrame:
    """Stage a change table as files (its own partitions, or ``files`` dealt by batch, each
    a micro-batch) and stream it onto the ``initial`` grades."""
    work = scratch_path(spark, "stream_academic_record")
    # the result does not depend on the order the files are read in
    rows = changes.select(*CHANGE_SCHEMA.fieldNames())
    (rows.repartition(files, "batch_id") if files else rows).write.mode("overwrite").parquet(f"{work}/source")
    state = RecordState(spark, f"{work}/state", every)
    state.begin(initial)
    return run_academic_record(spark, state, f"{work}/source", work, 1 if files else None)
