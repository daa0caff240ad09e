"""W13 over deliveries of requests that keep coming: seats, enrolments and claims carried on.

A delivery is a folder of request rows; a notice (one small JSON file: number, folder) announces
it. The stream is the stream of notices, one a micro-batch, so that a micro-batch holds exactly
one delivery, however many files that has, and requests are decided in the order of (delivery,
seq). Each micro-batch (``foreachBatch``):

1. looks up the seats taken and the enrolments that the delivery's requests touch (log of this
   stream, else what it began with; only the buckets of these keys are read);
2. decides the delivery by ``admission.decide``. No claim needs to be carried on its own: an
   earlier claim was accepted, then its pair is enrolled, or the offering was full and stays so;
3. adds the accepted pairs and the offerings' new seat counts to the logs, and writes statuses
   and class rows to the delivery's own folders.

A micro-batch that is run again reads only what is before it and overwrites its own folders. So
any cut of the requests into deliveries gives the statuses of one batch over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.operators.admission import decide
from registrar.operators.reports import tbl
from registrar.schema import REQUEST_SCHEMAS
from registrar.session import scratch_path
from registrar.streaming.balances import session_buckets
from registrar.streaming.keyed_log import KeyedLog, known_state

REQUEST_SCHEMA = REQUEST_SCHEMAS["admission_request"]
NOTICE_SCHEMA = "delivery long, folder string"
SEATS = T.StructType([T.StructField("edition_id", T.LongType()), T.StructField("n", T.LongType())])
PAIRS = T.StructType([T.StructField(n, T.LongType()) for n in ("student_id", "edition_id", "delivery")])
PAIR = ["student_id", "edition_id"]


class AdmissionState:
    """What the stream of deliveries keeps, under ``root``; ``tables`` hold the offerings,
    courses, classes, students and grades that requests are checked against."""

    def __init__(self, spark: SparkSession, root: str, tables, every: int = 8):
        self.spark, self.root, self.tables = spark, root, tables
        log = lambda name, schema, keys: KeyedLog(spark, f"{root}/{name}", schema, keys, session_buckets(spark), every)
        self.seats, self.pairs = log("seats", SEATS, ["edition_id"]), log("pairs", PAIRS, PAIR)
        self.first_seats, self.first_pairs = log("first_seats", SEATS, ["edition_id"]), log("first_pairs", PAIRS, PAIR)

    def begin(self) -> None:
        """Store the seats taken and the enrolments before the first delivery."""
        ce = tbl(self.tables, "course_enrollment")
        self.first_seats.put(0, ce.groupBy("edition_id").agg(F.count("*").alias("n")))
        self.first_pairs.put(0, ce.select(*PAIR).distinct().withColumn("delivery", F.lit(-1).cast("long")))

    def _written(self, name: str, rows: DataFrame, delivery: int) -> DataFrame:
        path = f"{self.root}/{name}/delivery={delivery}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def admit(self, requests: DataFrame, delivery: int) -> None:
        """Decide the requests of one delivery."""
        taken = known_state(self.seats, self.first_seats, delivery, requests.select("edition_id"))
        enrolled = known_state(self.pairs, self.first_pairs, delivery, requests.select(*PAIR))
        statuses, classes = decide(self.tables, requests, taken, enrolled)
        ok = self._written("outcome", statuses, delivery).where("status = 'ok'")
        self._written("classes", classes.join(ok.select("seq"), "seq", "left_semi").select("student_id", "class_id").distinct(), delivery)
        more = ok.groupBy("edition_id").agg(F.count("*").alias("more")).join(taken, "edition_id", "left")
        self.seats.put(delivery, more.select("edition_id", (F.coalesce("n", F.lit(0)) + F.col("more")).alias("n")))
        self.pairs.put(delivery, ok.select(*PAIR).withColumn("delivery", F.lit(delivery).cast("long")))

    def _all(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema + ", delivery long").parquet(f"{self.root}/{name}")

    def outcome(self) -> DataFrame:
        """seq, student_id, edition_id, status, delivery of every request decided."""
        return self._all("outcome", "seq long, student_id long, edition_id long, status string")

    def student_class(self) -> DataFrame:
        """The classes of the students, those of the accepted requests added."""
        new, old = self._all("classes", "student_id long, class_id long").drop("delivery").distinct(), tbl(self.tables, "student_class")
        return old.unionByName(new.join(old, ["student_id", "class_id"], "left_anti"))


def announce(spark: SparkSession, notices: str, delivery: int, folder: str) -> None:
    """Add the notice of a delivery whose folder is completely written."""
    spark.createDataFrame([(delivery, folder)], NOTICE_SCHEMA).coalesce(1).write.mode("append").json(notices)


def run_admissions(spark: SparkSession, state: AdmissionState, notices: str, work_dir: str) -> DataFrame:
    """Decide every announced delivery that wasn't yet (``availableNow``); the outcome of all.
    Deliveries are numbered from 0 in the order of their notices; another order is refused."""
    def one(batch: DataFrame, epoch: int) -> None:
        for notice in batch.collect():  # one row: a notice a micro-batch
            if notice.delivery != epoch:
                raise ValueError(f"delivery {notice.delivery} was announced as number {epoch}")
            state.admit(batch.sparkSession.read.schema(REQUEST_SCHEMA).parquet(notice.folder), epoch)

    stream = spark.readStream.schema(NOTICE_SCHEMA).option("maxFilesPerTrigger", 1).json(notices)
    q = (stream.writeStream.foreachBatch(one).option("checkpointLocation", f"{work_dir}/checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return state.outcome()


def admissions_from_table(spark: SparkSession, tables, requests: DataFrame, deliveries: int = 4) -> AdmissionState:
    """Cut a request table by ``seq`` into deliveries of about equal size, announce and decide them."""
    work = scratch_path(spark, "stream_admissions")
    shares = [i / deliveries for i in range(1, deliveries)]
    cuts = requests.select(F.percentile_approx("seq", shares, 10000).alias("c")).first().c if shares else []
    number = sum((F.when(F.col("seq") > c, 1).otherwise(0) for c in sorted(cuts or [])), F.lit(0))
    rows = requests.select(*REQUEST_SCHEMA.fieldNames()).withColumn("delivery", number)
    rows.write.mode("overwrite").partitionBy("delivery").parquet(f"{work}/source")
    state = AdmissionState(spark, f"{work}/state", tables)
    state.begin()
    for i in range(deliveries):
        folder = f"{work}/source/delivery={i}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)  # an empty delivery is one
        announce(spark, f"{work}/notices", i, folder)
    run_admissions(spark, state, f"{work}/notices", work)
    return state
