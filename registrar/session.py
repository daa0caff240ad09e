"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on. AQE re-plans joins at run time
# (broadcast only when the measured side is under the threshold), coalesces small
# shuffle partitions and splits skewed sort-merge-join partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call site kept for every column expression: it takes longer than the expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "registrar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's settings.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("REGISTRAR_DRIVER_MEMORY", "16g"))
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, streaming state and staged tables.

    The cluster names it in ``spark.checkpoint.dir``; it is read from the session. Only
    a local session may do without: it gets a scratch folder that goes with the JVM. On a
    cluster an unset folder is an error, for executors would write to their own disks.
    """
    path, sc = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    path = path or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="registrar-ckpt-")
        _delete_on_exit(spark, path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - a static setting in this deployment; sc has it
        pass
    return path.rstrip("/")


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Let the file system delete the folder when the driver's JVM ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root, deleted when the driver ends."""
    path = f"{checkpoint_root(spark)}/registrar/{name}/{uuid.uuid4().hex}"
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(path))
    _delete_on_exit(spark, path)
    return f"{path}/data"
