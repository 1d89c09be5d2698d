"""Session settings and the shared folder for checkpoints and job tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app="millrace", master=None, **conf) -> SparkSession:
    """A session with the settings every job here relies on.

    Shuffle partitions are left to AQE: it coalesces small ones and splits skewed ones,
    so the same code runs on a laptop and on a cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set what a job needs on a session someone else built (runtime settings only)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def job_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that goes when the driver's process ends."""
    path = job_dir(spark, name)
    files, root = on_disk(spark, path)
    files.deleteOnExit(root)
    return path


def on_disk(spark: SparkSession, path: str):
    """The file system a path is on, and the path on it."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def cut_lineage(df):
    """Reliable checkpoint, so a lost executor costs one read and not the whole history."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
