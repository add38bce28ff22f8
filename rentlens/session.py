"""Session helpers: a local session, table reading, worker import path, checkpoint folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers started from here on import this package by reference, from where it is installed on their machines.

    Arrow batches are bounded in rows and bytes, as texts can be long, unless the session has a bound of its own below the default."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) >= 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *known])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local master may do without: it gets a folder of its own, which goes when Python ends."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = sc._jvm.System.getProperty("rentlens.checkpoint.dir")
        if not folder:
            own = tempfile.mkdtemp(prefix="rentlens-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            folder = "file://" + own
            sc._jvm.System.setProperty("rentlens.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and read it back, so that later jobs don't recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def own_dir(spark: SparkSession, name: str) -> str:
    """A path for a new folder under the shared one, which the driver's JVM deletes when it ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p)  # only what exists can be marked
    fs.deleteOnExit(p)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that only this program uses, wherever it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished rounds: its cleaner acts once the driver has dropped what refers to them, which
    Python does here and now. Checkpoint files go likewise if spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
