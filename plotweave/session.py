"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plotweave")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PLOTWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir of the session. Only a local session without one
    (tests, a laptop) gets a temporary folder; a cluster must name a shared one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(where or tempfile.mkdtemp(prefix="plotweave-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads survive the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, as a URI."""
    ensure_checkpoint_dir(spark)
    where = spark.sparkContext.getCheckpointDir()
    return f"{where if ':/' in where else f'file://{where}'}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """A written table in the shared folder: compressed, and read by column."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Removes a written path when the driver ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
