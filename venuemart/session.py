"""Session settings the library counts on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Files of a checkpoint go when nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("venuemart")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure `DataFrame.checkpoint` has a folder every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. Only a local master, as in tests, may fall back to a
    temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = os.path.join(tempfile.gettempdir(), "venuemart-checkpoints")
    context.setCheckpointDir(folder)
    atexit.register(_remove, context, context.getCheckpointDir())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a new folder beside the checkpoints and read it back.

    Columns are read apart, and rows of many words take a fraction of a checkpoint. The end of Python deletes it.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark.sparkContext, folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _remove(context, folder: str) -> None:
    """Delete what is left of a folder of this session when Python ends."""
    try:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM may have ended before
        return
