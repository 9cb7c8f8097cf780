"""Tables kept in the shared folder, and small helpers of all operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.session import use_checkpoints

#: White space as the contracts name it: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Texts that a task works on at once; their results leave before the next ones come.
AT_ONCE = 256
#: Bytes of an Arrow batch between the JVM and Python. Spark's 64 MB lie several times in an executor, once a core:
#: as vectors that double while they grow, in Python, and again on the way back.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_folders: list[str] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which driver and executors share."""
    use_checkpoints(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """From now on rows of whole texts go to Python in batches of BATCH_BYTES, unless the session has its own setting."""
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(start, AT_ONCE)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows depends on the files alone, so a lost executor costs only its own tasks. `release` deletes
    the files when the results that read them have been written; the end of Python does so for the rest.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(folder)
    if not _folders:
        atexit.unregister(_leave)
        atexit.register(_leave, spark)
    _folders.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _leave(spark: SparkSession) -> None:
    """Delete what is left when Python ends, if Spark is still there."""
    try:
        release(spark)
    except Exception:
        _folders.clear()


def mark() -> int:
    """The number of stored tables so far, to `release` those of one job only."""
    return len(_folders)


def release(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete the tables that were stored from number `since` up to `until`."""
    for folder in _folders[since:until]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    del _folders[since:until]


def bounded(df: DataFrame, key: str, most: int) -> DataFrame:
    """All rows of a stored table, or, if it has more than `most`, those whose key has one of the first hashes.

    The share of the hashes is chosen so that about `most` rows stay, less a margin of five deviations: no
    sort, no single task, and the same rows whatever the partitions. Keys must be distinct.
    """
    n = df.count()
    if n <= most:
        return df
    share = max(0.0, most - 5 * most**0.5) / n
    return df.where(F.pmod(F.xxhash64(F.lit(40), key), F.lit(1 << 40)) < int(share * (1 << 40)))


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """All columns in one struct `row`, beside new columns that therefore cannot clash with theirs."""
    return df.select(F.struct("*").alias("row"), *[value.alias(name) for name, value in keys.items()])


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))
