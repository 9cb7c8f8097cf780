"""Queries over the test tables, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from venuemart.session import use_checkpoints

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Ranges that files are cut into by `small_ranges`, before the ranges grow.
MANY_RANGES = 512


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to several tasks per core, for small tables with costly work on each row."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which every executor reaches and which goes with them."""
    use_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_ranges(spark: SparkSession, folder: str) -> Iterator[None]:
    """The folder's files are cut into ranges of 64 KB inside, so that small test tables make many. Read results there.

    Larger folders have larger ranges, up to Spark's usual size: a task per 64 KB would cost more than its work.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    size = min(max(64 << 10, stored // MANY_RANGES), 128 << 20)
    keys = {"spark.sql.files.maxPartitionBytes": f"{size}b", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def load() -> None:
    """Import all query modules."""
    from venuemart.catalog import explore, learning, marts, pages, texts, venues  # noqa: F401
