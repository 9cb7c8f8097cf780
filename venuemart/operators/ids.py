"""Row identity: first row per key, dense ids, repeatable ranks and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from venuemart.session import use_checkpoints


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by `order`.

    The rank filter lets Spark cut each group down to one row per task before the shuffle, so a key that
    fills a third of the table moves only a few rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def checkpoint_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Globally sorted and stored, so that row positions survive the loss of an executor."""
    use_checkpoints(df.sparkSession)
    return df.orderBy(*order).checkpoint()


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Dense 0-based ids in row order.

    `df` must be a stored table (see `checkpoint_sorted`) or a row-wise projection, explode or filter of
    one. Ids are the position within the partition plus the size of the partitions before it; only those
    sizes (one row per partition) meet in one place.
    """
    marked = df.withColumn("_mid", F.monotonically_increasing_id())
    marked = marked.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .drop("_mid", "_part", "_pos", "_before")
    )


def seeded_order(key: Column, seed: int) -> Column:
    """A shuffle of the keys that depends on the seed only, not on the layout."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows, the same ones on every layout; `key` identifies a row."""
    return (
        df.withColumn("_order", seeded_order(F.col(key), seed)).orderBy("_order", key).limit(n).drop("_order")
    )


def seeded_rank(df: DataFrame, key: str, seed: int, strata: list[str], slice_rows: int = 100_000) -> DataFrame:
    """Add `rank` (1-based) in the seeded order and `size`, both per stratum.

    A stratum may be a third of the table, so it is cut into slices by the hash prefix, long enough for about
    `slice_rows` rows at most: slice sizes give the rank of each slice's first row, and rows are ranked inside
    their slice.
    """
    digits, rows = 1, df.count()
    while rows > slice_rows * 16**digits:
        digits += 1
    keyed = df.withColumn("_order", seeded_order(F.col(key), seed)).withColumn("_slice", F.substring("_order", 1, digits))
    slices = keyed.groupBy(*strata, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    in_stratum = Window.partitionBy(*strata)
    before = in_stratum.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        *strata,
        "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(in_stratum).alias("size"),
    )
    in_slice = Window.partitionBy(*strata, "_slice").orderBy("_order", key)
    return (
        keyed.join(slices, [*strata, "_slice"])
        .withColumn("rank", F.col("_before") + F.row_number().over(in_slice))
        .drop("_order", "_slice", "_before")
    )


def train_test_split(
    df: DataFrame, key: str, test_share: float = 0.3, seed: int = 17, strata: list[str] | None = None
) -> DataFrame:
    """Add `part` ('train' or 'test'): shuffled by seed, exact shares, per stratum if strata are given."""
    ranked = seeded_rank(df, key, seed, strata or [])
    n_test = F.ceil(F.col("size") * F.lit(test_share))
    return ranked.withColumn(
        "part", F.when(F.col("rank") <= F.col("size") - n_test, F.lit("train")).otherwise(F.lit("test"))
    ).drop("rank", "size")


def seeded_fold(key: Column, folds: int, seed: int) -> Column:
    """Cross-validation fold number of a row."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(folds)).cast("int")
