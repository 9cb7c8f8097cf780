"""Profiles of columns with very many values: sketches in place of exact counts.

A sketch is made in one pass: tasks send on their sketches, not their values, so nothing is shuffled by value.
Sketches are columns of bounded size. They can be kept per source or day, and merged later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values that a sketch keeps counts of.
TRACKED = 10_000


def count_error(rows: int, tracked: int = TRACKED) -> float:
    """Most by which a value's estimated count is off. A sketch of at most `tracked` different values is exact.

    The counts are held in a table that is filled up to three quarters and has a power of two of places.
    """
    places = 1 << max(3, (-(-4 * tracked // 3) - 1).bit_length())
    return 3.5 * rows / places


def value_sketches(df: DataFrame, column: str, keys: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """One row per keys (or one): `rows` with a value, and `sketch` of the frequent values."""
    state = F.expr(f"approx_top_k_accumulate(`{column}`, {tracked})")
    return df.groupBy(*(keys or [])).agg(F.count(column).alias("rows"), state.alias("sketch"))


def merged(sketches: DataFrame, keys: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """Sketches of the same `tracked` put together, per keys or all."""
    state = F.expr(f"approx_top_k_combine(sketch, {tracked})")
    return sketches.groupBy(*(keys or [])).agg(F.sum("rows").alias("rows"), state.alias("sketch"))


def frequent_values(sketches: DataFrame, column: str, k: int) -> DataFrame:
    """The k values with the largest estimated counts of each sketch: `column`, count, rows. NULL is no value."""
    found = F.inline(F.expr(f"approx_top_k_estimate(sketch, {k + 1})"))
    others = [c for c in sketches.columns if c not in ("rows", "sketch")]
    top = sketches.select(*others, "rows", found.alias("item", "count")).where("item IS NOT NULL")
    # A group is the k + 1 values of one sketch.
    place = F.row_number().over(Window.partitionBy(*(others or [F.lit(0)])).orderBy(F.col("count").desc(), "item"))
    return top.withColumn("_place", place).where(F.col("_place") <= k).select(*others, F.col("item").alias(column), "count", "rows")


def quantile_sketches(df: DataFrame, column: str, keys: list[str] | None = None, size: int = 800) -> DataFrame:
    """One row per keys (or one): `sketch` of the distribution; ranks are off by about 1.65 / size of all."""
    return df.groupBy(*(keys or [])).agg(F.expr(f"kll_sketch_agg_double(CAST(`{column}` AS DOUBLE), {size})").alias("sketch"))


def equal_share_bins(sketches: DataFrame, bins: int) -> DataFrame:
    """Edges that cut each sketch's values into `bins` of about equal share: bin, low, high."""
    others = [c for c in sketches.columns if c != "sketch"]
    ranks = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    edges = sketches.withColumn("_edges", F.call_function("kll_sketch_get_quantile_double", F.col("sketch"), ranks))
    rows = edges.select(*others, "_edges", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return rows.select(*others, "bin", F.get("_edges", F.col("bin")).alias("low"), F.get("_edges", F.col("bin") + 1).alias("high"))
