"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this many rows, ...
HOT_ROWS = 1_000_000
# ... or above this share of all rows if that is more, so there are at most as many hot keys as its inverse.
HOT_SHARE = 1 / 10_000
# Lookup tables up to this many rows and bytes are sent to every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def hot_keys(counts: DataFrame, on: list[str], hot_rows: int = HOT_ROWS, share: float = HOT_SHARE) -> DataFrame:
    """Keys with more rows than one task should get, and `_salts`, the number of tasks to deal each to.

    counts: the keys and `n`. The result has at most 1 / `share` rows.
    """
    least = F.greatest(F.lit(float(hot_rows)), counts.agg(F.sum("n").alias("n")).scalar() * F.lit(share))
    hot = counts.dropna(subset=on).where(F.col("n") > least)
    return hot.select(*on, F.ceil(F.col("n") / least).cast("int").alias("_salts"))


def skew_join(
    facts: DataFrame,
    dims: DataFrame,
    on: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    place: str | None = None,
) -> DataFrame:
    """Equi join (`inner` or `left`) whose fact rows of a hot key are dealt to several tasks.

    Hot keys come from the per-key counts (pre-aggregated before their shuffle; pass `counts`, with the keys
    and `n`, if they exist already); the larger the key, the more tasks. Only the dims rows of hot keys are
    repeated, once per task. Fact rows with a NULL key, which match nothing, are dealt out as well. Rows are
    dealt by their place in `facts`, so equal rows spread too; pass a stored table, or name a column that
    holds a number of each row, so that a repeated task deals them as before.
    """
    if counts is None:
        counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(counts, on, hot_rows))
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    number = F.monotonically_increasing_id() if place is None else F.col(place)
    left = facts.withColumn("_place", F.xxhash64(number)).join(hot, on, "left")
    salt = F.when(F.col("_salts").isNotNull(), F.pmod("_place", "_salts")).when(no_key, F.pmod("_place", F.lit(10_000)))
    left = left.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int")).drop("_salts", "_place")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = dims.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def with_group_values(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Add per-group aggregates to every row; rows with a NULL key get NULL."""
    return with_values_of_groups(df, {tuple(keys): aggregates})


def with_values_of_groups(df: DataFrame, groups: Mapping[tuple[str, ...], Mapping[str, Column]]) -> DataFrame:
    """The same for several groupings at once: {keys: {name: aggregate}}. `df` should be a stored table.

    A window over the keys would send a whole group to one task. Here the groups are aggregated first (with
    map-side partial aggregates), each straight from `df`, and joined back.
    """
    out = df.withColumn("_number", F.monotonically_increasing_id())
    for keys, aggregates in groups.items():
        values = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_rows"), *[value.alias(name) for name, value in aggregates.items()]
        )
        sizes = values.select(*keys, F.col("_rows").alias("n"))
        out = skew_join(out, values.drop("_rows"), list(keys), "left", counts=sizes, place="_number")
    names = [name for aggregates in groups.values() for name in aggregates]
    return out.select(*df.columns, *names)


def lookup_join(
    df: DataFrame, table: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES
):
    """Join with a lookup table: broadcast when it is measured to be small, balanced shuffle otherwise."""
    width = F.octet_length(F.to_json(F.struct("*")))
    n, size = table.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    if n <= rows and size <= most:
        return df.join(F.broadcast(table), on, how)
    return skew_join(df, table, on, how)
