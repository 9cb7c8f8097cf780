"""Profiling and report operators: counts, coverage, histograms, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(
    df: DataFrame, column: str, dropna: bool = True, by: str = "count", n: int | None = None, tail: bool = False
) -> DataFrame:
    """Rows per value, most frequent first (or by value); `n` keeps the head, or with `tail` the end, of that order."""
    rows = df.where(F.col(column).isNotNull()) if dropna else df
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if by == "count":
        order = [F.col("count").asc(), F.col(column).desc_nulls_first()] if tail else [
            F.col("count").desc(), F.col(column).asc_nulls_last()
        ]
    else:
        order = [F.col(column).desc_nulls_first() if tail else F.col(column).asc_nulls_last()]
    counts = counts.orderBy(*order)
    return counts if n is None else counts.limit(n)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: rows with and without a value; one pass over the table."""
    columns = columns or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(c).alias(c) for c in columns])
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column"), (F.col("_all") - F.col(c)).alias("nulls"), F.col(c).alias("values"))
            for c in columns
        ]
    )
    return counts.select(F.inline(per_column))


def coverage(found: DataFrame, everything: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Distinct keys of `found`, of `everything`, and the share of the former; keys are counted, not compared."""
    distinct = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.count_distinct(c))
    n_found = found.agg(distinct(F.col(key)).alias("n")).scalar()
    return everything.agg(distinct(F.col(key)).alias("total")).select(
        n_found.alias("found"), "total", F.try_divide(n_found.cast("double"), F.col("total")).alias("share")
    )


def histogram(df: DataFrame, column: str, bins: int = 20, density: bool = False) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed: bin, low, high, count (and density).

    Empty bins are not listed. NULL values are ignored.
    """
    bounds = df.agg(
        F.struct(
            F.min(column).cast("double").alias("low"),
            F.max(column).cast("double").alias("high"),
            F.count(column).alias("n"),
        ).alias("b")
    )
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_v"))
    rows = rows.withColumn("_b", bounds.scalar())
    low, width = F.col("_b.low"), (F.col("_b.high") - F.col("_b.low")) / bins
    place = F.floor(F.try_divide(F.col("_v") - low, width))
    number = F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = rows.select("_b", number.alias("bin")).groupBy("_b", "bin").agg(F.count(F.lit(1)).alias("count"))
    out = [
        F.col("bin"),
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.col("count"),
    ]
    if density:
        out.append(F.try_divide(F.col("count").cast("double"), F.col("_b.n") * width).alias("density"))
    return counts.select(*out)


def top_k(df: DataFrame, k: int, column: str, ties: list[str], largest: bool = True) -> DataFrame:
    """k rows with the largest (or smallest) values; NULL values never count as such."""
    first = F.col(column).desc() if largest else F.col(column).asc()
    return df.where(F.col(column).isNotNull()).orderBy(first, *ties).limit(k)


def reassemble(df: DataFrame, key: str, position: str, text: str, glue: str = ".", chunk: int | None = None) -> DataFrame:
    """The text of each key, its rows joined in order of position: key, text.

    Positions must be unique per key. Where a key's text may not fit one cell, ask for `chunk`: then a text
    comes in parts (key, part, text), one for every `chunk` positions; parts in order make the whole text.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))
    whole = F.array_join(F.transform(ordered, lambda r: r["t"]), glue).alias(text)
    parts = [] if chunk is None else [F.floor(F.col(position) / chunk).alias("part")]
    return df.groupBy(key, *parts).agg(whole)


def join_missing_columns(wide: DataFrame, narrow: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on the keys that takes from `wide` only the columns `narrow` lacks."""
    extra = sorted(set(wide.columns) - set(narrow.columns))
    others = [c for c in narrow.columns if c not in keys]
    return narrow.join(wide.select(*keys, *extra), keys).select(*keys, *extra, *others)


def map_columns(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """One column per map key."""
    return df.select("*", *[F.try_element_at(column, F.lit(k)).alias(k) for k in keys])
