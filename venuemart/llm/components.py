"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuemart.llm.common import stored


def _large(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours the smallest node it knows."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    met = both.join(least, "u").where("v > u")
    return met.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, the smallest of them. u > v in every link."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    met = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes that have a link (u, v); root is the smallest node of the component.

    Each round is a few shuffles of at most as many rows as there are links, and the rounds grow with the
    logarithm of a component's size. A round's table is written to the shared folder, so the plan stays short
    and nothing but a count and a sum comes to the driver. Links of a node to itself are ignored.
    """
    links = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = stored(links, "links")
    before = _state(links)
    while True:
        links = stored(_small(_large(links)), "stars")
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
