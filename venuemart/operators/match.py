"""Joining two venue tables by place and name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart.functions.geo import cell_of, cells_within, haversine
from venuemart.operators.ids import first_per_key
from venuemart.operators.skew import skew_join
from venuemart.session import use_checkpoints

CELL = ["_cx", "_cy", "_cz"]
GRAM = 3


def _with_cell(df: DataFrame, x: str, y: str, radius: float) -> DataFrame:
    return df.withColumns(dict(zip(CELL, cell_of(F.col(x), F.col(y), radius))))


def _with_cells_within(df: DataFrame, x: str, y: str, radius: float) -> DataFrame:
    for name, cells in zip(CELL, cells_within(F.col(x), F.col(y), radius)):
        df = df.withColumn(name, F.explode(cells))
    return df


def distance_join(left: DataFrame, right: DataFrame, radius: float, x: str = "x_coord", y: str = "y_coord"):
    """All pairs at most `radius` metres apart, with `distance`.

    Columns of the sides must differ except the coordinates, which come back as x/y (left) and x_right,
    y_right. Each right point is placed in the few cells within reach (at most 8), each left point in its own,
    and the pairs of one cell are checked exactly; pairs come from one cell only, so none is doubled.
    """
    near = _with_cells_within(right.withColumnsRenamed({x: f"{x}_right", y: f"{y}_right"}), f"{x}_right", f"{y}_right", radius)
    pairs = skew_join(_with_cell(left, x, y, radius), near, CELL).drop(*CELL)
    distance = haversine(F.col(f"{x}_right"), F.col(f"{y}_right"), F.col(x), F.col(y))
    return pairs.withColumn("distance", distance).where(F.col("distance") <= radius)


def _substrings(c: Column, n: int) -> Column:
    """All substrings of n characters."""
    starts = F.when(F.char_length(c) >= n, F.sequence(F.lit(1), F.char_length(c) - (n - 1)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.substring(c, i, F.lit(n)))


def _grams(c: Column) -> Column:
    """All substrings of up to GRAM characters, each once, and the empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), *[_substrings(c, n) for n in range(1, GRAM + 1)]))


def _longest_grams(c: Column) -> Column:
    """The substrings of min(GRAM, length) characters."""
    size = F.char_length(c)
    chosen = _substrings(c, GRAM)
    for n in range(GRAM - 1, -1, -1):
        chosen = F.when(size == n, F.array(c)).otherwise(chosen)
    return chosen


def nearest_namesakes(listing: DataFrame, register: DataFrame, radius: float) -> DataFrame:
    """Best register entry for every distinct (x_coord, y_coord, title_norm) of the listing.

    Best: at most `radius` metres away, one name part of the other, smallest distance, then smallest
    global_id. Copies (same place and name) are merged on both sides first, so they cost one row each.

    If one name is part of another, each of its grams is one of the other's. So every name is looked up on the
    other side under a single gram: the one that the fewest names there hold. A name with a gram that nobody
    holds there has no partner to contain it and leaves. Names of a crowded place thus meet only if they share
    a rare gram, not because of the place. Spark splits what is still skewed (adaptive skew join).
    """
    place = ["x_coord", "y_coord"]
    titles = listing.select(*place, F.col("title_norm").alias("name")).dropna().distinct()
    names = register.select("global_id", *place, F.col("Name_norm").alias("name")).dropna()
    names = names.groupBy(*place, "name").agg(F.min("global_id").alias("global_id"))
    use_checkpoints(listing.sparkSession)
    # Side 0 is the listing, side 1 the register. Read four times below, so stored.
    points = titles.select(F.lit(0).alias("side"), *place, "name", F.lit(None).alias("global_id")).unionByName(
        names.select(F.lit(1).alias("side"), *place, "name", "global_id")
    )
    points = points.checkpoint()

    known = points.select("side", "name").distinct()
    held = known.select((1 - F.col("side")).alias("asker"), F.explode(_grams(F.col("name"))).alias("_gram"))
    held = held.groupBy("asker", "_gram").agg(F.count(F.lit(1)).alias("_held"))
    asked = known.select(F.col("side").alias("asker"), "name", F.explode(_longest_grams(F.col("name"))).alias("_gram"))
    rarest = F.min(F.struct(F.coalesce("_held", F.lit(0)).alias("held"), F.col("_gram").alias("gram")))
    chosen = asked.join(held, ["asker", "_gram"], "left").groupBy("asker", "name").agg(rarest.alias("_rarest"))
    chosen = chosen.where("_rarest.held > 0").select(F.col("asker").alias("side"), "name", F.col("_rarest.gram").alias("_gram"))

    part = points.join(chosen, ["side", "name"]).withColumnsRenamed({c: f"{c}_p" for c in points.columns})
    part = _with_cells_within(part.withColumn("side", 1 - F.col("side_p")), "x_coord_p", "y_coord_p", radius)
    # Only points in a cube that somebody asks about are cut into grams.
    asked_cells = part.select("side", *CELL).distinct()
    whole = _with_cell(points, *place, radius).join(asked_cells, ["side", *CELL], "left_semi").withColumn("_gram", F.explode(_grams(F.col("name"))))
    pairs = whole.join(part, ["side", *CELL, "_gram"]).where(F.contains(F.col("name"), F.col("name_p")))

    listed = F.col("side") == 0
    pairs = pairs.select(
        *[F.when(listed, F.col(c)).otherwise(F.col(f"{c}_p")).alias(c) for c in (*place, "name")],
        *[F.when(listed, F.col(f"{c}_p")).otherwise(F.col(c)).alias(f"{c}_r") for c in place],
        F.coalesce("global_id", "global_id_p").alias("global_id"),
    )
    distance = haversine(F.col("x_coord_r"), F.col("y_coord_r"), F.col("x_coord"), F.col("y_coord"))
    pairs = pairs.withColumn("distance", distance).where(F.col("distance") <= radius)
    best = first_per_key(pairs, [*place, "name"], [F.col("distance"), F.col("global_id")])
    return best.select(*place, F.col("name").alias("title_norm"), "global_id", "distance")


def match_listing(listing: DataFrame, register: DataFrame, radius: float = 300.0) -> DataFrame:
    """Listing rows that have a namesake nearby, with its `global_id` and `distance`."""
    best = nearest_namesakes(listing, register, radius)
    return listing.join(best, ["x_coord", "y_coord", "title_norm"]).select(*listing.columns, "global_id", "distance")
