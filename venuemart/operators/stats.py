"""Whole-table statistics: standard scaling and the Box-Cox transform."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.operators.skew import BROADCAST_ROWS, lookup_join, skew_join
from venuemart.session import use_checkpoints

# First look: lambda = sinh(0.6 i), from -201 to 201, dense around zero.
FIRST_GRID = 10
FIRST_STEP = 0.6
# Each further look: this many steps between the neighbours of the best value so far.
ZOOM_STEPS = 12
ZOOMS = 4


def boxcox(log: Column, lmbda: Column | float) -> Column:
    """Box-Cox transform of a positive value given by its logarithm."""
    if isinstance(lmbda, float):
        return log if abs(lmbda) < 1e-12 else F.expm1(log * lmbda) / lmbda
    return F.when(F.abs(lmbda) < 1e-12, log).otherwise(F.expm1(log * lmbda) / lmbda)


def _spreads(rows: DataFrame, groups: list[str], lams: list, keep: list[str]) -> DataFrame:
    """One pass over the rows: mean logarithm and, per candidate, the variance after the transform.

    Sums are built before the shuffle, so a group of any size moves only one row per task.
    """
    spreads = [F.var_pop(boxcox(F.col("_log"), lam)).alias(f"_v{i}") for i, lam in enumerate(lams)]
    firsts = [F.first(c).alias(c) for c in keep]
    return rows.groupBy(*groups).agg(F.avg("_log").alias("_mean_log"), *firsts, *spreads)


def _narrow(lams: np.ndarray, mean_log: float, spreads: np.ndarray) -> tuple[float, float, float] | None:
    """(low, step, lmbda): the next grid, around the most likely candidate, and the best guess so far.

    The guess is the top of the parabola through the best candidate and its neighbours. None without spread.
    """
    with np.errstate(all="ignore"):
        likelihood = (lams - 1) * mean_log - 0.5 * np.log(spreads.astype(float))
    likelihood = np.where(np.isfinite(likelihood), likelihood, -np.inf)
    at = int(np.argmax(likelihood))
    if not np.isfinite(likelihood[at]):
        return None
    low, high = lams[max(at - 1, 0)], lams[min(at + 1, len(lams) - 1)]
    guess = lams[at]
    if 0 < at < len(lams) - 1 and np.isfinite(likelihood[at - 1 : at + 2]).all():
        before, best, after = likelihood[at - 1 : at + 2]
        if (bend := before - 2 * best + after) < 0:
            guess += (lams[at + 1] - lams[at]) * 0.5 * (before - after) / bend
    return float(low), float((high - low) / ZOOM_STEPS), float(guess)


def _grid(low: float, step: float) -> np.ndarray:
    return low + step * np.arange(ZOOM_STEPS + 1)


def _fit(df: DataFrame, x: str, groups: list[str]) -> DataFrame:
    """groups, `_centre` (mean logarithm) and `lmbda`.

    Values are divided by their geometric mean first. That changes neither lambda nor the scaled values, and
    keeps digits that would be lost when x to the power of lambda is far from 1.
    """
    use_checkpoints(df.sparkSession)
    # Read once per look, so the one number per row is kept (memory, then disk) instead of computed again.
    logs = df.where(F.col(x) > 0).select(*groups, F.ln(x).alias("_log")).persist(StorageLevel.MEMORY_AND_DISK)
    first = [math.sinh(FIRST_STEP * i) for i in range(-FIRST_GRID, FIRST_GRID + 1)]
    try:
        return _fit_groups(logs, groups, first) if groups else _fit_all(logs, first)
    finally:
        logs.unpersist()


def _fit_all(data: DataFrame, first: list[float]) -> DataFrame:
    spark = data.sparkSession
    none = spark.createDataFrame([], "_centre double, lmbda double")
    centre = data.agg(F.avg("_log")).first()[0]
    if centre is None:
        return none
    data = data.select((F.col("_log") - centre).alias("_log"))
    lams, found = first, None
    for _ in range(1 + ZOOMS):
        row = _spreads(data, [], lams, []).first()
        spreads = np.array([row[f"_v{i}"] for i in range(len(lams))], dtype=float)
        found = _narrow(np.array(lams), row["_mean_log"], spreads)
        if found is None:
            return none
        lams = _grid(*found[:2]).tolist()
    return spark.createDataFrame([(centre, found[2])], none.schema)


def _fit_groups(data: DataFrame, groups: list[str], first: list[float]) -> DataFrame:
    keys = T.StructType([data.schema[g] for g in groups])
    numbers = ["_centre", "_low", "_step", "lmbda"]
    out = T.StructType([*keys.fields, *(T.StructField(n, T.DoubleType()) for n in numbers)])

    def narrow(candidates: int, grid: list[float] | None):
        def run(batches):
            for batch in batches:
                rows = []
                for row in batch.to_dict("records"):
                    lams = np.array(grid) if grid else _grid(row["_low"], row["_step"])
                    spreads = np.array([row[f"_v{i}"] for i in range(candidates)], dtype=float)
                    found = _narrow(lams, row["_mean_log"], spreads)
                    if found is not None:
                        rows.append([*(row[g] for g in groups), row["_centre"], *found])
                yield pd.DataFrame(rows, columns=out.names)

        return run

    state = data.groupBy(*groups).agg(F.avg("_log").alias("_centre"), F.count(F.lit(1)).alias("n")).checkpoint()
    sizes = state.select(*groups, "n")
    for look in range(1 + ZOOMS):
        # One row per group: sent to every task while it is small.
        known = state.drop("lmbda", "n")
        small = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        rows = data.join(F.broadcast(known), groups) if small else skew_join(data, known, groups, counts=sizes)
        rows = rows.withColumn("_log", F.col("_log") - F.col("_centre"))
        lams = first if look == 0 else [F.col("_low") + F.col("_step") * i for i in range(ZOOM_STEPS + 1)]
        spreads = _spreads(rows, groups, lams, ["_centre"] if look == 0 else ["_centre", "_low", "_step"])
        state = spreads.mapInPandas(narrow(len(lams), first if look == 0 else None), out).checkpoint()
    return state.drop("_low", "_step")


def boxcox_lambda(df: DataFrame, x: str, groups: list[str] | None = None) -> DataFrame:
    """Maximum-likelihood Box-Cox lambda (`lmbda`) of the positive values, over all rows or per group.

    A few looks at a narrowing grid of candidates, each one aggregation. Between looks the state is one row
    per group, kept as a table; over all rows it is a pair of numbers. A group without spread has no row in
    the result.
    """
    return _fit(df, x, groups or []).drop("_centre")


def zscore(df: DataFrame, x: str, out: str, groups: list[str] | None = None) -> DataFrame:
    """(x - mean) / population deviation; 0 where there is no spread, NULL for NULL."""
    moments = F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))
    if groups:
        values = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), moments.alias("_m"))
        rows = lookup_join(df, values.drop("n"), groups, "left")
    else:
        rows = df.withColumn("_m", df.agg(moments.alias("_m")).scalar())
    centred = F.col(x) - F.col("_m.mean")
    spread = F.col("_m.std")
    return rows.withColumn(out, F.when(spread > 0, centred / spread).otherwise(centred * 0)).select(*df.columns, out)


def boxcox_scale(
    df: DataFrame, x: str, out: str, groups: list[str] | None = None, add_one: bool = False
) -> DataFrame:
    """Box-Cox transform with the fitted lambda, then standard scaling.

    Values that are not positive give NULL; positive values without spread give 0.
    """
    groups = groups or []
    rows = df.withColumn("_x", F.col(x) + F.lit(1.0 if add_one else 0.0))
    fitted = _fit(rows, "_x", groups)
    if groups:
        rows = lookup_join(rows, fitted, groups, "left")
    else:
        row = fitted.first()
        rows = rows.withColumns({c: F.lit(row[c] if row else None).cast("double") for c in fitted.columns})
    # No lambda means no spread: any lambda then gives a constant, which scales to 0.
    log = F.ln("_x") - F.coalesce("_centre", F.lit(0.0))
    rows = rows.withColumn("_bc", F.when(F.col("_x") > 0, boxcox(log, F.coalesce("lmbda", F.lit(1.0)))))
    return zscore(rows, "_bc", out, groups).select(*df.columns, out)
