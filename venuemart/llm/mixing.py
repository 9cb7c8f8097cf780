"""Mixing sources to target weights by pivotal dependent rounding over a distributed reduction tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuemart.llm.common import SPACE_RUN, packed, parts_for, stored, text_of

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
#: Documents that meet in one leaf of the tree on average, and residuals in one node above.
LEAF = 4096
FAN = 64

UNITS = "no int, node bigint, row bigint, id bigint, size bigint, base int, part double"


def word_count(text: Column) -> Column:
    trimmed = F.regexp_replace(text, rf"^{SPACE_RUN}|{SPACE_RUN}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("bigint")


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: no (by code point from 1, null last), n, source_size, target.

    The targets share all words by weight. A target is at most `most` times its source's size; what exceeds
    that goes to the others by weight until none is above. The sources whose target stops are those with the
    least size per weight, so running sums in that order find the common level. One row per source is all that
    meets in one task.
    """
    sums = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    named = sums.withColumn("no", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("no") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = named.withColumn("weight", weight).withColumn("full", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("full") / F.col("weight"), "no")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    level = rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("at", F.row_number().over(order)).withColumn("level", level)
    first = F.min(F.when(F.col("full") / F.col("weight") >= F.col("level"), F.struct("at", "level")))
    ranked = ranked.withColumn("level", first.over(every)["level"])
    return ranked.select("source", "no", "n", "source_size", F.least("full", F.col("weight") * F.col("level")).alias("target"))


def _pivot(part: pd.DataFrame, rng: np.random.Generator) -> pd.DataFrame:
    """Round all units but at most one; the words expected of the whole stay as they are.

    The unit in hand and the next one exchange words until one of the two is whole. Which of them gains is
    drawn so that neither's expectation changes. Larger documents come first, so the one left over is small.
    """
    part = part.sort_values(["size", "id", "row"], ascending=[False, True, True]).reset_index(drop=True)
    share, size = part["part"].to_numpy().copy(), part["size"].to_numpy()
    draws, held = rng.random(len(part)), -1
    for j in range(len(part)):
        if not 0 < share[j] < 1:
            continue
        if size[j] == 0:
            share[j] = float(draws[j] < share[j])
            continue
        if held < 0:
            held = j
            continue
        i = held
        up, down = min((1 - share[i]) * size[i], share[j] * size[j]), min(share[i] * size[i], (1 - share[j]) * size[j])
        move = up if draws[j] * (up + down) < down else -down
        a, b = share[i] + move / size[i], share[j] - move / size[j]
        first_whole = (1 - share[i]) * size[i] <= share[j] * size[j] if move > 0 else share[i] * size[i] <= (1 - share[j]) * size[j]
        if first_whole:
            share[i], share[j], held = round(a), min(max(b, 0.0), 1.0), j
        else:
            share[i], share[j] = min(max(a, 0.0), 1.0), round(b)
        if not 0 < share[held] < 1:
            held = -1
    part["part"] = share
    return part


def _round_at(level: int, seed: int):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _pivot(part, np.random.default_rng([seed, level, *map(int, key)]))

    return run


def copies(units: DataFrame, most_leaves: int, seed: int, fan: int = FAN) -> DataFrame:
    """(row, copies) of units (no, node, row, id, size, base, part).

    Leaves round their documents and hand one residual each to the node above; `fan` nodes meet in one. What
    is left of a source at the top is drawn by its probability.
    """
    level, nodes, done = 0, most_leaves, []
    while True:
        units = stored(units.groupBy("no", "node").applyInPandas(_round_at(level, seed), UNITS), f"level{level}")
        open_ = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(units.where(~open_).select("row", (F.col("base") + F.col("part").cast("int")).alias("copies")))
        units = units.where(open_)
        if nodes <= 1:
            break
        units, nodes, level = units.withColumn("node", F.floor(F.col("node") / fan)), parts_for(nodes, fan), level + 1
    draw = F.pmod(F.xxhash64(F.lit(seed), "no"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    done.append(units.select("row", (F.col("base") + (draw < F.col("part")).cast("int")).alias("copies")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def plan_mix(held: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 9, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """held (row, id, source, size; a stored table) with source_size, target and copies."""
    targets = stored(source_targets(held, weights, most), "targets")
    met = held.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    leaves = F.ceil(F.col("n") / leaf)
    met = met.withColumn("rate", rate).withColumn("base", F.floor("rate").cast("int")).withColumn("part", F.col("rate") - F.col("base"))
    units = met.withColumn("node", F.pmod(F.xxhash64(F.lit(seed), "id", "size"), leaves)).select("no", "node", "row", "id", "size", "base", "part")
    most_leaves = parts_for(targets.agg(F.max("n")).first()[0] or 0, leaf)
    return met.select("row", "id", "size", "source_size", "target").join(copies(units, most_leaves, seed, fan), "row")


def _held(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    return {
        "row": F.monotonically_increasing_id(), "id": F.col(id_col).cast("bigint"), "source": F.col(source_col).cast("string"), "size": word_count(text_of(text_col)),
    }


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """Per row: id, size in words, the source's size and target in words, and `taken`, the words the mix takes.

    All rows of a source have the same expected number of copies, target / size, at most `most`; each gets it
    rounded up or down, and the words of a source miss its target by less than one document. Equal seeds give
    equal copies whatever the partitions.

    A null text has no words, a null source is a source. Texts without words take nothing; their copies are
    drawn one by one. Repeated rows are separate documents, told apart by their place in the stored table. An
    empty table gives an empty result. Other columns are not read.
    """
    keys = _held(docs, id_col, text_col, source_col)
    held = stored(docs.select(*[v.alias(k) for k, v in keys.items()]), "held")
    out = plan_mix(held, **how)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix takes it. The table is stored once, with row numbers."""
    keys = _held(docs, id_col, text_col, source_col)
    base = stored(packed(docs, row_no=keys.pop("row"), **keys), "documents")
    planned = plan_mix(base.select("row_no", "id", "source", "size").withColumnRenamed("row_no", "row"), **how)
    return base.join(planned.where("copies > 0").select(F.col("row").alias("row_no"), "copies"), "row_no").select(
        "row", F.explode(F.sequence(F.lit(1), "copies"))
    ).select("row.*")
