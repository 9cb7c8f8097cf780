"""Whole texts of keys of any size, in parts with their offsets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuemart.operators.ids import checkpoint_sorted


def text_parts(df: DataFrame, key: str, position: str, text: str, size: int = 1 << 20, glue: str = ".") -> DataFrame:
    """The text of each key, its rows joined in order of position, in parts: key, part, start, text.

    A row belongs to the part in which it starts, parts being `size` characters of the key's whole text, so
    no cell holds more than `size` characters and one row's text. Parts in order, joined by `glue`, make the
    whole text; `start` is where a part begins in it. A part number is left out if no row starts there. Parts do not
    depend on the layout of df. Rows without a text are left out; a NULL key is a key; equal positions of a
    key are ordered by text.

    A sort by range spreads a large key over many tasks. The offset of a key that goes on from one task to the next
    is the sum of its lengths in the tasks before: one number per task, the only thing that is broadcast.
    """
    rows = df.select(F.col(key).alias("k"), F.col(position).alias("p"), F.col(text).alias("t")).where("t IS NOT NULL")
    rows = checkpoint_sorted(rows, [F.col("k"), F.col("p"), F.col("t")])
    rows = rows.withColumn("task", F.shiftright(F.monotonically_increasing_id(), 33))
    lengths = rows.groupBy("k", "task").agg(F.sum(F.char_length("t") + len(glue)).alias("n"))
    earlier = Window.partitionBy("k").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = lengths.select(F.col("k").alias("bk"), F.col("task").alias("btask"), F.sum("n").over(earlier).alias("before"))
    begun = F.broadcast(begun.where("before IS NOT NULL"))
    met = rows.join(begun, (F.col("task") == F.col("btask")) & F.col("k").eqNullSafe(F.col("bk")), "left")
    met = met.select("k", "t", F.coalesce("before", F.lit(0)).cast("long").alias("before"))

    def run(batches):
        own, at = None, None
        for batch in batches:
            starts = []
            for k, t, before in zip(*(batch.column(c).to_pylist() for c in ("k", "t", "before")), strict=True):
                if at is None or k != own:
                    own, at = k, before
                starts.append(at)
                at += len(t) + len(glue)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("t"), pa.array(starts, pa.int64())], ["k", "t", "start"])

    placed = met.mapInArrow(run, met.drop("before").schema.add("start", "long"))
    placed = placed.withColumn("part", F.expr(f"start div {size}"))
    ordered = F.array_sort(F.collect_list(F.struct("start", "t")))
    parts = placed.groupBy("k", "part").agg(F.min("start").alias("start"), F.array_join(F.transform(ordered, lambda r: r["t"]), glue).alias(text))
    return parts.select(F.col("k").alias(key), "part", "start", text)
