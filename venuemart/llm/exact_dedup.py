"""Exact dedup with a minimal perfect hash over the distinct digests of a history."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart.llm import mphf
from venuemart.llm.common import SPACE_RUN, parts_for, stored, text_of

#: Digests of one shard of the index, about 60 bytes each.
SHARD = 100_000

INDEX = "shard int, levels array<int>, bits binary, digests binary, nones array<boolean>, ids array<bigint>, rows array<bigint>, sizes array<bigint>"
GROUPS = "digest binary, keep_none boolean, keep_id bigint, keep_row bigint, group_size bigint"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text whose white-space runs are one blank."""
    return F.unhex(F.sha2(F.regexp_replace(text, SPACE_RUN, " "), 256))


def _halves(digests: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    held = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    words = held[:, :16].copy().view("<u8")
    return held, words[:, 0].copy(), words[:, 1].copy()


def _build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    held, a, b = _halves(part["digest"])
    levels, bits = mphf.build(a, b)
    slot = mphf.Slots(levels, bits).find(a, b)
    order = np.argsort(slot)
    row = [key[0], levels, bits, held[order].tobytes()]
    row += [part[c].iloc[order].tolist() for c in ("none", "id", "row", "size")]
    return pd.DataFrame([row], columns=["shard", "levels", "bits", "digests", "nones", "ids", "rows", "sizes"])


def _probe(key: tuple, new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    came = list(zip(*(new[c].tolist() for c in ("none", "id", "row", "size")), strict=True))
    if not len(index):
        return pd.DataFrame([(d, *x) for d, x in zip(new["digest"], came, strict=True)], columns=_COLUMNS)
    at = index.iloc[0]
    slots = np.frombuffer(at["digests"], np.uint8).reshape(-1, 32)
    keep = list(zip(*(at[c].tolist() for c in ("nones", "ids", "rows", "sizes")), strict=True))
    out = []
    if len(new):
        held, a, b = _halves(new["digest"])
        slot = mphf.Slots(at["levels"], at["bits"]).find(a, b)
        member = (slot >= 0) & (slots[np.maximum(slot, 0)] == held).all(axis=1)
        for digest, x, k, known in zip(new["digest"], came, slot, member, strict=True):
            if known:
                old = keep[k]
                # The smaller id, then row; no id comes last.
                keep[k] = (*min(old[:3], x[:3]), old[3] + x[3])
            else:
                out.append((digest, *x))
    out += [(slots[k].tobytes(), *x) for k, x in enumerate(keep)]
    return pd.DataFrame(out, columns=_COLUMNS)


_COLUMNS = ["digest", "keep_none", "keep_id", "keep_row", "group_size"]


def history_index(groups: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the hash, and in its slots the digests, winners (id and row) and group sizes."""
    dealt = groups.withColumn("shard", _shard(shards))
    return dealt.groupBy("shard").applyInPandas(_build, INDEX)


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def exact_dedup(docs: DataFrame, historical: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    Rows where `historical` holds make the index; the others look their digest up. A digest found byte for
    byte in its slot joins that group, any other starts a group of its own. Copies are folded (smallest id,
    count) before anything is shuffled by digest, so a text that fills a third of the table is one probe.

    Null text counts as empty. A null id comes after all ids. Rows alike in id and text are told apart by
    their place in the stored table, so exactly one row of each group is kept. Further columns are not read,
    an empty table gives an empty result.
    """
    keyed = docs.select(
        F.col(id_col).cast("bigint").alias("id"), digest_of(text_of(text_col)).alias("digest"), F.coalesce(historical, F.lit(False)).alias("old"), F.monotonically_increasing_id().alias("row")
    )
    keyed = stored(keyed, "digests")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row")))
    groups = keyed.groupBy("digest", "old").agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
    # Ids go to Python without nulls, beside a flag, and so stay whole numbers.
    groups = stored(groups.select("digest", "old", "best.none", F.coalesce("best.id", F.lit(0)).alias("id"), "best.row", "size"), "groups")
    shards = parts_for(groups.count(), SHARD)
    index = stored(history_index(groups.where("old").drop("old"), shards), "index")
    new = groups.where(~F.col("old")).drop("old").withColumn("shard", _shard(shards))
    found = new.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_probe, GROUPS)
    return keyed.join(found, "digest").select(
        F.col("id").alias(id_col), F.when(~F.col("keep_none"), F.col("keep_id")).alias("keep_id"), "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
