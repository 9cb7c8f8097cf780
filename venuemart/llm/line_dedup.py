"""Line dedup: documents probe the arrays behind a sharded minimal perfect hash over distinct line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm import mphf
from venuemart.llm.common import packed, parts_for, stored, text_of, with_fields

#: The repeated lines of most documents, at most this many, go to every executor (13 bytes each).
COMMON = 1_000_000
#: Probes that one shard of the other lines gets, on average.
SHARD = 500_000

INDEX = "shard int, levels array<int>, bits binary, prints binary, counts binary"


def line_hashes(text: str) -> tuple[list[bytes], np.ndarray]:
    """The lines of a text, and two unsigned 64-bit hashes of each line's key."""
    lines = text.encode().split(b"\n")
    raw = b"".join(xxhash.xxh3_128_digest(line.strip().lower()) for line in lines)
    return lines, np.frombuffer(raw, "<u8").reshape(-1, 2)


def _key_lengths(lines: list[bytes]) -> np.ndarray:
    return np.array([len(line.strip().decode()) for line in lines])


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct keys of each document."""
    for batch in batches:
        parts, sizes = [], []
        for text in batch.column("text").to_pylist():
            keys = np.unique(line_hashes(text)[1], axis=0)
            parts.append(keys)
            sizes.append(len(keys))
        keys = np.concatenate(parts).view(np.int64) if parts else np.zeros((0, 2), np.int64)
        back = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("k1", "k2")]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*back, keys[:, 0].copy(), keys[:, 1].copy())], ["k1", "k2", "a", "b"])


def arrays(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[list[int], bytes, bytes, bytes]:
    """The hash over the keys; in slot order their fingerprints (b) and document counts (up to 2^32 - 1)."""
    levels, bits = mphf.build(a, b)
    order = np.argsort(mphf.Slots(levels, bits).find(a, b))
    counts = np.minimum(n[order], 2**32 - 1).astype("<u4")
    return levels, bits, b[order].astype("<u8").tobytes(), counts.tobytes()


class Lines:
    """Document counts of lines, from the arrays."""

    def __init__(self, levels, bits, prints, counts):
        self.slots = mphf.Slots(levels, bits)
        self.prints, self.counts = np.frombuffer(prints, "<u8"), np.frombuffer(counts, "<u4")

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """0 for lines that the index does not hold."""
        if not len(self.prints):
            return np.zeros(len(a), np.uint32)
        slot = self.slots.find(a, b)
        at = np.maximum(slot, 0)
        return np.where((slot >= 0) & (self.prints[at] == b), self.counts[at], 0)


def _build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    made = arrays(mphf.unsigned(part["a"]), mphf.unsigned(part["b"]), part["n"].to_numpy())
    return pd.DataFrame([[key[0], *made]], columns=["shard", "levels", "bits", "prints", "counts"])


def repeated_lines(docs: DataFrame, min_docs: int, common: int = COMMON, shard: int = SHARD):
    """What `drop_lines` needs: the arrays of the common lines, and, unless these are all repeated lines, the other
    repeated lines of each text and the texts that have none because they are common themselves.

    docs: text, k1, k2 (two hashes of the text). Only lines of at least `min_docs` documents are indexed, no other
    line can go. A line is common if also at least total / `common` documents have it, so there are at most `common`
    such lines whatever the data; no other line fills more than that share of the probes, which makes the shards
    even. Texts are told by their hashes: the verdicts on the lines of equal texts are the same.
    """
    spark = docs.sparkSession
    lines = docs.select("text", "k1", "k2").mapInArrow(_explode, "k1 bigint, k2 bigint, a bigint, b bigint")
    held_counts = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    # Lines of fewer documents are only counted, by their number of documents; nothing else of them is kept.
    counts = stored(held_counts.groupBy("n", F.when(F.col("n") >= min_docs, F.struct("a", "b")).alias("line")).agg(F.count(F.lit(1)).alias("m")), "counts")
    total = counts.agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    counts = counts.where("line is not null").select("line.a", "line.b", "n")
    least = max(min_docs, -(-total // common))
    top = counts.where(F.col("n") >= least).toPandas()
    held = arrays(mphf.unsigned(top["a"]), mphf.unsigned(top["b"]), top["n"].to_numpy())
    sent = spark.sparkContext.broadcast(held)
    if least == min_docs:
        return sent, None, None

    def others(batches):
        known = Lines(*sent.value)
        for batch in batches:
            a, b = (mphf.unsigned(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("a", "b"))
            yield batch.filter(pa.array(known.count(a, b) == 0))

    def probe(key, asked, index):
        if not len(index) or not len(asked):
            return asked[["k1", "k2", "a", "b"]].iloc[:0]
        n = Lines(*index.iloc[0][["levels", "bits", "prints", "counts"]]).count(mphf.unsigned(asked["a"]), mphf.unsigned(asked["b"]))
        return asked.loc[n >= min_docs, ["k1", "k2", "a", "b"]]

    shards = parts_for(total, shard)
    to_shard = F.pmod(F.xxhash64("a", "b"), F.lit(shards)).cast("int")
    index = stored(counts.where(F.col("n") < least).withColumn("shard", to_shard).groupBy("shard").applyInPandas(_build, INDEX), "index")
    asked = lines.mapInArrow(others, lines.schema).withColumn("shard", to_shard)
    found = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(probe, "k1 bigint, k2 bigint, a bigint, b bigint")
    copies = docs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    texts = copies.where(F.col("n") >= least).select("k1", "k2", F.lit(True).alias("hot"))
    return sent, found.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("drop")), texts


def drop_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", common: int = COMMON, shard: int = SHARD) -> DataFrame:
    """Rows of docs as struct `row`, with n_lines, n_dropped and `kept`, the text that is left.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least `min_chars`
    code points that `min_docs` documents hold lose all their lines. Null text counts as one empty line. A
    repeated row counts as a document of its own. A text whose lines all go becomes empty. Other columns pass
    through whatever their names.
    """
    base = packed(docs, text=text_of(text_col), k1=F.xxhash64(text_of(text_col)), k2=F.xxhash64(F.lit(1), text_of(text_col)))
    sent, verdicts, texts = repeated_lines(base, min_docs, common, shard)
    if verdicts is None:
        joined = base.select("row", "text", F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("drop"))
    else:
        # All lines of a text with that many copies are common, and there are at most `common` such texts: their
        # rows need no verdict and are spread by number.
        spread = base.join(F.broadcast(texts), ["k1", "k2"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        spread = spread.withColumn("k1", F.when(F.col("hot"), F.monotonically_increasing_id()).otherwise(F.col("k1")))
        joined = spread.join(verdicts.withColumn("hot", F.lit(False)), ["k1", "k2", "hot"], "left").select("row", "text", "drop")
    fields = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())]

    def cut(batches):
        known = Lines(*sent.value)
        for batch in batches:
            out = []
            for text, drop in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist(), strict=True):
                lines, keys = line_hashes(text)
                gone = known.count(keys[:, 0], keys[:, 1]) >= min_docs
                if drop:
                    rare = {(x["a"], x["b"]) for x in drop}
                    gone |= np.fromiter(((x, y) in rare for x, y in keys.view(np.int64).tolist()), bool, len(lines))
                if gone.any():
                    gone &= _key_lengths(lines) >= min_chars
                kept = b"\n".join(line for line, x in zip(lines, gone, strict=True) if not x)
                out.append((len(lines), int(gone.sum()), kept.decode()))
            made = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(x, k) for x, k in zip(made, kinds, strict=True)]], ["row", "n_lines", "n_dropped", "kept"])

    return joined.mapInArrow(cut, with_fields(T.StructType([joined.schema["row"]]), *fields))
