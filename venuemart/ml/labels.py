"""Label scores of texts: averaged vectors of hashed words and character n-grams, and a softmax on top.

A text is the mean of the vectors of its words, of the character n-grams of the marked words, and of one feature
that every text has. Vectors and softmax weights are learned together by mini-batches: tasks turn their rows
into gradients, these are summed by feature, and the driver, which holds nothing but the model, takes a step.
As the scores are linear in the mean, a learned model is one table of logits by feature and label.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.session import use_checkpoints

#: Lengths of the character n-grams.
GRAMS = (3, 4, 5)
#: Places that words and n-grams are hashed to, and length of their vectors.
BUCKETS, WIDTH = 1 << 15, 16
#: Texts whose features a task holds at once: so many, or fewer of so many characters together.
SLICE, LETTERS = 512, 1 << 20

words_of = re.compile(r"\w+").findall
# CRC-32 of a byte after each remainder, as `zlib.crc32` computes it.
_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, (_TABLE >> 1) ^ np.uint32(0xEDB88320), _TABLE >> 1)


def _grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of `GRAMS`: word, place in it, and CRC-32 of all n-grams of the marked words, in order."""
    data = np.frombuffer("".join([f"<{w}>" for w in words]).encode(), np.uint8)
    heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(lengths)
    word, state, place = np.repeat(np.arange(len(words)), lengths), np.full(len(heads) - 1, 0xFFFFFFFF, np.uint32), np.arange(len(heads) - 1)
    for n in range(1, max(GRAMS) + 1):
        long_enough = place + n <= ends[word]
        word, state, place = word[long_enough], state[long_enough], place[long_enough]
        at, sizes = heads[place + n - 1], np.diff(heads)[place + n - 1]
        for byte in range(int(sizes.max(initial=0))):
            own = slice(None) if byte == 0 else np.flatnonzero(sizes > byte)
            state[own] = _TABLE[(state[own] ^ data[at[own] + byte]) & 0xFF] ^ (state[own] >> 8)
        if n in GRAMS:
            yield word, place - (ends - lengths)[word], state ^ np.uint32(0xFFFFFFFF)


def _of_words(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of the words one after the other, and where each word's begin."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    found = list(_grams(words))
    starts = np.cumsum([np.zeros(len(words), np.int64), np.ones(len(words), np.int64), *[np.bincount(w, minlength=len(words)) for w, _, _ in found]], axis=0)
    firsts = np.append(0, np.cumsum(starts[-1]))
    out = np.empty(firsts[-1], np.int64)
    out[firsts[:-1]] = [crc32(f" {w}".encode()) % buckets for w in words]
    for k, (word, place, code) in enumerate(found):
        out[firsts[word] + starts[k + 1][word] + place] = code % buckets
    return out, firsts


def _counted(ids: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    if 16 * len(ids) < buckets:
        met, at = np.unique(ids, return_inverse=True)
        return met, np.bincount(at, counts).astype(np.int64)
    sums = np.bincount(ids, counts, buckets)
    met = np.flatnonzero(sums)
    return met, sums[met].astype(np.int64)


def features_of(texts: list[str | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different features of each text, numbers below `buckets`, ascending, and how often each occurs.

    Different words of some texts are looked at once, all together.
    """
    at, every = 0, np.array([crc32(b" ") % buckets])
    while at < len(texts):
        index: dict[str, int] = {}
        own, letters = [], 0
        while at < len(texts) and (not own or letters + len(texts[at] or "") <= LETTERS):
            own.append(np.array([index.setdefault(w, len(index)) for w in words_of((texts[at] or "").lower())], np.int64))
            letters, at = letters + len(texts[at] or ""), at + 1
        features, firsts = _of_words(list(index), buckets)
        for numbers in own:
            met, times = np.unique(numbers, return_counts=True)
            sizes = firsts[met + 1] - firsts[met]
            ends = np.cumsum(sizes)
            ids = features[np.repeat(firsts[met] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
            yield _counted(np.append(ids, every), np.append(np.repeat(times, sizes), 1), buckets)


def featured(df: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """df without `text`, with `ids` (different features) and `counts`. A text has at most `buckets` features.

    Null text counts as empty: it has the one feature that all texts have.
    """
    kept = [f for f in df.schema.fields if f.name != text]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = list(features_of(batch.column(text).to_pylist(), buckets))
                made = [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in (0, 1)]
                names = [*[f.name for f in kept], "ids", "counts"]
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *made], names)

    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType([*kept, T.StructField("ids", numbers), T.StructField("counts", numbers)])
    return df.mapInArrow(run, schema)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all rows one after the other: row number, feature, and share of the row."""
    lists = batch.column("ids")
    sizes = np.diff(lists.offsets.to_numpy())
    rows = np.repeat(np.arange(batch.num_rows), sizes)
    ids, counts = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(float)
    return rows, ids, counts / np.bincount(rows, counts, batch.num_rows)[rows]


def softmax(logits: np.ndarray) -> np.ndarray:
    scaled = np.exp(logits - logits.max(axis=1, keepdims=True))
    return scaled / scaled.sum(axis=1, keepdims=True)


def _gradients(sent):
    def run(batches):
        vectors, weights = sent.value
        width, buckets = vectors.shape
        by_vector, by_weight, n = np.zeros_like(vectors), np.zeros_like(weights), 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows, ids, share = _flat(batch)
                mean = np.stack([np.bincount(rows, share * v[ids], batch.num_rows) for v in vectors], axis=1)
                off = softmax(mean @ weights)
                off[np.arange(len(off)), batch.column("y").to_numpy()] -= 1.0
                by_weight += mean.T @ off
                back = off @ weights.T
                for j in range(width):
                    by_vector[j] += np.bincount(ids, share * back[rows, j], buckets)
                n += len(off)
        if n:
            met = np.flatnonzero(by_vector.any(axis=0))
            at = np.concatenate([met, buckets + np.arange(weights.shape[1])])
            sums = np.concatenate([by_vector[:, met], by_weight], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *map(pa.array, sums)], ["at", *[f"g{j}" for j in range(width)]])

    return run


class Steps:
    """Adam: steps by running means of the gradient and of its square."""

    def __init__(self, shape: tuple[int, ...], rate: float):
        self.mean, self.square, self.rate, self.n = np.zeros(shape), np.zeros(shape), rate, 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.n += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient**2 - self.square)
        return -self.rate * (self.mean / (1 - 0.9**self.n)) / (np.sqrt(self.square / (1 - 0.999**self.n)) + 1e-8)


@dataclass
class LabelModel:
    """logits: by label and feature; a text's logits are the means over its features."""

    labels: list[str]
    logits: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        """A table of one row per feature: `bucket` and a column per label."""
        held = pd.DataFrame(self.logits.T, columns=self.labels)
        held.insert(0, "bucket", np.arange(len(held)))
        spark.createDataFrame(held).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LabelModel:
        held = spark.read.parquet(path).orderBy("bucket").toPandas().drop(columns="bucket")
        return cls(list(held.columns), held.to_numpy().T.copy())


def fit(
    df: DataFrame, text: str, label: str, labels: list[str], epochs: int = 6, batches: int = 4, rate: float = 0.1,
    buckets: int = BUCKETS, width: int = WIDTH, seed: int = 0,
) -> LabelModel:
    """Learn all `labels` from the rows of df; rows with another label or none teach nothing.

    A row's mini-batch is drawn by the hash of its text. Features are stored once, by mini-batch, so a step reads
    its own rows only. What a task sends on is at most one row per feature, and so is what the driver gets.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    number = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label).cast("string")).cast("int") - 1
    rows = df.select(F.col(text).cast("string").alias("text"), number.alias("y")).where("y >= 0")
    rows = rows.withColumn("batch", F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(batches)).cast("int"))
    folder = f"{spark.sparkContext.getCheckpointDir()}/labels-{uuid.uuid4().hex}"
    featured(rows, "text", buckets).write.partitionBy("batch").parquet(folder)
    stored = spark.read.schema("y int, ids array<int>, counts array<int>, batch int").parquet(folder)
    sizes = {r.batch: r.n for r in stored.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}

    vectors = np.random.default_rng(seed).uniform(-1, 1, (width, buckets)) / width
    weights = np.zeros((width, len(labels)))
    of_vectors, of_weights = Steps(vectors.shape, rate), Steps(weights.shape, rate)
    names = [f"g{j}" for j in range(width)]
    for _ in range(epochs):
        for b in sorted(sizes):
            sent = spark.sparkContext.broadcast((vectors, weights))
            found = stored.where(F.col("batch") == b).select("y", "ids", "counts")
            found = found.mapInArrow(_gradients(sent), "at long, " + ", ".join(f"{g} double" for g in names))
            sums = found.groupBy("at").agg(*[F.sum(g).alias(g) for g in names]).toPandas()
            gradient = np.zeros((width, buckets + len(labels)))
            gradient[:, sums["at"].to_numpy()] = sums[names].to_numpy().T / sizes[b]
            vectors = vectors + of_vectors.step(gradient[:, :buckets])
            weights = weights + of_weights.step(gradient[:, buckets:])
            sent.unpersist()
    return LabelModel(list(labels), weights.T @ vectors)


def scorer(model: LabelModel) -> Callable[[DataFrame, str], DataFrame]:
    """A label scorer for `text_features`: adds one column per label, the probabilities of a row's text.

    Null text is scored as empty. Columns of df that are named like a label are replaced.
    """

    def score(df: DataFrame, text: str) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(model.logits)

        @F.pandas_udf("array<double>")
        def probabilities(texts: pd.Series) -> pd.Series:
            logits = sent.value
            out = []
            for ids, counts in features_of(list(texts), logits.shape[1]):
                out.append(softmax((logits[:, ids] @ (counts / counts.sum()))[None])[0])
            return pd.Series(out)

        scored = df.withColumn("_scores", probabilities(F.col(text)))
        return scored.withColumns({x: F.get("_scores", F.lit(i)) for i, x in enumerate(model.labels)}).drop("_scores")

    return score
