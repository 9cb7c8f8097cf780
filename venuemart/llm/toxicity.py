"""Toxicity by class-conditional Kneser-Ney models of word pairs.

A toxic and an ordinary model are counted over labelled texts. Both interpolate their own discounted pair
counts with their own continuation counts, and those with one continuation model counted over both classes.
An expression that is too rare or too even to tell the classes apart has no counts of its own: both take it from
the shared model, so it decides next to nothing. A text's score compares its two log-likelihoods per word, of the whole and of its
worst passage, calibrated on labelled texts that were not counted.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm.common import bounded, packed, stored, text_of, with_fields

#: Labelled rows to learn from at most, chosen by the hash of their id.
LABELLED = 500_000
#: Words and pairs that the models hold one by one at most; rarer ones share a place or back off.
WORDS = 100_000
PAIRS = 1_000_000
#: Share of the labelled rows that are not counted but calibrate the score: one of so many.
CALIBRATE = 4

#: Log-likelihood ratio in nats that the counts of an expression must reach against the same split as all.
EVIDENCE = 14.0
#: The same per occurrence: slighter differences come from topics and from the unequal sizes of the classes.
CONTRAST = 0.5
#: Words of a passage.
PASSAGE = 4

UNKNOWN, START = 0, 1

words_of = re.compile(r"[^\W_]+").findall


@dataclass
class Model:
    """words: ids from 2. keys: sorted v * size + w of the pairs held. pair, word, back: per class, the
    probabilities of pairs, of words alone, and the weight of the latter after each word."""

    words: dict[str, int]
    keys: np.ndarray
    pair: np.ndarray
    word: np.ndarray
    back: np.ndarray
    weights: np.ndarray | None = None

    def ids(self, text: str) -> np.ndarray:
        get = self.words.get
        return np.array([START, *[get(w, UNKNOWN) for w in words_of(text.lower())]], np.int64)

    def likelihoods(self, text: str) -> tuple[float, float, float, int]:
        """Log-likelihoods per word, ordinary and toxic; their largest difference over a passage; words."""
        ids = self.ids(text)
        if len(ids) == 1:
            return 0.0, 0.0, 0.0, 0
        v, w = ids[:-1], ids[1:]
        p = self.back[:, v] * self.word[:, w]
        if len(self.keys):
            key = v * self.word.shape[1] + w
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            p += np.where(self.keys[at] == key, self.pair[:, at], 0)
        p = np.log(p)
        ordinary, toxic = p.mean(axis=1)
        run = np.concatenate([[0.0], np.cumsum(p[1] - p[0])])
        size = min(PASSAGE, len(w))
        return float(ordinary), float(toxic), float((run[size:] - run[:-size]).max() / size), len(w)


def features(ordinary: np.ndarray, toxic: np.ndarray, worst: np.ndarray) -> np.ndarray:
    """The differences per word over the text and over its worst passage."""
    return np.stack([np.ones_like(worst), toxic - ordinary, worst], axis=1)


def _count_words(batches):
    for batch in batches:
        seen = Counter()
        for text in batch.column("text").to_pylist():
            seen.update(words_of(text.lower()))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])


def _count_pairs(sent, size):
    def run(batches):
        model = Model(sent.value, None, None, None, None)
        for batch in batches:
            held = {0: [np.zeros(0, np.int64)], 1: [np.zeros(0, np.int64)]}
            for text, c in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                ids = model.ids(text)
                held[c].append(ids[:-1] * size + ids[1:])
            for c, keys in held.items():
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key), pa.array(n)], ["toxic", "key", "n"])

    return run


def _cutoff(counts: DataFrame, most: int) -> int:
    """The least n that at most `most` rows reach. Few different n occur."""
    total = 0
    for n, rows in sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True):
        total += rows
        if total > most:
            return n + 1
    return 1


def evidence(ordinary, toxic, share, log):
    """How far the counts of an expression are from the split that `share` of all counts be toxic (nats)."""
    n = ordinary + toxic
    return toxic * log((toxic + 1e-9) / (n * share)) + ordinary * log((ordinary + 1e-9) / (n * (1 - share)))


def estimate(pairs: pd.DataFrame, kinds: np.ndarray, after: np.ndarray, ones: dict, words: dict, size: int, enough: float = EVIDENCE) -> Model:
    """pairs (key, n0, n1): those held. kinds (2, size): kinds of words seen before w, by class. after
    (2, size): occurrences of v as a first word. ones: class to (pairs seen once, pairs seen twice)."""
    keys = pairs["key"].to_numpy(np.int64)
    order = np.argsort(keys)
    keys, held = keys[order], pairs[["n0", "n1"]].to_numpy(float)[order].T
    base = (kinds.sum(axis=0) + 1) / (kinds.sum() + size)
    share = min(max(kinds[1].sum() / max(kinds.sum(), 1), 1e-6), 1 - 1e-6)
    seen = np.where(kinds.sum(axis=0) > 0, kinds, 1)
    apart = evidence(*seen, share, np.log)
    told = (apart >= enough) & (apart >= CONTRAST * seen.sum(axis=0))
    word, back, pair = np.zeros((2, size)), np.ones((2, size)), np.zeros((2, len(keys)))
    for c in (0, 1):
        once, twice = ones.get(c, (0, 0))
        discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.75
        total = max(kinds[c].sum(), 1)
        own = np.maximum(kinds[c] - discount, 0) / total + discount * (kinds[c] > 0).sum() / total * base
        word[c] = np.where(told, own, base * (1 - own[told].sum()) / base[~told].sum())
        pair[c] = np.maximum(held[c] - discount, 0) / np.maximum(after[c][keys // size], 1)
        back[c] -= np.bincount(keys // size, pair[c], size)
    return Model(words, keys, pair, word, np.maximum(back, 1e-6))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression with a slight penalty, by Newton steps."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9) if len(x) else np.ones(x.shape[1])
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (p - y) + 1e-2 * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labelled: int = LABELLED, words: int = WORDS, pairs: int = PAIRS) -> Model:
    """Learn from the rows of labels (id, 0 or 1) and the texts of docs.

    Up to `labelled` labels are sent to the documents, so no text is shuffled; words and pairs of words are
    counted where the texts are read, and the driver gets at most `words` words and `pairs` pairs. Null ids and
    labels teach nothing; of contradicting labels of an id the larger counts. Without any labels all scores
    are 0.5.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.dropna().groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.withColumn("fold", F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(CALIBRATE)))
    known = bounded(stored(known, "labels"), "id", labelled)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    texts = texts.join(F.broadcast(known), "id")
    counted = texts.where("fold != 0").select("text", "toxic")

    seen = stored(counted.mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    least = max(2, _cutoff(seen, words))
    names = sorted(r.word for r in seen.where(F.col("n") >= least).select("word").toLocalIterator())
    ids, size = {w: k for k, w in enumerate(names, 2)}, len(names) + 2
    sent = spark.sparkContext.broadcast(ids)
    met = counted.mapInArrow(_count_pairs(sent, size), "toxic int, key bigint, n bigint").groupBy("toxic", "key").agg(F.sum("n").alias("n"))
    met = stored(met.withColumn("v", F.expr(f"key div {size}")).withColumn("w", F.expr(f"key % {size}")), "pairs")
    kinds, after = np.zeros((2, size)), np.zeros((2, size))
    for r in met.groupBy("toxic", "w").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        kinds[r.toxic, r.w] = r.n
    for r in met.groupBy("toxic", "v").agg(F.sum("n").alias("n")).toLocalIterator():
        after[r.toxic, r.v] = r.n
    few = met.groupBy("toxic").agg(F.count_if(F.col("n") == 1).alias("a"), F.count_if(F.col("n") == 2).alias("b"))
    ones = {r.toxic: (r.a, r.b) for r in few.collect()}
    share = min(max(after[1].sum() / max(after.sum(), 1), 1e-6), 1 - 1e-6)
    each = [F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    both = met.groupBy("key").agg(F.sum("n").alias("n"), *each)
    apart = evidence(F.col("n0"), F.col("n1"), F.lit(float(share)), F.log)
    both = stored(both.where((apart >= EVIDENCE) & (apart >= CONTRAST * F.col("n"))), "both")
    top = both.where(F.col("n") >= _cutoff(both, pairs)).select("key", "n0", "n1").toPandas()
    model = estimate(top, kinds, after, ones, ids, size)

    sent = spark.sparkContext.broadcast(model)
    spare = _likelihoods(texts.where("fold = 0").select("text", "toxic"), sent).toPandas()
    model.weights = logistic(features(*(spare[c].to_numpy(float) for c in ("ordinary", "toxicity", "worst"))), spare["toxic"].to_numpy(float))
    return model


LIKELIHOODS = [("ordinary", T.DoubleType()), ("toxicity", T.DoubleType()), ("worst", T.DoubleType()), ("words", T.LongType())]


def _likelihoods(docs: DataFrame, sent) -> DataFrame:
    """docs without their text, and both log-likelihoods per word and the number of words."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches):
        model = sent.value
        for batch in batches:
            out = [model.likelihoods(t) for t in batch.column("text").to_pylist()]
            made = [pa.array([x[k] for x in out], pa.float64() if k < 3 else pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], *made], [*[f.name for f in rest], *[n for n, _ in LIKELIHOODS]])

    return docs.mapInArrow(run, with_fields(T.StructType(rest), *[T.StructField(n, t) for n, t in LIKELIHOODS]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of docs as struct `row`, with score, predicted and both log-likelihoods per word.

    Null text counts as empty; texts without words get the score of equal likelihoods.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    held = _likelihoods(packed(docs, text=text_of(text_col)), sent)
    bias, whole, worst = (F.lit(float(x)) for x in model.weights)
    x = bias + whole * (F.col("toxicity") - F.col("ordinary")) + worst * F.col("worst")
    p: Column = F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
    return held.withColumn("score", p).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
