"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

P(grade <= k) = 1 / (1 + exp(score - threshold k)): one weight per hash bucket, shared by all grades, and
thresholds in increasing order. The expected grade and the probability of reaching a grade follow.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm.common import bounded, packed, slices, small_batches, stored, text_of, with_fields

#: Rated rows to learn from at most, chosen by the hash of their id.
SAMPLE = 10_000
BUCKETS = 1 << 13
#: Distinct words whose buckets a task remembers.
REMEMBERED = 200_000

_runs = [(re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[a-zß-öø-ÿ]+"), "a"), (re.compile(r"\d+"), "0"), (re.compile(r"([^Aa0])\1+"), r"\1")]


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) % BUCKETS


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits, and of one other character, as one character each."""
    for pattern, by in _runs:
        word = pattern.sub(by, word)
    return word


class Hasher:
    """Turns texts into hashed features: the square root of each bucket's share of the words."""

    def __init__(self):
        # Three buckets for each word, side by side: tuples of numbers would take ten times the memory.
        self.rows, self.buckets = {}, array("H")

    def _row(self, word: str) -> int:
        at = self.rows.get(word)
        if at is None:
            at = self.rows[word] = len(self.rows)
            self.buckets.extend((_bucket("word", word.lower()), _bucket("shape", shape(word)), _bucket("end", word[-3:])))
        return at

    def __call__(self, text: str) -> np.ndarray:
        words = Counter(text.split())
        n = words.total()
        if len(self.rows) > REMEMBERED:
            self.__init__()
        out = np.zeros(BUCKETS, np.float64)
        if n:
            rows = [self._row(w) for w in words]
            counts = np.fromiter(words.values(), float, len(words))
            at = np.frombuffer(self.buckets, np.uint16).reshape(-1, 3)[rows]
            for k in range(at.shape[1]):
                out += np.bincount(at[:, k], counts, BUCKETS)
        out = np.sqrt(out / max(n, 1))
        # How often words come again, and the size of the text, are words of their own.
        out[_bucket("repeats", str(int(10 * (1 - len(words) / max(n, 1)))))] += 1
        out[_bucket("size", str(n.bit_length()))] += 1
        return out


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[float]

    def reach(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each score and each grade but the lowest."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -35, 35)))


def fit_ordinal(sizes: np.ndarray, at: np.ndarray, x: np.ndarray, grades: np.ndarray, rounds: int = 150, rate: float = 0.1, penalty: float = 1e-5) -> Model:
    """sizes: entries of each text; at, x: bucket and value of every entry, text by text. Adam on the mean
    negative log-likelihood."""
    values = sorted(set(grades.tolist()))
    k = len(values) - 1
    if k < 1:
        return Model(np.zeros(BUCKETS), np.zeros(max(k, 0)), values)
    y = np.searchsorted(values, grades)
    n, of = len(sizes), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    below = np.array([(y <= j).mean() for j in range(k)]).clip(0.01, 0.99)
    start = np.log(below / (1 - below))
    # The first threshold and the logarithms of the steps to the next ones: so they stay in order.
    w = np.concatenate([np.zeros(BUCKETS), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    for t in range(1, rounds + 1):
        steps = np.exp(w[BUCKETS + 1 :])
        theta = w[BUCKETS] + np.concatenate([[0.0], np.cumsum(steps)])
        s = np.bincount(of, w[at] * x, n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(invalid="ignore"):
            high, low = sig(edges[y + 1] - s), sig(edges[y] - s)
        high, low = np.where(y == k, 1.0, high), np.where(y == 0, 0.0, low)
        p = np.maximum(high - low, 1e-12)
        grad = np.zeros_like(w)
        grad[:BUCKETS] = np.bincount(at, (1 - high - low)[of] * x, BUCKETS) / n + penalty * w[:BUCKETS]
        by = np.zeros(k)
        for j in range(k):
            by[j] = (-(high * (1 - high) / p)[y == j].sum() + (low * (1 - low) / p)[y == j + 1].sum()) / n
        grad[BUCKETS] = by.sum()
        for j in range(1, k):
            grad[BUCKETS + j] = by[j:].sum() * steps[j - 1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    theta = w[BUCKETS] + np.concatenate([[0.0], np.cumsum(np.exp(w[BUCKETS + 1 :]))])
    return Model(w[:BUCKETS], theta, values)


def _features(batches):
    hasher = Hasher()
    for batch in slices(batches):
        at, values = [], []
        for text in batch.column("text").to_pylist():
            x = hasher(text)
            held = np.flatnonzero(x)
            at.append(held.astype(np.int32))
            values.append(x[held].astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())), batch.column("grade")], ["id", "at", "x", "grade"])


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE) -> Model:
    """Learn from up to `sample` rows of ratings (id, grade), the documented bound of this fit.

    The ratings of the sample go to the documents, which are not shuffled. Null ids and grades teach nothing;
    of several ratings of an id the lowest counts. With one grade every text has it; without ratings nothing is
    known, the expected grade is null and every text passes.
    """
    small_batches(docs.sparkSession)
    known = ratings.select(F.col(id_col).cast("bigint").alias("id"), F.col(grade_col).cast("double").alias("grade"))
    known = known.dropna().groupBy("id").agg(F.min("grade").alias("grade"))
    known = bounded(stored(known, "ratings"), "id", sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text")).join(F.broadcast(known), "id")
    found = texts.select("id", "text", "grade").mapInArrow(_features, "id bigint, at array<int>, x array<float>, grade double")
    # The order of the sums, and so the model, must not depend on the partitions.
    held = found.orderBy("id", "grade").toArrow()
    at, x = (held.column(c).combine_chunks().flatten().to_numpy() for c in ("at", "x"))
    sizes = np.array(pa.compute.list_value_length(held.column("at").combine_chunks()).to_pylist(), np.int64)
    return fit_ordinal(sizes, at, x, held.column("grade").to_numpy())


def score(docs: DataFrame, model: Model, least: float | None = None, text_col: str = "text") -> DataFrame:
    """Rows of docs as struct `row`, with expected_grade and tail, the probability of grade `least` or better.

    `least` is the highest grade by default. Null text counts as empty, which is scored like any text.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = packed(docs, text=text_of(text_col))

    def run(batches):
        model, hasher = sent.value, Hasher()
        goal = sum(g < (model.grades[-1] if least is None else least) for g in model.grades)
        for batch in slices(batches):
            s = np.array([hasher(t) @ model.weights for t in batch.column("text").to_pylist()], float)
            reach = np.concatenate([np.ones((len(s), 1)), model.reach(s), np.zeros((len(s), 1))], axis=1)
            if not model.grades:
                expected, tail = pa.nulls(len(s), pa.float64()), np.ones(len(s))
            else:
                expected, tail = pa.array((reach[:, :-1] - reach[:, 1:]) @ np.array(model.grades)), reach[:, goal]
            yield pa.RecordBatch.from_arrays([batch.column("row"), expected, pa.array(tail)], ["row", "expected_grade", "tail"])

    fields = [T.StructField("expected_grade", T.DoubleType()), T.StructField("tail", T.DoubleType())]
    return base.mapInArrow(run, with_fields(T.StructType([base.schema["row"]]), *fields))
