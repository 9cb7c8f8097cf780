"""Gradient boosting with a softmax over all classes, on quantile-binned features.

Every round grows one tree per class from the same scores, by gradients and Hessians of the log loss. Rows stay
where they are, packed in blocks of binned features, labels and scores; per level each task sums gradients and
Hessians by class, node, feature and bin, and the sums are added up in a tree. They are whole numbers (a gradient
of 1 is 2^36), so sums are exact and the model does not depend on how rows are partitioned.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuemart.session import use_checkpoints

#: One gradient unit in whole numbers; sums over a block of rows stay exact in doubles, sums over 2^26 rows in longs.
UNIT = float(1 << 36)
#: Rows of a block; those of a task as long as there are fewer tasks than cores; partial sums that one task or the
#: driver adds up.
BLOCK, FEW_ROWS, FAN = 1 << 15, 1 << 10, 32
#: Rounds after which the scores of all rows are stored again; in between tasks apply the rounds since then.
STORED_EVERY = 10


@dataclass
class Tree:
    """A full tree in heap order: nodes 1 .. 2^depth - 1 test feature <= edge (as bins), leaves follow."""

    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(int(np.log2(len(self.leaf)))):
            node = 2 * node + (bins[rows, self.feature[node]] > self.bin[node])
        return node - len(self.leaf)

    def add(self, bins: np.ndarray) -> np.ndarray:
        return self.leaf[self.leaves(bins)]


def softmax(scores: np.ndarray) -> np.ndarray:
    scaled = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scaled / scaled.sum(axis=1, keepdims=True)


def whole_gradients(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and Hessians of the log loss per row and class, in whole numbers."""
    p = softmax(scores)
    g = p.copy()
    g[np.arange(len(labels)), labels] -= 1.0
    return np.rint(g * UNIT), np.rint(np.maximum(p * (1.0 - p), 1e-16) * UNIT)


def histograms(bins: np.ndarray, node: np.ndarray, weights: tuple[np.ndarray, ...], first: int, nodes: int, n_bins: int) -> np.ndarray:
    """Sums of each of the weights by node (from number `first`), feature and bin; `bins` has a row per feature.

    Feature by feature, so that a sum's numbers stay in the processor's cache and no weight is repeated.
    """
    held = (node >= first) & (node < first + nodes)
    if not held.all():
        bins, node, weights = bins[:, held], node[held], tuple(w[held] for w in weights)
    at = (node - first) * n_bins
    out = np.empty((len(weights), nodes, len(bins), n_bins), np.int64)
    for f, own in enumerate(bins):
        cell = at + own
        for k, w in enumerate(weights):
            out[k, :, f] = np.rint(np.bincount(cell, w, nodes * n_bins)).reshape(nodes, n_bins)
    return out


def best_splits(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the best (feature, bin) and the sums (g, h) of both sides; equal gains go to the first.

    g, h: sums by node, feature and bin. A node without a gain sends all rows to the left.
    """
    left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    whole_g, whole_h = left_g[:, :, -1:], left_h[:, :, -1:]
    lg, lh, rg, rh = left_g / UNIT, left_h / UNIT, (whole_g - left_g) / UNIT, (whole_h - left_h) / UNIT
    gain = lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - (whole_g / UNIT) ** 2 / (whole_h / UNIT + ridge)
    gain = np.where((lh >= least) & (rh >= least), gain, -np.inf)
    gain[:, :, -1] = -np.inf
    n, d, b = g.shape
    at = gain.reshape(n, -1).argmax(axis=1)
    none = ~(gain.reshape(n, -1)[np.arange(n), at] > 1e-12)
    feature, cut = np.where(none, 0, at // b), np.where(none, b - 1, at % b)
    rows = np.arange(n)
    side_g = np.stack([left_g[rows, feature, cut], whole_g[rows, feature, 0] - left_g[rows, feature, cut]], axis=1)
    side_h = np.stack([left_h[rows, feature, cut], whole_h[rows, feature, 0] - left_h[rows, feature, cut]], axis=1)
    return feature, cut, side_g, side_h


class Rows:
    """Blocks of training rows, and sums over all of them."""

    def __init__(self, blocks: DataFrame, features: int, classes: int):
        self.blocks, self.features, self.classes = blocks, features, classes
        self.parts = blocks.rdd.getNumPartitions()
        self.trees: list[list[Tree]] = []

    def _unpacked(self, batch: pa.RecordBatch):
        for k in range(batch.num_rows):
            bins = np.frombuffer(batch.column("bins")[k].as_buffer(), np.uint8).reshape(-1, self.features)
            labels = np.frombuffer(batch.column("labels")[k].as_buffer(), np.int32)
            scores = np.frombuffer(batch.column("scores")[k].as_buffer(), np.float64).reshape(-1, self.classes).copy()
            for round_ in self.trees:
                for c, tree in enumerate(round_):
                    scores[:, c] += tree.add(bins)
            yield bins, labels, scores

    def total(self, part: Callable, size: int) -> np.ndarray:
        """The sum over all blocks of part(bins, labels, scores), whole numbers."""

        def first(batches):
            held = np.zeros(size, np.int64)
            for batch in batches:
                for own in self._unpacked(batch):
                    held += part(*own)
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["sums"])

        def again(batches):
            held = np.zeros(size, np.int64)
            for batch in batches:
                for cell in batch.column("sums"):
                    held += np.frombuffer(cell.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["sums"])

        # The task needs neither Spark's frame nor this object's session.
        blocks, self.blocks = self.blocks, None
        try:
            sums, parts = blocks.mapInArrow(first, "sums binary"), self.parts
            while parts > FAN:
                parts = -(-parts // FAN)
                sums = sums.repartition(parts).mapInArrow(again, "sums binary")
            return sum((np.frombuffer(x.as_buffer(), np.int64) for x in sums.toArrow().column(0)), np.zeros(size, np.int64))
        finally:
            self.blocks = blocks

    def store(self) -> None:
        """Scores of all rounds so far become part of the stored blocks."""

        def run(batches):
            for batch in batches:
                scores = [s.tobytes() for _, _, s in self._unpacked(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("labels"), pa.array(scores, pa.binary())], ["bins", "labels", "scores"])

        blocks, self.blocks = self.blocks, None
        made = blocks.mapInArrow(run, blocks.schema).checkpoint()
        self.blocks, self.trees = made, []


def edges_of(df: DataFrame, column: str, n_features: int, n_bins: int) -> np.ndarray:
    """Upper edges of the bins per feature, from quantiles of all rows; repeated edges leave bins empty.

    Quantiles are exact up to 10,000 rows, else within 1/10,000 of the ranks.
    """
    shares = ", ".join(f"{k / n_bins}D" for k in range(1, n_bins))
    found = df.agg(*[F.expr(f"percentile_approx(`{column}`[{k}], array({shares}), 10000)").alias(f"q{k}") for k in range(n_features)]).first()
    return np.array([list(q) for q in found])


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin b holds values above edge b - 1 and up to edge b."""
    return np.stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, values.T, strict=True)], axis=1).astype(np.uint8)


def fit(df: DataFrame, features: str, label: str, rounds: int = 200, depth: int = 4, rate: float = 0.1, ridge: float = 1.0, least: float = 1e-3, n_bins: int = 32, edges: np.ndarray | None = None) -> dict:
    """The model as plain values: edges, start scores and trees. `label` holds 0 .. classes - 1, `features` arrays.

    `edges` (features x bins - 1) are the upper edges of the bins, by default quantiles.
    The driver holds 2 x classes x 2^(depth - 1) x features x bins numbers at a time, whatever the number of rows.
    """
    data = df.select(F.col(features).alias("x"), F.col(label).cast("int").alias("y"))
    counts = {r.y: r.n for r in data.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes, n = max(counts) + 1, sum(counts.values())
    size = data.select(F.size("x").alias("d")).first().d
    edges = edges_of(data, "x", size, n_bins) if edges is None else edges
    n_bins = edges.shape[1] + 1
    start = np.log([max(counts.get(k, 0), 0.5) / n for k in range(classes)])

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                values = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                labels = part.column("y").to_numpy(zero_copy_only=False).astype(np.int32)
                cells = [binned(values, edges).tobytes(), labels.tobytes(), np.tile(start, (len(labels), 1)).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["bins", "labels", "scores"])

    use_checkpoints(df.sparkSession)
    tasks = max(1, min(df.sparkSession.sparkContext.defaultParallelism, n // FEW_ROWS), n // BLOCK)
    packed = (data.repartition(tasks) if data.rdd.getNumPartitions() < tasks else data.coalesce(tasks)).mapInArrow(pack, "bins binary, labels binary, scores binary").checkpoint()
    rows, trees = Rows(packed, size, classes), []
    for done in range(rounds):
        grown = _grow(rows, classes, size, n_bins, depth, rate, ridge, least)
        trees.append(grown)
        rows.trees.append(grown)
        if len(rows.trees) == STORED_EVERY and done + 1 < rounds:
            rows.store()
    return {"edges": edges.tolist(), "start": start.tolist(), "trees": [[[t.feature.tolist(), t.bin.tolist(), t.leaf.tolist()] for t in r] for r in trees]}


def _grow(rows, classes: int, size: int, n_bins: int, depth: int, rate: float, ridge: float, least: float) -> list[Tree]:
    """One tree per class, level by level together."""
    feature, cut = np.zeros((classes, 1 << depth), np.int64), np.full((classes, 1 << depth), n_bins, np.int64)
    leaf = np.zeros((classes, 1 << depth))
    for level in range(depth):
        first = nodes = 1 << level
        shape = (classes, 2, nodes, size, n_bins)

        def part(bins, labels, scores, first=first, nodes=nodes, level=level, shape=shape):
            g, h = whole_gradients(scores, labels)
            out, by_feature = np.zeros(shape, np.int64), np.ascontiguousarray(bins.T)
            for c in range(classes):
                node, at = np.ones(len(bins), np.int64), np.arange(len(bins))
                for _ in range(level):
                    node = 2 * node + (bins[at, feature[c, node]] > cut[c, node])
                out[c] = histograms(by_feature, node, (g[:, c].copy(), h[:, c].copy()), first, nodes, n_bins)
            return out.ravel()

        sums = rows.total(part, int(np.prod(shape))).reshape(shape)
        for c in range(classes):
            f, b, g, h = best_splits(sums[c, 0], sums[c, 1], ridge, least)
            feature[c, first : first + nodes], cut[c, first : first + nodes] = f, b
            if level == depth - 1:
                leaf[c] = (-rate * (g / UNIT) / (h / UNIT + ridge)).reshape(-1)
    return [Tree(feature[c], cut[c], leaf[c]) for c in range(classes)]


def scores_of(model: dict, values: np.ndarray) -> np.ndarray:
    bins = binned(values, np.array(model["edges"]))
    scores = np.tile(model["start"], (len(bins), 1))
    for round_ in model["trees"]:
        for c, tree in enumerate(round_):
            scores[:, c] += Tree(*map(np.array, tree)).add(bins)
    return scores


class _Boosting(HasFeaturesCol, HasLabelCol):
    rounds = Param(Params._dummy(), "rounds", "boosting rounds", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of each tree", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of each tree that is added", TypeConverters.toFloat)


class SoftmaxBoosting(Estimator, _Boosting):
    """Fits trees on a vector column; the model adds `probability` and `prediction`."""

    @keyword_only
    def __init__(self, *, rounds: int = 200, depth: int = 4, rate: float = 0.1, featuresCol: str = "components", labelCol: str = "label"):
        super().__init__()
        self._setDefault(rounds=200, depth=4, rate=0.1, featuresCol="components", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SoftmaxBoostingModel:
        data = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).alias("y"))
        held = fit(data, "x", "y", self.getOrDefault(self.rounds), self.getOrDefault(self.depth), self.getOrDefault(self.rate))
        return SoftmaxBoostingModel()._set(featuresCol=self.getFeaturesCol(), trees=json.dumps(held))


class SoftmaxBoostingModel(Model, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    trees = Param(Params._dummy(), "trees", "edges, start scores and trees as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="components")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = json.loads(self.getOrDefault(self.trees))

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            return pd.Series(list(softmax(scores_of(model, np.stack(features)))) if len(features) else [])

        out = dataset.withColumn("_p", score(vector_to_array(self.getFeaturesCol())))
        first = F.array_position("_p", F.array_max("_p")).cast("double") - 1
        return out.withColumn("probability", array_to_vector("_p")).withColumn("prediction", first).drop("_p")
