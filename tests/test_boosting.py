"""Softmax boosting against a plain implementation."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from venuemart.ml import boosting


def brute(x, y, edges, classes, rounds, depth, rate=0.1, ridge=1.0, least=1e-3):
    """Row by row, in doubles. Returns the scores of the rows after all rounds."""
    n = len(y)
    start = [math.log(max(sum(1 for v in y if v == c), 0.5) / n) for c in range(classes)]
    scores = [list(start) for _ in range(n)]
    for _ in range(rounds):
        new = [list(s) for s in scores]
        for c in range(classes):
            g, h = [], []
            for i in range(n):
                e = [math.exp(s - max(scores[i])) for s in scores[i]]
                p = e[c] / sum(e)
                g.append(p - (y[i] == c))
                h.append(p * (1 - p))

            def grow(rows, level, c=c, g=g, h=h, new=new):
                G, H = sum(g[i] for i in rows), sum(h[i] for i in rows)
                best = None
                if level < depth:
                    for f in range(len(x[0])):
                        for edge in edges[f]:
                            left = [i for i in rows if x[i][f] <= edge]
                            lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                            if lh < least or H - lh < least:
                                continue
                            gain = lg**2 / (lh + ridge) + (G - lg) ** 2 / (H - lh + ridge) - G**2 / (H + ridge)
                            if best is None or gain > best[0]:
                                best = gain, f, edge
                if best is None or best[0] <= 1e-12:
                    for i in rows:
                        new[i][c] += -rate * G / (H + ridge)
                    return
                _, f, edge = best
                grow([i for i in rows if x[i][f] <= edge], level + 1)
                grow([i for i in rows if x[i][f] > edge], level + 1)

            grow(list(range(n)), 0)
        scores = new
    return np.array(scores)


def loss(scores, y):
    p = boosting.softmax(np.asarray(scores))
    return -np.log(p[np.arange(len(y)), y]).mean()


def made(n, d, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).round(3)
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.standard_normal(n) > 0.4).astype(int) + (x[:, 2] > 0.8)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y, strict=True)], "x array<double>, y int")


@pytest.mark.parametrize("parts, block, fan", [(1, 1 << 15, 32), (5, 16, 2)])
def test_against_plain_boosting(spark, monkeypatch, parts, block, fan):
    monkeypatch.setattr(boosting, "BLOCK", block)
    monkeypatch.setattr(boosting, "FAN", fan)
    monkeypatch.setattr(boosting, "STORED_EVERY", 3)
    x, y = made(90, 3)
    model = boosting.fit(frame(spark, x, y).repartition(parts), "x", "y", rounds=7, depth=3, n_bins=8)
    got, want = boosting.scores_of(model, x), brute(x.tolist(), y.tolist(), model["edges"], 3, 7, 3)
    assert np.abs(got - want).max() < 1e-8
    assert loss(got, y) == pytest.approx(loss(want, y), abs=1e-9)
    assert loss(got, y) < loss(boosting.scores_of({**model, "trees": []}, x), y)


def test_same_model_from_any_partitions(spark, monkeypatch):
    x, y = made(200, 4, 2)
    df = frame(spark, x, y)
    one = boosting.fit(df.coalesce(1), "x", "y", rounds=4)
    monkeypatch.setattr(boosting, "BLOCK", 32)
    assert boosting.fit(df.repartition(7), "x", "y", rounds=4) == one


def test_edges_are_quantiles(spark):
    x, y = made(500, 3, 3)
    edges = boosting.edges_of(frame(spark, x, y), "x", 3, 4)
    assert np.allclose(edges, [[np.sort(c)[math.ceil(q * 500) - 1] for q in (0.25, 0.5, 0.75)] for c in x.T])
    bins = boosting.binned(x, edges)
    assert all(np.bincount(b, minlength=4).min() > 110 for b in bins.T)


def test_constant_features_and_a_missing_class(spark):
    df = frame(spark, np.zeros((10, 2)), [0] * 6 + [2] * 4)
    model = boosting.fit(df, "x", "y", rounds=2)
    p = boosting.softmax(boosting.scores_of(model, np.zeros((1, 2))))[0]
    assert p.sum() == pytest.approx(1) and p[0] > p[2] > p[1]


def test_estimator_learns_saves_and_keeps_columns(spark, tmp_path):
    x, y = made(300, 4, 4)
    df = spark.createDataFrame([(k, Vectors.dense(r.tolist()), float(v)) for k, (r, v) in enumerate(zip(x, y, strict=True))], ["id", "components", "label"])
    model = PipelineModel(stages=[boosting.SoftmaxBoosting(rounds=25).fit(df)])
    model.write().overwrite().save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(df)
    assert out.columns == ["id", "components", "label", "probability", "prediction"]
    assert out.where("prediction = label").count() > 270
    first = {r.id: r.probability for r in model.transform(df).collect()}
    assert all(first[r.id] == r.probability for r in out.collect())
    assert out.limit(0).agg(F.count("*")).first()[0] == 0


def test_few_rows_are_dealt_to_many_tasks_with_the_same_model(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    rows = [(rnd.normal(size=3).tolist(), int(i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "x array<double>, y int").coalesce(1)
    parts, held = [], boosting.Rows.__init__
    monkeypatch.setattr(boosting.Rows, "__init__", lambda self, blocks, *a: (held(self, blocks, *a), parts.append(self.parts))[0])
    whole = boosting.fit(df, "x", "y", rounds=2, depth=2)
    monkeypatch.setattr(boosting, "FEW_ROWS", 20)
    assert boosting.fit(df, "x", "y", rounds=2, depth=2) == whole and parts == [1, 4]


def test_histograms_of_several_weights():
    rnd = np.random.default_rng(9)
    bins, node, weights = rnd.integers(0, 4, (3, 50)).astype(np.uint8), rnd.integers(2, 6, 50), rnd.integers(-9, 9, (2, 50)).astype(float)
    want = np.zeros((2, 2, 3, 4), np.int64)
    for i in np.flatnonzero(node < 4):
        for f in range(3):
            want[:, node[i] - 2, f, bins[f, i]] += weights[:, i].astype(int)
    assert (boosting.histograms(bins, node, tuple(weights), 2, 2, 4) == want).all()
