"""Whitening against numpy's eigenvectors and Python's whole numbers."""

import math

import numpy as np
import pytest

from venuemart.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def brute(rows, size, components=16):
    """rows (id, vector): what the contract asks for, up to the sign of a component."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    ints = [(i, tuple(math.floor(64 * float(c)) + 1000000 for c in v)) for i, v in kept]
    fit = sorted({x for _, x in ints})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(n * c - s) for c, s in zip(x, total, strict=True)] for x in fit]) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, x in ints:
        dev = [n * c - s for c, s in zip(x, total, strict=True)]
        white = np.array([float(d) / n for d in dev]) @ axes / np.sqrt(values)
        for k, z in enumerate(white, 1):
            out.setdefault((i, k), []).append((n, sum(d * d for d in dev), abs(z), values[k - 1] / np.trace(cov)))
    return out


def agree(found, want, digits=1e-7):
    held = {}
    for r in found:
        assert r.identity_error <= 1e-4
        held.setdefault((r[0], r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
    assert held.keys() == want.keys()
    for key, rows in want.items():
        assert len(held[key]) == len(rows)
        for a, b in zip(sorted(held[key]), sorted(rows), strict=True):
            assert a[:2] == b[:2]
            assert a[2] == pytest.approx(b[2], abs=digits) and a[3] == pytest.approx(b[3], rel=1e-9)


def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = queries.QUERIES["op13_embedding_whitening"](spark, SF).collect()
    agree(found, brute(rows, 64))


def test_nulls_repeats_lengths_and_other_columns(spark):
    rng = np.random.default_rng(3)
    made = [(k, (rng.standard_normal(5) * [9, 5, 3, 2, 1]).tolist()) for k in range(60)]
    made += [(100 + k, made[0][1]) for k in range(40)] + [(None, made[1][1]), (7, made[2][1]), (7, made[2][1])]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [math.nan] * 5), (204, [math.inf, 0.0, 0.0, 0.0, 0.0]), (205, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in made + odd], "vec_id bigint, embedding array<double>, component string, x int")
    for parts in (1, 7):
        found = whitening.whiten(df.repartition(parts)).collect()
        agree(found, brute(made, 5))
        axes = {}
        for r in found:
            axes.setdefault((r.component, r.explained), set()).add(r.n)
        assert len(axes) == 5 and all(ns == {60} for ns in axes.values())


def test_wide_values_stay_exact(spark):
    made = [(k, [float(k * 10**9), float((k * k) % 7), 1e30 if k == 3 else 0.0]) for k in range(20)]
    found = whitening.whiten(spark.createDataFrame(made, "vec_id bigint, embedding array<double>")).collect()
    assert {r.deviation for r in found} == {None}
    small = [(k, [v[0], v[1]]) for k, v in made]
    agree(whitening.whiten(spark.createDataFrame([(k, [v[0] / 1e6, v[1]]) for k, v in small], "vec_id bigint, embedding array<double>")).collect(), brute([(k, [v[0] / 1e6, v[1]]) for k, v in small], 2))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_varies(spark, rows):
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_flat_directions_have_no_component(spark):
    rng = np.random.default_rng(5)
    made = [(k, [float(a), float(b), float(a), 3.0]) for k, (a, b) in enumerate(rng.integers(-50, 50, (40, 2)))]
    found = whitening.whiten(spark.createDataFrame(made, "vec_id bigint, embedding array<float>")).collect()
    assert {r.component for r in found} == {1, 2}
    agree(found, brute(made, 4, 2))


def test_sums_in_a_tree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(k, rng.standard_normal(6).tolist()) for k in range(300)], "vec_id bigint, embedding array<double>").repartition(16)
    whole = whitening.Blocks(whitening.fit_list(df, 6), 6)
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 16)
    tree = whitening.Blocks(whitening.fit_list(df, 6), 6)
    block = rng.standard_normal((6, 3))
    assert (tree.n, tree.total) == (whole.n, whole.total) and tree.parts > whole.parts
    assert np.allclose(tree.product(block), whole.product(block), rtol=1e-12)


@pytest.mark.parametrize("size, decay", [(40, 1e9), (200, 1e9), (200, 12.0), (64, 0.0), (12, 3.0)])
def test_principal_against_eigh(size, decay):
    rng = np.random.default_rng(size)
    x = rng.standard_normal((2000, size)) * (np.exp(-np.arange(size) / decay) if decay else (np.arange(size) < 3))
    cov = x.T @ x / 2000
    values, axes, taken = whitening.principal(lambda b: cov @ b, size, min(16, size))
    assert np.abs(values - np.linalg.eigvalsh(cov)[::-1][: len(values)]).max() < 1e-13 * values[0]
    assert np.linalg.norm(cov @ axes - axes * values, axis=0).max() < 1e-12 * values[0]
    assert taken < 260


def test_repeated_eigenvalues():
    values, axes, _ = whitening.principal(lambda b: b * 2.0, 30, 16)
    assert np.allclose(values, 2.0) and np.allclose(axes.T @ axes, np.eye(16))
