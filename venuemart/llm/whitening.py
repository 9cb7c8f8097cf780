"""Whitening of embeddings: leading eigenpairs of their covariance by block Jacobi-Davidson.

The covariance is never formed. All it does is multiply a block of vectors: each task centres its own part of
the vectors, multiplies there and back, and the small products are summed over all tasks in a tree. The
search works on these products alone:

1. Rayleigh-Ritz in the subspace gives the candidates; leading ones whose residual has reached double precision
   are locked and projected out from then on.
2. For each of the others the correction equation (I - QQ')(V - e I)(I - QQ') t = -r, with Q all locked
   vectors and candidates, is solved roughly by MINRES. All equations take their steps together, so a step
   costs one distributed product whatever their number.
3. The corrections extend the subspace; when it has grown too wide it starts anew from the best candidates.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm.common import stored

COMPONENTS = 16
#: Pairs beyond the wanted ones that are followed too, so that none is passed over.
GUARD = 4
#: Vectors in one stored block, and partial sums that one task or the driver adds up.
BLOCK, FAN = 1024, 64
#: Residuals of this size beside the largest eigenvalue, per square root of the dimension, are round-off.
ROUND_OFF = 32 * np.finfo(float).eps
#: Eigenvalues below this share of the largest, per dimension, are zero in double precision.
ZERO = 64 * np.finfo(float).eps
#: Steps of one inner solve, and rounds of the outer search (few are needed; more mean that something is wrong).
INNER, OUTER = 10, 200
SEED = 46
_EDGE = float(2**62)


def _valid(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that have `size` entries, all of them finite, and their entries as integers."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False), np.int64)
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    whole = np.concatenate([[0], np.cumsum(np.isfinite(values))])
    good = np.flatnonzero((lengths == size) & (whole[ends] - whole[ends - lengths] == size))
    entries = values[(ends - lengths)[good, None] + np.arange(size)] if len(good) else np.zeros((0, size))
    return good, np.floor(np.clip(64.0 * entries, -_EDGE, _EDGE)).astype(np.int64) + 1_000_000


def _deviation(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S, exact: in longs, or in whole numbers of any size where longs would overflow."""
    reach = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, total), default=0))
    if 2 * reach < 2**62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def _squares(dev: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None where it is beyond a long."""
    if dev.dtype != object:
        most = int(np.abs(dev).max(initial=0))
        if most * most * dev.shape[1] < 2**62:
            return (dev * dev).sum(axis=1).tolist()
        dev = dev.astype(object)
    return [s if s < 2**63 else None for s in (dev * dev).sum(axis=1).tolist()]


def dimension(vectors: DataFrame, vector_col: str = "embedding") -> int:
    """The length that most vectors have, the greater of two as frequent; 0 if there is none."""
    sizes = vectors.select(F.size(vector_col).alias("d")).where("d > 0").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return most.d if most else 0


def fit_list(vectors: DataFrame, size: int, vector_col: str = "embedding") -> DataFrame:
    """A stored table of blocks: the distinct integer vectors, up to `BLOCK` of them as one binary cell."""

    def own(batches):
        for batch in batches:
            x = _valid(batch.column("v"), size)[1]
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], ["x"])

    def blocks(batches):
        for batch in batches:
            cells = batch.column("x").to_pylist()
            packs = [b"".join(cells[at : at + BLOCK]) for at in range(0, len(cells), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(packs, pa.binary())], ["block"])

    distinct = vectors.select(F.col(vector_col).alias("v")).mapInArrow(own, "x binary").distinct()
    return stored(distinct.mapInArrow(blocks, "block binary"), "vectors")


class Blocks:
    """The fit list, and sums over it of small arrays."""

    def __init__(self, blocks: DataFrame, size: int):
        self.blocks, self.size, self.parts = blocks, size, blocks.count()
        low, high, rows = self._sum(lambda x: np.concatenate([x & 0xFFFFFFFF, x >> 32, np.ones((len(x), 1), np.int64)], axis=1).sum(axis=0), np.int64, 2 * size + 1, split=True)
        self.n = int(rows[0])
        self.total = [int(a) + (int(b) << 32) for a, b in zip(low, high, strict=True)]

    def _sum(self, part: Callable[[np.ndarray], np.ndarray], kind, width: int, split: bool = False):
        """The sum of part(x) over all blocks x; the tree has as many levels as the blocks ask for."""
        size = self.size

        def first(batches):
            held = np.zeros(width, kind)
            for batch in batches:
                for cell in batch.column("block"):
                    held += part(np.frombuffer(cell.as_buffer(), np.int64).reshape(-1, size)).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["part"])

        def again(batches):
            held = np.zeros(width, kind)
            for batch in batches:
                for cell in batch.column("part"):
                    held += np.frombuffer(cell.as_buffer(), kind)
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["part"])

        sums, parts = self.blocks.mapInArrow(first, "part binary"), self.parts
        while parts > FAN:
            parts = -(-parts // FAN)
            sums = sums.repartition(parts).mapInArrow(again, "part binary")
        held = np.zeros(width, kind)
        for row in sums.collect():
            held = held + np.frombuffer(row.part, kind)
        return (held[:size], held[size : 2 * size], held[2 * size :]) if split else held

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block of vectors."""
        n, total = self.n, self.total

        def part(x):
            centred = _deviation(x, n, total).astype(float) / n
            return centred.T @ (centred @ block)

        return self._sum(part, float, block.size).reshape(block.shape) / n

    def trace(self) -> float:
        n, total = self.n, self.total

        def part(x):
            centred = _deviation(x, n, total).astype(float) / n
            return np.array([(centred * centred).sum()])

        return float(self._sum(part, float, 1)[0]) / n

    def moments(self, vectors: np.ndarray) -> np.ndarray:
        """Covariance, centred by their own mean, of the vectors' projections."""
        n, total, k = self.n, self.total, vectors.shape[1]

        def part(x):
            z = (_deviation(x, n, total).astype(float) / n) @ vectors
            return np.concatenate([(z.T @ z).reshape(-1), z.sum(axis=0)])

        held = self._sum(part, float, k * k + k) / n
        return held[: k * k].reshape(k, k) - np.outer(held[k * k :], held[k * k :])


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `new` adds to the bases."""
    scale = np.linalg.norm(new, axis=0)
    new = new[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        for base in bases:
            new = new - base @ (base.T @ new)
        if not new.size:
            return new
        left, found, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, found > 1e-10]
    return new


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, least: float) -> np.ndarray:
    """Approximate solutions of one symmetric system per column; every step applies all operators at once."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    first = np.where(live, beta, 1.0)
    old, v = np.zeros_like(right), right / first
    d0, d1 = np.zeros_like(right), np.zeros_like(right)
    eta, beta = np.where(live, beta, 0.0), np.zeros(right.shape[1])
    c0, c1, s0, s1 = (np.full(right.shape[1], k) for k in (1.0, 1.0, 0.0, 0.0))
    for _ in range(steps):
        if not (np.abs(eta) > least * first).any():
            break
        w = apply(v)
        alpha = (v * w).sum(axis=0)
        w = w - alpha * v - beta * old
        grown = np.linalg.norm(w, axis=0)
        delta, epsilon = c1 * alpha - c0 * s1 * beta, s0 * beta
        gamma, rho = np.hypot(delta, grown), s1 * alpha + c0 * c1 * beta
        gamma = np.where(gamma > 0, gamma, 1.0)
        c0, s0 = c1, s1
        c1, s1 = delta / gamma, grown / gamma
        d = (v - epsilon * d0 - rho * d1) / gamma
        d0, d1 = d1, d
        x = x + np.where(live, c1 * eta, 0.0) * d
        eta = -s1 * eta
        live &= grown > 1e-14 * np.maximum(np.abs(alpha), 1e-300)
        old, v, beta = v, np.where(live, w / np.where(grown > 0, grown, 1.0), 0.0), grown
    return x


def principal(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, int]:
    """The `wanted` largest eigenvalues, falling, their unit eigenvectors, and the number of products taken."""
    width = min(size, wanted + GUARD)
    widest = min(size, 4 * width)
    locked, values, taken = np.zeros((size, 0)), np.zeros(0), 0

    def times(block):
        nonlocal taken
        taken += 1
        return product(block)

    basis = _orthonormal(np.random.default_rng(seed).standard_normal((size, width)))
    image = times(basis)
    for outer in range(OUTER):
        small = basis.T @ image
        found, turn = np.linalg.eigh((small + small.T) / 2)
        turn = turn[:, ::-1][:, : width - len(values)]
        found = found[::-1][: width - len(values)]
        ritz, turned = basis @ turn, image @ turn
        rest = turned - ritz * found
        # What the locked vectors keep is not the candidates' fault.
        rest -= locked @ (locked.T @ rest)
        largest = max(values.max(initial=0.0), found.max(initial=0.0))
        small_enough = np.linalg.norm(rest, axis=0) <= ROUND_OFF * math.sqrt(size) * largest
        done = int(np.argmin(np.append(small_enough, False)))
        done = min(done, wanted - len(values))
        if done:
            locked, values = np.hstack([locked, ritz[:, :done]]), np.append(values, found[:done])
            if len(values) == wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order], taken
            outside = basis @ np.linalg.qr(turn[:, :done], mode="complete")[0][:, done:]
            onto = basis.T @ outside
            basis, image = outside, image @ onto
            ritz, rest, found = ritz[:, done:], rest[:, done:], found[done:]
            turn = basis.T @ ritz
        if basis.shape[1] + ritz.shape[1] > widest and basis.shape[1] + len(values) < size:
            # Start anew from the candidates.
            keep, _ = np.linalg.qr(turn)
            basis, image = basis @ keep, image @ keep
        both = np.hstack([locked, ritz])
        away = lambda block: block - both @ (both.T @ block)
        shifts = found[: rest.shape[1]]
        fix = minres(lambda t: away(times(t) - t * shifts), away(-rest), INNER, 10.0 ** -min(outer + 1, 4))
        new = _orthonormal(away(fix), locked, basis)
        room = size - len(values) - basis.shape[1]
        if not new.size:
            new = _orthonormal(np.random.default_rng(seed + outer + 1).standard_normal((size, min(width, max(room, 1)))), locked, basis)
        new = new[:, : max(room, 0)]
        if new.size:
            basis, image = np.hstack([basis, new]), np.hstack([image, times(new)])
        else:
            # The whole space is searched: only round-off is left, which fresh products remove.
            basis = _orthonormal(basis, locked)
            image = times(basis)
    raise RuntimeError("the residuals do not reach double precision")


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS):
    """(blocks, eigenvalues, eigenvectors, explained shares, identity error), or None if nothing varies."""
    size = dimension(vectors, vector_col)
    if not size:
        return None
    held = Blocks(fit_list(vectors, size, vector_col), size)
    if held.n < 2:
        return None
    trace = held.trace()
    values, axes, _ = principal(held.product, size, min(components, size))
    real = values > ZERO * size * values.max()
    values, axes = values[real], axes[:, real]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    error = float(np.abs(held.moments(axes / np.sqrt(values)) - np.eye(len(values))).max())
    return held, values, axes, values / trace, error


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component (from 1): id, component, n, deviation, whitened, explained, identity_error.

    Rows are dropped whose vector is null, empty, or holds null or non-finite entries, or whose length is not the
    most frequent one: they lack entries or have unknown ones. Null ids and repeated rows are ordinary rows; equal
    vectors count once in the fit. Entries beyond 2^62 / 64 count as that; a deviation beyond a long is null.
    Components of no variance in double precision have no whitened value and are left out, so equal vectors
    only, or an empty table, give no rows. Equal eigenvalues may come in any rotation, the same for all rows.
    Other columns, whatever their names, are not read.
    """
    kind = vectors.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    base = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    model = fit(base, "v", components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    held, values, axes, explained, error = model
    n, total, size, scaled, k = held.n, held.total, held.size, axes / np.sqrt(values), len(values)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                good, x = _valid(part.column("v"), size)
                dev = _deviation(x, n, total)
                white = (dev.astype(float) / n) @ scaled
                at = pa.array(np.repeat(np.arange(len(good)), k))
                columns = [
                    part.column("id").take(pa.array(good)).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(good))),
                    pa.array(np.full(len(at), n, np.int64)),
                    pa.array(_squares(dev), pa.int64()).take(at),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(explained, len(good))),
                    pa.array(np.full(len(at), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return base.mapInArrow(run, schema)
