"""Whitening of embeddings onto their leading principal components, by Jacobi-Davidson.

The covariance V is never formed. What the solver needs of it are products with a few
vectors, and each product is one Spark pass over the fitted rows: every task centres its rows, multiplies
them with the block, multiplies back, and Spark sums the partial results. All vectors of a step
share one pass.

- Rayleigh-Ritz: V is projected on a small orthonormal basis; its leading pairs are the guesses.
- A leading pair whose residual is down to rounding is locked and kept out of the further search.
- Each other wanted pair gives a correction t, orthogonal to all locked and current vectors, from
  ``P (V - theta I) P t = -r`` with a few MINRES steps, for all pairs in lockstep.
- The corrections widen the basis; beyond its bound it restarts with the best vectors.

Rows are fitted as whole numbers x = floor(64 c) + 1000000, each distinct x once. Their number n and sums S
are exact, and centring happens on the whole numbers: n x - S holds no rounding.

Row rules: rows whose vector is null or empty, holds null or non-finite entries, or has another length than most
(equal counts: the shorter) give no rows. Repeated rows and null ids are rows of their own. Entries beyond 2^55 count as
2^55. Directions without spread (all eigenvalues below rounding) are no components, so there may be
fewer than asked; one row, or equal rows only, give none. ``deviation`` is null where it exceeds
a long. An empty table gives no rows. Columns other than the id and the vector do not stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline.llm.adaptive_scan import _matrix
from sieveline.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 61
EPS = float(np.finfo(np.float64).eps)


class Fit(NamedTuple):
    """Exact statistics of the fitted rows and the solved components."""

    n: int
    sums: list[int]  # per dimension
    vectors: np.ndarray  # unit eigenvectors in columns
    values: np.ndarray  # their eigenvalues, falling
    trace: float
    residuals: np.ndarray
    identity_error: float
    passes: int  # over the fitted rows


def whole_numbers(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * x), -LARGEST, LARGEST - 2 * SHIFT).astype(np.int64) + SHIFT


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is whole: neither null nor empty, all entries finite."""
    v = F.col(vector)
    fine = (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return df.where(F.coalesce(fine, F.lit(False)))


def _as_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column's vectors as whole numbers."""
    for batch in batches:
        if batch.num_rows:
            x = whole_numbers(_matrix(batch.column(batch.num_columns - 1)))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[*batch.schema.names[:-1], "x"])


def _long_rows(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _sums(fitted: DataFrame, width: int) -> tuple[int, list[int]]:
    """(n, exact sum of each dimension)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            if batch.num_rows:
                x = _long_rows(batch.column(0))
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # no overflow in either half
                total = [t + (int(h) << 32) + int(b) for t, h, b in zip(total, high, low, strict=True)]
                n += len(x)
        values = [Decimal(v) for v in (n, *total)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["at", "value"])

    found = fitted.select("x").mapInArrow(partial, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value")).collect()
    by_place = {r.at: int(r.value) for r in found}  # one row per dimension
    return by_place.get(-1, 0), [by_place.get(j, 0) for j in range(width)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean goes in whole numbers, the rest is below one."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - base).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]  # n x - S = n (x - base) - rest
    apart = x - base
    largest = n * (int(np.abs(apart).max(initial=0)) + 1)
    if largest * largest * x.shape[1] < 1 << 63:
        off = n * apart - np.array(rest, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    found = [sum((n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in apart.tolist()]
    return [f if f < 1 << 63 else None for f in found]


class Products:
    """Products of the covariance with blocks of vectors, one pass over the fitted rows each."""

    def __init__(self, fitted: DataFrame, n: int, sums: list[int]):
        self.fitted, self.n, self.sums, self.passes = fitted, n, sums, 0

    def _summed(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        """Sum over all fitted rows of ``of(centred rows)``; Spark adds the tasks' parts."""
        n, sums = self.n, self.sums

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                if batch.num_rows:
                    total += of(centred(_long_rows(batch.column(0)), n, sums))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "value"])

        self.passes += 1
        parts = self.fitted.select("x").mapInArrow(partial, "at int, value double")
        table = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()  # as many rows as the result has entries
        out = np.zeros(shape[0] * shape[1])
        out[table.column("at").to_numpy()] = table.column("value").to_numpy()
        return out.reshape(shape)

    def __call__(self, block: np.ndarray) -> np.ndarray:
        """V times ``block``."""
        return self._summed(lambda c: c.T @ (c @ block), block.shape) / self.n

    def trace(self) -> float:
        return float(self._summed(lambda c: np.array([[(c * c).sum()]]), (1, 1))[0, 0]) / self.n

    def covariance_of(self, maps: np.ndarray) -> np.ndarray:
        """Covariance of the centred rows times ``maps``, centred once more on their own mean."""
        k = maps.shape[1]

        def of(c: np.ndarray) -> np.ndarray:
            w = c @ maps
            return np.vstack([w.T @ w, w.sum(axis=0)])

        found = self._summed(of, (k + 1, k)) / self.n
        return found[:k] - np.outer(found[k], found[k])


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal columns of ``against``."""
    for _ in range(3):
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        block = block - against @ (against.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-8]  # a direction that is there already leaves rounding only
        if not block.shape[1]:
            break
    return block


def _corrections(product: Callable, theta: np.ndarray, residual: np.ndarray, against: np.ndarray, steps: int) -> np.ndarray:
    """MINRES, all columns in lockstep, for P (V - theta) P t = -residual with P = 1 - against against^T."""

    def project(x: np.ndarray) -> np.ndarray:
        return x - against @ (against.T @ x)

    b = project(-residual)
    m = b.shape[1]
    beta = np.linalg.norm(b, axis=0)
    start = beta.copy()
    tiny = np.finfo(np.float64).tiny
    v_old, v = np.zeros_like(b), b / np.maximum(beta, tiny)
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    t = np.zeros_like(b)
    eta, c, c_old, s, s_old = beta.copy(), np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    live = beta > 0
    for _ in range(steps):
        if not live.any():
            break
        z = np.zeros_like(b)
        z[:, live] = project(product(v[:, live]) - theta[live] * v[:, live])
        alpha = (v * z).sum(axis=0)
        z = project(z - alpha * v - np.where(live, beta, 0) * v_old)
        beta_new = np.linalg.norm(z, axis=0)
        # Two old rotations and a new one turn the tridiagonal column into a triangular one.
        delta = c * alpha - c_old * s * beta
        above = s * alpha + c_old * c * beta
        above2 = s_old * beta
        gamma = np.sqrt(delta * delta + beta_new * beta_new)
        live &= gamma > tiny
        safe = np.where(live, gamma, 1.0)
        c_old, c, s_old, s = c, np.where(live, delta / safe, c), s, np.where(live, beta_new / safe, s)
        w_new = (v - above * w - above2 * w_old) / safe
        w_old, w = w, w_new
        t = np.where(live, t + c * eta * w, t)
        eta = np.where(live, -s * eta, eta)
        v_old, v = v, z / np.maximum(beta_new, tiny)
        beta = beta_new
        live &= (np.abs(eta) > 1e-3 * start) & (beta_new > EPS * np.abs(theta))
    return project(t)


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], width: int, k: int, most: int = 96, inner: int = 4, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvectors, eigenvalues, residual norms) of the k leading pairs, eigenvalues falling.

    ``most`` bounds the basis (with the locked vectors left out), ``inner`` the MINRES steps of a correction. A pair is
    locked when its residual is at most 8 eps times the largest eigenvalue and the root of the width; where
    rounding of the products leaves more, when a fresh product of it brings no smaller one.
    """
    guard = min(8, width - k)
    most = max(most, 2 * (k + guard))
    locked, values, norms = np.zeros((width, 0)), [], []
    basis = _orthonormal(np.random.default_rng(width).normal(size=(width, k + guard)), locked)
    image = product(basis)
    spent: dict[int, float] = {}  # by locked vectors: the leading residual at the last stop
    for _ in range(rounds):
        h = basis.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        want = min(k - len(values), basis.shape[1])
        ritz, carried = basis @ y, image @ y
        residual = carried[:, :want] - theta[:want] * ritz[:, :want]
        size = np.linalg.norm(residual, axis=0)
        scale = max(values[0] if values else 0.0, theta[0] if len(theta) else 0.0, 0.0)
        done = size <= 8 * EPS * np.sqrt(width) * scale
        lead = want if done.all() else int(np.argmin(done))  # leading pairs only: none is overtaken later
        if lead:
            locked = np.hstack([locked, ritz[:, :lead]])
            values += theta[:lead].tolist()
            norms += size[:lead].tolist()
            if len(values) >= k:
                break
        # The rest of the basis in its own Ritz vectors, freed of what is locked.
        keep = slice(lead, None)
        basis, image, theta = ritz[:, keep], carried[:, keep], theta[keep]
        residual, size, want = residual[:, lead:], size[lead:], want - lead
        if basis.shape[1] + want > most:
            basis, image = basis[:, : want + guard], image[:, : want + guard]
        if basis.shape[1] + len(values) < width:
            against = np.hstack([locked, basis[:, :want]])
            t = _corrections(product, theta[:want], residual, against, inner)
            new = _orthonormal(t[:, size > 0], np.hstack([locked, basis]))
        else:
            new = np.zeros((width, 0))
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
            continue
        # Nothing left to add: what remains is the rounding of older products. Take them anew.
        if size[0] >= 0.5 * spent.get(len(values), np.inf):
            locked = np.hstack([locked, basis[:, :1]])
            values.append(float(theta[0]))
            norms.append(float(size[0]))
            basis, image = basis[:, 1:], image[:, 1:]
            if len(values) >= k or not basis.shape[1]:
                break
            continue
        spent[len(values)] = float(size[0])
        basis = _orthonormal(basis, locked)
        image = product(basis)
    order = np.argsort(-np.array(values), kind="stable")
    return locked[:, order], np.array(values)[order], np.array(norms)[order]


def fit(df: DataFrame, components: int = 16, vector: str = "embedding") -> tuple[Fit | None, int]:
    """The components of the distinct rows of ``df`` and the vectors' length; None where no row is usable."""
    rows = usable(df, vector)
    usual = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return None, 0
    width = usual.n
    doubles = rows.where(F.size(vector) == width).select(F.transform(vector, lambda e: e.cast("double")).alias("v"))
    fitted = stored(doubles.mapInArrow(_as_whole, "x array<long>").distinct(), "whitening-rows")
    n, sums = _sums(fitted, width)
    products = Products(fitted, n, sums)
    trace = products.trace()
    if trace <= 0:
        return Fit(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, np.zeros(0), 0.0, products.passes), width
    vectors, values, residuals = jacobi_davidson(products, width, min(components, width))
    spread = values > 64 * EPS * width * values[0]
    vectors, values, residuals = vectors[:, spread], values[spread], residuals[spread]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    vectors = vectors * np.sign(largest)  # one sign for all runs
    unit = products.covariance_of(vectors / np.sqrt(values))
    error = float(np.abs(unit - np.eye(len(values))).max())
    return Fit(n, sums, vectors, values, trace, residuals, error, products.passes), width


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, components: int = 16, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable row and component: the id and ``RESULT``."""
    spark: SparkSession = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {RESULT}"
    model, width = fit(df, components, vector)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    maps = model.vectors / np.sqrt(model.values)
    explained = model.values / model.trace
    shared = spark.sparkContext.broadcast((model.n, model.sums, maps, explained, model.identity_error))  # width x components

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, maps, explained, error = shared.value
        k = maps.shape[1]
        for batch in (b.slice(at, 2000) for b in batches for at in range(0, b.num_rows, 2000)):
            x = whole_numbers(_matrix(batch.column(1)))
            w = centred(x, n, sums) @ maps
            rows = len(x)
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, dtype=np.int64)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = usable(df, vector).where(F.size(vector) == width).select(id_col, F.transform(vector, lambda e: e.cast("double")).alias("v"))
    return rows.mapInArrow(project, schema)
