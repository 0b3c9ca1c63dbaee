"""Whitening of embeddings: leading components of a distributed covariance, projected and scaled to unit variance.

Vectors become integers first (256 steps to one), so that sums are exact and copies are found by equality. Everything
that depends on the number of rows is summed by Spark; the driver only ever holds one matrix of dimension x
dimension. Its leading eigenvectors come from a Householder tridiagonal form, bisection on Sturm counts and inverse
iteration.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from webtide.plans.lineage import Scratch

STEPS = 256
_LONG = 1 << 63
#: Eigenvalues closer than this share of the largest form a cluster, whose vectors are made orthogonal to each other.
_CLUSTER = 1e-3


@dataclass
class Whitening:
    """n distinct vectors with per-dimension sums; `components` has one column per component, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], np.float64)


# --- the eigenproblem of one symmetric matrix ---------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of Householder's form; reflector k acts on the entries from k + 1 on."""
    a = np.array(v, np.float64)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        u = np.zeros_like(x)
        size = np.abs(x).max()
        if np.any(x[1:]):
            x /= size
            u = x
            u[0] += np.copysign(np.linalg.norm(x), x[0])
            u /= np.linalg.norm(u)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ u
            w = 2.0 * (p - (u @ p) * u)
            rest -= np.outer(u, w) + np.outer(w, u)
            column = a[k + 1 :, k]
            column -= 2.0 * (u @ column) * u
        reflectors.append(u)
    off = np.array([a[k + 1, k] for k in range(d - 1)])
    return np.diag(a).copy(), off, reflectors


def _below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie under each x."""
    tiny = np.finfo(np.float64).tiny ** 0.5
    q = diagonal[0] - x
    n = (q < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off):
        q = d - x - e * e / np.where(np.abs(q) < tiny, -tiny, q)
        n += q < 0
    return n


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of a tridiagonal matrix, falling, each bisected down to neighbouring numbers."""
    d = len(diagonal)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    pad = 1e-12 * (np.abs(diagonal) + reach).max() + np.finfo(np.float64).tiny
    low = np.full(k, (diagonal - reach).min() - pad)
    high = np.full(k, (diagonal + reach).max() + pad)
    want = d - 1 - np.arange(k)  # so many lie under the one looked for
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        under = _below(diagonal, off, middle) > want
        high, low = np.where(under, middle, high), np.where(under, low, middle)


def _solve_near(diagonal: np.ndarray, off: np.ndarray, x: float, b: np.ndarray, least: float) -> np.ndarray:
    """y with (T - x) y = b, by elimination with row exchanges; a pivot of zero is taken as `least`."""
    d = len(diagonal)
    main, up, up2 = (diagonal - x).copy(), np.append(off, 0.0), np.zeros(d)
    y = b.copy()
    for i in range(d - 1):
        low = off[i]
        if abs(low) > abs(main[i]):
            f = main[i] / low
            main[i], up[i], main[i + 1], up2[i], up[i + 1] = low, main[i + 1], up[i] - f * main[i + 1], up[i + 1], -f * up[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
        else:
            f = low / (main[i] if main[i] else least)
            main[i + 1] -= f * up[i]
            y[i + 1] -= f * y[i]
    for i in range(d - 1, -1, -1):
        above = up[i] * y[i + 1] if i + 1 < d else 0.0
        above += up2[i] * y[i + 2] if i + 2 < d else 0.0
        y[i] = (y[i] - above) / (main[i] if abs(main[i]) > least else np.copysign(least, main[i]))
        if abs(y[i]) > 1e150:
            y /= abs(y[i])
    return y


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One unit vector per value (falling), by inverse iteration; within a cluster each is made orthogonal to those before."""
    d, size = len(diagonal), max(np.abs(values).max(), np.finfo(np.float64).tiny)
    least = np.finfo(np.float64).eps * size
    start = np.random.default_rng(0)
    found: list[np.ndarray] = []
    shift = np.inf
    for i, value in enumerate(values):
        shift = min(value, shift - 8 * least)  # equal eigenvalues get shifts of their own
        near = [found[j] for j in range(i) if values[j] - value <= _CLUSTER * size]
        y = start.standard_normal(d)
        for _ in range(5):
            y = _solve_near(diagonal, off, shift, y / np.linalg.norm(y), least)
            y /= np.linalg.norm(y)
            for _ in range(2):
                for other in near:
                    y -= (other @ y) * other
            y /= np.linalg.norm(y)
        found.append(y)
    return np.stack(found, axis=1)


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, falling: up to k of those above rounding errors.

    The largest entry of each vector is positive.
    """
    d = len(v)
    if not d or not np.trace(v) > 0:
        return np.zeros(0), np.zeros((d, 0))
    diagonal, off, reflectors = tridiagonal(v)
    values = leading_eigenvalues(diagonal, off, min(k, d))
    values = values[values > 8 * d * np.finfo(np.float64).eps * values[0]]
    vectors = eigenvectors(diagonal, off, values)
    for at in range(len(reflectors) - 1, -1, -1):
        u, part = reflectors[at], vectors[at + 1 :]
        part -= 2.0 * np.outer(u, u @ part)
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    return values, vectors * np.sign(largest)


# --- what Spark does ----------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, NaN or infinite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(vector: Column) -> Column:
    """floor(256 c) of every entry; what does not fit into a long is the nearest one."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(STEPS))).cast("bigint"))


def _padded(x: Column, d: int) -> Column:
    return F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), F.lit(d) - F.size(x)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(rows: DataFrame, per_batch: Callable[[np.ndarray], np.ndarray], d: int, kind: str) -> dict[int, object]:
    """Sum over all rows (column x) of what `per_batch` makes of some of them: a vector whose length depends on d only.

    A task adds up its own batches, Spark the vectors of the tasks, entry by entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_batch(_matrix(batch.column(0), d))
                total = part if total is None else total + part
        if total is not None:
            values = [str(v) for v in total] if kind == "string" else total
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(values)], names=["ix", "v"])

    parts = rows.select("x").mapInArrow(run, f"ix BIGINT, v {kind}")
    value = F.col("v").cast("decimal(38,0)") if kind == "string" else F.col("v")
    return {r.ix: r.v for r in parts.groupBy("ix").agg(F.sum(value).alias("v")).collect()}


def _exact_sums(x: np.ndarray) -> np.ndarray:
    return x.sum(axis=0, dtype=np.int64 if np.abs(x.astype(np.float64)).max(initial=0) < 2**40 else object).astype(object)


def fit(df: DataFrame, column: str, k: int = 4) -> Whitening:
    """Components of the covariance of all distinct usable vectors of `df`, each counted once however often it occurs.

    Vectors of different lengths are read as of the longest one, with zeros at the end. Copies are combined within
    tasks before they are shuffled. The fit list is written once; sums, then centred products, then the moments of
    the whitened vectors are added up over it. The driver holds d x d numbers for d dimensions and nothing per row. Without
    a usable vector, or where all are equal, there are no components.
    """
    scratch = Scratch(df.sparkSession)
    vector = F.col(f"`{column}`")
    good = df.filter(usable(vector)).select(integers(vector).alias("x"))
    d = good.agg(F.max(F.size("x")).alias("d")).first().d or 0
    if not d:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    listed, seen = scratch.save(good.select(_padded(F.col("x"), d).alias("x")).distinct(), "fit")
    n = seen["rows"]
    sums = [int(v) for _, v in sorted(_summed(listed, _exact_sums, d, "string").items())]
    model = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    mean, upper = model.mean, np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    added = _summed(listed, products, d, "double")
    v = np.zeros((d, d))
    v[upper] = [added[i] / n for i in range(len(upper[0]))]
    v = v + np.triu(v, 1).T
    model.eigenvalues, model.components = leading_components(v, k)
    model.trace = float(np.trace(v))
    model.identity_error = _identity_error(listed, model, d)
    return model


def _identity_error(listed: DataFrame, model: Whitening, d: int) -> float:
    """Largest entry of (covariance of the whitened fit list - identity), measured on the vectors themselves."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    project = _projection(model)

    def moments(x: np.ndarray) -> np.ndarray:
        z = project(x)
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    added = _summed(listed, moments, d, "double")
    flat = np.array([added[i] for i in range(k + k * k)]) / model.n
    cov = flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k])
    return float(np.abs(cov - np.eye(k)).max())


def _projection(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    mean, scaled = model.mean, model.components / np.sqrt(model.eigenvalues)
    return lambda x: (x - mean) @ scaled


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n x - S)^2 for every row; null beyond the range of a long."""
    reach = n * max(1.0, float(np.abs(x.astype(np.float64)).max(initial=0))) + max(map(abs, sums))
    if reach * reach * len(sums) < 2.0**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < _LONG else None for v in exact]


def whiten(df: DataFrame, column: str, model: Whitening) -> DataFrame:
    """(_row, deviation, whitened) of every row whose vector is usable: _row holds all columns of `df`.

    whitened has one number per component: x - S/n projected on it, over the root of its eigenvalue. deviation is the
    sum over dimensions of (n x - S)^2, null where it exceeds a long. Vectors longer than the model's are cut at its
    dimensions. Repeated rows give repeated rows; where the model has no component, `whitened` is empty.
    """
    d, n, sums = len(model.sums), model.n, model.sums
    vector = F.col(f"`{column}`")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    rows = df.filter(usable(vector)).select(row, F.slice(_padded(integers(vector), d), 1, max(d, 1)).alias("x"))
    if not d:
        return rows.limit(0).select("_row", F.lit(0).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    project, k = _projection(model), len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            ends = pa.array(np.arange(len(x) + 1) * k, pa.int32())
            white = pa.ListArray.from_arrays(ends, pa.array(project(x).ravel()))
            columns = [batch.column(0), pa.array(_deviations(x, n, sums), pa.int64()), white]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "deviation", "whitened"])

    shape = rows.select("_row").schema.add("deviation", LongType()).add("whitened", ArrayType(DoubleType()))
    return rows.mapInArrow(run, shape)


def components_of(df: DataFrame, key: str, column: str, k: int = 4) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), one row per usable vector and component."""
    model = fit(df, column, k)
    each = whiten(df, column, model).select(
        F.col(f"_row.`{key}`").alias(key), "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    share = (model.eigenvalues / model.trace).tolist() if model.trace > 0 else []
    explained = F.element_at(F.array(*map(F.lit, share or [0.0])), F.col("at") + 1)
    return each.select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
