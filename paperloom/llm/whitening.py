"""Whitening of embeddings by a randomised range finder.

Vectors are brought to integers (``floor(SCALE * c)``); the fit list holds each distinct integer vector once. Its count
and sums are exact, and every vector is centred exactly (``n * x - S``, an integer) before anything is multiplied.

The components come from a random orthonormal block of ``k + OVERSAMPLE`` directions, which is multiplied with the
covariance again and again; a pass goes over all rows of the fit list: each task adds up ``C' (C Q)`` of its centred
rows ``C``, and Spark adds up the tasks' sums by entry. After each pass Rayleigh-Ritz turns the block into estimates,
whose residuals bound the error of a component by residual over gap. When that is within ``TOLERANCE`` for all, they
are the components; if it isn't after ``PASSES`` passes (no gap behind the block), the block is expanded to all
directions, which gives the whole covariance. What reaches the driver is a matrix of at most dimension x dimension, with
the dimension bounded by ``MOST_DIMENSIONS`` (longer vectors raise an error); the model is one for all rows.

The distinct vectors are written to the shared folder once; copies are aggregated before they are shuffled, so that a
vector that a third of the rows share arrives once per task.

Nulls and odd rows: a row is dropped whose vector is null or empty, holds null or non-finite entries or entries beyond a
long after scaling, or has another length than most rows (of equally common lengths the larger counts). Repeated rows
and rows of null id stay, each with its own results. A component whose variance is nothing next to the trace
(``RANK``) has a null ``whitened`` and counts for nothing in ``identity_error``; vectors of fewer dimensions than
components have fewer. A deviation beyond a long is null. An empty table gives no rows. Extra columns pass through
``whitened`` unless they carry its output's names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

SCALE = 256
COMPONENTS = 4
OVERSAMPLE = 12
PASSES = 5
#: The error of a component that is allowed, as residual over gap.
TOLERANCE = 1e-12
#: A variance below this share of the trace is none.
RANK = 1e-12
MOST_DIMENSIONS = 2048
SEED = 5
LARGEST = (1 << 63) - 1
FIELDS = ["deviation", "whitened"]


@dataclass
class Model:
    """Of a fit list: its size and sums, components (a column each) with their variances, the trace, and the largest
    entry by which the whitened fit list's covariance differs from the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0
    passes: int = 0
    expanded: bool = False

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace else 0.0 for e in self.variances]

    @property
    def scales(self) -> np.ndarray:
        """One over the deviation of each component, NaN where there is none."""
        real = (self.variances > RANK * self.trace) & (self.variances > 0)
        return np.where(real, 1 / np.sqrt(np.where(real, self.variances, 1)), np.nan)


def integers(vector: str | Column = "embedding") -> Column:
    """The vector as longs; null unless all its entries are numbers that a long holds after scaling."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    scaled = F.transform(vector, lambda c: c.cast("double") * SCALE)
    whole = F.forall(scaled, lambda c: F.coalesce(F.abs(c) < F.lit(float(1 << 63)), F.lit(False)))
    return F.when((F.size(vector) > 0) & whole, F.transform(scaled, lambda c: F.floor(c).cast("long")))


def usable(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """``vectors`` with ``x``, without the rows that can't be used; and the dimension."""
    rows = vectors.withColumn("x", integers(F.col(f"`{vector}`"))).filter("x IS NOT NULL")
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (most.d if most else 0)), most.d if most else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``: exact, in longs where these suffice and in Python's integers elsewhere."""
    most = int(max(-int(x.min()), int(x.max()), 0)) if x.size else 0
    if n * most + max(map(abs, sums)) <= LARGEST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(float)


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of each row's squared deviations; null where a long can't hold it."""
    by = deviations(x, n, sums)
    about = (by.astype(float) ** 2).sum(axis=1)
    if about.max(initial=0) < 9e18:
        return (by.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in by]
    return [v if v <= LARGEST else None for v in exact]


def moments(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, sums by dimension), exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            x = _matrix(batch["x"], d)
            n += len(x)
            if len(x):
                small = int(max(-int(x.min()), int(x.max()), 0)) * len(x) <= LARGEST
                sums = [a + int(b) for a, b in zip(sums, (x if small else x.astype(object)).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(map(Decimal, sums), pa.decimal128(38, 0))], names=["i", "n", "total"])

    rows = storage.in_arrow(fit.select("x"), run, "i int, n long, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    return rows[0].n, [int(r.total) for r in sorted(rows)]


def _summed(fit: DataFrame, d: int, entries, rows: int, columns: int) -> np.ndarray:
    """The sum over all tasks of the matrices that ``entries(x)`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = entries(_matrix(batch["x"], d))
                total = own if total is None else total + own
        if total is not None:
            i, j = np.indices(total.shape, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    found = storage.in_arrow(fit.select("x"), run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((rows, columns))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return out


def multiplied(fit: DataFrame, n: int, sums: list[int], q: np.ndarray) -> tuple[np.ndarray, float]:
    """(covariance times q, trace of the covariance), by one pass over all centred rows."""
    d, width = q.shape

    def entries(x: np.ndarray) -> np.ndarray:
        c = centred(x, n, sums)
        last = np.zeros((1, width))
        last[0, 0] = (c * c).sum()
        return np.vstack([c.T @ (c @ q), last])

    found = _summed(fit, d, entries, d + 1, width) / n
    return found[:d], float(found[d, 0])


def rayleigh_ritz(q: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, error): the k leading estimates from an orthonormal q and y = V q; the error is the largest
    residual over the gap to the nearest other value."""
    t = q.T @ y
    values, turn = np.linalg.eigh((t + t.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    residual = np.linalg.norm(y @ turn - (q @ turn) * values, axis=0)
    gaps = np.abs(values[:, None] - values[None, :]) + np.diag(np.full(len(values), np.inf))
    near = gaps.min(axis=1)
    error = float(np.max(np.where(residual[:k] > 0, residual[:k] / np.maximum(near[:k], 1e-300), 0), initial=0))
    vectors = q @ turn[:, :k]
    return values[:k].clip(min=0), vectors / np.linalg.norm(vectors, axis=0), error


def leading(multiply, d: int, k: int, oversample: int = OVERSAMPLE, passes: int = PASSES, tolerance: float = TOLERANCE) -> tuple:
    """(variances, components, trace, passes, expanded) of the covariance that ``multiply`` applies to a block."""
    width = min(d, k + oversample)
    q, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, width)))
    for done in range(1, passes + 1):
        y, trace = multiply(q)
        values, vectors, error = rayleigh_ritz(q, y, k)
        if width == d or error <= tolerance or not trace:
            return values, vectors, trace, done, False
        q, _ = np.linalg.qr(y)
    q = np.eye(d)
    y, trace = multiply(q)
    values, vectors, _ = rayleigh_ritz(q, y, k)
    return values, vectors, trace, passes + 1, True


def identity_error(fit: DataFrame, model: Model) -> float:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    own = np.flatnonzero(np.isfinite(model.scales))
    if not len(own):
        return 0.0
    projection, k = model.components[:, own] * model.scales[own], len(own)

    def entries(x: np.ndarray) -> np.ndarray:
        z = centred(x, model.n, model.sums) @ projection
        return np.vstack([z.T @ z, z.sum(axis=0)[None, :]])

    found = _summed(fit, len(model.sums), entries, k + 1, k) / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def fit(rows: DataFrame, d: int, k: int = COMPONENTS) -> Model | None:
    """The model of ``rows(x)`` of dimension d; none without rows."""
    if not d:
        return None
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; at most {MOST_DIMENSIONS} fit on the driver")
    distinct = storage.staged(rows.select("x").distinct(), "fit-list")
    n, sums = moments(distinct, d)
    variances, components, trace, passes, expanded = leading(lambda q: multiplied(distinct, n, sums, q), d, min(k, d))
    model = Model(n, sums, components, variances, trace, passes=passes, expanded=expanded)
    model.identity_error = identity_error(distinct, model)
    return model


def whitened(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with ``x``) with ``FIELDS``: the squared deviation and the whitened projections."""
    d = len(model.sums)
    projection = model.components * np.nan_to_num(model.scales)
    missing = np.isnan(model.scales)

    @F.arrow_udf("struct<deviation:long,whitened:array<double>>")
    def run(column: pa.Array) -> pa.Array:
        x = _matrix(column, d)
        z = centred(x, model.n, model.sums) @ projection
        values = pa.array(z.ravel(), mask=np.tile(missing, len(z)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), values)
        return pa.StructArray.from_arrays([pa.array(squared_deviations(x, model.n, model.sums), pa.int64()), lists], names=FIELDS)

    own = [c for c in rows.columns if c not in FIELDS]
    made = rows.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), run("x").alias("made"))
    return made.select(*[F.col(f"own.`{c}`").alias(c) for c in own], *[F.col(f"made.{c}").alias(c) for c in FIELDS])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every usable vector's whitened components."""
    rows, d = usable(storage.documents(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    model = fit(rows, d)
    if model is None:
        return rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))])
    each = whitened(rows.select("vec_id", "x"), model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, model.explained)), F.col("place") + 1)
    return each.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
