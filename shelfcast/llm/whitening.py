"""Embedding whitening by a block Jacobi-Davidson iteration (operator 12).

The covariance is never formed. Each product with a few vectors is one Spark
job over the packed distinct vectors: rows are centred first, multiplied, and
every task returns one small sum. The driver holds the search space (at most
``MAX_SPACE`` vectors of the embedding's width):

* Rayleigh-Ritz on the space gives the leading pairs and their residuals.
* The correction equations of all wanted pairs, projected off the locked and
  the current vectors, are solved together by a few steps of MINRES, so a step
  costs one job whatever the number of pairs.
* A pair is locked in order when its residual is at rounding level; the next
  ones are kept orthogonal to it. The iteration ends when all are locked.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import materialize
from shelfcast.llm.vectors import exact, kept_vectors, longest, pack, scaled_floor, unpack

SCALE = 256
COMPONENTS = 4
GUARD = 4                  # extra columns of the search space's start
INNER_STEPS = 8
MAX_SPACE = 40
MAX_OUTER = 80
EPS = float(np.finfo(np.float64).eps)

_BLOCK = T.StructType([T.StructField("kind", T.StringType()), T.StructField("vectors", T.BinaryType())])
_SUM = T.StructType([T.StructField("total", T.BinaryType())])


@dataclass
class FitList:
    """The distinct integer vectors: packed blocks, their number, and exact sums per dimension."""

    blocks: DataFrame
    width: int
    n: int
    sums: list[int]
    squares: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def trace(self) -> float:
        """Trace of the covariance, rounded once."""
        whole = sum(self.n * q - s * s for s, q in zip(self.sums, self.squares))
        return whole / (self.n * self.n)

    def sum_over_tasks(self, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``of_block`` (centred rows -> small matrix) over all blocks.

        A task streams its blocks and returns one matrix. Tasks are bounded by
        the cluster's cores, not by the data, and so is what the driver adds
        (correctly rounded, so the order in which tasks end does not matter).
        """
        width, n, sums = self.width, self.n, self.sums

        def run(batches):
            total = None
            for batch in batches:
                for kind, data in zip(batch.column("kind").to_pylist(), batch.column("vectors").to_pylist()):
                    part = of_block(deviations(unpack(kind, data, width), n, sums).astype(np.float64) / n)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

        tasks = max(2 * self.blocks.sparkSession.sparkContext.defaultParallelism, 8)
        parts = [np.frombuffer(r.total) for r in self.blocks.coalesce(tasks).mapInArrow(run, _SUM).collect()]
        return np.array([math.fsum(column) for column in zip(*parts)])

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        return self.sum_over_tasks(lambda y: y.T @ (y @ q)).reshape(q.shape) / self.n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` exactly: longs where their squares cannot overflow, else Python integers."""
    top = n * int(max(np.abs(x.astype(np.float64)).max(initial=0), 1)) + max(map(abs, sums), default=0)
    if top * top * max(len(sums), 1) < 2 ** 62:
        return x.astype(np.int64) * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def fit_list(vectors: DataFrame, scale: int = SCALE) -> FitList:
    """Each distinct integer vector once, by a distinct with map-side combining on its packed bytes."""
    width = longest(vectors)

    def keys(batches):
        for batch in batches:
            x = scaled_floor(batch.column(0), scale, width)
            yield pa.RecordBatch.from_arrays([pa.array([pack(row)[1] for row in x], pa.binary())], names=["x"])

    def blocks(batches):
        for batch in batches:
            data = batch.column(0).to_pylist()
            if data:
                kinds = {2: "<i2", 4: "<i4", 8: "<i8"}
                kind, packed = pack(np.array([np.frombuffer(d, kinds[len(d) // width]).astype(np.int64) for d in data]))
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.string()), pa.array([packed], pa.binary()),
                                                  pa.array([len(data)], pa.int64())], names=["kind", "vectors", "n"])

    rows = vectors.select("embedding").mapInArrow(keys, "x binary").distinct()
    packed = materialize(rows.mapInArrow(blocks, T.StructType([*_BLOCK, T.StructField("n", T.LongType())])), "whiten-fit")

    def moments(batches):
        s, q, seen = [0] * width, [0] * width, False
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("vectors").to_pylist()):
                x, seen = unpack(kind, data, width), True
                for total, power in ((s, 1), (q, 2)):
                    wide = exact(x, int((2.0 ** 62 / max(len(x), 1)) ** (1 / power)))
                    part = (wide ** power).sum(axis=0)
                    total[:] = [a + int(b) for a, b in zip(total, part)]
        if seen:
            dims = range(width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dims, pa.int32()), pa.array([str(v) for v in s], pa.string()), pa.array([str(v) for v in q], pa.string())],
                names=["dim", "s", "q"])

    n = packed.agg(F.sum("n").alias("n")).first()["n"] or 0
    tasks = max(2 * vectors.sparkSession.sparkContext.defaultParallelism, 8)
    sums, squares = [0] * width, [0] * width
    for r in packed.select("kind", "vectors").coalesce(tasks).mapInArrow(moments, "dim int, s string, q string").collect():
        sums[r.dim] += int(r.s)
        squares[r.dim] += int(r.q)
    return FitList(packed.select("kind", "vectors"), width, n, sums, squares)


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """At most ``steps`` of MINRES for each column of ``b`` with one shared ``apply``; stops below ``goal`` of the start."""
    norm = lambda m: np.sqrt((m * m).sum(axis=0))
    beta = norm(b)
    start = np.where(beta > 0, beta, 1.0)
    v_old, v = np.zeros_like(b), b / start
    w_old, w, x = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    cos_old, cos, sin_old, sin = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta = beta.copy()
    alive = beta > 0
    for _ in range(steps):
        av = apply(v)
        alpha = (v * av).sum(axis=0)
        nxt = av - alpha * v - beta * v_old
        beta_next = norm(nxt)
        delta = cos * alpha - cos_old * sin * beta
        rho2, rho3 = sin * alpha + cos_old * cos * beta, sin_old * beta
        rho1 = np.hypot(delta, beta_next)
        alive &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1.0)
        cos_old, cos, sin_old, sin = cos, delta / safe, sin, beta_next / safe
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe
        x += np.where(alive, cos * eta, 0.0) * w
        eta = -sin * eta
        alive &= (beta_next > 1e-14 * start) & (np.abs(eta) > goal * start)
        if not alive.any():
            break
        v_old, v, beta = v, nxt / np.where(beta_next > 0, beta_next, 1.0), beta_next
    return x


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The directions of ``new`` outside ``against``, orthonormal; those lost in rounding are left out."""
    basis = np.hstack(against) if against else np.zeros((len(new), 0))
    out = []
    for column in new.T:
        size = np.linalg.norm(column)
        c = column / size if size > 0 else column
        for _ in range(3):
            for m in (basis, np.array(out).T if out else None):
                if m is not None and m.size:
                    c = c - m @ (m.T @ c)
            left = np.linalg.norm(c)
            if left < 1e-10:
                break
            c = c / left
        else:
            out.append(c)
    return np.array(out).T if out else np.zeros((len(new), 0))


def jacobi_davidson(times: Callable[[np.ndarray], np.ndarray], width: int, scale: float,
                    wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs (values falling, vectors as columns) of the symmetric operator ``times``.

    ``scale`` is a bound of its norm (the trace). Every pair returned has a
    residual of at most ``max(width, 16) * eps`` times the largest
    eigenvalue; an iteration that does not get there fails.
    """
    wanted = min(wanted, width)
    rng = np.random.default_rng(12)
    space = orthonormal(rng.standard_normal((width, min(wanted + GUARD, width))))
    image = times(space)
    locked, values = np.zeros((width, 0)), []
    for outer in range(MAX_OUTER):
        h = space.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        top = max([*values, theta[0] if len(theta) else 0.0, 0.0])
        limit = max(width, 16) * EPS * (top if top > 0 else scale)
        space, image = space @ s, image @ s
        residual = image - space * theta
        done = 0
        while done < min(wanted - len(values), space.shape[1]) and np.linalg.norm(residual[:, done]) <= limit:
            done += 1
        locked = np.hstack([locked, space[:, :done]])
        values += theta[:done].tolist()
        space, image, theta, residual = space[:, done:], image[:, done:], theta[done:], residual[:, done:]
        left = wanted - len(values)
        if left == 0:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        if space.shape[1] > MAX_SPACE:
            space, image = space[:, :MAX_SPACE // 2], image[:, :MAX_SPACE // 2]
        u, t = space[:, :left], theta[:left]
        fixed = np.hstack([locked, u])
        off = lambda m: m - fixed @ (fixed.T @ m)

        def projected(p: np.ndarray) -> np.ndarray:
            p = off(p)
            return off(times(p) - p * t[:p.shape[1]])

        step = minres(projected, -off(residual[:, :left]), INNER_STEPS, 2.0 ** -(outer + 2)) if left and u.size else u
        fresh = orthonormal(np.hstack([step, residual[:, :left]]), locked, space)
        if not fresh.size:
            fresh = orthonormal(rng.standard_normal((width, left)), locked, space)
        if fresh.size:
            space, image = np.hstack([space, fresh]), np.hstack([image, times(fresh)])
    raise RuntimeError(f"jacobi_davidson: {len(values)} of {wanted} pairs at rounding level after {MAX_OUTER} steps")


@dataclass
class Whitening:
    """What `whiten` applies: exact sums, the components (columns) and their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(df: DataFrame, scale: int = SCALE, wanted: int = COMPONENTS) -> Whitening:
    """Components of the distinct integer vectors of ``df``.

    Components without variance (fewer distinct vectors or dimensions than
    components) cannot be whitened and are left out.
    """
    data = fit_list(kept_vectors(df), scale)
    if data.n < 2 or data.trace == 0:
        return Whitening(data.n, data.sums, np.zeros(0), np.zeros((data.width, 0)), np.zeros(0), 0.0)
    values, components = jacobi_davidson(data.covariance_times, data.width, data.trace, wanted)
    real = values > 64 * max(data.width, 16) * EPS * data.trace
    values, components = values[real], components[:, real]
    k = len(values)
    whitened = components / np.sqrt(values)
    covariance = data.sum_over_tasks(lambda y: (y @ whitened).T @ (y @ whitened)).reshape(k, k) / data.n
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return Whitening(data.n, data.sums, values, components, values / data.trace, error)


_OUT = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])


def whiten(df: DataFrame, model: Whitening, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row with a finite vector.

    Rows whose vector is null or holds null or non-finite entries are dropped;
    null and repeated vec_ids keep their rows; extra columns are ignored; an
    empty table gives an empty result. A vector shorter than the longest counts
    as continued with zeros. Components come out in falling order of their
    eigenvalue, at most as many as there are with variance: rows of a table of
    equal vectors have none. ``deviation`` is exact.
    """
    import decimal

    shared = df.sparkSession.sparkContext.broadcast(model)          # a few vectors of the embedding's width

    def run(batches):
        m = shared.value
        k, width = len(m.values), len(m.sums)
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = scaled_floor(batch.column(1), scale, width).astype(np.int64)
            y = deviations(x, m.n, m.sums)
            dev = np.repeat((y * y).sum(axis=1), k)
            z = (y.astype(np.float64) / m.n) @ (m.components / np.sqrt(m.values))
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, m.n)),
                (pa.array(dev).cast(pa.decimal128(38, 0)) if dev.dtype != object
                 else pa.array([decimal.Decimal(int(v)) if v < 10 ** 38 else None for v in dev], pa.decimal128(38, 0))),
                pa.array(z.ravel()), pa.array(np.tile(m.explained, rows)),
                pa.array(np.full(rows * k, m.identity_error))],
                names=[f.name for f in _OUT])

    vectors = kept_vectors(df, "vec_id").select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return vectors.mapInArrow(run, _OUT)
