"""Whitening of embeddings along their leading principal components, found by block Jacobi-Davidson.

A vector's entries become whole numbers, floor(scale * c).  The fit list holds each distinct vector once: n of
them, with sums S.  Their covariance V (divisor n) is never formed.

*Products.*  V times a few columns is one Spark job over the fit list: each batch is centred exactly
(n * x - S in whole numbers, then divided by n) and multiplied, and the tasks' sums are added by an aggregation.
The driver holds vectors of the dimension only.

*Jacobi-Davidson.*  A search space Q with V Q is kept.  Rayleigh-Ritz in it gives the leading pairs (u, theta) and
their residuals r = V u - theta u.  For those that have not converged the correction equation
(I - P)(V - theta I)(I - P) t = -r, with P the projector on the locked vectors and u, is solved roughly by MINRES,
all of them side by side so that a step costs one job; the t extend Q.  A pair is locked, and projected out of all
that follows, when its residual is down to rounding (``TOLERANCE`` of the greatest eigenvalue) and all larger
ones are locked.  One pair more than asked for is followed until it can't lie above them.  Q restarts from its
leading Ritz vectors when it holds ``SPACE`` columns.

Rows whose vector is null or empty, holds a null or non-finite entry or one that leaves the range of whole numbers
(2**53 / scale), or has another than the most frequent length (ties: the greater) take no part.  Components whose
eigenvalue is nil to rounding are left out: equal vectors alone, a single one or an empty table give no rows.
Repeated rows count once in the fit and are all returned.  A deviation beyond a long is null.  Of the other
columns of the input only the id is read; a null id is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

SCALE = 256
COMPONENTS = 4
TOLERANCE = 64 * np.finfo(float).eps
SPACE = 64
INNER = 2
OUTER = 200
EXACT = 1 << 53


# --- the fit list and products with its covariance -------------------------------------------

def whole(embeddings: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x (array of long) of the rows that take part."""
    v = C.col(vector_col).cast("array<double>")
    fits = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float(EXACT) / scale))  # false for NaN, which is greatest
    x = F.transform(v, lambda c: F.floor(c * float(scale)).cast("long"))
    rows = embeddings.where(F.coalesce(fits, F.lit(False)) & (F.size(v) > 0)).select(C.col(id_col).alias("vec_id"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size("x") == (top["length"] if top else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def summed(df: DataFrame, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum over the batches of ``x`` of what ``work`` makes of each: per task one sum, added up by an aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            x = matrix(b.column(0))
            for a in range(0, len(x), 4096):
                total += work(x[a:a + 4096])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(flat.size)), pa.array(flat)], ["i", "v"])

    out = np.zeros(int(np.prod(shape)))
    for r in df.select("x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out.reshape(shape)


def centring(n: int, sums: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """x -> n * x - S in whole numbers: int64 where they fit, else Python's."""
    if n * max(1, int(np.abs(sums).max()) // n + 1) * 4 < 1 << 62:
        low = sums.astype(np.int64)

        def run(x: np.ndarray) -> np.ndarray:
            if len(x) and n * int(np.abs(x).max()) > 1 << 61:
                return x.astype(object) * n - sums
            return x * n - low

        return run
    return lambda x: x.astype(object) * n - sums


@dataclass
class Fit:
    """The fit list: its rows (a stored table with ``x``), their number and exact sums."""

    rows: DataFrame
    n: int
    sums: np.ndarray  # whole numbers of any size

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        n, exact = self.n, centring(self.n, self.sums)
        return lambda x: exact(x).astype(float) / n

    def product(self, v: np.ndarray) -> np.ndarray:
        """V v for the columns of v."""
        n, y = self.n, self.centred()

        def work(x: np.ndarray) -> np.ndarray:
            c = y(x)
            return c.T @ (c @ v) / n

        return summed(self.rows, work, v.shape)

    def trace(self) -> float:
        n, y = self.n, self.centred()
        return float(summed(self.rows, lambda x: np.array([(y(x) ** 2).sum() / n]), (1,))[0])


def fit_list(rows: DataFrame, path: str) -> Fit | None:
    """The distinct ``x`` of ``rows``, stored below ``path``, with their number and sums."""
    distinct = C.store(rows.select("x").distinct(), f"{path}/fit")
    n = distinct.count()
    if not n:
        return None
    by = distinct.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    return Fit(distinct, n, np.array([int(r["s"]) for r in by.orderBy("pos").collect()], object))


# --- Jacobi-Davidson -----------------------------------------------------------------------

def orthonormal(v: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of v made orthonormal and orthogonal to ``against``; dependent ones are dropped."""
    out: list[np.ndarray] = []
    base = [a for a in against if a.size]
    for c in v.T:
        size = np.linalg.norm(c)
        for _ in range(3):
            for a in base:
                c = c - a @ (a.T @ c)
            for o in out:
                c = c - o * (o @ c)
        now = np.linalg.norm(c)
        if size > 0 and now > 1e-10 * size:
            out.append(c / now)
    return np.stack(out, 1) if out else np.zeros((len(v), 0))


def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, theta: np.ndarray,
           project: Callable[[np.ndarray], np.ndarray], steps: int, reduce: float) -> np.ndarray:
    """Rough solutions t of P(V - theta I)P t = b, column by column but with one product for all in each step.

    Lanczos with Givens rotations; a column rests once its residual is ``reduce`` of b or its space is exhausted.
    """
    k = b.shape[1]
    x, w, w_old, v_old = (np.zeros_like(b) for _ in range(4))
    beta = np.linalg.norm(b, axis=0)
    start = np.where(beta > 0, beta, 1)
    v = b / start
    eta = beta.copy()
    beta_in = np.zeros(k)
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    active = beta > 0
    for _ in range(steps):
        if not active.any():
            break
        at = np.flatnonzero(active)
        p = np.zeros_like(b)
        p[:, at] = product(v[:, at])
        p = project(p - v * theta)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta_in * v_old
        beta_out = np.linalg.norm(p, axis=0)
        # column of the tridiagonal, turned by the last two rotations; then a new one
        r3 = s_old * beta_in
        bar = c_old * beta_in
        r2 = c * bar + s * alpha
        r1_bar = c * alpha - s * bar
        r1 = np.hypot(r1_bar, beta_out)
        ok = active & (r1 > 0)
        safe = np.where(ok, r1, 1)
        c_new, s_new = np.where(ok, r1_bar / safe, 1), np.where(ok, beta_out / safe, 0)
        w_new = (v - r3 * w_old - r2 * w) / safe
        x = np.where(ok, x + (c_new * eta) * w_new, x)
        eta = np.where(ok, -s_new * eta, eta)
        w_old, w = np.where(ok, w, w_old), np.where(ok, w_new, w)
        c_old, c, s_old, s = c, c_new, s, s_new
        v_old, v = v, np.where(beta_out > 0, p / np.where(beta_out > 0, beta_out, 1), 0)
        beta_in = beta_out
        active = ok & (np.abs(eta) > reduce * start) & (beta_out > 1e-14 * start)
    return project(x)


@dataclass
class Eigen:
    values: np.ndarray
    vectors: np.ndarray  # columns
    residuals: np.ndarray
    products: int


def leading(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int = COMPONENTS,
            tolerance: float = TOLERANCE, space: int = SPACE, inner: int = INNER, seed: int = 12) -> Eigen:
    """The ``wanted`` leading eigenpairs of a symmetric positive operator (all, if the dimension is less)."""
    wanted = min(wanted, dimension)
    space = max(space, 3 * (wanted + 1))
    jobs = 0

    def apply(v: np.ndarray) -> np.ndarray:
        nonlocal jobs
        jobs += 1
        return product(v)

    locked = np.zeros((dimension, 0))
    values: list[float] = []
    residuals: list[float] = []
    rng = np.random.default_rng(seed)
    q = orthonormal(rng.standard_normal((dimension, min(dimension, wanted + 2))))
    vq = apply(q)
    best, still = np.inf, 0
    for turn in range(OUTER):
        # Rayleigh-Ritz in the search space, which is orthogonal to the locked vectors
        h = q.T @ vq
        theta, z = np.linalg.eigh((h + h.T) / 2)
        theta, z = theta[::-1], z[:, ::-1]
        q, vq = q @ z, vq @ z
        scale = max([*values, theta[0] if len(theta) else 0.0, 0.0])
        if scale == 0:
            break
        want = wanted - len(values)
        r = vq - q * theta
        if locked.size:
            r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        # a residual that no longer falls has met the rounding of the products
        head = size[0] if len(size) else 0.0
        best, still = (head, 0) if head < 0.5 * best else (best, still + 1)
        limit = tolerance * scale
        done = 0
        while done < min(want, len(theta)) and (size[done] <= limit or (done == 0 and still >= 6 and size[0] <= 100 * limit)):
            done += 1
        if done:
            locked = np.concatenate([locked, q[:, :done]], 1)
            values += list(theta[:done])
            residuals += list(size[:done])
            q, vq, theta, r, size = q[:, done:], vq[:, done:], theta[done:], r[:, done:], size[done:]
            best, still = np.inf, 0
            want -= done
        if locked.shape[1] == dimension:
            break
        if want == 0:
            # the next pair must not hide a larger eigenvalue
            if not len(theta) or theta[0] + size[0] <= min(values) or size[0] <= limit:
                if len(theta) and theta[0] > min(values) + limit:
                    worst = int(np.argmin(values))  # it does: take it in, give back the least
                    q = np.concatenate([q, locked[:, worst:worst + 1]], 1)
                    vq = np.concatenate([vq, apply(locked[:, worst:worst + 1])], 1)
                    locked = np.delete(locked, worst, 1)
                    del values[worst], residuals[worst]
                    continue
                break
        if q.shape[1] + 1 > space:
            keep = want + 4
            q, vq, theta, r, size = q[:, :keep], vq[:, :keep], theta[:keep], r[:, :keep], size[:keep]
        if len(theta) == 0:
            more = rng.standard_normal((dimension, want + 1))
        else:
            some = [j for j in range(min(want + 1, len(theta))) if size[j] > limit]
            u, shift, rhs = q[:, some], theta[some], -r[:, some]

            def project(t: np.ndarray, u: np.ndarray = u) -> np.ndarray:
                if locked.size:
                    t = t - locked @ (locked.T @ t)
                return t - u * (u * t).sum(0)

            more = minres(apply, project(rhs), shift, project, inner, 0.5 ** (turn + 1))
            flat = np.linalg.norm(more, axis=0) == 0
            more[:, flat] = rhs[:, flat]
        new = orthonormal(more, locked, q)
        if not new.shape[1]:
            new = orthonormal(rng.standard_normal((dimension, want + 1)), locked, q)
        if not new.shape[1]:  # the search space is everything: the pairs are as exact as the products
            take = min(want, len(theta))
            locked = np.concatenate([locked, q[:, :take]], 1)
            values += list(theta[:take])
            residuals += list(size[:take])
            break
        q, vq = np.concatenate([q, new], 1), np.concatenate([vq, apply(new)], 1)
    else:
        raise RuntimeError(f"no convergence in {OUTER} steps: residuals {size[:want]}")
    order = np.argsort(values)[::-1]
    return Eigen(np.array(values)[order], locked[:, order], np.array(residuals)[order], jobs)


# --- whitening -----------------------------------------------------------------------------

@dataclass
class Whitening:
    """Centre, components and what they explain."""

    fit: Fit
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    products: int

    def project(self) -> Callable[[np.ndarray], np.ndarray]:
        y, to = self.fit.centred(), self.vectors / np.sqrt(self.values)
        return lambda x: y(x) @ to

    def identity_error(self) -> float:
        """Largest entry of the whitened fit list's covariance less the identity."""
        n, k, z = self.fit.n, len(self.values), self.project()
        mean = summed(self.fit.rows, lambda x: z(x).sum(0) / n, (k,))

        def work(x: np.ndarray) -> np.ndarray:
            c = z(x) - mean
            return c.T @ c / n

        return float(np.abs(summed(self.fit.rows, work, (k, k)) - np.eye(k)).max())


def train(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct ``x`` of ``rows`` (as ``whole`` gives them); None where they do not vary."""
    fit = fit_list(rows, C.work_dir(rows.sparkSession, "whitening"))
    if fit is None:
        return None
    trace = fit.trace()
    if trace == 0:
        return None
    found = leading(fit.product, len(fit.sums), components)
    real = found.values > len(fit.sums) * TOLERANCE * found.values[0]
    return Whitening(fit, found.values[real], found.vectors[:, real], trace, found.residuals[real], found.products)


WHITENED = ("vec_id {id}, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")


def whitened(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = WHITENED.format(id=rows.schema["vec_id"].dataType.simpleString())
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, k, z, exact = model.fit.n, len(model.values), model.project(), centring(model.fit.n, model.fit.sums)
    explained, error = model.values / model.trace, model.identity_error()

    def deviation(c: np.ndarray) -> list:
        """Sums of squares of whole numbers, null beyond a long."""
        if c.dtype != object and c.size and c.shape[1] * float(np.abs(c).max()) ** 2 < 2.0 ** 62:
            return (c * c).sum(1).tolist()
        wide = (c.astype(object) ** 2).sum(1)
        return [int(d) if d < 1 << 63 else None for d in wide]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1))
            m = len(x)
            row = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(np.repeat(np.array(deviation(exact(x)), object), k), pa.int64()),
                 pa.array(z(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)
