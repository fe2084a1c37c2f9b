"""Embedding whitening by a block Jacobi-Davidson method.

An entry c of an embedding becomes the integer x = floor(SCALE * c) + OFFSET.
The covariance V of all rows (divisor n, centred before multiplying) is never
formed: the solver only asks for products V U with a block of a few vectors,
and each product is one distributed pass (partial sums in the tasks, added up
by a shuffle on the dimension; the driver gets dimension x block numbers).

* Rayleigh-Ritz: the operator is projected on the current subspace; its
  leading unlocked Ritz pairs are looked at.
* Correction: for the leading pairs (theta, u) with residual r the equation
  (I - QQ')(V - theta I)(I - QQ') t = -r, Q being the locked vectors and the
  block's Ritz vectors, is solved by INNER steps of MINRES, all right sides in step, so that a
  step is one pass; the solutions widen the subspace.
* Locking: leading pairs whose residual is at most TOLERANCE times the
  largest Ritz value (double precision) leave the search, which goes on among
  vectors orthogonal to them until the wanted number is locked.

Components are the locked pairs by falling eigenvalue. Those whose eigenvalue
is at most ZERO times the trace have no direction in the data and are left
out, so data of rank r give at most r components.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are dropped; so are vectors of another length than the commonest
(ties: the longest); an entry beyond +-LARGEST / SCALE counts as that bound;
null and repeated ids and repeated vectors are rows like others; a deviation
beyond 64 bits is null; fewer than two different vectors give no components
and so no rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import saved

SCALE, OFFSET, LARGEST = 64, 1_000_000, float(1 << 40)
COMPONENTS, BLOCK, INNER, ROUNDS = 32, 8, 4, 200
TOLERANCE, ZERO = 256 * np.finfo(float).eps, 1e-12
#: Vector entries that a task holds in double precision at a time.
ENTRIES = 1 << 20


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """Rows (vec_id, x array<bigint>) of the usable vectors."""
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = embeddings.select("vec_id", "embedding").where(e.isNotNull() & (F.size(e) > 0) & fine)
    whole = F.transform(e, lambda v: F.floor(F.greatest(F.least(v.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))) + OFFSET)
    rows = saved(usable.select("vec_id", whole.alias("x")), "op11-x")
    widths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = widths.orderBy(F.desc("n"), F.desc("d")).limit(1).first()
    return rows.where(F.size("x") == (usual["d"] if usual else 0))


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(a slice of a batch, its vectors as an integer matrix); x is its last column."""
    step = max(1, ENTRIES // d)
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            yield part, part.column(part.num_columns - 1).flatten().to_numpy().reshape(-1, d)


def _summed(rows: DataFrame, d: int, term: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of ``term`` (a matrix of few numbers for a block of rows)."""
    def run(batches):
        total = None
        for _, x in _blocks(batches, d):
            now = term(x)
            total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total))], ["i", "v"])
    parts = rows.select("x").mapInArrow(run, f"i int, v array<{kind}>")
    whole = kind == "long"
    value = F.col("v").cast("decimal(38,0)") if whole else F.col("v")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum(value).alias("v")).collect()
    if not cells:
        return np.zeros((0, 0))
    out = np.zeros((max(r["i"] for r in cells) + 1, max(r["j"] for r in cells) + 1), object if whole else float)
    for r in cells:
        out[r["i"], r["j"]] = int(r["v"]) if whole else r["v"]
    return out


@dataclass
class Centre:
    """Exact sums of the fit list; the mean is a whole part and a fraction."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.part = np.array([s % self.n for s in self.sums], float) / self.n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 by row, exact."""
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        sums = np.array(self.sums, object if most >= 1 << 62 else np.int64)
        if most < 1 << 62:
            diff = self.n * x - sums
            most = int(np.abs(diff).max(initial=0))
            if most * most * x.shape[1] < 1 << 63:
                return (diff * diff).sum(1).tolist()
        diff = self.n * x.astype(object) - sums.astype(object)
        return [v if v < 1 << 63 else None for v in (diff * diff).sum(1)]


def _against(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x - q @ (q.T @ x) if q.shape[1] else x


def _orthonormal(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what x adds to the orthonormal q."""
    out = []
    for v in x.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        basis = np.column_stack([q, *out])
        for _ in range(2):
            v = _against(basis, v[:, None])[:, 0]
        left = np.linalg.norm(v)
        if left > 1e-8:
            v = _against(basis, (v / left)[:, None])[:, 0]
            out.append(v / np.linalg.norm(v))
    return np.column_stack(out) if out else np.zeros((x.shape[0], 0))


def minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, q: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Columns t of (I - QQ')(V - shift I)(I - QQ') t = rhs by MINRES, all
    columns in step: a product with the whole block for each step."""
    def operator(v):
        return _against(q, product(v) - shifts * v)
    rhs = _against(q, rhs)
    m = rhs.shape[1]
    x, v_old, w_old, w = (np.zeros_like(rhs) for _ in range(4))
    beta = np.linalg.norm(rhs, axis=0)
    v = rhs / np.where(beta > 0, beta, 1)
    eta, c_old, c, s_old, s = beta.copy(), np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    live, least = beta > 0, beta * 1e-14
    beta = np.where(live, beta, 0)
    for _ in range(steps):
        if not live.any():
            break
        p = operator(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # two plane rotations of the tridiagonal's new column
        r3, r2 = s_old * beta, s * alpha + c_old * c * beta
        low = c * alpha - c_old * s * beta
        r1 = np.hypot(low, beta_new)
        ok = live & (r1 > 0)
        safe = np.where(ok, r1, 1)
        c_new, s_new = np.where(ok, low / safe, 1), np.where(ok, beta_new / safe, 0)
        w_new = np.where(ok, (v - r3 * w_old - r2 * w) / safe, 0)
        x = x + np.where(ok, c_new * eta, 0) * w_new
        eta = -s_new * eta
        w_old, w = w, w_new
        c_old, c, s_old, s = c, c_new, s, s_new
        live = ok & (beta_new > 0) & (np.abs(eta) > least)
        v_old, v = v, np.where(live, p / np.where(beta_new > 0, beta_new, 1), 0)
        beta = beta_new
    return _against(q, x)


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, block: int = BLOCK,
                    inner: int = INNER, tolerance: float = TOLERANCE, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the ``wanted`` largest of a
    symmetric operator that is only known by its products with blocks. Raises
    if ROUNDS rounds do not bring all residuals to the tolerance."""
    rng = np.random.default_rng(seed)
    wanted, most = min(wanted, d), min(d, 3 * max(wanted, block))
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    fresh = _orthonormal(basis, rng.standard_normal((d, min(d, 2 * block))))
    top = 0.0
    for _ in range(ROUNDS):
        if fresh.shape[1]:
            image = np.column_stack([image, product(fresh)])
            basis = np.column_stack([basis, fresh])
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        basis, image = basis @ y, image @ y
        top = max(top, abs(theta[0]) if len(theta) else 0.0, values.max(initial=0.0))
        residual = _against(locked, image - basis * theta)
        sizes = np.linalg.norm(residual, axis=0)
        done = int(np.argmin(np.append(sizes <= tolerance * top, False)))
        done = min(done, wanted - len(values))
        locked, values = np.column_stack([locked, basis[:, :done]]), np.append(values, theta[:done])
        basis, image, theta, residual = basis[:, done:], image[:, done:], theta[done:], residual[:, done:]
        if len(values) == wanted and not (len(theta) and theta[0] > values.min() + tolerance * top):
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        if len(values) == wanted:  # a larger value came up late: the least locked one makes room
            worst = int(np.argmin(values))
            locked, values = np.delete(locked, worst, 1), np.delete(values, worst)
        if basis.shape[1] + block > most and basis.shape[1] > wanted + block and locked.shape[1] + basis.shape[1] < d:
            basis, image = basis[:, :wanted + block], image[:, :wanted + block]
            theta, residual = theta[:wanted + block], residual[:, :wanted + block]
        have = np.column_stack([locked, basis])
        now = min(block, basis.shape[1])
        if now and have.shape[1] < d:
            q = np.column_stack([locked, basis[:, :now]])
            t = minres(product, theta[:now], q, -residual[:, :now], inner)
            fresh = _orthonormal(have, t)
        else:
            fresh = np.zeros((d, 0))
        if not fresh.shape[1]:
            if have.shape[1] < d:
                fresh = _orthonormal(have, rng.standard_normal((d, min(block, d - have.shape[1]))))
            else:  # the whole space: products anew take rounding out of the images
                basis = _orthonormal(locked, basis)
                fresh, basis, image = basis, np.zeros((d, 0)), np.zeros((d, 0))
    raise RuntimeError(f"{wanted - len(values)} of {wanted} pairs have not converged in {ROUNDS} rounds")


@dataclass
class Whitening:
    """A fitted whitening: centre, eigenvalues, eigenvectors (columns), trace and products taken."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors of ``integer_rows``; None without vectors."""
    first = rows.select(F.size("x").alias("d")).limit(1).first()
    if first is None:
        return None
    d = first["d"]
    total = _summed(rows, d, lambda x: np.append(x.sum(0), len(x))[:, None], "long")[:, 0]
    centre = Centre(int(total[-1]), [int(s) for s in total[:-1]])
    trace = _summed(rows, d, lambda x: (centre(x) ** 2).sum(0)[:, None], "double").sum() / centre.n
    passes = 0

    def product(u: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def term(x):
            y = centre(x)
            return y.T @ (y @ u)
        return _summed(rows, d, term, "double") / centre.n
    if not trace > 0:
        return Whitening(centre, np.zeros(0), np.zeros((d, 0)), 0.0, 0)
    values, vectors = jacobi_davidson(product, d, components)
    real = values > ZERO * trace
    return Whitening(centre, values[real], vectors[:, real], float(trace), passes)


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, centre, matrix = len(w.values), w.centre, w.matrix
    if not k:
        return 0.0

    def term(x):
        y = np.column_stack([centre(x) @ matrix, np.ones(len(x))])
        return y.T @ y
    g = _summed(rows, len(centre.sums), term, "double") / centre.n
    return float(np.abs(g[:k, :k] - np.outer(g[:k, k], g[:k, k]) - np.eye(k)).max())


def whiten(rows: DataFrame, w: Whitening) -> DataFrame:
    """Rows (vec_id, deviation, whitened array<double>), one for each vector."""
    centre, matrix, d = w.centre, w.matrix, len(w.centre.sums)

    def run(batches):
        for part, x in _blocks(batches, d):
            z = centre(x) @ matrix
            offsets = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(centre.deviation(x), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))],
                ["vec_id", "deviation", "whitened"])
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def digest(embeddings: DataFrame) -> DataFrame:
    rows = integer_rows(embeddings)
    w = fit(rows)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    if w is None or not len(w.values):
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(rows, w)
    share = F.array(*[F.lit(float(e / w.trace)) for e in w.values])
    long = whiten(rows, w).select("vec_id", "deviation", F.posexplode("whitened").alias("c", "whitened"))
    return long.select("vec_id", (F.col("c") + 1).cast("int").alias("component"), F.lit(w.centre.n).cast("long").alias("n"), "deviation",
                       "whitened", share[F.col("c")].alias("explained"), F.lit(error).alias("identity_error"))
