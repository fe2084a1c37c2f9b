import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import op11_whitening as op

from ..conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(vectors):
    """(n, deviations, eigenvalues, eigenvectors, trace) by a full eigendecomposition."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    y = (x - s // n).astype(float) - (s % n).astype(float) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    return n, dev, e[::-1], q[:, ::-1], np.trace(v), y


def compare(got, ids, vectors, components):
    n, dev, e, q, trace, y = brute(vectors)
    by = {}
    for r in got:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by) == list(range(1, components + 1))
    for c, rows in by.items():
        z = y @ q[:, c - 1] / math.sqrt(e[c - 1])
        mine = np.array([rows[i]["whitened"] for i in ids])
        assert min(np.abs(mine - z).max(), np.abs(mine + z).max()) < 1e-6
        for i, d in zip(ids, dev):
            r = rows[i]
            assert r["n"] == n and r["deviation"] == d
            assert abs(r["explained"] - e[c - 1] / trace) < 1e-9 * r["explained"] + 1e-15 and r["identity_error"] < 1e-9


def test_against_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    v = (rng.standard_normal((400, 40)) * np.linspace(2, 0.3, 40)).astype(np.float32)
    got = op.digest(frame(spark, [(i, r.tolist()) for i, r in enumerate(v)]).repartition(7)).collect()
    compare(got, range(400), v, 32)


def test_small_table(spark):
    t = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in t.collect()]
    rows = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    got = op.digest(t).collect()
    compare(got, [r[0] for r in rows], [r[1] for r in rows], 32)


def test_awkward_rows(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((30, 5)).astype(np.float32).tolist()
    bad = [(None, None), (100, []), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, [1.0, 2.0])]
    rows = list(enumerate(v)) + [(None, v[0]), (3, v[1])] + bad
    df = frame(spark, rows).withColumn("x", F.lit("x")).withColumn("n", F.lit(1)).withColumn("component", F.lit(1))
    got = op.digest(df).collect()
    assert len(got) == 32 * 5 and {r["vec_id"] for r in got} == set(range(30)) | {None}
    assert {r["n"] for r in got} == {32} and max(r["identity_error"] for r in got) < 1e-9
    assert got[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}


def test_low_rank_constant_and_empty(spark):
    line = [(i, [float(i), float(2 * i), 1.0]) for i in range(20)]
    got = op.digest(frame(spark, line)).collect()
    assert len(got) == 20 and {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-9
    assert op.digest(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert op.digest(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    empty = op.digest(frame(spark, []))
    assert empty.count() == 0 and len(empty.columns) == 7


def test_large_entries_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [3.0, 5.0])]
    got = {r["vec_id"]: r["deviation"] for r in op.digest(frame(spark, rows)).collect()}
    assert got[1] is None and got[2] is None and got[3] is not None


def test_solver_with_restarts_and_ties():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((200, 200)))
    e = np.concatenate([[9, 9, 9, 5, 5], np.linspace(4, 0, 195)])
    v = (q * e) @ q.T
    calls = []

    def product(u):
        calls.append(u.shape[1])
        return v @ u
    values, vectors = op.jacobi_davidson(product, 200, 12)
    assert np.abs(values - e[:12]).max() < 1e-12
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 and np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
    assert max(calls) <= 200 - 0 and len(calls) < 200


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((25, 25))
    a = a + a.T
    q, _ = np.linalg.qr(rng.standard_normal((25, 3)))
    shifts, rhs = np.array([0.1, 2.0]), rng.standard_normal((25, 2))
    t = op.minres(lambda u: a @ u, shifts, q, rhs, 80)
    p = np.eye(25) - q @ q.T
    assert np.abs(q.T @ t).max() < 1e-12
    for i, s in enumerate(shifts):
        assert np.abs(p @ (a - s * np.eye(25)) @ t[:, i] - p @ rhs[:, i]).max() < 1e-9


def test_no_convergence_raises():
    with pytest.raises(RuntimeError):
        rng = np.random.default_rng(7)
        op.jacobi_davidson(lambda u: rng.standard_normal(u.shape), 50, 5)
