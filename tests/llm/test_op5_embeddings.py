import math

import numpy as np
import pytest

from panelkit.llm import op5_embeddings as op

from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = {}
    for i, (v, e, lab) in enumerate(rows):
        if e and lab is not None and all(x is not None and math.isfinite(x) for x in e) and any(x for x in e):
            x = np.array(e, np.float32).astype(float)
            ok[i] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    near = {i: [j for j in ok if j != i and i in ok and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j])
                and ok[i] @ ok[j] >= 0.98] for i in range(len(rows))}
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("rep", "v", "n", "cell", "copies", "near")})
    return sorted([tuple(r)[:3] for r in op.digest(op.near_duplicates(df)).collect()], key=repr)


def clouds(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 4 and i:
            base = rng.integers(0, i)
            e = (np.array(rows[base][1]) + rng.normal(0, spread, dim)).tolist()
            rows.append((i, e, rows[base][2]))
        else:
            rows.append((i, rng.normal(0, 1, dim).tolist(), int(rng.integers(0, 2))))
    return rows


@pytest.mark.parametrize("shard", [2048, 40])
def test_links_are_all_pairs(spark, monkeypatch, shard):
    monkeypatch.setattr(op, "SHARD", shard)
    rows = clouds(400, 16, 1, 0.08)
    assert run(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.01], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0),
            (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (None, [1.0, 0.0], 0), (None, None, None), (10, [], 0),
            (11, [1.0, 0.0, 0.0], 0), (12, [1e-40, 0.0], 0), (13, [3e38, 0.0], 0), (14, [-1.0, 0.0], 0), (15, [-0.0, 1.0], 2), (16, [0.0, 1.0], 2)]
    assert run(spark, rows) == brute(rows)


def test_copies_and_empty(spark):
    rows = [(i, [1.0, 2.0, 3.0], 5) for i in range(300)]
    assert run(spark, rows) == [t for t in sorted([(i, 299, 0) for i in range(300)], key=repr)]
    assert run(spark, []) == []


def test_recall_audit(spark):
    rows = clouds(300, 16, 3, 0.08)
    df = spark.createDataFrame(rows, SCHEMA)
    got = op.audit_recall(df, op.near_duplicates(df), 3).first()
    assert got["queries"] == 100 and got["recall"] == 1.0 and got["true_links"] > 0


def test_pruned_graph_reaches_every_point():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (300, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = op.pruned_graph(x)
    seen, todo = {0}, [0]
    while todo:
        for j in b[a == todo.pop()].tolist():
            if j not in seen:
                seen.add(j)
                todo.append(j)
    assert len(seen) == 300
