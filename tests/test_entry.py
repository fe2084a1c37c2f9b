"""Driver contract: entry runs, every query has a callable, and a sample of
oracle-checked queries agrees with DuckDB on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from panelkit.plans.testpanel import TEST_TABLES

from .conftest import SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) >= {"period", "step", "row", "remaining"}


def test_contract_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 70


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            vals.append(f"{v:.9g}" if isinstance(v, float) else str(v))
        out.append("|".join(vals))
    return sorted(out)


@pytest.mark.parametrize("name", ["R3_exclusion_cascade", "A7_duplicate_keys", "A9_numeric_profile",
                                  "M2_spearman_matrix", "J1_prepared_with_flag", "A18_errors_by_p90"])
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    s_rows, s_cols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _norm(s_rows, s_cols) == _norm(d_rows, d_cols)
