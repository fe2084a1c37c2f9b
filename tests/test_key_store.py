"""Key audits over buckets: the general operators' answers, without a shuffle of the panel."""

import random
import re

import pytest
from pyspark.sql import functions as F

from panelkit.operators import keys as K
from panelkit.operators import keystore as KS
from panelkit.sources.buckets import bucket_count, open_key_store, write_key_store

KEY = ["period", "person"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(rng.choice("AB"), rng.randint(1, 400), rng.choice(["x", "y"]), i) for i in range(700)]
    data += [("A", 1000, rng.choice(["x", "y", "z"]), i) for i in range(500)]   # a hot key
    data += [(None, 3, "x", 1), (None, 3, "x", 2), ("A", None, "y", 3), (None, None, "z", 4)]
    return spark.createDataFrame(data, "period string, person long, content string, n long").repartition(4)


@pytest.fixture(scope="module")
def store(rows):
    import tempfile
    return write_key_store(rows, KEY, f"{tempfile.mkdtemp(prefix='panelkit-keys-', dir='/tmp')}/s", 8, hot_rows=100)


def same(a, b):
    return sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(map(repr, b.select(*sorted(a.columns)).collect()))


def exchanges(df):
    """The shuffles of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if re.search(r"Exchange (hash|range|round|single|REBALANCE)", line)]


def test_parts_share_no_key_and_hold_all_rows(rows, store):
    assert same(store.rows(), rows)
    light, plain = (df.select(*KEY).distinct() for df in (store.bucketed, store.plain))
    assert light.join(plain, KEY).count() == 0 and store.bucketed.where(K.any_null(KEY)).count() == 0
    assert store.plain.where("person = 1000").count() == 500


def test_answers_are_the_general_ones(rows, store):
    assert same(KS.key_audit(store), K.key_audit(rows, KEY))
    assert same(KS.duplicate_keys(store, ["content"]), K.duplicate_keys(rows, KEY, ["content"]))


@pytest.mark.parametrize("null_keys", ["report", "flag"])
def test_flags_are_the_general_ones(rows, store, tmpdir_path, null_keys):
    panel = rows.where("n % 3 <> 0")
    kept = write_key_store(panel, KEY, f"{tmpdir_path}/kept", store.buckets, hot_rows=50)
    cold = write_key_store(panel, KEY, f"{tmpdir_path}/cold", store.buckets, hot_rows=10_000)
    want = K.flag_duplicates(panel, K.duplicate_keys(rows, KEY, ["content"]), KEY, null_keys=null_keys)
    for s in (kept, cold):  # hot in one store, ordinary in the other
        assert same(KS.flag_duplicates(s, store, ["content"], null_keys=null_keys), want)
    with pytest.raises(ValueError):
        KS.flag_duplicates(write_key_store(panel, KEY, f"{tmpdir_path}/other", 3), store, ["content"])


def test_no_shuffle_of_the_bucketed_panel(spark, store):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan is printed whole
    try:
        for df in (KS._bucketed_duplicates(store, ["content"]), store.bucketed.groupBy(*KEY).count(),
                   store.bucketed.join(KS._bucketed_duplicates(store, ["content"]).select(*KEY).hint("merge"), KEY, "left")):
            assert exchanges(df) == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_store_opens_again(spark, rows, tmpdir_path):
    write_key_store(rows, KEY, f"{tmpdir_path}/s", 8, hot_rows=100)
    fresh = spark.newSession()
    again = open_key_store(fresh, f"{tmpdir_path}/s")
    assert (again.key, again.buckets) == (KEY, 8) and again.rows().count() == rows.count()
    assert KS.key_audit(again).first().asDict() == K.key_audit(rows, KEY).first().asDict()


def test_buckets_follow_the_rows(rows, tmpdir_path):
    assert bucket_count(0, 8) == 8 and bucket_count(10**9, 8) == 1000
    empty = write_key_store(rows.limit(0), KEY, f"{tmpdir_path}/e")
    assert KS.key_audit(empty).first().asDict() == {"rows": 0, "distinct_keys": 0, "surplus_rows": 0, "null_key_rows": 0}
    assert KS.duplicate_keys(empty, ["content"]).count() == 0


def test_without_hot_keys_no_key_is_counted(rows, tmpdir_path, monkeypatch):
    """Rows are counted by cells of the keys' hash; a count by key would shuffle every key."""
    from panelkit.sources import buckets as B
    counted = []
    monkeypatch.setattr(B, "cut", lambda df, was=B.cut: counted.extend(exchanges(df)) or was(df))
    cold = write_key_store(rows, KEY, f"{tmpdir_path}/cold", 8, hot_rows=10_000)
    assert counted and not any("person" in line for line in counted)
    assert same(cold.rows(), rows) and cold.plain.count() == 4


def test_a_hot_key_shares_its_cell(rows, tmpdir_path, monkeypatch):
    """All keys in one cell: only the hot one leaves the buckets."""
    from panelkit.sources import buckets as B
    monkeypatch.setattr(B, "CELLS", 1)
    few = write_key_store(rows, KEY, f"{tmpdir_path}/few", 8, hot_rows=100)
    assert same(few.rows(), rows)
    assert few.plain.where("person = 1000").count() == 500 and few.plain.count() == 504
