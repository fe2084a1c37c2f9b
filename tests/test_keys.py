"""Key audits: exact repeats, conflicts, null keys, separator collisions."""

from panelkit.operators import keys as K

KEY = ["period", "household", "person"]
SCHEMA = "period string, household long, person long, a string, b string"


def _frame(spark):
    rows = [
        ("P", 1, 1, "x", "y"), ("P", 1, 1, "x", "y"),            # exact repeat
        ("P", 2, 1, "x", "y"), ("P", 2, 1, "x", "z"),            # conflict
        ("P", None, 1, "x", "y"), ("P", None, 1, "x", "y"),      # null key
        ("P", 3, 1, "x", "y"), ("Q", 3, 1, "x", "y"),            # other period: not a duplicate
        ("P", 4, 1, "a|b", "c"), ("P", 4, 1, "a", "b|c"),        # separator collision -> conflict
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_duplicate_classification(spark):
    d = {(r["household"]): (r["n_rows"], r["n_versions"], r["kind"])
         for r in K.duplicate_keys(_frame(spark), KEY, ["a", "b"]).collect()}
    assert d[1] == (2, 1, K.EXACT)
    assert d[2] == (2, 2, K.CONFLICT)
    assert d[None] == (2, 1, K.EXACT)
    assert d[4] == (2, 2, K.CONFLICT)
    assert 3 not in d


def test_signature_variant_agrees(spark):
    a = {tuple(r) for r in K.duplicate_keys(_frame(spark), KEY, ["a", "b"]).collect()}
    b = {tuple(r) for r in K.duplicate_keys(_frame(spark), KEY, ["a", "b"], by_signature=True).collect()}
    assert a == b


def test_key_audit(spark):
    r = K.key_audit(_frame(spark), KEY, ["household", "person"]).first()
    assert (r["rows"], r["distinct_keys"], r["surplus_rows"], r["null_key_rows"]) == (10, 6, 4, 2)


def test_flags_report_vs_flag(spark):
    df = _frame(spark)
    dups = K.duplicate_keys(df, KEY, ["a", "b"])
    rep = {(r["household"], r["duplicate_key"]) for r in K.flag_duplicates(df, dups, KEY).collect()}
    assert (None, False) in rep and (1, True) in rep and (3, False) in rep
    flg = {(r["household"], r["duplicate_key"]) for r in K.flag_duplicates(df, dups, KEY, null_keys="flag").collect()}
    assert (None, True) in flg
    # flagging never drops or multiplies rows
    assert K.flag_duplicates(df, dups, KEY).count() == df.count()
    # the shuffle-join path (no broadcast) gives the same flags
    big = {(r["household"], r["duplicate_key"]) for r in
           K.flag_duplicates(df, dups, KEY, max_broadcast_bytes=0).collect()}
    assert big == rep


def test_examples_and_top(spark):
    df = _frame(spark)
    dups = K.duplicate_keys(df, KEY, ["a", "b"])
    top = K.top_duplicates(dups, KEY, 2).collect()
    assert [r["n_versions"] for r in top] == [2, 2]
    ex = K.duplicate_examples(df, dups, KEY, 10)
    assert ex.where("household is null").count() == 0 and ex.count() == 6
