import tiktoken

from panelkit.llm import op2_token_counts as op

from .helpers import awkward, documents


def lengths():
    with open(op.RANKS, "rb") as f:
        e = op._encoding(f.read(), op.PATTERN)
    assert isinstance(e, tiktoken.Encoding)
    return [len(e.encode_ordinary(r[1])) if r[1] else 0 for r in awkward()]


def test_suffix_sums_answer_every_limit(spark):
    n = lengths()
    sums = op.digest(documents(spark))
    rows = sums.collect()
    assert {r["n_tokens"]: r["n_docs"] for r in rows} == {x: n.count(x) for x in n}
    for r in rows:
        L = r["n_tokens"]
        assert r["docs_at_least"] == sum(x >= L for x in n) and r["tokens_at_least"] == sum(x for x in n if x >= L)
        assert r["docs_total"] == len(n) and r["tokens_total"] == sum(n) and r["tokens_cut"] == sum(min(x, L) for x in n)
    limits = [0, 1, 50, 500, 10 ** 6]
    got = op.truncated_totals(sums, limits).first()
    assert [got[f"cut_{x}"] for x in limits] == [sum(min(a, x) for a in n) for x in limits]
    shares = [0.1, 0.5, 0.9, 1.0]
    got = op.quantiles(sums, shares).first()
    ordered = sorted(n)
    assert [got[f"q_{s}"] for s in shares] == [next(x for x in ordered if sum(y <= x for y in n) >= s * len(n)) for s in shares]


def test_groups_and_buckets(spark):
    h = spark.createDataFrame([("a", 5, 2), ("a", 300, 1), ("a", 9000, 1), (None, 7, 4)], "source string, n_tokens long, n_docs long")
    got = {(r["source"], r["n_tokens"]): (r["docs_at_least"], r["tokens_cut"]) for r in op.suffix_sums(h, ("source",)).collect()}
    assert got == {("a", 5): (4, 20), ("a", 300): (2, 610), ("a", 9000): (1, 9310), (None, 7): (4, 28)}


def test_empty(spark):
    sums = op.digest(documents(spark, []))
    assert sums.count() == 0
    assert op.truncated_totals(sums, [5]).first()["cut_5"] == 0 and op.quantiles(sums, [0.5]).first()[0] is None


def test_long_runs_keep_their_tokens(monkeypatch):
    """A text cut at long runs has the tokens of the whole, in all places a run can stand."""
    enc = op._encoding(open(op.RANKS, "rb").read(), op.PATTERN)
    texts = [a + run + b for run in (" " * 50, "\n" * 50, " \n" * 30, "\t\u3000" * 40, "\x85" * 45 + " ")
             for a in ("", "word", "word.", "7") for b in ("", "word", "'s", "7", "!", "\u00e9" + " " * 60 + "x")]
    whole = [len(enc.encode_ordinary(t)) for t in texts]
    monkeypatch.setattr(op, "LONG_RUN", 40)
    monkeypatch.setattr(op, "LONG_SPACES", op.re.compile(op.LONG_SPACES.pattern.replace(str(1 << 15), "40")))
    assert [op.n_tokens(enc, t) for t in texts] == whole


def test_very_long_runs(spark):
    runs = [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "!" * 2_000_000, "x" + " " * 2_000_000 + "y"]
    got = op.encoded_lengths(spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "doc_id long, text string"), ["doc_id"]).collect()
    n = {r["doc_id"]: r["n_tokens"] for r in got}
    assert all(n[i] > 0 for i in range(5)) and n[4] == n[0] + 1 or n[4] >= n[0]
