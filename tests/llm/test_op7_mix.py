import pytest

from panelkit.llm import op7_mix as op

from ..conftest import SMALL
from .helpers import awkward, documents, same, words, written


def rows_of(sizes):
    """(source, size) as documents."""
    return [(i, words(n, i) if n else "", "en", s, 0) for i, (s, n) in enumerate(sizes)]


CASES = {
    "awkward": awkward(),
    "one source": rows_of([("a", 500), ("a", 3), ("a", 0), ("a", 129)]),
    "capped": rows_of([("a", 10), ("b", 2000), ("c", 40), (None, 5), ("", 7), ("d", 900), ("e", 1)]),
    "many": rows_of([(f"s{i % 9}", 37 * i % 400) for i in range(300)]),
    "no words": rows_of([("a", 0), (None, 0)]),
    "empty": [],
}


@pytest.mark.parametrize("name", list(CASES))
def test_against_sql(spark, tmpdir_path, name):
    docs = documents(spark, CASES[name])
    path = written(documents(spark, CASES[name], clashing=False), tmpdir_path, "d")
    same(op.digest(op.mix(docs)), op.ORACLE, documents=path)


def test_small_table_against_sql(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    same(op.digest(op.mix(docs)), op.ORACLE, documents=f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("name", ["awkward", "capped", "many"])
def test_targets_are_met_and_nothing_is_taken_more_than_twice(spark, name):
    rows = op.mix(documents(spark, CASES[name])).collect()
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in rows)
    assert abs(sum(rs[0]["target"] for rs in by.values()) - 1.5 * total) < 1e-6 * total
    for rs in by.values():
        assert rs[0]["source_size"] == sum(r["size"] for r in rs) and rs[0]["target"] <= 2 * rs[0]["source_size"] + 1e-9
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= 0.5 + 1e-6
    again = op.mix(documents(spark, CASES[name]).repartition(5)).collect()
    key = lambda r: (repr(r["doc_id"]), repr(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_targets_by_resharing(spark):
    """The closed form against sharing the excess again and again."""
    docs = documents(spark, CASES["capped"])
    sizes = {}
    for s, n in [(r["source"], r["size"]) for r in op.sizes(docs).collect()]:
        sizes[s] = sizes.get(s, 0) + n
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(sizes.values())
    while left > 1e-9 and free:
        share = left / sum(weight[s] for s in free)
        left = 0.0
        for s in list(free):
            target[s] += share * weight[s]
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    got = {r["source"]: r["target"] for r in op.targets(op.sizes(docs)).collect()}
    assert all(abs(got[s] - target[s]) < 1e-6 for s in names)


def test_slots_hold_the_words(spark):
    docs = documents(spark, CASES["many"])
    n = {}
    for r in op.mixed_slots(docs, shard_slots=16).collect():
        assert 0 <= r["slot"] and len(r["text"].split()) <= op.BLOCK_WORDS
        n[r["source"]] = n.get(r["source"], 0) + len(r["text"].split())
    want = {}
    for r in op.mix(docs).collect():
        want[r["source"]] = want.get(r["source"], 0) + r["taken"]
    assert n == {s: w for s, w in want.items() if w}


def test_each_slot_is_drawn_once(spark):
    t = op.targets(op.sizes(documents(spark, CASES["many"])))
    by = {}
    for r in op.draws(t, 16, 8).collect():
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(by) > 10


def test_shard_counts_spread_like_a_multinomial(spark):
    """Each draw falls into its shard independently: the counts' chi-square is near its degrees of freedom."""
    rows = rows_of([(f"s{i % 3}", 4000) for i in range(60)])
    passes = op.epochs(op.targets(op.sizes(documents(spark, rows))), 16)
    counts = op.shard_counts(passes, 400).collect()
    draws = {r["sid"]: r["d"] for r in passes.groupBy("sid").sum("n").withColumnRenamed("sum(n)", "d").collect()}
    shards = -(-sum(draws.values()) // 400)
    n = {(r["sid"], r["shard"]): r["n"] for r in counts}
    assert all(sum(v for (s, _), v in n.items() if s == sid) == d for sid, d in draws.items())
    chi = sum((n.get((sid, t), 0) - d / shards) ** 2 / (d / shards) for sid, d in draws.items() for t in range(shards))
    free = len(draws) * (shards - 1)
    assert abs(chi - free) < 5 * (2 * free) ** 0.5
    # the ranges of a source's draws follow each other without gap or overlap
    for sid, d in draws.items():
        at = 0
        for r in sorted((r for r in counts if r["sid"] == sid), key=lambda r: r["first"]):
            assert r["first"] == at
            at += r["n"]
        assert at == d


def test_block_order_is_a_permutation_without_a_fixed_step(spark):
    passes = op.epochs(op.targets(op.sizes(documents(spark, rows_of([("a", 30_000), ("b", 20_000)])))), 16)
    order = {}
    for r in op.block_ranks(passes).collect():
        order.setdefault((r["sid"], r["epoch"]), []).append((r["rank"], r["block"]))
    assert len(order) >= 2
    for got in order.values():
        got.sort()
        assert [k for k, _ in got] == list(range(len(got))) and sorted(b for _, b in got) == list(range(len(got)))
        steps = {(b2 - b1) % len(got) for (_, b1), (_, b2) in zip(got, got[1:])}
        assert len(steps) > len(got) / 3


def test_main_path_has_no_python(spark):
    plan = op.digest(op.mix(documents(spark, CASES["many"])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Pandas" not in plan


def test_hot_null_id_is_spread(spark):
    """A third of the rows without an id still hash apart by text."""
    rows = [(None, words(5, i), "en", "a", 0) for i in range(3000)]
    h = op.sizes(documents(spark, rows)).select("h").distinct().count()
    assert h > 2900
