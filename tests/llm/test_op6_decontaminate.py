from pyspark.sql import functions as F

from panelkit.llm import op6_decontaminate as op

from ..conftest import SMALL
from .helpers import awkward, documents, same, words, written

ITEMS = [(1, words(40, 1)[:200]), (2, words(12, 2)), (3, "one"), (4, "É ç"), (5, None), (6, "..."), (2, words(12, 2)), (2, "hill river stone"),
         (None, words(15, 3)), (10, words(25, 1)), (7, "straße K")]


def bench(spark, rows=ITEMS):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "item_id long, text string")
    return df.withColumns({c: F.lit("x") for c in ("win", "m", "rid", "item", "sh", "off")})


def more():
    inside = f"{words(30, 50)} {words(12, 2).upper()}, {words(9, 51)} ONE"
    twice = f"{words(25, 1)}\n{words(25, 1)} hill River; stone É ç K straße"
    return awkward() + [(20, inside, "en", "a", 1), (21, twice, "en", "a", 1), (22, "é Ç", "fr", "a", 1), (23, "É Ç", "fr", "a", 1)]


def test_awkward_rows_against_sql(spark, tmpdir_path):
    docs, items = documents(spark, more()), bench(spark)
    d = written(docs.select("doc_id", "text"), tmpdir_path, "d")
    b = written(items.select("item_id", "text"), tmpdir_path, "b")
    same(op.digest(op.decontaminate(docs, items)), op.ORACLE, documents=d, benchmark=b)


def test_small_table_against_sql(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    same(op.digest(op.decontaminate(docs, items)), op.ORACLE, documents=f"{SMALL}/documents.parquet", benchmark=f"{SMALL}/benchmark.parquet")


def test_frequent_windows(spark, tmpdir_path):
    """A passage that every document holds, and one word repeated."""
    rows = [(i, f"{words(8, i)} {words(14, 77)} {'the ' * (i % 30)}", "en", "a", 1) for i in range(60)]
    items = [(1, words(14, 77)), (2, "the " * 12), (3, "the the")]
    d = written(documents(spark, rows).select("doc_id", "text"), tmpdir_path, "d")
    b = written(bench(spark, items).select("item_id", "text"), tmpdir_path, "b")
    same(op.digest(op.decontaminate(documents(spark, rows), bench(spark, items))), op.ORACLE, documents=d, benchmark=b)


def test_full_bitmap_changes_nothing(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(op, "LEAST_LONGS", 1)
    monkeypatch.setattr(op, "MOST_LONGS", 1)
    d = written(documents(spark, more()).select("doc_id", "text"), tmpdir_path, "d")
    b = written(bench(spark).select("item_id", "text"), tmpdir_path, "b")
    same(op.digest(op.decontaminate(documents(spark, more()), bench(spark))), op.ORACLE, documents=d, benchmark=b)


def test_empty_tables(spark):
    assert op.decontaminate(documents(spark, []), bench(spark)).count() == 0
    got = op.decontaminate(documents(spark), bench(spark, [])).collect()
    assert len(got) == len(awkward()) and not any(r["contaminated"] or r["n_hit"] for r in got)


def test_clean_documents_stay(spark, tmpdir_path):
    docs = spark.read.parquet(written(documents(spark, more()), tmpdir_path, "d"))
    keep = [r["doc_id"] for r in op.decontaminate(docs, bench(spark)).collect() if not r["contaminated"]]
    left = op.clean_documents(docs, bench(spark))
    assert left.columns == docs.columns
    assert sorted([r["doc_id"] for r in left.collect()], key=repr) == sorted(keep, key=repr)


def test_rows_are_known_however_scans_pack_files(spark, tmpdir_path):
    """The split size follows the session's cores, which may change between two scans."""
    path = f"{tmpdir_path}/d.parquet"
    rows = [(i, f"{words(30, 100 + i)} {words(14, 77) if i % 2 else ''}", "en", "a", 1) for i in range(40)]
    documents(spark, rows, clashing=False).repartition(8).write.parquet(path)
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(names[0], "1")
        left = op.clean_documents(spark.read.parquet(path), bench(spark, [(1, words(14, 77))]))
        spark.conf.set(names[0], "64")
        spark.conf.set(names[1], "1")
        assert sorted(r["doc_id"] for r in left.collect()) == list(range(0, 40, 2))
    finally:
        for name in names:
            spark.conf.unset(name)


def test_main_path_has_no_python(spark):
    plan = op.decontaminate(documents(spark), bench(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_long_copy_moves_in_proportion(spark):
    """A document equal to one long item: what the join moves grows with its words, not with their square."""
    def moved(n):
        text = " ".join(f"w{i}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        bench = spark.createDataFrame([(1, text)], "item_id long, text string")
        _, found, _ = op.occurrences(docs, bench)
        assert found.count() == n - 9
        runs = spark.createDataFrame([(1, n, 5, 0, text.split())], "rid long, n_words int, k int, a int, w array<string>")
        placed = op._placed(runs)
        return placed.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    few, many = moved(2000), moved(4000)
    assert many < 2.2 * few and many < 4000 * 2000
