"""Files of equal headers in one scan; re-delivered quarters alone are rewritten."""

import os

import pytest
from pyspark.sql import functions as F

from panelkit.sources import refresh as RF
from panelkit.sources.ingest import Source

REQUIRED = ["A", "B", "C"]


def put(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.fixture()
def files(tmpdir_path):
    a = put(tmpdir_path, "q1 one.csv", "a,B ,C\n1, x ,7.0\n2,,8\n")
    b = put(tmpdir_path, "q2.csv", "a,B ,C\n3,z,abc\n")
    c = put(tmpdir_path, "q3.csv", "B,A\nw,4\n\"v,1\",5\n")
    return [Source("2025T1", 2025, 1, "develop", a), Source("2025T2", 2025, 2, "validate", b), Source("2025T3", 2025, 3, "test", c)]


def rows(spark, dest):
    return sorted(((r["period"], r["A"], r["B"], r["C"], r["source"], r["period_quarter"]) for r in RF.stored(spark, dest).collect()), key=repr)


WANT = [("2025T1", "1", "x", "7", "q1 one.csv", 1), ("2025T1", "2", None, "8", "q1 one.csv", 1), ("2025T2", "3", "z", "abc", "q2.csv", 2),
        ("2025T3", "4", "w", None, "q3.csv", 3), ("2025T3", "5", "v,1", None, "q3.csv", 3)]


def written(dest):
    return {(d, f): os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(f"{dest}/rows") for f in names if f.startswith("part-")}


def test_only_the_changed_quarter_is_rewritten(spark, files, tmpdir_path):
    dest = f"{tmpdir_path}/store"
    first = RF.refresh(spark, files, REQUIRED, dest)
    assert first == RF.Refresh(["2025T1", "2025T2", "2025T3"], [], []) and rows(spark, dest) == sorted(WANT, key=repr)
    before = written(dest)
    assert RF.refresh(spark, files, REQUIRED, dest).rewritten == [] and written(dest) == before
    put(tmpdir_path, "q2.csv", "a,B ,C\n3,z,abc\n6,n,9\n")
    again = RF.refresh(spark, files, REQUIRED, dest)
    assert again.rewritten == ["2025T2"] and again.unchanged == ["2025T1", "2025T3"]
    after = written(dest)
    assert {k: v for k, v in before.items() if "2025T2" not in k[0]} == {k: v for k, v in after.items() if "2025T2" not in k[0]}
    assert not {k for k in before if "2025T2" in k[0]} & set(after)
    assert RF.stored(spark, dest).where("period = '2025T2'").count() == 2
    gone = RF.refresh(spark, files[:2], REQUIRED, dest)
    assert gone.orphaned == ["2025T3"] and RF.stored(spark, dest).count() == 6


def test_order_of_rows_does_not_change_a_digest_but_content_does(spark, files, tmpdir_path):
    def digests():
        return {r["file"].split("/")[-1]: (r["digest"], r["rows"]) for r in RF.file_digests(spark, files).collect()}
    a = digests()
    put(tmpdir_path, "q3.csv", "B,A\n\"v,1\",5\nw,4\n")
    assert digests() == a and a["q1%20one.csv"][1] == 2
    put(tmpdir_path, "q3.csv", "B,A\n\"v,1\",4\nw,5\n")
    assert digests()["q3.csv"] != a["q3.csv"]


def test_jobs_do_not_grow_with_the_files(spark, tmpdir_path):
    def jobs(n):
        group = f"files-{n}"
        sources = [Source(f"P{i}", 2000, 1, "develop", put(tmpdir_path, f"{n}-{i}.csv", f"A,B,C\n{i},x,1\n")) for i in range(n)]
        spark.sparkContext.setJobGroup(group, group)
        RF.refresh(spark, sources, REQUIRED, f"{tmpdir_path}/store{n}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert RF.stored(spark, f"{tmpdir_path}/store{n}").count() == n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert jobs(12) == jobs(3)


def test_missing_file_empty_file_and_report(spark, files, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        RF.refresh(spark, [*files, Source("X", 2025, 4, "test", f"{tmpdir_path}/none.csv")], REQUIRED, f"{tmpdir_path}/s")
    empty = Source("2025T4", 2025, 4, "test", put(tmpdir_path, "q4.csv", "A,B\n"))
    dest = f"{tmpdir_path}/s2"
    RF.refresh(spark, [*files, empty], REQUIRED, dest)
    got = {r["period"]: (r["rows"], r["source_columns"], r["missing_required"]) for r in RF.load_report(spark, [*files, empty], REQUIRED, dest).collect()}
    assert got == {"2025T1": (2, 3, "—"), "2025T2": (1, 3, "—"), "2025T3": (2, 2, "C"), "2025T4": (0, 2, "C")}


def test_parquet_sources(spark, tmpdir_path):
    path = f"{tmpdir_path}/p.parquet"
    spark.createDataFrame([(1, 2.0), (3, None)], "a long, B double").coalesce(1).write.parquet(path)
    file = next(f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-"))
    dest = f"{tmpdir_path}/s"
    RF.refresh(spark, [Source("P", 2025, 1, "develop", file)], REQUIRED, dest, "parquet")
    assert sorted((r["A"], r["B"], r["C"]) for r in RF.stored(spark, dest).fillna("null").collect()) == [("1", "2", "null"), ("3", "null", "null")]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_bernoulli_sample_does_not_depend_on_partitions(spark, parts):
    from panelkit.operators.sampling import bernoulli_sample
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 13).alias("x"))
    want = sorted(r["id"] for r in bernoulli_sample(df.repartition(3, "x"), 500, seed=1).collect())
    got = sorted(r["id"] for r in bernoulli_sample(df.repartition(parts), 500, seed=1).collect())
    assert got == want and 400 < len(got) <= 500
    assert sorted(r["id"] for r in bernoulli_sample(df.repartition(parts), 500, seed=2).collect()) != want
    assert bernoulli_sample(df.limit(3), 10).count() == 3 and bernoulli_sample(df.limit(0), 10).count() == 0
