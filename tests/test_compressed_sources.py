"""Sources as compressed text, rewritten without a shuffle."""

import gzip
import os

from panelkit.sources import refresh as RF
from panelkit.sources.ingest import Source


def _sources(folder):
    out = []
    for i, text in enumerate(["a,B\n1, x \n2,\n", "a,B\n3,y\n", "B,A\nz,4.0\n"]):
        path = f"{folder}/f{i}.csv" + ".gz" * (i != 1)
        with (open if i == 1 else gzip.open)(path, "wt") as f:
            f.write(text)
        out.append(Source(f"2025T{min(i + 1, 2)}", 2025, min(i + 1, 2), "develop", path))
    return out


def test_compressed_sources_are_read_and_rewritten_without_a_shuffle(spark, tmpdir_path, monkeypatch):
    files = _sources(tmpdir_path)
    assert [RF.header(spark, f.path, "csv") for f in files] == [("a", "B"), ("a", "B"), ("B", "A")]

    def hint(self, name, *args):
        raise AssertionError(f"a {name} hint")
    monkeypatch.setattr(type(spark.range(1)), "hint", hint)
    RF.refresh(spark, files, ["A", "B"], f"{tmpdir_path}/s")
    got = sorted((r["period"], r["A"], r["B"], r["source"]) for r in RF.stored(spark, f"{tmpdir_path}/s").fillna("-").collect())
    assert got == [("2025T1", "1", "x", "f0.csv.gz"), ("2025T1", "2", "-", "f0.csv.gz"), ("2025T2", "3", "y", "f1.csv"), ("2025T2", "4", "z", "f2.csv.gz")]
    parts = [f for _, _, names in os.walk(f"{tmpdir_path}/s/rows") for f in names if f.endswith(".parquet")]
    assert len(parts) <= len(files)
