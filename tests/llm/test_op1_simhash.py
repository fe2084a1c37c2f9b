import numpy as np
import pytest
import xxhash

from panelkit.llm import op1_simhash as op

from ..conftest import SMALL
from .helpers import awkward, documents, words


def brute_fp(text, words=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    h = [xxhash.xxh64_intdigest(b" ".join(parts[i:i + words]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def brute_components(rows, bits):
    """(id, fingerprint, component_id, root) for each of the (id, fp) rows."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f)), find(f)) for d, f in rows]


def expected(rows):
    return sorted([r[:3] for r in brute_components(rows, 4)], key=key)


def key(r):
    return tuple(repr(x) for x in r)


def test_awkward_rows(spark):
    rows = [(r[0], brute_fp(r[1])) for r in awkward()]
    got = [tuple(r) for r in op.digest(op.near_duplicates(documents(spark))).collect()]
    assert sorted(got, key=key) == expected(rows)


def test_empty(spark):
    assert op.digest(op.near_duplicates(documents(spark, []))).count() == 0


def test_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], brute_fp(r["text"])) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in op.digest(op.near_duplicates(docs)).collect()]
    assert sorted(got, key=key) == expected(rows)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_links_are_all_pairs_within_the_distance(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 30, dtype=np.int64).astype(np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():  # neighbours at every distance, and a dense ball
        for _ in range(12):
            for i in rng.choice(64, int(rng.integers(1, 8)), replace=False):
                b ^= 1 << int(i)
            fps.add(b)
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed
            if a != b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= bits}
    got = {tuple(r) for r in op.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits).collect()}
    assert got == want


def test_thresholds_sum_and_differ():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.int64).view(np.uint64)
    fps[:250] &= np.uint64(~0x1F & (2 ** 64 - 1))  # a skewed part
    groups = [list(range(0, 22)), list(range(22, 43)), list(range(43, 64))]
    bits = op._bits(fps)
    hists = {(3, g, k): np.bincount(op._value(bits, b), minlength=1 << len(b)).astype(float)
             for g, group in enumerate(groups) for k, b in enumerate(op._blocks(group))}
    t, cost = op.Allocation(3, groups, hists, 500, 4).thresholds(bits)
    assert (t.sum(1) == 2).all() and t.min() >= -1 and np.isfinite(cost).all()


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = op.simhash([text.encode()])[0]
    monkeypatch.setattr(op, "HASHES", 64)
    assert op.simhash([b"a b", text.encode(), None])[1] == whole == brute_fp(text)


def test_one_row_of_each_group_stays(spark, tmpdir_path):
    path = f"{tmpdir_path}/d.parquet"
    documents(spark, clashing=False).write.parquet(path)
    docs = spark.read.parquet(path)
    left = op.deduplicated(docs).collect()
    comps = brute_components([(r[0], brute_fp(r[1])) for r in awkward()], 4)
    best = {}
    for d, _, _, root in comps:
        best[root] = min(best.get(root, (True, 0)), (d is None, d or 0))
    assert sorted((r["doc_id"] for r in left), key=repr) == sorted((None if n else d for n, d in best.values()), key=repr)


def test_rows_are_known_however_scans_pack_files(spark, tmpdir_path):
    """The split size follows the session's cores, which may change between two scans."""
    path = f"{tmpdir_path}/d.parquet"
    documents(spark, [(i, f"{words(40, i % 20)}", "en", "a", 1) for i in range(40)], clashing=False).repartition(8).write.parquet(path)
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(names[0], "1")
        left = op.deduplicated(spark.read.parquet(path))
        spark.conf.set(names[0], "64")
        spark.conf.set(names[1], "1")
        assert sorted(r["doc_id"] for r in left.collect()) == list(range(20))
    finally:
        for name in names:
            spark.conf.unset(name)
