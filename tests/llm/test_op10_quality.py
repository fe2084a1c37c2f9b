import zlib

import numpy as np
import zstandard

from panelkit.llm import op10_quality as op

from .helpers import awkward, documents, words


def corpus(n=600):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        t = words(70, i) if good else (" | ".join(words(70, i).split()) if i % 8 else f"{words(1, i)} " * 60)
        rows.append((i, t, "en", "a", len(t)))
        if i % 9:
            labels.append((i, int(good), 0))
    return rows, labels


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out(spark):
    rows, labels = corpus()
    got = op.digest(documents(spark, rows), frame(spark, labels)).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(rows) and sum(r["predicted"] == (r["doc_id"] % 4 > 0) for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_awkward_rows(spark):
    rows, labels = corpus(200)
    labels += [(None, 1, 1), (1, None, None), (1, 0, 0), (9999, 1, 1)]
    got = op.digest(documents(spark, rows + awkward()), frame(spark, labels)).collect()
    assert len(got) == len(rows) + len(awkward()) and all(r["score"] is not None for r in got)


def test_no_labels_one_class_and_empty(spark):
    got = op.digest(documents(spark), frame(spark, [])).collect()
    assert len(got) == len(awkward()) and {r["score"] for r in got} == {0.5}
    one = op.digest(documents(spark), frame(spark, [(6, 1, 0), (8, 1, 0), (9, 1, 0)])).collect()
    assert all(r["score"] > 0.5 for r in one)
    assert op.digest(documents(spark, []), frame(spark, [])).count() == 0


def test_whole_texts_are_compressed():
    size = op.compressor(b"")
    text = words(20_000, 1).encode()
    params = zstandard.ZstdCompressionParameters.from_level(op.LEVEL, write_content_size=False, write_dict_id=False)
    pieces = [text[i:i + op.PIECE] for i in range(0, len(text), op.PIECE)]
    assert size(text) == sum(len(zstandard.ZstdCompressor(compression_params=params).compress(p)) for p in pieces)


def brute_scores(rows, labels):
    """Scores with own compressor calls and an own logistic regression (plain Newton steps)."""
    known = {i: q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    sample = sorted((i, t.encode()) for i, t, *_ in rows if i in known and t)
    build, rest, seen = {0: [], 1: []}, [], {0: 0, 1: 0}
    for i, t in sample:
        k = known[i]
        seen[k] += 1
        (build[k] if seen[k] % 2 else rest).append(t if seen[k] % 2 else (t, k))

    def cut(t):
        return [t[a:a + 4096] for a in range(0, len(t), 4096)]
    sizes = {}
    for k in (0, 1):
        d = zstandard.ZstdCompressionDict(zstandard.train_dictionary(65_536, [p for t in build[k] for p in cut(t)]).as_bytes())
        d.precompute_compress(level=3)
        params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_dict_id=False)
        sizes[k] = lambda t, d=d, params=params: sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(p)) for p in cut(t))

    def feature(t):
        return [(sizes[0](t) - sizes[1](t)) / len(t), sizes[1](t) / len(t), 1 / len(t)] if t else [0.0, 0.0, 0.0]
    x = np.array([feature(t) for t, _ in rest])
    y = np.array([k for _, k in rest], float)
    mean, sd = x.mean(0), x.std(0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    w, pull = np.zeros(4), np.diag([1e-6, 1, 1, 1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, z.T @ (p - y) + pull @ w)
        w -= np.clip(step, -2, 2)
    return {i: 1 / (1 + np.exp(-np.clip(w[0] + (np.array(feature((t or "").encode())) - mean) / sd @ w[1:], -30, 30))) for i, t, *_ in rows}


def test_scores_by_brute_force(spark):
    rows, labels = corpus(400)
    rows += [(9001, "", "en", "a", 0), (9002, words(9000, 5), "en", "a", 0)]
    want = brute_scores(rows, labels)
    got = op.digest(documents(spark, rows), frame(spark, labels)).collect()
    assert len(got) == len(rows) and all(abs(r["score"] - want[r["doc_id"]]) < 1e-6 for r in got)


def test_scores_are_calibrated_by_band(spark):
    """Held-out documents of a noisy corpus: the share of good ones in a band of scores is near the band's mean score."""
    rows, _ = corpus(1500)
    labels = [(i, int((i % 4 > 0) != (i * 7919 % 10 == 0)), 0) for i, *_ in rows]     # one label in ten is wrong
    truth = {i: y for i, y, _ in labels}
    held = [(r["score"], truth[r["doc_id"]]) for r in op.digest(documents(spark, rows), frame(spark, labels)).collect() if r["held_out"]]
    for lo, hi in ((0, 0.5), (0.5, 1.01)):
        band = [(s, y) for s, y in held if lo <= s < hi]
        assert len(band) > 50 and abs(sum(s for s, _ in band) / len(band) - sum(y for _, y in band) / len(band)) < 0.08
