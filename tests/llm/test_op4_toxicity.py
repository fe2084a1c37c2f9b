import numpy as np

from panelkit.llm import op4_toxicity as op

from .helpers import awkward, documents, words

TERMS = ["moron", "worthless", "trash", "clown", "oaf", "patheticly"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_is_edit_distance():
    rng = np.random.default_rng(0)
    a = op.Automaton(TERMS)
    for _ in range(3000):
        w = list(TERMS[rng.integers(len(TERMS))])
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(w) + 1))
            kind = rng.integers(3)
            c = "abcdefghilmnoprstw"[rng.integers(18)]
            w[at:at + (kind > 0)] = [] if kind == 1 else [c]
        w = "".join(w)
        want = sorted([(t, d) for t in TERMS if (d := distance(w, t)) <= op.edits_allowed(t)], key=lambda x: (x[1], x[0]))
        assert a.match(w) == want


def test_context_and_misspellings():
    m = op.Matches(op.Lexicon(["moron", "worthless"], ordinary={"oron"}))
    assert [w for _, w in op.hits("You worthless m0ron!", m)[0]] == [1.0, op.MISSPELT]
    assert op.hits("the oron of", m)[0] == []
    assert [w for _, w in op.hits('he said "you moron" to me', m)[0]] == [op.QUOTED]
    assert [w for _, w in op.hits('he said "yes" moron and left', m)[0]] == [1.0]
    assert op.hits(None, m) == ([], 0)


def corpus(spark, n=600):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        t = words(80, i)
        if toxic:
            parts = t.split()
            for k in range(3):
                parts.insert(7 * k + i % 11, TERMS[(i // 5 + k) % 4])
            t = " ".join(parts)
        rows.append((i, t, "en", "a", len(t)))
        if i % 7:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out(spark):
    rows, labels = corpus(spark)
    got = op.digest(documents(spark, rows), labels_frame(spark, labels)).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(rows) and len(held) > 100
    assert all(r["predicted"] == (r["doc_id"] % 5 == 0) and 0 <= r["score"] <= 1 for r in held)


def test_awkward_rows(spark):
    rows, labels = corpus(spark, 200)
    labels += [(None, 1, 1), (1, None, None), (1, 1, 0), (1, 1, 0), (9999, 1, 1)]
    got = op.digest(documents(spark, rows + awkward()), labels_frame(spark, labels)).collect()
    assert len(got) == len(rows) + len(awkward()) and all(r["score"] is not None for r in got)
    none = {r["score"] for r in got if r["doc_id"] in (-3,)}
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] is None) and len(none) == 1


def test_no_labels_and_empty(spark):
    got = op.digest(documents(spark), labels_frame(spark, [])).collect()
    assert len(got) == len(awkward()) and {r["score"] for r in got} == {0.5}
    assert op.digest(documents(spark, []), labels_frame(spark, [])).count() == 0
    one = op.digest(documents(spark), labels_frame(spark, [(6, 1, 0), (8, 1, 0), (9, 1, 0)])).collect()
    assert all(r["score"] < 0.5 for r in one)
