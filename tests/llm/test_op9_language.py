import numpy as np

from panelkit.llm import op9_language as op

from ..conftest import SMALL
from .helpers import awkward, documents, words


def brute_phrases(text, trained):
    """Longest phrases of a symbol string that occur in the trained one."""
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i:i + k] in trained:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_phrases_are_the_longest_matches():
    rng = np.random.default_rng(0)
    for _ in range(30):
        trained = [bytes(rng.integers(2, 6, 200, dtype=np.uint8)) for _ in range(3)]
        docs = [rng.integers(0, 7, int(rng.integers(0, 300)), dtype=np.uint8) for _ in range(9)]
        table, roots = op.transitions(tuple(trained), 8)
        got = op.count_phrases(docs, table, roots, 8)
        for d, row in zip(docs, got):
            # 0, 1 and 6 occur in no training text: each is a phrase
            assert row.tolist() == [brute_phrases(bytes(d), t) for t in trained]


def test_rare_symbols_give_the_longest_matches_too(monkeypatch):
    rng = np.random.default_rng(2)
    for width in (1, 3, 5):
        monkeypatch.setattr(op, "DENSE_SYMBOLS", width)
        trained = [bytes(rng.integers(2, 6 + k, 200, dtype=np.uint8)) for k in range(3)]
        docs = [rng.integers(0, 10, int(rng.integers(0, 300)), dtype=np.uint8) for _ in range(20)]
        automata = op.Automata(tuple(trained), 10)
        got = op.count_phrases(docs, automata, automata.starts, 10)
        for d, row in zip(docs, got):
            assert row.tolist() == [brute_phrases(bytes(d), t) for t in trained]


def test_each_letter_of_a_large_alphabet_is_told_apart(spark):
    """Two languages of common letters, two that share a script of 2,000 letters in other words."""
    rng = np.random.default_rng(3)
    han = [chr(0x4E00 + i) for i in range(2000)]
    lexicon = {n: ["".join(rng.choice(han, 3)) for _ in range(700)] for n in ("x", "y")}
    latin = {"a": "the of hill river stone".split(), "b": "le mot avec papier vert".split()}
    rows, n = [], 0
    for _ in range(40):
        for name, ws in {**latin, **lexicon}.items():
            n += 1
            rows.append((n, " ".join(rng.choice(ws, 150 if name in latin else 60)), name, "s", 1))
    languages = op.train(documents(spark, rows))
    assert len(languages.alphabet) > 1500
    table = op.symbol_table(languages.alphabet)
    assert all(op.OTHER not in map(ord, t) for t in languages.texts)
    assert op.symbols("".join(han[:5]) + "ж", table)[-1] == op.OTHER
    held = [r for r in op.digest(documents(spark, rows)).collect() if r["held_out"]]
    lang = {r[0]: r[2] for r in rows}
    assert held and all(r["lang_pred"] == lang[r["doc_id"]] for r in held)


def test_segments_add_at_most_one_phrase_each(monkeypatch):
    rng = np.random.default_rng(1)
    trained = bytes(rng.integers(2, 5, 400, dtype=np.uint8))
    doc = rng.integers(2, 5, 1000, dtype=np.uint8)
    table, roots = op.transitions((trained,), 8)
    whole = brute_phrases(bytes(doc), trained)
    monkeypatch.setattr(op, "SEGMENT", 100)
    monkeypatch.setattr(op, "SIDE_BY_SIDE", 3)
    assert whole <= op.count_phrases([doc], table, roots, 8)[0, 0] <= whole + 10


def test_symbols():
    table = op.symbol_table((ord("a"), ord("b"), ord("é")))
    assert op.symbols(" A,b--É9漢 ", table).tolist() == [2, 0, 3, 0, 4, 0, 1]
    assert op.symbols("", table).tolist() == [] and op.symbols("12 !", table).tolist() == []


def test_small_table_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in op.digest(docs).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_awkward_rows(spark):
    got = op.digest(documents(spark)).collect()
    assert len(got) == len(awkward())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["lang_pred"])
        assert 0 <= r["score"] <= 1
    assert by[3] == by[4] == by[5] == by[7] == {"und"} and "und" not in by[9] | by[6]


def test_language_of_long_texts_alone_is_learned(spark):
    rows = [(i, words(5000, i) if i % 2 else "le mot avec papier vert " * 30, "en" if i % 2 else "fr", "a", 1) for i in range(30)]
    assert all(len(r[1]) > 20_000 for r in rows if r[2] == "en")
    got = op.digest(documents(spark, rows)).collect()
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "fr") for r in got)


def test_stage_keeps_lettered_texts_if_nothing_was_learned(spark):
    import corpus_pipeline
    none = [(i, t, None, s, n) for i, t, _, s, n in awkward()]
    left = corpus_pipeline.language_id(spark, documents(spark, none, clashing=False), "")
    want = [r[0] for r in none if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted([r["doc_id"] for r in left.collect()], key=repr) == sorted(want, key=repr)


def test_nothing_learned_and_empty(spark):
    none = [(i, t, None, s, n) for i, t, _, s, n in awkward()]
    got = op.digest(documents(spark, none)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert op.digest(documents(spark, [])).count() == 0
