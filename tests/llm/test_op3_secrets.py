import hashlib
import re

import numpy as np

from panelkit.llm import op3_secrets as op

from ..conftest import SMALL
from .helpers import awkward, documents, words

PATTERNS = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 12),
            ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
SECRETS = ['x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y', "API_KEY:abcdefghijklmnop and AKIA12345678901234 end",
           "token = token = abcdefghijklmnop", "password='short' secret:AAAAAAAAAAAA", "deadbeefdeadbeefdeadbeef", "é ü TOKEN=0123456789abcdef0", "ſecret=abcdefghijklmn"]


def naive(text):
    out = []
    for k, (kind, p, group, least) in enumerate(PATTERNS):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in p.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(x for _, _, x in sorted(out))


def text_rows():
    return awkward() + [(100 + i, s, "en", "a", len(s)) for i, s in enumerate(SECRETS)]


def test_base_spans(spark):
    docs = documents(spark, text_rows())
    got = {}
    for r in op.digest(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text, *_ in text_rows():
        want = naive(text)
        rows = [r for r in got[i] if r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()]
        assert rows
        assert rows[0]["n_assign"] == want.count("assign") and rows[0]["n_access"] == want.count("access") and rows[0]["n_hex"] == want.count("hex")
        assert set(want.split(",")) - {""} <= set(rows[0]["spans"].split(","))


def test_empty(spark):
    assert op.digest(documents(spark, [])).count() == 0


def corpus(n):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(n)]
    return [f'{words(30, i)} token = "{h}" {words(20, i + 7)}' if i % 3 else words(60, i) for i, h in enumerate(hexes)]


def whole_viterbi(field, e):
    score, back = e[0].copy(), []
    for x in e[1:]:
        step = score[:, None] + field.moves
        back.append(step.argmax(0))
        score = step.max(0) + x
    s, path = int(score.argmax()), []
    for b in reversed(back):
        path.append(s)
        s = int(b[s])
    return [s, *path[::-1]]


def test_field_finds_what_the_rules_miss_and_nothing_in_plain_text():
    tagger = op.Tagger(op.fit(corpus(200)))
    missed = 'the hill and credential = "9F8E7D6C5B4A00FF11223344" of the field'
    found = tagger.spans([missed, words(300, 1234), ""])
    assert [missed[s.start:s.end] for s in found[0]] == ["9F8E7D6C5B4A00FF11223344"] and found[1] == [] and found[2] == []


def test_runs_between_sure_tokens_give_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(300):
        field = op.Field.zero()
        field.moves[:] = rng.normal(0, 1, (3, 3))
        n = int(rng.integers(1, 40))
        e = rng.normal(0, 1, (n, 3))
        e[:, 0] += rng.choice([0, 9], n)
        path = [0] * n
        open_ = np.flatnonzero(e[:, 0] - np.maximum(e[:, 1], e[:, 2]) <= field.margin())
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            if len(run):
                path[run[0]:run[-1] + 1] = field.best_path(e[run[0]:run[-1] + 1], run[0] == 0, run[-1] == len(e) - 1)
        assert path == whole_viterbi(field, e)


def test_redaction():
    text = 'a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" b AKIA12345678901234.'
    assert op.redacted(text, op.base_spans(text)) == 'a token = "[SECRET]" b [SECRET].'


def test_a_secret_beyond_the_base_pattern_goes_whole():
    text = "a password=hunter2hunter2!Pa$$w0rd b ABCXYZ0123456789abcdefQRS c token = abcdefghijklmnop"
    base = op.base_spans(text)
    tokens = [text.index(t) for t in ("hunter2", "ABCXYZ", "abcdefghijklmnop")]
    added = [op.Span(i, i + len(text[i:].split()[0]), "crf", i) for i in tokens]
    spans = op.all_spans(base, added)
    assert set(base) <= set(spans) and [s for s in spans if s.kind == "crf"] == added[:2]
    assert op.redacted(text, spans) == "a password=[SECRET] b [SECRET] c token = [SECRET]"


def test_windows_are_picked_from_the_whole_sample(monkeypatch):
    monkeypatch.setattr(op, "SPAN_WINDOWS", 8)
    monkeypatch.setattr(op, "STEPS", 1)
    shown = []
    variant = op._variant
    monkeypatch.setattr(op, "_variant", lambda row, *rest: shown.append(" ".join(row)) or variant(row, *rest))
    texts = [f'{words(30, i)} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" d{i}d' for i in range(200)]
    op.fit(texts)
    seen = {int(re.search(r"d(\d+)d$", s)[1]) for s in shown}
    assert len(seen) == 8 and max(seen) > 60


def test_shape_counts_all_of_a_long_token():
    plain = "ab" * 300
    assert op.token_features(plain) != op.token_features(plain + "9F8E7D6C5B4A00FF")


def test_tokens_keep_their_places():
    for t in [r[1] for r in text_rows() if r[1]]:
        toks = op.tokens_of(t)
        at = op.offsets(t, toks)
        assert all(t[a:a + len(x)] == x for a, x in zip(at, toks)) and at == sorted(at)


def test_small_table_base_spans(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in op.digest(docs).collect():
        assert r["base_sha256"] == hashlib.sha256(naive(texts[r["doc_id"]]).encode()).hexdigest()
