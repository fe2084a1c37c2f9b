"""Secret scan: rule-based spans, and a linear-chain conditional random field.

Base spans come from three patterns (kinds assign, access, hex). The field
tags tokens as O, B or I (outside, begin and inside of a secret). Tokens are
runs of characters between white space, with the signs of SIGNS as tokens of
their own. A token's score has its own shape (character classes, length, hex
or digit runs, changes of class, digit share, distinct characters, word, first
letters), the shapes and words of the three tokens before and two after, and
features of the file (length, share of signs, share of tokens with digits).
Spans that the field finds are added as kind crf, if their text has at least
LEAST_ADDED characters and no base span holds all of it; they may meet base spans.

Decoding is Viterbi's, exact, over whole texts. A token at which O beats B
and I by more than any transitions can make good is O in the best path, so
the path is computed run by run between such tokens.

Training: no table marks secrets, so the base spans of about TRAIN_DOCS
documents (picked by a hash of the id; of a text longer than MAX_TRAIN_CHARS
characters so many from a hashed place) are the labels. Windows of WINDOW tokens around at most SPAN_WINDOWS
spans, picked by a hash of text and place from all of the sample, and one of
each of at most PLAIN_WINDOWS documents without spans, by a hash of the text,
are fitted by gradient
ascent of the penalised likelihood (forward-backward). So that the field
learns shapes and neighbours, not the corpus's favourite length, each window
around a span is also shown VARIANTS times with another secret in its place
(random hex, capitals and digits, or mixed characters of 12 to 48), and once
without its key words. Only the weights are broadcast.

Defined cases: a null text is an empty one and has no spans (base_sha256 of
the empty string); repeated rows give a row each; spans of one start are
ordered by kind; an empty table gives no rows; columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import SLICE_BYTES, carried, release, sliced, text_first
from panelkit.llm.fitting import _picked, excerpt

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ADDED = 8

SIGNS = "\"'=:,;()[]{}<>|"
BEFORE, AFTER = 3, 2
TRAIN_DOCS, MAX_TRAIN_CHARS, WINDOW = 6000, 20_000, 48
STEPS, RATE, PENALTY = 40, 0.2, 0.3
PLAIN_WINDOWS, SPAN_WINDOWS, VARIANTS = 1500, 600, 3
CACHE = 150_000
MARK = "[SECRET]"

#: Feature slots of a token and their sizes; words and first letters are hashed.
SLOTS = (32, 14, 28, 7, 6, 6, 1024, 256)
STARTS = np.cumsum((0,) + SLOTS[:-1])
N_OWN = sum(SLOTS)
#: What neighbours contribute: their classes (slot 0), lengths (1) and words (6).
SEEN = (0, 1, 6)
N_FILE = (8, 6, 6)
LENGTHS = (1, 2, 3, 4, 6, 8, 11, 15, 19, 27, 39, 63, 127)


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    value: int  # where the secret itself begins


def base_spans(text: str) -> list[Span]:
    """The base spans by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYS) or not low.isascii():
        out += [Span(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [Span(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text)]
    out += [Span(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def tokens_of(text: str) -> list[str]:
    for sign in SIGNS:
        if sign in text:
            text = text.replace(sign, f" {sign} ")
    return text.split()


def offsets(text: str, tokens: list[str]) -> list[int]:
    """Where each token starts: tokens follow each other with white space between."""
    out, at = [], 0
    for t in tokens:
        at = text.index(t, at)
        out.append(at)
        at += len(t)
    return out


_CLASS = [0] * 128
for _c in range(128):
    _s = chr(_c)
    _CLASS[_c] = 1 if _s.islower() else 2 if _s.isupper() else 4 if _s.isdigit() else 8
_HEX_CHARS = frozenset("0123456789abcdef")


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    for i, e in enumerate(edges):
        if n <= e:
            return i
    return len(edges)


def token_features(t: str) -> tuple[int, ...]:
    """A token's feature in each slot."""
    mask, last, changes, digits = 0, 0, 0, 0
    for ch in t:
        o = ord(ch)
        c = _CLASS[o] if o < 128 else 16
        mask |= c
        changes += c != last
        last = c
        digits += c == 4
    n = len(t)
    size = _bucket(n, LENGTHS)
    chars = set(t)
    run = 1 + min(size, 12) if mask == 4 else 14 + min(size, 13) if chars <= _HEX_CHARS else 0
    share = 0 if not digits else 5 if digits == n else 1 + min(3, 4 * digits // n)
    # of so many characters as a token of 256 would have: a long one repeats its letters
    distinct = min(5, 6 * len(chars) // min(n, 256)) if n > 4 else 0
    word = zlib.crc32(t.lower().encode("utf-8", "replace")) % 1023 + 1 if n <= 10 and not digits else 0
    first = zlib.crc32(t[:3].encode("utf-8", "replace")) % 255 + 1 if n >= 8 and (digits or mask & 10) else 0
    slots = (mask, size, run, min(6, _bucket(changes, (1, 2, 3, 5, 9, 16))), share, distinct, word, first)
    return tuple(int(s + f) for s, f in zip(STARTS, slots))


class Tokens(dict):
    """Ids of distinct tokens, with their features by id."""

    def __init__(self):
        super().__init__()
        self.features: list[tuple[int, ...]] = []

    def __missing__(self, t: str) -> int:
        self[t] = i = len(self.features)
        self.features.append(token_features(t))
        return i


def file_features(n: int, n_signs: int, n_digits: int) -> tuple[int, int, int]:
    """Buckets of a text's number of tokens, share of signs and of tokens with digits."""
    part = lambda k: 0 if not k else 1 + _bucket(int(1000 * k / n), (4, 15, 50, 200))
    return _bucket(n, (0, 10, 50, 200, 800, 3000, 20000)), part(n_signs), part(n_digits)


@dataclass
class Field:
    own: np.ndarray  # (features, 3)
    near: np.ndarray  # (offset, features, 3)
    file: np.ndarray  # (features, 3)
    moves: np.ndarray  # (3, 3)

    @staticmethod
    def zero() -> Field:
        return Field(np.zeros((N_OWN, 3)), np.zeros((BEFORE + AFTER, N_OWN, 3)), np.zeros((sum(N_FILE), 3)), np.zeros((3, 3)))

    def parts(self):
        return self.own, self.near, self.file, self.moves

    def margin(self) -> float:
        """What a token can gain from its transitions by not being O."""
        m, best = self.moves, 0.0
        for s in (1, 2):
            into = max(0.0, (m[:, s] - m[:, 0]).max())
            out = max(0.0, (m[s, :] - m[0, :]).max())
            best = max(best, into + out)
        return best

    def best_path(self, e: np.ndarray, first: bool = False, last: bool = False) -> list[int]:
        """Viterbi over a run of emissions that stands between tokens that are
        O; first, last: where the text begins or ends with the run, so that no
        transition leads into or out of it."""
        score = e[0] + (0.0 if first else self.moves[0])
        back = []
        for x in e[1:]:
            step = score[:, None] + self.moves
            back.append(step.argmax(0))
            score = step.max(0) + x
        s = int((score + (0.0 if last else self.moves[:, 0])).argmax())
        path = [s]
        for b in reversed(back):
            s = int(b[s])
            path.append(s)
        return path[::-1]


OFFSETS = tuple(range(-BEFORE, 0)) + tuple(range(1, AFTER + 1))


def _file_ids(buckets: tuple[int, int, int]) -> list[int]:
    return [buckets[0], N_FILE[0] + buckets[1], N_FILE[0] + N_FILE[1] + buckets[2]]


ALPHABETS = ("0123456789abcdef", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-")


def _variant(tokens: list[str], tags: list[int], variant: int, seed: int) -> tuple[list[str], list[int]]:
    """A window with other secrets (variants 1 to VARIANTS), or its key words
    replaced by the first plain word of the window (the last variant)."""
    rng = np.random.default_rng([seed & 0xFFFFFFFF, variant])
    if variant > VARIANTS:
        plain = next((t for t, g in zip(tokens, tags) if not g and t.isalpha() and t.lower() not in KEYS), "x")
        return [plain if t.lower() in KEYS else t for t in tokens], tags
    chars = ALPHABETS[(seed + variant) % len(ALPHABETS)]

    def other(t: str) -> str:
        new = "".join(chars[i] for i in rng.integers(0, len(chars), rng.integers(12, 49)))
        end = t[len(t.rstrip(".,!?*%#&$")):]
        return ("AKIA" + new if chars is ALPHABETS[1] and variant == 1 else new) + end
    return [other(t) if g == 1 else t for t, g in zip(tokens, tags)], tags


def _seed(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def fit(texts: list[str]) -> Field:
    """The field of the texts' base spans."""
    vocabulary = Tokens()
    ids, tags, docs = [], [], []
    texts = sorted(texts, key=_seed)
    found = [base_spans(text) for text in texts]
    places = [(zlib.crc32(b"%d" % s.start, _seed(text)), k, i) for k, text in enumerate(texts) for i, s in enumerate(found[k])]
    picked = {(k, i) for _, k, i in sorted(places)[:SPAN_WINDOWS]}
    n_plain = 0
    for k, (text, spans) in enumerate(zip(texts, found)):
        shown_spans = {i for i in range(len(spans)) if (k, i) in picked}
        if spans and not shown_spans or not spans and n_plain >= PLAIN_WINDOWS:
            continue
        toks = tokens_of(text)
        if not toks:
            continue
        tag = [0] * len(toks)
        marks = []
        at = offsets(text, toks) if spans else []
        for j, s in enumerate(spans):
            inside = [i for i, (a, t) in enumerate(zip(at, toks)) if a < s.end and a + len(t) > s.value]
            for place, i in enumerate(inside):
                tag[i] = tag[i] or (1 if place == 0 else 2)
            if j in shown_spans:
                marks += inside[:1]
        signs = sum(len(t) == 1 and t in SIGNS for t in toks)
        digits = sum(vocabulary.features[vocabulary[t]][0] & 4 > 0 for t in toks)
        f = _file_ids(file_features(len(toks), signs, digits))
        seed = _seed(text)
        n_plain += not marks
        for w in [max(0, m - WINDOW // 2) for m in marks] or [seed % max(1, len(toks) - WINDOW)]:
            begin = max(0, w - BEFORE)
            shown, label = toks[begin:w + WINDOW + AFTER], tag[begin:w + WINDOW + AFTER]
            for variant in range(1 + (VARIANTS + 1 if marks else 0)):
                row, lab = _variant(shown, label, variant, seed + w) if variant else (shown, label)
                ids.append([vocabulary[t] for t in row])
                tags.append((lab[w - begin:w - begin + WINDOW], w - begin))
                docs.append(f)
    field = Field.zero()
    if not any(any(t) for t, _ in tags):
        field.moves[:, 1:] = -10.0  # nothing to learn from: nothing is added
        field.own[:, 1:] = -1.0
        return field
    feats = np.array(vocabulary.features + [(-1,) * len(SLOTS)], np.int64)
    n, width = len(ids), WINDOW
    none = len(feats) - 1
    x = np.full((n, BEFORE + width + AFTER), none)
    y = np.zeros((n, width), int)
    mask = np.zeros((n, width), bool)
    for k, (row, (tag, skip)) in enumerate(zip(ids, tags)):
        x[k, BEFORE - skip:BEFORE - skip + len(row)] = row
        y[k, :len(tag)] = tag
        mask[k, :len(tag)] = True
    f = np.array(docs)
    cur = feats[x[:, BEFORE:BEFORE + width]]
    around = [feats[x[:, BEFORE + o:BEFORE + o + width]][..., SEEN] for o in OFFSETS]
    grads = [np.zeros_like(p) for p in field.parts()]
    first = [np.zeros_like(p) for p in field.parts()]
    second = [np.zeros_like(p) for p in field.parts()]
    onehot = np.eye(3)[y] * mask[..., None]
    pairs = mask[:, 1:, None, None] * (onehot[:, :-1, :, None] * onehot[:, 1:, None, :])
    want_moves = pairs.sum((0, 1))

    def summed(index: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.where(index[..., None] >= 0, table[index], 0).sum(-2)

    def scattered(index: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros((size, 3))
        flat = np.broadcast_to(value[..., None, :], (*index.shape, 3)).reshape(-1, 3)
        ok = index.ravel() >= 0
        for s in range(3):
            out[:, s] = np.bincount(index.ravel()[ok], flat[ok, s], size)
        return out

    for step in range(1, STEPS + 1):
        e = summed(cur, field.own) + summed(f, field.file)[:, None, :]
        for j, a in enumerate(around):
            e = e + summed(a, field.near[j])
        alpha, beta = np.zeros((n, width, 3)), np.zeros((n, width, 3))
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + field.moves, axis=1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], nxt, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            nxt = np.logaddexp.reduce(field.moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], nxt, beta[:, t + 1])
        logz = np.logaddexp.reduce(alpha[:, -1], axis=1)[:, None, None]
        p = np.exp(alpha + beta - logz) * mask[..., None]
        two = np.exp(alpha[:, :-1, :, None] + field.moves + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - logz[..., None]) * mask[:, 1:, None, None]
        d = onehot - p
        grads = [scattered(cur, d, N_OWN), np.stack([scattered(a, d, N_OWN) for a in around]),
                 scattered(f, d.sum(1), sum(N_FILE)), want_moves - two.sum((0, 1))]
        for k, w in enumerate(field.parts()):
            g = grads[k] - PENALTY * w
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w += RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    return field


class Tagger:
    """Tags batches of texts."""

    def __init__(self, field: Field):
        self.field, self.vocabulary = field, Tokens()
        self.margin = field.margin()
        self._reset()

    def _reset(self) -> None:
        self.vocabulary = Tokens()
        self.scores = np.zeros((0, 1 + len(OFFSETS), 3))
        self.kind = np.zeros((0, 2), bool)

    def _grow(self) -> None:
        new = self.vocabulary.features[len(self.scores):]
        if new:
            f = np.array(new)
            s = np.stack([self.field.own[f].sum(1)] + [self.field.near[j][f[:, SEEN]].sum(1) for j in range(len(OFFSETS))], 1)
            self.scores = np.concatenate([self.scores, s])
            sign = np.zeros((len(new), 2), bool)
            sign[:, 1] = (f[:, 0] & 4) > 0
            self.kind = np.concatenate([self.kind, sign])
            self.vocabulary.features[-len(new):] = [None] * len(new)  # scored, and not looked at again

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """The spans that the field finds in each text."""
        out: list[list[Span]] = [[] for _ in texts]
        start = 0
        while start < len(texts):  # so many texts at a time as hold about 2^20 characters
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= 1 << 20):
                size += len(texts[end])
                end += 1
            self._tag(texts[start:end], start, out)
            start = end
        return out

    def _tag(self, texts: list[str], base: int, out: list[list[Span]]) -> None:
        if len(self.vocabulary) > CACHE:
            self._reset()
        get = self.vocabulary.__getitem__
        toks = [tokens_of(t) for t in texts]
        sizes = np.array([len(t) for t in toks])
        if not sizes.sum():
            return
        ids = np.concatenate([np.fromiter(map(get, t), np.int64, len(t)) for t in toks])
        self._grow()
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        doc = np.repeat(np.arange(len(texts)), sizes)
        e = self.scores[ids, 0]
        at = np.arange(len(ids)) - first[doc]
        left = sizes[doc] - 1 - at
        for j, o in enumerate(OFFSETS):
            if o < 0:
                ok = at[-o:] >= -o
                e[-o:] += self.scores[ids[:o], 1 + j] * ok[:, None]
            else:
                ok = left[:-o] >= o
                e[:-o] += self.scores[ids[o:], 1 + j] * ok[:, None]
        digits = np.bincount(doc, self.kind[ids, 1], len(texts))
        for k, t in enumerate(texts):
            n_signs = sum(t.count(s) for s in SIGNS)
            f = _file_ids(file_features(int(sizes[k]), n_signs, int(digits[k])))
            e[first[k]:first[k] + sizes[k]] += self.field.file[f].sum(0)
        open_ = np.flatnonzero(e[:, 0] - np.maximum(e[:, 1], e[:, 2]) <= self.margin)
        if not len(open_):
            return
        breaks = np.flatnonzero((np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])) + 1
        found: dict[int, list[tuple[int, int]]] = {}
        for run in np.split(open_, breaks):
            k, begin = int(doc[run[0]]), None
            path = self.field.best_path(e[run[0]:run[-1] + 1], run[0] == first[k], run[-1] == first[k] + sizes[k] - 1)
            for i, s in zip(run - first[k], path):
                if s == 1 or (s == 2 and begin is None):
                    begin = int(i)
                    found.setdefault(k, []).append((begin, begin))
                elif s == 2:
                    found[k][-1] = (found[k][-1][0], int(i))
                else:
                    begin = None
        for k, spans in found.items():
            starts = offsets(texts[k], toks[k])
            out[base + k] = [Span(starts[a], starts[b] + len(toks[k][b]), "crf", starts[a]) for a, b in spans]


def all_spans(base: list[Span], added: list[Span]) -> list[Span]:
    """The base spans, and those added that lie within none and are long enough."""
    extra = [s for s in added if s.end - s.start >= LEAST_ADDED and not any(b.start <= s.start and s.end <= b.end for b in base)]
    return sorted(base + extra, key=lambda s: (s.start, KINDS.index(s.kind)))


def train(documents: DataFrame) -> Field:
    fit_ = F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    docs = documents.select("doc_id", "text").where(fit_)
    n = documents.count()
    rows = (docs.where(_picked(F.col("doc_id"), F.lit(min(1.0, TRAIN_DOCS / max(1, n)))))
            .withColumn("text", excerpt(F.col("doc_id"), MAX_TRAIN_CHARS)).groupBy("doc_id").agg(F.min("text").alias("text"))).toPandas().sort_values("doc_id")
    return fit(rows["text"].tolist())


def scan(documents: DataFrame, field: Field, carry: list[str]) -> DataFrame:
    """``carry`` columns, spans (array of kind, start, end, value) and clean, the
    text with every secret replaced by MARK (null if it was), for each document row."""
    docs, schema = text_first(documents, carry)
    kept = documents.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        tagger = Tagger(kept.value)
        for b in sliced(batches, SLICE_BYTES):
            given = b.column(0).to_pylist()
            texts = [t or "" for t in given]
            spans = [all_spans(base_spans(t), a) for t, a in zip(texts, tagger.spans(texts))]
            clean = [redacted(t, s) if s else t for t, s in zip(given, spans)]
            rows = [[{"kind": s.kind, "start": s.start, "end": s.end, "value": s.value} for s in x] for x in spans]
            yield pa.RecordBatch.from_arrays([*carried(b, carry), pa.array(rows, kind), pa.array(clean, pa.string())],
                                             [*carry, "spans", "clean"])
    out = f"{schema}, spans array<struct<kind:string,start:bigint,end:bigint,value:bigint>>, clean string"
    return docs.mapInArrow(run, out)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with the secrets, and no key before them, replaced by MARK."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s.value):
        if s.end > at:
            if s.value >= at:
                out += [text[at:s.value], MARK]
            at = s.end
    return "".join(out) + text[at:]


def digest(documents: DataFrame) -> DataFrame:
    got = scan(documents, train(documents), ["doc_id"]).drop("clean")

    def joined(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return got.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                      F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))

