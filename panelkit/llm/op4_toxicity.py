"""Toxicity: Levenshtein automata over a learned lexicon trie, and context windows.

Lexicon: words whose document frequencies in toxic and clean labelled text
differ beyond chance (G2 >= LEAST_G2, at least LEAST_RATIO times as frequent
in toxic text). Copies must not vote: documents whose least shingle hash is
equal count once.

Matching: the terms form a trie. The Levenshtein automata of all terms (one
edit from five letters on, two from eight) are run over it together, as one
automaton whose states are sets of (trie node, edits); it is made
deterministic as words need it, and each distinct token is matched once per
worker until the cache is full. A misspelling counts unless it is an
ordinary word (seen in clean labelled text); a term with FUZZY_TYPES ordinary
neighbours or more is matched exactly only.

Context: a hit weighs 1, a misspelled one 0.5; between quotation marks that
open and close within CONTEXT tokens of it, a quarter of that. A document's
score is a logistic function of the logarithms of the summed weights and of
the heaviest window of CONTEXT tokens, and of the weight per token.

Both are fitted on about PER_CLASS labelled ids of either class outside the
held-out fold (of a text longer than MAX_TRAIN_CHARS characters so many from
a hashed place). Whole texts are
scored; labels, lang, source and doc_id are no inputs.

Defined cases: null and empty texts have no hits and get the score of none;
without labels of both kinds there is no lexicon and the score is the
labelled share; a null doc_id has the crc32 of empty text; repeated rows give
a row each; an empty table gives no rows; columns other than doc_id, text and
toxic are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import carried, crc_mod, text_first
from panelkit.llm.fitting import Logistic, labelled_sample

FOLDS, HELD_OUT, CUT = 3, 1, 0.7
PER_CLASS, MAX_TRAIN_CHARS = 3000, 20_000
LEAST_G2, LEAST_RATIO, LEAST_LETTERS, MOST_TERMS = 20.0, 8.0, 3, 2000
FUZZY_TYPES, CONTEXT, QUOTED, MISSPELT = 2, 16, 0.25, 0.5
CACHE = 500_000
OPENS, CLOSES = "\"'“„«‘‚", "\"'”“»’"
WORDS = re.compile(r"\w+")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """All terms within their edits of a word, by one lazily determinised automaton."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term = [None]
        self.most = [0]  # edits that some term below a node allows
        for t in terms:
            node, k = 0, edits_allowed(t)
            self.most[0] = max(self.most[0], k)
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], k)
            self.term[node] = t
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        """The state of the items and of all that skipping letters of a term adds; -1 for none."""
        todo, closed = list(items), set()
        while todo:
            node, e = todo.pop()
            if e <= self.most[node] and (node, e) not in closed:
                closed.add((node, e))
                todo += [(child, e + 1) for child in self.children[node].values()]
        if not closed:
            return -1
        key = frozenset(closed)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            out.add((node, e + 1))  # a letter too many
            for x, child in self.children[node].items():
                out.add((child, e + (x != c)))
        self.moves[state][c] = nxt = self._state(out)
        return nxt

    def match(self, word: str) -> list[tuple[str, int]]:
        """(term, edits) for each term within its edits of the word."""
        s = self.start
        for c in word:
            n = self.moves[s].get(c)
            s = self._move(s, c) if n is None else n
            if s < 0:
                return []
        best: dict[str, int] = {}
        for node, e in self.sets[s]:
            t = self.term[node]
            if t is not None and e <= edits_allowed(t):
                best[t] = min(e, best.get(t, 9))
        return sorted(best.items(), key=lambda x: (x[1], x[0]))


@dataclass
class Lexicon:
    terms: list[str]
    ordinary: set[str] = field(default_factory=set)  # words near a term that are no misspellings
    exact_only: set[str] = field(default_factory=set)


class Matches(dict):
    """Weight by token: 0 for none, 1 for a term, MISSPELT for a misspelling."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon, self.automaton = lexicon, Automaton(lexicon.terms)

    def __missing__(self, token: str) -> float:
        parts = WORDS.findall(token)
        weight = 0.0
        # also the token without its ends' punctuation, as letters may be replaced by signs
        for p in {*parts, token.strip("\"'“”„«»‘’‚.,;:!?()[]{}|")}:
            if p and p not in self.lexicon.ordinary:
                for t, e in self.automaton.match(p):
                    if e == 0:
                        weight = 1.0
                    elif t not in self.lexicon.exact_only:
                        weight = max(weight, MISSPELT)
        if len(self) >= CACHE:
            self.clear()
        self[token] = weight
        return weight


def _quoted(tokens: list[str], i: int) -> bool:
    opened = False
    for k in range(max(0, i - CONTEXT), i + 1):
        t = tokens[k]
        if t[0] in OPENS:
            opened = True
        if k < i and t.rstrip(".,;:!?")[-1:] and t.rstrip(".,;:!?")[-1] in CLOSES and len(t) > 1:
            opened = False
    return opened and any(t.rstrip(".,;:!?")[-1:] and t.rstrip(".,;:!?")[-1] in CLOSES for t in tokens[i:i + CONTEXT + 1])


def hits(text: str | None, matches: Matches) -> tuple[list[tuple[int, float]], int]:
    """((token, weight in context) of each hit, number of tokens)."""
    tokens = text.lower().split() if text else []
    found = [(i, w) for i, w in enumerate(map(matches.__getitem__, tokens)) if w]
    return [(i, w * QUOTED if _quoted(tokens, i) else w) for i, w in found], len(tokens)


def features(texts: list[str | None], matches: Matches) -> np.ndarray:
    out = np.zeros((len(texts), 3))
    for k, text in enumerate(texts):
        found, n = hits(text, matches)
        if found:
            total = sum(w for _, w in found)
            heaviest, held, first = 0.0, 0.0, 0
            for i, w in found:
                held += w
                while found[first][0] <= i - CONTEXT:
                    held -= found[first][1]
                    first += 1
                heaviest = max(heaviest, held)
            out[k] = math.log1p(total), math.log1p(heaviest), math.log1p(100 * total / n)
    return out


def learn_lexicon(rows: pd.DataFrame) -> Lexicon:
    """From rows (text, y)."""
    seen: set[tuple[int, int]] = set()
    df = {0: Counter(), 1: Counter()}
    n = {0: 0, 1: 0}
    for text, y in zip(rows["text"], rows["y"]):
        words = WORDS.findall(text.lower())
        if not words:
            continue
        sign = min(xxhash.xxh64_intdigest(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2)))
        if (sign, y) not in seen:
            seen.add((sign, y))
            n[y] += 1
            df[y].update(set(words))
    if not n[0] or not n[1]:
        return Lexicon([])
    scored = []
    for w, a in df[1].items():
        b = df[0][w]
        if len(w) >= LEAST_LETTERS and (a / n[1]) >= LEAST_RATIO * (b + 0.5) / n[0]:
            p, p1, p0 = (a + b) / (n[0] + n[1]), a / n[1], b / n[0]
            g2 = 2 * (a * math.log(p1 / p) + (b * math.log(p0 / p) if b else 0)
                      + ((n[1] - a) * math.log((1 - p1) / (1 - p)) if a < n[1] else 0)
                      + (n[0] - b) * math.log((1 - p0) / (1 - p)))
            if g2 >= LEAST_G2:
                scored.append((-g2, w))
    terms = sorted(w for _, w in sorted(scored)[:MOST_TERMS])
    automaton, known, near = Automaton(terms), set(terms), Counter()
    ordinary = set()
    for w in df[0]:
        if w not in known and (found := automaton.match(w)):
            ordinary.add(w)
            near.update(t for t, _ in found)
    return Lexicon(terms, ordinary, {t for t, k in near.items() if k >= FUZZY_TYPES})


def train(documents: DataFrame, labels: DataFrame) -> tuple[Lexicon, Logistic]:
    rows = labelled_sample(documents, labels, "toxic", PER_CLASS, MAX_TRAIN_CHARS, FOLDS, HELD_OUT)
    lexicon = learn_lexicon(rows)
    x = features(rows["text"].tolist(), Matches(lexicon))
    return lexicon, Logistic(x.reshape(-1, 3), rows["y"].to_numpy(int))


def score(documents: DataFrame, lexicon: Lexicon, logistic: Logistic, carry: list[str]) -> DataFrame:
    """``carry`` columns and score for each document row."""
    docs, schema = text_first(documents, carry)
    kept = documents.sparkSession.sparkContext.broadcast((lexicon, logistic))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, logistic = kept.value
        matches = Matches(lexicon)
        for b in batches:
            x = features(b.column(0).to_pylist(), matches)
            yield pa.RecordBatch.from_arrays([*carried(b, carry), pa.array(logistic.score(x))], [*carry, "score"])
    return docs.mapInArrow(run, f"{schema}, score double")


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    got = score(documents, *train(documents, labels), ["doc_id"])
    return got.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))
