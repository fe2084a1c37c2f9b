"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A document is
parsed from left to right into the longest phrases that occur in a
language's text; the language that needs the fewest phrases, each costing the
logarithm of its text's length, wins. Texts are reduced to lower-case letters
with single blanks between words, for training and parsing alike. Every letter
of the training texts is a symbol of its own; a letter that no language's text
has is a phrase in each of them.

Training takes a bounded sample: about TRAIN_CHARS characters for each
language (all languages together MOST_CHARS, so fewer if there are many), as
excerpts from hashed places of about DOCS_PER_LANGUAGE documents outside the
held-out fold.
The automata are built by each Python worker from that text, which is all
that is broadcast. Every text is parsed whole, in segments of SEGMENT
characters that are parsed side by side (a cut adds a phrase to every
language alike).

Score: the winner's margin, 1 - cost / cost of the second (1 with a single
language). A text of which no letter was learned goes to the language of the
shortest training text. Defined cases: a null text, or one without a letter, is ``und``
with score 0, as is every text if nothing could be learned; ties go to the
language first in order; a null doc_id has the crc32 of empty text; repeated
rows give a row each; an empty table gives no rows; columns other than
doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import SLICE_BYTES, carried, crc_mod, held, sliced, text_first
from panelkit.llm.fitting import class_sample

FOLDS, HELD_OUT = 5, 0
DOCS_PER_LANGUAGE, TRAIN_CHARS = 60, 30_000
#: All languages' training text together.
MOST_CHARS = 2_000_000
#: Transitions by the commonest symbols are kept in one dense table of at most
#: so many symbols and cells, the others sorted by state and symbol. It changes speed alone.
DENSE_SYMBOLS, DENSE_CELLS = 252, 1 << 26
SEGMENT, SIDE_BY_SIDE = 1024, 4096
#: Symbols: 0 blank, 1 a letter of no training text (never matched), 2.. letters, commonest first.
BLANK, OTHER = 0, 1


@lru_cache(1)
def _letters() -> np.ndarray:
    """By code point: its lower-case letter's code point, 0 for a non-letter."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """A text's symbols, with runs of non-letters as one blank and none at the ends."""
    s = table[_code_points(text)]
    blank = s == BLANK
    keep = ~blank
    if len(s):
        keep[1:] |= ~blank[:-1]
    s = s[keep]
    begin = 1 if len(s) and s[0] == BLANK else 0
    end = len(s) - (1 if len(s) > begin and s[-1] == BLANK else 0)
    return s[begin:end]


class Languages:
    """The learned languages: names, alphabet and training symbols."""

    def __init__(self, names: list[str], texts: list[list[str]]):
        limit = min(TRAIN_CHARS, MOST_CHARS // max(1, len(names)))
        lower = _letters()
        seen: dict[int, int] = {}
        cut: list[str] = []
        for parts in texts:
            share = limit if sum(map(len, parts)) <= limit else -(-limit // len(parts))
            cut.append("\n".join(p[:share] for p in parts))
            cp, n = np.unique(lower[_code_points(cut[-1])], return_counts=True)
            for c, k in zip(cp.tolist(), n.tolist()):
                if c:
                    seen[c] = seen.get(c, 0) + k
        self.alphabet = tuple(sorted(seen, key=lambda c: (-seen[c], c)))
        table = symbol_table(self.alphabet)
        # a character for each symbol: hashable, and no larger than its symbols need
        trained = [(n, "".join(map(chr, symbols(t, table).tolist()))) for n, t in zip(names, cut)]
        trained = [(n, t) for n, t in trained if t]
        self.names, self.texts = tuple(n for n, _ in trained), tuple(t for _, t in trained)


@lru_cache(2)
def symbol_table(alphabet: tuple[int, ...]) -> np.ndarray:
    lower = _letters()
    of = np.full(0x110000, OTHER, np.min_scalar_type(len(alphabet) + 1))
    of[0] = BLANK
    of[list(alphabet)] = np.arange(2, len(alphabet) + 2)
    return of[lower]


def suffix_automaton(text: bytes | str) -> list[dict[int, int]]:
    """The transitions of the least automaton of a text's substrings, state 0 first."""
    if isinstance(text, str):
        text = [ord(c) for c in text]
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


class Automata:
    """The transitions of several automata. step() gives the next state, or, if
    no phrase goes on so, the complement of the state after a new phrase has
    begun with the symbol. From a language's start state every symbol begins a
    phrase."""

    def __init__(self, texts: tuple[bytes | str, ...], n_symbols: int):
        states = sum(2 * len(t) + 2 for t in texts)
        self.n_symbols = n_symbols
        self.width = min(n_symbols, DENSE_SYMBOLS, max(1, DENSE_CELLS // max(1, states)))
        blocks, roots, starts, keys, nexts, root = [], [], [], [], [], 0
        for text in texts:  # one automaton at a time, as its dictionaries take more memory than the table
            automaton = suffix_automaton(text)
            none = root + len(automaton)  # the last state continues nothing
            fresh = np.full(self.width, none, np.int32)  # a symbol that the text lacks is a phrase
            for c, s in automaton[0].items():
                if c < self.width:
                    fresh[c] = root + s
            block = np.tile(~fresh, (len(automaton) + 1, 1))
            far: list[tuple[int, int]] = []
            for s, to in enumerate(automaton):
                if to and max(to) >= self.width:
                    far += [((root + s) * n_symbols + c, root + x) for c, x in to.items() if c >= self.width]
                    to = {c: x for c, x in to.items() if c < self.width}
                if to:
                    block[s, list(to)] = np.fromiter(to.values(), np.int32, len(to)) + root
            blocks.append(block)
            pairs = np.array(far, np.int64).reshape(-1, 2)
            pairs = pairs[np.argsort(pairs[:, 0])]  # states rise from text to text, so all keys are sorted
            keys.append(pairs[:, 0])
            nexts.append(pairs[:, 1].astype(np.int32))
            roots.append(root)
            starts.append(none)
            root = none + 1
            del automaton
        self.dense = np.concatenate(blocks).ravel()
        self.keys = np.concatenate([*keys, [np.iinfo(np.int64).max]])  # one key that is never asked for
        self.nexts = np.concatenate([*nexts, [0]]).astype(np.int32)
        self.roots, self.starts = np.array(roots, np.int64), np.array(starts, np.int32)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """By language and text: ``state`` (languages, texts), ``symbol`` (texts)."""
        if self.width == self.n_symbols:
            return self.dense[state * self.width + symbol]
        rare = np.flatnonzero(symbol >= self.width)
        out = self.dense[state * self.width + np.where(symbol < self.width, symbol, 0)]
        if len(rare):
            out[:, rare] = self._rare(state[:, rare], symbol[rare].astype(np.int64))
        return out

    def _rare(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        want = state.astype(np.int64) * self.n_symbols + symbol
        at = np.searchsorted(self.keys, want)
        # no phrase goes on: begin one with the symbol, if the language's text has it
        symbol, of = np.unique(symbol, return_inverse=True)
        first = self.roots[:, None] * self.n_symbols + symbol
        begin = np.searchsorted(self.keys, first)
        fresh = np.where(self.keys[begin] == first, self.nexts[begin], self.starts[:, None])
        return np.where(self.keys[at] == want, self.nexts[at], ~fresh[:, of])


def transitions(texts: tuple[bytes | str, ...], n_symbols: int) -> tuple[Automata, np.ndarray]:
    """(automata, starts), built once by a worker."""
    automata = held(("op9", texts, n_symbols), lambda: Automata(texts, n_symbols))
    return automata, automata.starts


def count_phrases(docs: list[np.ndarray], table: Automata, starts: np.ndarray, n_symbols: int) -> np.ndarray:
    """Phrases needed, by document and language."""
    out = np.zeros((len(docs), len(starts)), np.int64)
    pieces = [(d, s[i:i + SEGMENT]) for d, s in enumerate(docs) for i in range(0, len(s), SEGMENT)]
    pieces.sort(key=lambda x: -len(x[1]))
    for i in range(0, len(pieces), SIDE_BY_SIDE):
        part = pieces[i:i + SIDE_BY_SIDE]
        sizes = np.array([len(s) for _, s in part])
        grid = np.zeros((sizes[0], len(part)), np.min_scalar_type(n_symbols))
        for k, (_, s) in enumerate(part):
            grid[:len(s), k] = s
        state = np.repeat(starts[:, None], len(part), 1)
        begun = np.zeros((len(starts), len(part)), np.int32)
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        for t in range(sizes[0]):
            n = active[t]
            s = table.step(state[:, :n], grid[t, :n])
            broke = s >> 31
            begun[:, :n] -= broke
            state[:, :n] = s ^ broke
        np.add.at(out, [d for d, _ in part], begun.T)
    return out


def train(documents: DataFrame, column: str = "lang") -> Languages:
    rows = class_sample(documents, column, DOCS_PER_LANGUAGE, TRAIN_CHARS, MOST_CHARS, FOLDS, HELD_OUT)
    names = sorted(rows["y"].unique().tolist())
    return Languages(names, [rows.loc[rows["y"] == n, "text"].tolist() for n in names])


def identify(documents: DataFrame, languages: Languages, carry: list[str]) -> DataFrame:
    """``carry`` columns with lang_pred, score and __lettered (the text has a
    letter, whatever was learned) for each document row."""
    docs, schema = text_first(documents, carry)
    names, texts, alphabet = languages.names, languages.texts, languages.alphabet
    kept = documents.sparkSession.sparkContext.broadcast((names, texts, alphabet))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, texts, alphabet = kept.value
        n_symbols = len(alphabet) + 2
        to_symbol = symbol_table(alphabet)
        if names:
            table, starts = transitions(texts, n_symbols)
            bits = np.log2([len(t) + 1 for t in texts])
        for b in sliced(batches, SLICE_BYTES):
            docs = [symbols(t, to_symbol) if t else to_symbol[:0] for t in b.column(0).to_pylist()]
            lettered = np.array([bool(len(s)) for s in docs], bool)
            pred, score = np.full(len(docs), "und", object), np.zeros(len(docs))
            if names and lettered.any():
                cost = count_phrases(docs, table, starts, n_symbols) * bits
                best = np.argmin(cost, 1)
                pred[lettered] = np.array(names, object)[best[lettered]]
                if len(names) > 1:
                    two = np.partition(cost, 1, 1)
                    margin = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-9)
                else:
                    margin = np.ones(len(docs))
                score[lettered] = np.clip(margin, 0, 1)[lettered]
            yield pa.RecordBatch.from_arrays([*carried(b, carry), pa.array(pred, pa.string()), pa.array(score), pa.array(lettered)],
                                             [*carry, "lang_pred", "score", "__lettered"])
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double, __lettered boolean")


def digest(documents: DataFrame) -> DataFrame:
    got = identify(documents, train(documents), ["doc_id"])
    return got.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
