"""Quality by compression: two zstandard dictionaries, one score.

One dictionary is built from good, one from bad labelled text. A document is
cut into pieces of PIECE bytes, every piece is compressed with either
dictionary, and the difference of the summed sizes per byte says which text
it resembles. A logistic regression over that difference, the size per byte
under the good dictionary (repetition compresses with both) and the inverse
length turns it into a calibrated score.

Both are fitted on a bounded sample: about PER_CLASS labelled ids of either
class outside the held-out fold, of a text longer than MAX_TRAIN_CHARS
characters so many from a hashed place;
every other one builds the dictionaries, the rest calibrate. The dictionaries
and four weights are all that is broadcast. Whole texts are scored, and doc_id,
lang, source and labels are no inputs.

Defined cases: null and empty texts get the score of size zero; without
labels of both kinds the score is the labelled share of good (0.5 without
any); a null doc_id has the crc32 of empty text; repeated rows give a row
each; an empty table gives no rows; columns other than doc_id, text and
quality are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import crc_mod
from panelkit.llm.fitting import Logistic, labelled_sample

FOLDS, HELD_OUT, CUT = 3, 1, 0.5
PER_CLASS, MAX_TRAIN_CHARS = 2500, 20_000
PIECE, DICTIONARY_BYTES, LEVEL = 4096, 65_536, 3
FEWEST_PIECES = 16


@dataclass
class Model:
    good: bytes
    bad: bytes
    logistic: Logistic


def _pieces(text: bytes) -> list[bytes]:
    return [text[i:i + PIECE] for i in range(0, len(text), PIECE)]


def _dictionary(texts: list[bytes]) -> bytes:
    """The content of a trained dictionary, or of raw text if there is little."""
    parts = [p for t in texts for p in _pieces(t)]
    if len(parts) >= FEWEST_PIECES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
        except zstandard.ZstdError:  # too little text for statistics
            pass
    return b"\n".join(parts)[:DICTIONARY_BYTES]


def compressor(dictionary: bytes):
    """A function that gives a text's compressed size, summed over its pieces."""
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_dict_id=False)
    if len(dictionary) >= 8:
        d = zstandard.ZstdCompressionDict(dictionary)
        d.precompute_compress(level=LEVEL)
        c = zstandard.ZstdCompressor(dict_data=d, compression_params=params)
    else:
        c = zstandard.ZstdCompressor(compression_params=params)
    return lambda text: sum(len(c.compress(p)) for p in _pieces(text))


def features(texts: list[bytes | None], good, bad) -> np.ndarray:
    out = np.zeros((len(texts), 3))
    for i, t in enumerate(texts):
        if t:
            g, n = good(t), len(t)
            out[i] = (bad(t) - g) / n, g / n, 1 / n
    return out


def train(documents: DataFrame, labels: DataFrame) -> Model:
    rows = labelled_sample(documents, labels, "quality", PER_CLASS, MAX_TRAIN_CHARS, FOLDS, HELD_OUT)
    texts = [t.encode("utf-8", "replace") for t in rows["text"]]
    y = rows["y"].to_numpy(int)
    seen = {0: 0, 1: 0}
    build: dict[int, list[bytes]] = {0: [], 1: []}
    rest = []
    for i, (t, k) in enumerate(zip(texts, y)):
        seen[k] += 1
        if seen[k] % 2:
            build[k].append(t)
        else:
            rest.append(i)
    rest = rest if len(set(y[rest])) == len(set(y)) else list(range(len(y)))
    model = Model(_dictionary(build[1]), _dictionary(build[0]), None)
    x = features([texts[i] for i in rest], compressor(model.good), compressor(model.bad))
    # the sample is balanced, the labels need not be: a score of 0.5 parts the classes
    model.logistic = Logistic(x.reshape(-1, 3), y[rest])
    return model


def score(documents: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry`` columns and score for each document row."""
    docs = documents.select(F.col("text").cast("binary").alias("text"), *carry)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*carry).schema)
    kept = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = kept.value
        good, bad = compressor(m.good), compressor(m.bad)
        for b in batches:
            x = features(b.column(0).to_pylist(), good, bad)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(m.logistic.score(x))], [*b.schema.names[1:], "score"])
    return docs.mapInArrow(run, f"{schema}, score double")


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    got = score(documents, train(documents, labels), ["doc_id"])
    return got.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))
