"""Token counts from an exact length histogram.

Every text is encoded once. Documents are aggregated by encoded length; the
running sums of that histogram, from the longest length down, then answer
totals, quantiles and truncated totals for every context limit without
touching the texts again:

* ``length_histogram``: rows (n_tokens, n_docs), by optional group columns;
* ``suffix_sums``: for each length L the documents and tokens of length >= L
  and the total kept when texts are cut at L;
* ``truncated_totals`` and ``quantiles`` look limits and shares up there.

The tokenizer is a file of ranks (base64 token and rank by line); the driver
reads it, checks its size (MAX_RANKS_BYTES) and broadcasts it.

The encoder's splitter fails on very long runs of white space, so texts are
cut at runs of LONG_RUN characters or more, only where the splitting rule itself
cuts: such a run is one piece, but for its last character if a word follows.

Defined cases: null and empty texts have length 0 and count as documents;
repeated rows count each; an empty table has an empty histogram; special
tokens' strings are ordinary text; columns other than text and the group
columns are ignored. A quantile is the least length that at least that share
of the documents does not exceed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import SLICE_BYTES, saved, sliced

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_RANKS_BYTES = 64 << 20
#: The vocabulary's rule for splitting a text before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as that rule has it, in runs that are counted by themselves.
LONG_RUN = 1 << 15
LONG_SPACES = re.compile(r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
#: Lengths to a bucket of the running sums.
BUCKET = 256


@lru_cache(2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def n_tokens(encoding: tiktoken.Encoding, text: str | None) -> int:
    """Tokens of a whole text of any length."""
    if not text:
        return 0
    total, at = 0, 0
    for run in LONG_SPACES.finditer(text) if len(text) >= LONG_RUN else ():
        # the run's last character may belong to the word after it
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at:run.start()])) + len(encoding._encode_single_piece(text[run.start():end].encode()))
        at = end
    return total + len(encoding.encode_ordinary(text[at:] if at else text))


def encoded_lengths(documents: DataFrame, carry: list[str], ranks_path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``carry`` columns and n_tokens (long) for each document row."""
    with open(ranks_path, "rb") as f:
        ranks = f.read(MAX_RANKS_BYTES + 1)
    if len(ranks) > MAX_RANKS_BYTES:
        raise ValueError(f"{ranks_path} is larger than {MAX_RANKS_BYTES} bytes")
    kept = documents.sparkSession.sparkContext.broadcast(ranks)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.select(*carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(kept.value, pattern)
        for b in sliced(batches, SLICE_BYTES):
            n = [n_tokens(encoding, t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n, pa.int64())], [*b.schema.names[1:], "n_tokens"])
    return documents.select("text", *carry).mapInArrow(run, f"{schema}n_tokens long")


def length_histogram(documents: DataFrame, by: tuple[str, ...] = (), ranks_path: str = RANKS) -> DataFrame:
    """Rows (*by, n_tokens, n_docs)."""
    return encoded_lengths(documents, list(by), ranks_path).groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows (*by, n_tokens, n_docs, docs_at_least, tokens_at_least,
    docs_total, tokens_total, tokens_cut): the last is the total when every
    text is cut at n_tokens tokens. Sums run within buckets of lengths, whose
    own sums are added, so no window holds more than BUCKET lengths or the
    list of buckets (the longest length / BUCKET)."""
    h = histogram.withColumn("__b", F.floor(F.col("n_tokens") / BUCKET)).withColumn("__t", F.col("n_tokens") * F.col("n_docs"))
    down = Window.partitionBy(*by, "__b").orderBy(F.col("n_tokens").desc())
    inner = h.select("*", F.sum("n_docs").over(down).alias("__d"), F.sum("__t").over(down).alias("__s"))
    tops = h.groupBy(*by, "__b").agg(F.sum("n_docs").alias("bd"), F.sum("__t").alias("bt"))
    above = Window.partitionBy(*by).orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by)
    tops = tops.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], F.col("__b").alias("__c"),
                       F.coalesce(F.sum("bd").over(above), F.lit(0)).alias("ad"), F.coalesce(F.sum("bt").over(above), F.lit(0)).alias("at"),
                       F.sum("bd").over(every).alias("docs_total"), F.sum("bt").over(every).alias("tokens_total"))
    on = F.col("__b") == F.col("__c")
    for i, c in enumerate(by):
        on = on & inner[c].eqNullSafe(F.col(f"__g{i}"))
    out = inner.join(tops, on).select(
        *by, "n_tokens", "n_docs", (F.col("__d") + F.col("ad")).alias("docs_at_least"),
        (F.col("__s") + F.col("at")).alias("tokens_at_least"), "docs_total", "tokens_total")
    cut = F.col("tokens_total") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return out.withColumn("tokens_cut", cut)


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """One row, a column ``cut_<limit>`` for each limit: the tokens left when
    texts are cut there, from the whole corpus's suffix sums."""
    outs = []
    for x in limits:
        # the least length above the limit carries the sums of all longer texts
        longer = F.col("n_tokens") > x
        docs, tokens = (F.coalesce(F.max(F.when(longer, F.col(c))), F.lit(0)) for c in ("docs_at_least", "tokens_at_least"))
        outs.append((F.coalesce(F.max("tokens_total"), F.lit(0)) - tokens + docs * int(x)).alias(f"cut_{x}"))
    return sums.agg(*outs)


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """One row, a column ``q_<share>`` for each share: the exact quantile of length."""
    up_to = F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")
    return sums.agg(*[F.min(F.when(up_to >= F.col("docs_total") * x, F.col("n_tokens"))).alias(f"q_{x}") for x in shares])


def digest(documents: DataFrame) -> DataFrame:
    """The suffix sums over all lengths."""
    return suffix_sums(saved(length_histogram(documents), "op2-lengths"))
