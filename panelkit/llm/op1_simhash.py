"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprint: A-Z are lower-cased; a text's words (runs without ASCII white
space) give shingles of ``words`` consecutive words (fewer words: one shingle
of all), repeats included; bit i of the 64 is set if it is set in over half
of the shingles' XXH64 values (seed 42).

Links (at most ``max_bits`` differing bits) are searched among distinct
fingerprints, so exact copies, however many, are one node:

1. The correlations of the bits are counted over all fingerprints, and bits
   that go together are grouped into one of m partitions.
2. A fingerprint q gets a threshold t_i >= -1 for each partition with
   sum(t_i) = max_bits - m + 1. If two fingerprints differ in max_bits bits
   or fewer, some partition then differs in t_i or fewer. The thresholds
   are unequal, and found by dynamic programming on the candidate counts
   that histograms of all fingerprints (256 counts for each eight bits)
   promise for each partition and threshold, and on the keys to probe.
3. Each q probes partition i with all values within t_i bits of its own; a
   join on (partition, value) finds the candidates.
4. The whole fingerprints are compared.

The number of partitions is that of the least estimated cost per
fingerprint, over a sample of at most COST_SAMPLE fingerprints; it changes
cost alone. Driver memory: 64 x 64 correlations and the histograms.

Defined cases: a null, empty or word-less text has fingerprint zero and is
linked like any other; repeated rows give a row each; a null doc_id is
returned as it is and is never a component's id unless the component has no
other (then component_id is null); an empty table gives no rows. Columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import SLICE_BYTES, numbered_rows, release, saved, sliced, without
from panelkit.llm.components import connected_components

WORDS, MAX_BITS, SEED = 4, 4, 42
PARTITIONS = (2, 3, 4, 5)
COST_SAMPLE = 2000
#: Cost of a probe (a row to shuffle) in candidates (rows to compare).
PROBE_COST = 8.0
#: Hashes taken at once, whatever a text's length.
HASHES = 1 << 17
PROBES = 1 << 20


def simhash(texts: list[bytes | None], words: int = WORDS) -> np.ndarray:
    """The fingerprints of UTF-8 texts as unsigned 64-bit integers."""
    ones = np.zeros((len(texts), 64), np.int64)
    total = np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []
    n_held = 0

    def flush() -> None:
        nonlocal n_held
        if held:
            h = np.concatenate([x for _, x in held])
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            starts = np.cumsum([0] + [len(x) for _, x in held[:-1]])
            np.add.at(ones, [d for d, _ in held], np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
            held.clear()
            n_held = 0

    digest = xxhash.xxh64_intdigest
    for d, text in enumerate(texts):
        parts = text.lower().split() if text else []  # of bytes: A-Z and ASCII white space only
        if not parts:
            continue
        joined = b" ".join(parts)
        k = min(words, len(parts))
        at = np.cumsum([0] + [len(p) + 1 for p in parts])
        begin, end = at[:len(parts) - k + 1].tolist(), (at[k:] - 1).tolist()
        total[d] = len(begin)
        for i in range(0, len(begin), HASHES):
            held.append((d, np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begin[i:i + HASHES], end[i:i + HASHES])),
                                        np.uint64, min(HASHES, len(begin) - i))))
            n_held += len(held[-1][1])
            if n_held >= HASHES:
                flush()
    flush()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(documents: DataFrame, words: int = WORDS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and fp, the 64 bits as a signed long."""
    docs = documents.select(F.col("text").cast("binary").alias("text"), *carry)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.select(*carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in sliced(batches, SLICE_BYTES):
            fp = simhash(b.column(0).to_pylist(), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp)], [*carry, "fp"])
    return docs.mapInArrow(run, f"{schema}fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _column(b: pa.RecordBatch) -> np.ndarray:
    return b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def bit_correlations(nodes: DataFrame) -> np.ndarray:
    """The 64 x 64 correlations of the bits over all fingerprints."""
    def run(batches):
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _bits(_column(b)).astype(np.float32)
            both, n = both + x.T @ x, n + len(x)
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, 64)), pa.array(np.append(j, 64)),
                                          pa.array(np.append(both.ravel(), n))], ["i", "j", "v"])
    got = nodes.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((65, 65))
    for r in got:  # 4097 rows
        m[r["i"], r["j"]] = r["v"]
    n = max(m[64, 64], 1)
    p = np.diag(m)[:64] / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return (m[:64, :64] / n - np.outer(p, p)) / np.outer(sd, sd)


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """m groups of equal size (by one): each begins with the most correlated
    pair left and takes in the bit of the greatest mean correlation with it."""
    c = np.abs(corr).copy()
    np.fill_diagonal(c, 0)
    left, out = set(range(64)), []
    for g in range(m):
        size = 64 // m + (g < 64 % m)
        pool = sorted(left)
        sub = c[np.ix_(pool, pool)]
        i, j = np.unravel_index(np.argmax(sub), sub.shape)
        group = [pool[i], pool[j]] if i != j else pool[:2]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(rest[int(np.argmax(c[np.ix_(rest, group)].mean(1)))])
        out.append(group[:size])
        left -= set(out[-1])
    return out


def _blocks(group: list[int]) -> list[list[int]]:
    return [group[i:i + 8] for i in range(0, len(group), 8)]


def _value(bits: np.ndarray, group: list[int]) -> np.ndarray:
    return bits[:, group].astype(np.int64) @ (1 << np.arange(len(group), dtype=np.int64))


def histograms(nodes: DataFrame, plans: dict[int, list[list[int]]]) -> tuple[dict, int]:
    """{(m, group, block): counts of the block's values}, and the number of fingerprints."""
    def run(batches):
        acc: dict[tuple[int, int, int], np.ndarray] = {}
        for b in batches:
            bits = _bits(_column(b))
            for m, groups in plans.items():
                for g, group in enumerate(groups):
                    for k, block in enumerate(_blocks(group)):
                        acc[m, g, k] = acc.get((m, g, k), 0) + np.bincount(_value(bits, block), minlength=1 << len(block))
        for (m, g, k), n in acc.items():
            size = len(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, x)) for x in (m, g, k)] + [pa.array(np.arange(size)), pa.array(n)],
                                             ["m", "g", "k", "v", "n"])
    got = (nodes.mapInArrow(run, "m long, g long, k long, v long, n long").groupBy("m", "g", "k", "v")
           .agg(F.sum("n").alias("n")).collect())  # at most 256 rows for each eight bits of each plan
    out = {(m, g, k): np.zeros(1 << len(block)) for m, groups in plans.items()
           for g, group in enumerate(groups) for k, block in enumerate(_blocks(group))}
    for r in got:
        out[r["m"], r["g"], r["k"]][r["v"]] = r["n"]
    first = next(iter(plans))
    return out, int(out[first, 0, 0].sum())


class Allocation:
    """Thresholds for one plan: the groups of bits, and for each the share of
    fingerprints expected within 0..max_bits of a value."""

    def __init__(self, m: int, groups: list[list[int]], hists: dict, n: int, max_bits: int):
        self.groups, self.n, self.max_bits = groups, n, max_bits
        self.near = []
        for g, group in enumerate(groups):
            tables = []
            for k, block in enumerate(_blocks(group)):
                v = np.arange(1 << len(block))
                dist = np.bitwise_count(v[:, None] ^ v[None, :])
                share = hists[m, g, k] / max(n, 1)
                tables.append(np.stack([(share[None, :] * (dist == t)).sum(1) for t in range(len(block) + 1)], 1))
            self.near.append(tables)
        self.masks = [self._masks(len(group)) for group in groups]

    def _masks(self, width: int) -> list[np.ndarray]:
        """By threshold t: the patterns of at most t bits."""
        by = [np.zeros(1, np.int64)]
        for t in range(1, min(self.max_bits, width) + 1):
            by.append(np.array([sum(1 << i for i in c) for c in combinations(range(width), t)], np.int64))
        return [np.concatenate(by[:t + 1]) for t in range(len(by))]

    def thresholds(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(t, cost): thresholds by row and group, found by dynamic programming."""
        n, m, top = len(bits), len(self.groups), self.max_bits
        cost = np.full((n, m, top + 2), np.inf)
        cost[:, :, 0] = 0  # threshold -1: the group is not probed
        for g, group in enumerate(self.groups):
            dist = np.zeros((n, top + 1))
            dist[:, 0] = 1
            for block, table in zip(_blocks(group), self.near[g]):
                add, new = table[_value(bits, block)], np.zeros_like(dist)
                for t in range(min(add.shape[1], top + 1)):
                    new[:, t:] += add[:, t:t + 1] * dist[:, :top + 1 - t]
                dist = new
            within = np.cumsum(dist, 1) * self.n
            for t in range(min(top + 1, len(self.masks[g]))):
                cost[:, g, t + 1] = within[:, t] + PROBE_COST * len(self.masks[g][t])
        want = top - m + 1
        # best[s]: least cost of the groups so far with thresholds + 1 summing to s
        best = np.full((n, want + m + 1), np.inf)
        best[:, 0] = 0
        back = np.zeros((m, n, want + m + 1), np.int64)
        for g in range(m):
            new = np.full_like(best, np.inf)
            for s in range(want + m + 1):
                for t in range(min(s, top + 1) + 1):
                    c = best[:, s - t] + cost[:, g, t]
                    better = c < new[:, s]
                    new[better, s] = c[better]
                    back[g, better, s] = t
            best = new
        left, t = np.full(n, want + m), np.zeros((n, m), np.int64)
        for g in reversed(range(m)):
            t[:, g] = back[g, np.arange(n), left]
            left = left - t[:, g]
        return t - 1, best[:, want + m]


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (a, b), a < b: the distinct fingerprints ``nodes`` (fp) that differ in max_bits bits or fewer."""
    # as many tasks as a shuffle has: few fingerprints have many probes
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.select("fp").repartition(parts, "fp")
    corr = bit_correlations(nodes)
    plans = {m: group_bits(corr, m) for m in PARTITIONS if m <= max_bits + 1} or {1: [list(range(64))]}
    hists, n = histograms(nodes, plans)
    sample = np.array([r[0] for r in nodes.limit(COST_SAMPLE).collect()], np.int64).view(np.uint64)
    choices = {m: Allocation(m, groups, hists, n, max_bits) for m, groups in plans.items()}
    cost = {m: a.thresholds(_bits(sample))[1].mean() if len(sample) else m for m, a in choices.items()}
    chosen = choices[min(cost, key=cost.get)]

    def own(batches):
        for b in batches:
            bits = _bits(_column(b))
            for g, group in enumerate(chosen.groups):
                yield pa.RecordBatch.from_arrays([pa.array(_value(bits, group) * 8 + g), b.column(0)], ["key", "fp"])

    def probe(batches):
        for b in batches:
            fps, bits = _column(b).view(np.int64), _bits(_column(b))
            t, _ = chosen.thresholds(bits)
            for g, group in enumerate(chosen.groups):
                values = _value(bits, group)
                for x in range(t[:, g].max(initial=-1) + 1):
                    rows, masks = np.flatnonzero(t[:, g] == x), chosen.masks[g][x]
                    step = max(1, PROBES // len(masks))
                    for i in range(0, len(rows), step):
                        at = rows[i:i + step]
                        keys = (values[at][:, None] ^ masks[None, :]) * 8 + g
                        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fps[at], len(masks)))], ["key", "q"])

    data = nodes.mapInArrow(own, "key long, fp long")
    probes = nodes.mapInArrow(probe, "key long, q long")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= max_bits
    pairs = probes.join(data, (probes["key"] == data["key"]) & near & (F.col("q") != F.col("fp")))
    return pairs.select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b")).distinct()


def near_duplicates(documents: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS,
                    carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns (doc_id among them), fp, component (the least
    fingerprint reachable) and component_id, one row per document row."""
    fps = saved(fingerprints(documents, words, carry), "op1-fps")
    nodes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "op1-nodes")
    roots = connected_components(links(nodes, max_bits))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("component"))
    named = saved(named, "op1-roots")
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_fp = named.select("fp", "component").join(ids, "component").select("fp", "component", "component_id")
    return fps.join(of_fp, "fp").select(*carry, "fp", "component", "component_id")


def deduplicated(documents: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, that with the smallest doc_id (null last);
    of equal ids one. The numbered rows are written once: numbers of two scans
    need not agree. The others' numbers are joined to the rows, as they are
    fewer, and texts move only if there are too many of them to broadcast."""
    numbered, rid = numbered_rows(documents, "op1-rows")
    found = saved(near_duplicates(numbered, words, max_bits, ("doc_id", rid)).select("component", F.col("doc_id").alias("id"), F.col(rid).alias("row")), "op1-found")
    one = (found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))["row"].alias("keep"), F.count(F.lit(1)).alias("n"))
           .where("n > 1").select(F.col("component").alias("c"), "keep"))
    others = found.join(one, F.col("component") == F.col("c")).where("row <> keep").select(F.col("row").alias(rid))
    return without(numbered, others, rid).select(*documents.columns)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
