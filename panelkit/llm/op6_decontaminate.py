"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

An item's windows are its runs of ten consecutive words (an item of fewer
words, but not none, is one window). A window occurs in a document if its
words stand there consecutively. The steps are those of a prefix-filtered
join for containment 1:

1. The shingles (three words, or a whole shorter window) of all windows set
   bits of a bitmap of fixed size. One scan of the corpus keeps, of each
   document, the runs of consecutive positions whose shingles are in the
   bitmap, if a window can fit (length bound). The bitmap has false
   positives only, so no occurrence is lost.
2. Shingles are counted over those runs and ordered by rarity. As all of a
   window must be contained, its necessary prefix is its one rarest shingle.
3. Runs and prefixes are joined on the shingle; the shingle's place in the
   window gives the start, which must leave room for the window (positional
   bound).
4. The words at that place are compared with the window's.

Defined cases: a null or word-less text has no words (documents: zero counts
and no items; items: no window). Repeated rows give a row each; rows of one
item_id are one item; a null item_id is listed as an empty string. Columns
other than doc_id, item_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import ascii_lower, numbered_rows, saved, without

#: Between words once A-Z may stand for a-z: ASCII that is no letter or digit.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
#: Bounds of the bitmap's length in longs, whatever the benchmark's size.
LEAST_LONGS, MOST_LONGS = 1 << 10, 1 << 16


def _joined_words(text: Column) -> Column:
    """The words of a text, case kept, joined by spaces; null for none."""
    t = F.trim(F.regexp_replace(text, SEPARATORS, " "))
    return F.when(t != "", t)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (item string, win string, m int): the distinct windows of each item."""
    words = F.split(ascii_lower(_joined_words(F.col("text"))), " ")
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                              words.alias("w"))
             .where(F.col("w").isNotNull()))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))).alias("i")
    return (items.select("item", "w", at)
            .select("item", F.slice("w", F.col("i"), window).alias("w"))
            .select("item", F.array_join("w", " ").alias("win"), F.size("w").alias("m"))
            .distinct())


def _window_shingles(windows: DataFrame) -> DataFrame:
    """Rows (win, m, off, sh): every shingle of every distinct window."""
    w = windows.select("win", "m").distinct().withColumn("w", F.split("win", " "))
    k = F.least(F.lit(SHINGLE), F.col("m"))
    return (w.select("win", "m", "w", k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("m") - k)).alias("off"))
            .select("win", "m", "off", "k", F.array_join(F.slice("w", F.col("off") + 1, F.col("k")), " ").alias("sh")))


def _hash(get, k: int) -> Column:
    return F.xxhash64(*[get(j) for j in range(k)])


def _bitmap(shingles: DataFrame) -> list[int]:
    """Longs with a bit set for each shingle's hash; their number follows the
    shingles up to MOST_LONGS, so the driver holds 512 KB at most. A fuller
    bitmap only lets more candidates through."""
    n = shingles.count()
    longs = LEAST_LONGS
    while longs < MOST_LONGS and longs * 8 < n:
        longs *= 2
    w = F.split(F.lower("sh"), " ")
    # a shorter shingle has null third words, which the hash skips
    h = _hash(lambda j: F.get(w, F.lit(j)), SHINGLE)
    one = F.lit(1).cast("long")
    bits = (shingles.select(h.alias("h")).distinct()
            .groupBy(_slot(F.col("h"), longs).alias("id"))
            .agg(F.bit_or(F.call_function("shiftleft", one, _bit(F.col("h")))).alias("v")))
    out = [0] * longs
    for r in bits.collect():  # at most MOST_LONGS rows
        out[r["id"]] = r["v"]
    return out


def _slot(h: Column, longs: int) -> Column:
    return F.shiftright(h, 6).bitwiseAND(F.lit(longs - 1).cast("long")).cast("int")


def _bit(h: Column) -> Column:
    return h.bitwiseAND(F.lit(63).cast("long")).cast("int")


def _runs(documents: DataFrame, bits: list[int], shapes: list[tuple[int, int]], carry: list[str]) -> DataFrame:
    """Per document its word count and the runs that can hold a window.

    shapes: (k, least length) for each shingle length in use. A run of
    positions a..b stands for the words a..b+k-1, stored once.
    """
    # one literal, folded to an array when the plan is made
    bitmap = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")
    df = documents.select(*carry, _joined_words(F.col("text")).alias("raw"))
    # lower() also changes letters beyond A-Z, but equally in equal words: it
    # can only add candidates, and the words kept are lower-cased exactly
    df = df.select(*carry, F.split("raw", " ").alias("w"), F.split(F.lower("raw"), " ").alias("lw"))
    n = F.coalesce(F.size("w"), F.lit(0))
    df = df.withColumn("n_words", F.when(F.col("w").isNull(), 0).otherwise(n))

    def kept(k: int, least: int) -> Column:
        def in_bitmap(i):
            h = _hash(lambda j: F.get("lw", i + j), k)
            return F.getbit(F.get(bitmap, _slot(h, len(bits))), _bit(h)) == 1
        at = F.filter(F.sequence(F.lit(0), F.col("n_words") - k), in_bitmap)
        return F.when(F.col("n_words") >= k, at).otherwise(F.array().cast("array<int>"))

    df = df.select(*carry, "n_words", "w", *[kept(k, least).alias(f"at{k}") for k, least in shapes])
    def spans(k: int, least: int) -> Column:
        p = F.col(f"at{k}")
        first = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        last = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
        runs = F.filter(F.zip_with(first, last, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                        lambda s: s["b"] - s["a"] + 1 >= least)
        return F.transform(runs, lambda s: F.struct(
            F.lit(k).alias("k"), s["a"].alias("a"),
            ascii_lower(F.array_join(F.slice("w", s["a"] + 1, s["b"] - s["a"] + k), " ")).alias("words")))

    parts = [spans(k, least) for k, least in shapes]
    return df.select(*carry, F.col("n_words").cast("long").alias("n_words"), F.concat(*parts).alias("runs"))


def _placed(runs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (rid, n_words, a, len, i, lo, sh, near): each shingle of a run with
    the words around it that a window can reach, not with the run."""
    def place(i):
        lo = F.greatest(i - (window - 1), F.lit(0))
        return F.struct(i.alias("i"), lo.alias("lo"), F.array_join(F.slice("w", i + 1, F.col("k")), " ").alias("sh"),
                        F.slice("w", lo + 1, F.lit(2 * window)).alias("near"))
    places = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("k")), place)
    return runs.select("rid", "n_words", "a", F.size("w").alias("len"), F.inline(places))


def occurrences(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                numbers: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, found, windows). ``numbers`` names a column that numbers the
    rows; without it they are numbered here.

    texts: a row per document (rid, doc_id, n_words, runs). found: a row for
    each place where a window occurs (rid, start, m, win), with the first
    word's index and the number of words. windows: see benchmark_windows.
    """
    windows = saved(benchmark_windows(benchmark, window), "op6-windows")
    shingles = saved(_window_shingles(windows), "op6-shingles")
    shapes = [(r["k"], r["least"]) for r in  # at most SHINGLE rows
              shingles.groupBy("k").agg((F.min("m") - F.col("k") + 1).alias("least")).orderBy("k").collect()]
    rid = F.monotonically_increasing_id() if numbers is None else F.col(numbers)
    docs = documents.select("doc_id", "text", rid.alias("rid"))
    texts = saved(_runs(docs, _bitmap(shingles), shapes or [(SHINGLE, 1)], ["rid", "doc_id"]), "op6-runs")

    runs = texts.where(F.size("runs") > 0).select("rid", "n_words", F.explode("runs").alias("r"))
    runs = runs.select("rid", "n_words", "r.k", "r.a", F.split("r.words", " ").alias("w"))
    placed = _placed(runs, window)

    counts = placed.groupBy("sh").agg(F.count(F.lit(1)).alias("n"))
    by_rarity = Window.partitionBy("win").orderBy("n", "off")
    prefix = (shingles.join(counts, "sh", "left").fillna(0, ["n"])
              .withColumn("place", F.row_number().over(by_rarity))
              .where((F.col("place") == 1) & (F.col("n") > 0))
              .select("sh", "win", "m", "off"))

    start = F.col("i") - F.col("off")
    found = (placed.join(prefix, "sh")
             .where((start >= 0) & (start + F.col("m") <= F.col("len")) & (F.col("m") <= F.col("n_words")))
             .where(F.array_join(F.slice("near", start - F.col("lo") + 1, F.col("m")), " ") == F.col("win"))
             .select("rid", (F.col("a") + start).alias("start"), "m", "win"))
    return texts, found, windows


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per document row: doc_id, n_words, n_hit (words inside an
    occurrence), items (sorted strings), contaminated."""
    texts, found, windows = occurrences(documents, benchmark, window)
    found = saved(found, "op6-found")
    # the share of sorted intervals that reaches beyond what is covered so far
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("m")).alias("end"))))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).alias("n"),
                              F.greatest(s["end"], x["end"]).alias("end")),
        lambda s: s["n"].cast("long"))
    hit = found.groupBy("rid").agg(covered.alias("n_hit"))
    # two texts with one passage find the same windows: items come by distinct (document, item)
    items = (found.select("rid", "win").distinct().join(windows.select("win", "item"), "win")
             .groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items")))
    none = F.array().cast("array<string>")
    return (texts.select("rid", "doc_id", "n_words").join(hit, "rid", "left").join(items, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated")))


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any window. The numbered rows are written once:
    numbers of two scans need not agree."""
    numbered, rid = numbered_rows(documents, "op6-rows")
    _, found, _ = occurrences(numbered, benchmark, window, rid)
    return without(numbered, found.select(F.col("rid").alias(rid)).distinct(), rid).select(*documents.columns)


def digest(result: DataFrame) -> DataFrame:
    """The query's columns."""
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, i, i + 9), ' ') AS win, least(len(w), 10) AS m
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT rid, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS win
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m)),
f AS (SELECT DISTINCT dw.rid, dw.i, dw.m, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.m = bw.m),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM f) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item FROM f) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN it USING (rid)
"""
