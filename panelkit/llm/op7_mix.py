"""Mixing sources to target weights with fixed-length blocks (DataFrame functions only).

Targets: the sources weigh 3, 1, 2, repeating, by code point with null last,
and share 150 % of all words; no target exceeds twice its source's size, the
excess being reshared by weight (in closed form: target = min(2 size,
level x weight), the level found over the sorted source table).

Packing: a source's documents stand in a pseudorandom order (a hash of id,
size and text), one after the other, and are cut into blocks of ``block_words``
words (the last may be shorter).

Shards: the mix is dealt to shards of about ``shard_slots`` slots. A shard's
source counts are multinomial: every draw of a source falls into a shard by a
hashed variate of its own, independently of the others, and the draws in
each are counted, so each source's counts over the shards are multinomial
with its exact number of draws. Running totals over the shards then give each
shard's slots of a source their range of the source's draw numbers.

Permutations: a source is drawn in epochs; the k-th draw of an epoch takes
the full block of rank k in the order of a hash of (source, epoch, block),
a pseudorandom permutation of the block numbers, and the short block at a
hashed rank. Slots and blocks are joined by that number. The last block of the last epoch
is cut to fit. Targets are at most twice the size, so no block is drawn
more than twice, and each source gets its target to the word.

All of it derives from the data: reruns agree. Defined cases: a null or
word-less text has size 0 and takes 0; a null source is a source; repeated
rows are packed each (equal rows are interchangeable); a null doc_id hashes
like -1; an empty table gives no rows. Columns other than doc_id, text and
source are ignored. The table of sources (a row each, never of documents) is
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import SPACES, running_total, saved

BLOCK_WORDS = 128
SHARD_SLOTS = 8192
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
WEIGHTS = (3, 1, 2)
#: Hash of small integers: x times MUL modulo the prime MOD.
MOD, MUL = 2147483647, 48271
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 12


def hashed(*parts: Column) -> Column:
    """A number below 2^60 from the first hex digits of an MD5 of the parts."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def sizes(documents: DataFrame, *carry: str) -> DataFrame:
    """Rows (doc_id, source, size long, h long, *carry), one for each document row; h hashes id, size and text."""
    text = F.coalesce("text", F.lit(""))
    n = F.regexp_count(text, F.lit(WORD)).cast("long")
    rows = documents.select("doc_id", "source", n.alias("size"), F.md5(text.cast("binary")).alias("t"), *carry)
    return rows.select("doc_id", "source", "size", hashed(F.coalesce("doc_id", F.lit(-1)), F.col("size"), F.col("t")).alias("h"), *carry)


def targets(sized: DataFrame) -> DataFrame:
    """Rows (source, sid, source_size, target, take): a row per source."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    src = src.withColumn("sid", rank)
    src = src.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), F.col("sid") % len(WEIGHTS) + 1))
    # capped sources are those whose cap per weight lies lowest
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    src = (src.withColumn("cap", F.col("source_size") * float(MAX_REPEATS))
           .withColumn("left", F.sum("source_size").over(every) * TOTAL_SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("w_left")))
    # the first source, in that order, that its level does not cap sets the level of all after it
    free = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    src = src.withColumn("level", F.first(free, ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    src = src.withColumn("target", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w"))))
    return src.select("source", "sid", "source_size", "target",
                      F.least(F.round("target").cast("long"), F.col("source_size") * MAX_REPEATS).alias("take"))


def pieces(sized: DataFrame, targeted: DataFrame, n_rows: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (rid, sid, block, at, words): the words [at, at + words) of a block that a document fills."""
    docs = (sized.join(targeted.select(F.col("source").alias("s"), "sid"), F.col("source").eqNullSafe(F.col("s")))
            .where(F.col("size") > 0).select("rid", "sid", "size", "h"))
    docs = running_total(docs, ["sid"], ["h", "size"], F.col("h"), "size", "begin", n_rows)
    end = F.col("begin") + F.col("size")
    at = F.explode(F.sequence(_div("begin", block_words), _div(end - 1, block_words)))
    part = docs.select("rid", "sid", "begin", end.alias("end"), at.alias("block"))
    lo = F.greatest("begin", F.col("block") * block_words)
    hi = F.least("end", (F.col("block") + 1) * block_words)
    return part.select("rid", "sid", "block", (lo - F.col("block") * block_words).alias("at"), (hi - lo).alias("words"))


def _div(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def _numbered(df: DataFrame, n: Column, name: str) -> DataFrame:
    """A row for each number below ``n`` (column ``name``), made in chunks, so
    that a large count is dealt to many tasks."""
    first = F.lit(0).cast("long")
    df = df.where(n > 0).select("*", n.alias("__n")).select("*", F.explode(F.sequence(first, _div(F.col("__n") - 1, CHUNK))).alias("__c"))
    df = df.repartition("sid", "__c")
    last = F.least(F.col("__n"), (F.col("__c") + 1) * CHUNK) - 1
    return df.select("*", F.explode(F.sequence(F.col("__c") * CHUNK, last)).alias(name)).drop("__n", "__c")


def epochs(targeted: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (sid, epoch, want, full, short, z, n, before): the passes over each
    source, their words, full blocks, length and rank of the short block,
    draws, and the source's draws before."""
    size, want = F.col("source_size"), F.col("want")
    e = _passes(targeted)
    u = F.col("sid") * (MAX_REPEATS + 1) + F.col("epoch") + 1
    h = u * MUL % MOD * MUL % MOD * MUL % MOD * MUL % MOD
    e = (e.withColumn("full", _div(size, block_words)).withColumn("short", F.pmod(size, F.lit(block_words)))
         # the short last block is drawn at a hashed rank, the full ones are permuted around it
         .withColumn("z", F.when(F.col("short") > 0, h % (F.col("full") + 1)).otherwise(F.col("full"))))
    ends = F.col("z") * block_words + F.col("short")
    lack = F.when((F.col("short") > 0) & (want > ends), block_words - F.col("short")).otherwise(0)
    e = e.withColumn("n", _div(want + lack + block_words - 1, block_words))
    earlier = Window.partitionBy("sid").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    return e.select("sid", "epoch", "want", "full", "short", "z", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def shard_counts(passes: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Rows (shard, sid, n, first): the multinomial counts of each shard, and
    the number of the source's draws that stand before the shard's."""
    totals = passes.groupBy("sid").agg(F.sum("n").alias("draws"))
    shards = F.greatest(_div(passes.agg(F.sum("n")).scalar() + (shard_slots - 1), shard_slots), F.lit(1).cast("long"))
    thrown = _numbered(totals, F.col("draws"), "i").select("sid", F.pmod(hashed(F.lit("shard"), F.col("sid"), F.col("i")), shards).alias("shard"))
    counts = saved(thrown.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n")), "op7-shards")
    return running_total(counts, ["sid"], ["shard"], F.col("shard"), "n", "first", counts.count())


def block_ranks(passes: DataFrame) -> DataFrame:
    """Rows (sid, epoch, rank, block): the permutation of a pass's full blocks."""
    blocks = _numbered(passes.select("sid", "epoch", "full"), F.col("full"), "block")
    blocks = saved(blocks.select("sid", "epoch", "block", hashed(F.lit("block"), F.col("sid"), F.col("epoch"), F.col("block")).alias("h"),
                                 F.lit(1).cast("long").alias("one")), "op7-blocks")
    return (running_total(blocks, ["sid", "epoch"], ["h", "block"], F.col("h"), "one", "rank", blocks.count())
            .select("sid", "epoch", "rank", "block"))


def draws(targeted: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Rows (shard, slot, sid, epoch, block, take): the block each output slot
    holds and how many of its words."""
    passes = saved(epochs(targeted, block_words), "op7-epochs")
    counts = shard_counts(passes, shard_slots)
    listed = passes.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct(  # at most MAX_REPEATS
        "epoch", "before", "n", "want", "full", "short", "z"))).alias("es"))
    slots = counts.join(listed, "sid").select("shard", "sid", "first", "es", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("j"))
    i = F.col("first") + F.col("j")
    e = F.filter("es", lambda x: (x["before"] <= i) & (i < x["before"] + x["n"]))[0]
    slots = slots.select("shard", "sid", "j", e.alias("e"), (i - e["before"]).alias("k"))
    slots = slots.select("shard", "sid", "j", "k", "e.epoch", "e.want", "e.full", "e.short", "e.z")
    mixed = Window.partitionBy("shard").orderBy(hashed(F.lit("slot"), F.col("shard"), F.col("sid"), F.col("j")), "sid", "j")
    slots = slots.withColumn("slot", F.row_number().over(mixed) - 1)
    is_short = (F.col("short") > 0) & (F.col("k") == F.col("z"))
    after = (F.col("short") > 0) & (F.col("k") > F.col("z"))
    begin = F.col("k") * block_words - F.when(after, block_words - F.col("short")).otherwise(0)
    take = F.least(F.when(is_short, F.col("short")).otherwise(F.lit(block_words)), F.col("want") - begin)
    rank = F.when(~is_short, F.col("k") - after.cast("long"))
    slots = slots.select("shard", "slot", "sid", "epoch", "full", rank.alias("rank"), take.alias("take"))
    # both sides are made by explode, whose rows Spark's size estimates don't see: no broadcast
    got = slots.join(block_ranks(passes).hint("merge"), ["sid", "epoch", "rank"], "left")
    return got.select("shard", "slot", "sid", "epoch", F.when(F.col("rank").isNull(), F.col("full")).otherwise(F.col("block")).alias("block"), "take")


def _passes(targeted: DataFrame) -> DataFrame:
    """Rows (sid, source_size, epoch, want): each pass over a source and the words it takes."""
    t = targeted.where(F.col("take") > 0)
    epoch = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("take") - 1) / F.col("source_size")))).alias("epoch")
    e = t.select("sid", "source_size", "take", epoch)
    return e.select("sid", "source_size", "epoch",
                    F.least("source_size", F.col("take") - F.col("epoch") * F.col("source_size")).alias("want"))


def _prepared(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    sized = saved(sizes(documents).withColumn("rid", F.monotonically_increasing_id()), "op7-sizes")
    return sized, saved(targets(sized), "op7-targets")


def mix(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (doc_id, size, source, source_size, target, taken), one per document row."""
    sized, targeted = _prepared(documents)
    parts = pieces(sized, targeted, sized.count(), block_words)
    drawn = draws(targeted, block_words).select("sid", "block", F.col("take").alias("cut"))
    got = F.least("words", F.greatest(F.lit(0).cast("long"), F.col("cut") - F.col("at")))
    # no broadcast of what explode made: Spark's estimates don't see those rows
    taken = parts.join(drawn.hint("merge"), ["sid", "block"]).groupBy("rid").agg(F.sum(got).alias("taken"))
    t = targeted.select(F.col("source").alias("s"), "source_size", "target")
    return (sized.join(t, F.col("source").eqNullSafe(F.col("s"))).join(taken, "rid", "left")
            .select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def mixed_slots(documents: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix itself: rows (shard, slot, source, text), a slot's words joined
    by spaces. A document's words are cut by its pieces before the join, so
    that no whole text travels with each of its blocks."""
    docs = documents.select("doc_id", "source", "text")
    docs = saved(docs.withColumn("rid", F.monotonically_increasing_id()), "op7-texts")
    sized = saved(sizes(docs, "rid"), "op7-sizes")
    targeted = saved(targets(sized), "op7-targets")
    parts = pieces(sized, targeted, sized.count(), block_words)
    of_doc = parts.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("block", "sid", "at", "words"))).alias("p"))
    words = F.split(F.trim(F.regexp_replace("text", SPACES, " ")), " ")
    texts = docs.select("rid", words.alias("w")).join(of_doc, "rid")
    # a document's pieces follow each other, so the first starts at its first word
    begin = F.col("x.block") * block_words + F.col("x.at") - (F.col("p")[0]["block"] * block_words + F.col("p")[0]["at"])
    cut = (texts.select("w", "p", F.explode("p").alias("x"))
           .select("x.sid", "x.block", "x.at", "x.words", F.slice("w", (begin + 1).cast("int"), F.col("x.words").cast("int")).alias("w")))
    drawn = draws(targeted, block_words, shard_slots)
    got = F.least("words", F.greatest(F.lit(0).cast("long"), F.col("take") - F.col("at"))).cast("int")
    slots = (drawn.hint("merge").join(cut, ["sid", "block"]).where(F.col("take") > F.col("at"))
             .select("shard", "slot", "sid", "at", F.slice("w", F.lit(1), got).alias("w"))
             .groupBy("shard", "slot", "sid").agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("ws")))
    names = targeted.select("sid", "source")
    return (slots.join(names, "sid")
            .select("shard", "slot", "source", F.array_join(F.flatten(F.transform("ws", lambda x: x["w"])), " ").alias("text")))


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _md5(*parts: str) -> str:
    """``hashed`` in SQL."""
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(f'CAST({p} AS VARCHAR)' for p in parts)})), 1, 15) AS BIGINT)"


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS ss FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM s0),
s2 AS (SELECT *, [3.0, 1.0, 2.0][sid % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * ss AS cap FROM s1),
s3 AS (SELECT *, (1.5 * sum(ss) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lvl
       FROM s2 WINDOW o AS (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, first_value(CASE WHEN lvl * w <= cap THEN lvl END IGNORE NULLS) OVER
         (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fl FROM s3),
s5 AS (SELECT source, sid, ss, CASE WHEN fl IS NULL THEN cap ELSE least(cap, fl * w) END AS target FROM s4),
s6 AS (SELECT *, least(round(target)::BIGINT, 2 * ss) AS take FROM s5),
e0 AS (SELECT sid, ss, take, unnest(range(0, (take - 1) // ss + 1)) AS epoch FROM s6 WHERE take > 0),
e1 AS (SELECT sid, ss, epoch, least(ss, take - epoch * ss) AS want, ss // {BLOCK_WORDS} AS nfull, ss % {BLOCK_WORDS} AS short,
              (sid * 3 + epoch + 1) * {MUL} % {MOD} * {MUL} % {MOD} * {MUL} % {MOD} * {MUL} % {MOD} AS h FROM e0),
e2 AS (SELECT *, CASE WHEN short > 0 THEN h % (nfull + 1) ELSE nfull END AS z FROM e1),
e3 AS (SELECT *, (want + CASE WHEN short > 0 AND want > z * {BLOCK_WORDS} + short THEN {BLOCK_WORDS} - short ELSE 0 END
                  + {BLOCK_WORDS} - 1) // {BLOCK_WORDS} AS n FROM e2),
ep AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY sid ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM e3),
sh AS (SELECT greatest(1, (sum(n)::BIGINT + {SHARD_SLOTS} - 1) // {SHARD_SLOTS}) AS shards FROM ep),
th AS (SELECT sid, unnest(range(0, sum(n)::BIGINT)) AS i FROM ep GROUP BY sid),
sc AS (SELECT sid, {_md5("'shard'", "sid", "i")} % (SELECT shards FROM sh) AS shard, count(*) AS n FROM th GROUP BY ALL),
sb AS (SELECT *, shard % (SELECT greatest(1, count(*) // 4096) FROM sc) AS bucket FROM sc),
sf AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY sid ORDER BY bucket, shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM sb),
sl AS (SELECT shard, sid, first + unnest(range(0, n)) AS i FROM sf),
bl AS (SELECT sid, epoch, unnest(range(0, nfull)) AS block FROM ep),
bh AS (SELECT *, {_md5("'block'", "sid", "epoch", "block")} AS h FROM bl),
bk AS (SELECT *, h % (SELECT greatest(1, count(*) // 4096) FROM bl) AS bucket FROM bh),
pm AS (SELECT sid, epoch, block, row_number() OVER (PARTITION BY sid, epoch ORDER BY bucket, h, block) - 1 AS rank FROM bk),
e5 AS (SELECT sl.shard, ep.*, sl.i - ep.before AS k FROM sl JOIN ep ON ep.sid = sl.sid AND sl.i >= ep.before AND sl.i < ep.before + ep.n),
e6 AS (SELECT *, short > 0 AND k = z AS at_short, CASE WHEN short > 0 AND k > z THEN 1 ELSE 0 END AS aft FROM e5),
dr AS (SELECT e6.sid, CASE WHEN at_short THEN nfull ELSE pm.block END AS block,
              least(CASE WHEN at_short THEN short ELSE {BLOCK_WORDS} END,
                    want - (k * {BLOCK_WORDS} - aft * ({BLOCK_WORDS} - short))) AS cut
       FROM e6 LEFT JOIN pm ON pm.sid = e6.sid AND pm.epoch = e6.epoch AND pm.rank = k - aft),
p0 AS (SELECT d.rid, s6.sid, d.size, {_md5("coalesce(doc_id, -1)", "size", "md5(coalesce(text, ''))")} AS h
       FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source WHERE d.size > 0),
p1 AS (SELECT *, h % (SELECT greatest(1, count(*) // 4096) FROM d) AS bucket FROM p0),
p2 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY sid ORDER BY bucket, h, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM p1),
p3 AS (SELECT rid, sid, b, b + size AS e, unnest(range(b // {BLOCK_WORDS}, (b + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM p2),
p4 AS (SELECT rid, sid, block, greatest(b, block * {BLOCK_WORDS}) - block * {BLOCK_WORDS} AS pos,
              least(e, (block + 1) * {BLOCK_WORDS}) - greatest(b, block * {BLOCK_WORDS}) AS words FROM p3),
t AS (SELECT rid, sum(least(words, greatest(0, cut - pos)))::BIGINT AS taken FROM p4 JOIN dr USING (sid, block) GROUP BY rid)
SELECT d.doc_id, d.size, s6.ss AS source_size, s6.target, coalesce(t.taken, 0) AS taken
FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source LEFT JOIN t USING (rid)
"""
