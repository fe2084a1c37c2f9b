"""Conversation structure repair by an auction shortest-path algorithm.

A conversation is to have role initials (s?(ua)+)?. Its cheapest repair is a
shortest path in a lattice: nodes are (rows consumed, state of the pattern),
arcs are edits with integer costs. Delete (3), Keep (0) and Rerole (2) consume
a row, Insert (2) adds an empty message; a truncated row that stays costs 1
more, a blank or duplicate row can only be deleted. From every state one role
follows for a Rerole or an Insert, so the edits' letters fix the result.

``auction`` finds a shortest path by node prices p with p(i) <= cost + p(j) on
every arc: the path is extended along a tight arc, or, where none is tight, the
price of its end rises to the least cost + p(j) and the path is contracted. Prices
start at a sum of the rows' least costs, which satisfies the inequality. When the
path reaches the goal the prices solve the dual, so every shortest path runs
on tight arcs; those that lead to the goal are walked with the least letter
first (D, I, K, R), which gives the ASCII-least of the cheapest edits.

Distribution: rows are sorted into ranges by conversation and turn, so a
conversation may span ranges, and are cut into blocks of 2^BITS rows. A
conversation inside one block is one lattice. One that spans blocks, of any
length, is solved by a tree of blocks: each block's costs between the states
at its ends, by the auction; the same over 2^BITS blocks as arcs of a coarser lattice, level by
level; then down again the exact prices at every block's end, and in the same
way the states in which the trace enters each block. No task holds more than
2^BITS rows or blocks of one conversation. Only the last step, which hands out
a conversation in its order, reads it in one task, row by row.

Defined cases: a null role or text counts as one space (so a null text is
blank), a null id or turn as one space in the damage key; null ids form one
conversation; rows of equal turn are ordered by role, then by the SHA-256 of
the text; repeated rows are rows, of which all but the first are duplicates; a role by any
other name counts by its first letter, an empty one by none; a conversation that loses all rows is
returned with zeros; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import saved

#: Costs and damage (fixed values).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
DROPS, EMPTIES, UNENDS, REPEATS, MAKES_USER, KINDS = 0, 1, 2, 3, 4, 20
BITS = 8
ROWS_A_RANGE = 500_000
NEVER = 1 << 60
#: States of the pattern: nothing yet, after system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The state that a Rerole or an Insert leads to, and the roles' names.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
END = (0, NEVER, NEVER, 0)

Arcs = list[list[tuple[int, int, str]]]


# --- the lattice and the auction -------------------------------------------

def row_lattice(codes: str, exits: tuple[int, ...], last: bool) -> tuple[Arcs, list[int]]:
    """(arcs (head, cost, letter) by node, starting prices) of rows given by
    one code each: x must go; s, u, a, o is the role's initial, upper case if
    truncated. The goal is the last node; ``exits`` are the costs from the
    states after the last row. Inserts stand before a row, and after the last
    one only in the last block."""
    n = len(codes)
    goal = STATES * (n + 1)
    arcs: Arcs = [[] for _ in range(goal + 1)]
    for i in range(n + 1):
        for s in range(STATES):
            out = arcs[STATES * i + s]
            if i < n:
                after, code = STATES * (i + 1), codes[i].lower()
                out.append((after + s, DELETE, "D"))
                if code != "x":
                    extra = TRUNCATED * codes[i].isupper()
                    kept = KEPT.get((s, code))
                    if kept is not None:
                        out.append((after + kept, KEEP + extra, "K"))
                    out.append((after + NEXT[s], REROLE + extra, "R"))
            elif exits[s] < NEVER:
                out.append((goal, exits[s], ""))
            if i < n or last:
                out.append((STATES * i + NEXT[s], INSERT, "I"))
    least = [min(DELETE, TRUNCATED) if c.isupper() else DELETE if c == "x" else KEEP for c in codes]
    return arcs, _prices(least, exits)


def block_lattice(blocks: list[list[int]], exits: tuple[int, ...]) -> tuple[Arcs, list[int]]:
    """The same for blocks, each given by its costs between entry and exit states."""
    n = len(blocks)
    goal = STATES * (n + 1)
    arcs: Arcs = [[] for _ in range(goal + 1)]
    for k, m in enumerate(blocks):
        for s in range(STATES):
            arcs[STATES * k + s] = [(STATES * (k + 1) + e, m[STATES * s + e], "") for e in range(STATES) if m[STATES * s + e] < NEVER]
    for s in range(STATES):
        if exits[s] < NEVER:
            arcs[STATES * n + s].append((goal, exits[s], ""))
    return arcs, _prices([min(m) for m in blocks], exits)


def _prices(least: list[int], exits: tuple[int, ...]) -> list[int]:
    """No more than any cost from a node to the goal, and tight nowhere too much."""
    price, out = min(exits), [0]
    for x in [0, *least[::-1]]:
        price += x
        out += [price] * STATES
    return out[::-1]


def reaching(arcs: Arcs, tight: list[int] | None = None) -> list[bool]:
    """Which nodes reach the goal, by all arcs or by those tight at the prices ``tight``."""
    back: list[list[int]] = [[] for _ in arcs]
    for i, out in enumerate(arcs):
        for j, cost, _ in out:
            if tight is None or tight[i] == cost + tight[j]:
                back[j].append(i)
    seen = [False] * len(arcs)
    todo, seen[-1] = [len(arcs) - 1], True
    while todo:
        for i in back[todo.pop()]:
            if not seen[i]:
                seen[i] = True
                todo.append(i)
    return seen


def auction(arcs: Arcs, price: list[int], origin: int) -> None:
    """Raises the prices, which must satisfy p(i) <= cost + p(j), until a path
    from ``origin`` to the goal, the last node, is tight; then price[origin] is its
    length (NEVER if there is none). Prices of earlier origins remain right."""
    goal, path = len(arcs) - 1, [origin]
    while path[-1] != goal:
        i = path[-1]
        best, to = NEVER, -1
        for j, cost, _ in arcs[i]:
            if cost + price[j] < best:
                best, to = cost + price[j], j
        if price[i] < best:  # contract
            price[i] = best
            if len(path) > 1:
                path.pop()
        elif to < 0:
            return
        else:
            path.append(to)


def _priced(arcs: Arcs, price: list[int], origins: range | tuple[int, ...]) -> list[int]:
    """The prices after an auction from each origin; nodes without a way to the goal are NEVER."""
    price = [p if ok else NEVER for p, ok in zip(price, reaching(arcs))]
    for s in origins:
        if price[s] < NEVER:
            auction(arcs, price, s)
    return price


def costs_between(lattice) -> list[int]:
    """The least costs from each entry to each exit state; ``lattice`` gives
    arcs and prices for exit costs."""
    by_exit = []
    for e in range(STATES):
        arcs, price = lattice(tuple(0 if s == e else NEVER for s in range(STATES)))
        by_exit.append(_priced(arcs, price, range(STATES))[:STATES])
    return [by_exit[e][s] for s in range(STATES) for e in range(STATES)]


@lru_cache(1 << 12)
def row_costs(codes: str, last: bool) -> list[int]:
    return costs_between(lambda exits: row_lattice(codes, exits, last))


def block_costs(blocks: list[list[int]]) -> list[int]:
    return costs_between(lambda exits: block_lattice(blocks, exits))


def prices_after(blocks: list[list[int]], exits: tuple[int, ...]) -> list[list[int]]:
    """For each block the exact costs from its exit states to the goal; NEVER off the shortest paths."""
    arcs, price = block_lattice(blocks, exits)
    price = _priced(arcs, price, range(STATES))
    alive = reaching(arcs, price)
    return [[price[i] if alive[i] and price[i] < NEVER else NEVER for i in range(STATES * (k + 1), STATES * (k + 2))]
            for k in range(len(blocks))]


@lru_cache(1 << 14)
def trace(codes: str, entry: int, exits: tuple[int, ...] = END, last: bool = True) -> tuple[int, int, tuple[str, ...]] | None:
    """(cost, exit state, the edits of each row with the inserts before it) of
    the ASCII-least shortest path; inserts after the last row stand with that row."""
    arcs, price = row_lattice(codes, exits, last)
    price = _priced(arcs, price, (entry,))
    if price[entry] >= NEVER:
        return None
    alive = reaching(arcs, price)
    node, goal, here, rows = entry, len(arcs) - 1, "", []
    while node != goal:
        letter, to = min((x, j) for j, cost, x in arcs[node] if alive[j] and price[node] == cost + price[j])
        here += letter
        if to != goal and to // STATES > node // STATES:
            rows.append(here)
            here = ""
        if to == goal:
            end = node % STATES
        node = to
    if rows:
        rows[-1] += here
    return price[entry], end, tuple(rows)


# --- rows after damage ------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) after the damage; a dropped row
    stays as one marked gone, without text."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind, role, text = F.col("kind"), F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % KINDS).alias("kind"))
    text = F.when(kind.isin(DROPS, EMPTIES), "").when(kind == UNENDS, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == REPEATS, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(kind == MAKES_USER, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (kind == DROPS).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows in ranges by conversation and turn, numbered by ``pos`` in that
    order, with the marks of blank and truncated texts and the text's hash.
    Rows equal in all columns are spread by their place in the input."""
    trimmed = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumns({"h": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "blank": trimmed == "",
                             "truncated": (trimmed != "") & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "__at": F.monotonically_increasing_id()})
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h"), F.col("__at")]
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_A_RANGE))
    sorted_ = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("__at")
    return saved(sorted_.withColumn("pos", F.monotonically_increasing_id()), "op13-rows")


def coded(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, fault, code) of ``ordered`` rows that are not gone. The fault
    is b, d, t or empty; the first of equal messages is the least position of
    their group, a partial aggregate, joined back to the groups that repeat."""
    light = rows.where(~F.col("gone")).select("conv_id", "pos", "role", "h", "blank", "truncated")
    again = (light.where(~F.col("blank")).groupBy("conv_id", "role", "h").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("g"), "first"))
    got = light.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("g")), "left")
    fault = F.when(F.col("blank"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("truncated"), "t").otherwise("")
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (got.select("conv_id", "pos", fault.alias("fault"), code.alias("code"))
            .withColumn("code", F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper("code")).otherwise(F.col("code"))))


def blocked(codes: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows (conv_id, node, pos array, fault array, codes, whole, last): a conversation's rows in one
    block of 2^bits numbers; whole: it has no others; last: its last block."""
    block = F.shiftright("pos", bits)
    ends = codes.groupBy("conv_id").agg(F.min(block).alias("lo"), F.max(block).alias("hi")).withColumnRenamed("conv_id", "c")
    rows = F.array_sort(F.collect_list(F.struct("pos", "fault", "code")))
    parts = codes.groupBy("conv_id", block.alias("node")).agg(rows.alias("rows"))
    return parts.join(ends, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "node", F.col("rows.pos").alias("pos"), F.col("rows.fault").alias("fault"), F.array_join("rows.code", "").alias("codes"),
        (F.col("lo") == F.col("hi")).alias("whole"), (F.col("node") == F.col("hi")).alias("last"))


# --- conversations that span blocks ----------------------------------------

def _kind(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _folded(nodes: DataFrame, bits: int, value: str, kind: str, fold) -> DataFrame:
    """Rows (conv_id, node, ``value``) of the parents: ``fold`` of the children's values in order."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        return pa.table({"conv_id": t["conv_id"][:1], "node": t["up"][:1], value: pa.array([fold(t[value].to_pylist())], t[value].type)})
    return (nodes.select("conv_id", "node", value, F.shiftright("node", bits).alias("up")).groupBy("conv_id", "up")
            .applyInArrow(run, f"conv_id {_kind(nodes)}, node long, {value} {kind}"))


def _handed(parents: DataFrame, children: DataFrame, bits: int, given: str, value: str, kind: str, spread) -> DataFrame:
    """Rows (conv_id, node, ``given``) of the children: ``spread`` of their values in order and of what the parent was given."""
    above = parents.select(F.col("conv_id").alias("c"), F.col("node").alias("up"), given)
    below = children.select("conv_id", "node", value)
    both = below.join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.shiftright("node", bits) == F.col("up"))).drop("c")

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        out = spread(t[value].to_pylist(), t[given][0].as_py())
        return pa.table({"conv_id": t["conv_id"], "node": t["node"], given: pa.array(out, t[given].type)})
    return both.groupBy("conv_id", "up").applyInArrow(run, f"conv_id {_kind(children)}, node long, {given} {kind}")


def _through(leaves: DataFrame, bits: int, value: str, kind: str, fold, given: str, given_kind: str, start, spread) -> DataFrame:
    """Rows (conv_id, node, ``given``) for the leaves: values folded up a tree, until each
    conversation is one node that is given ``start``, and handed down again."""
    levels = [leaves]
    while levels[-1].groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        levels.append(saved(_folded(levels[-1], bits, value, kind, fold), f"op13-up-{value}"))
    out = levels[-1].select("conv_id", "node", start.cast(given_kind).alias(given))
    for children in levels[-2::-1]:
        out = saved(_handed(out, children, bits, given, value, given_kind, spread), f"op13-down-{given}")
    return out


def _after(steps: list[list[int]], state: int) -> list[int]:
    """The states before each step."""
    out = []
    for f in steps:
        out.append(state)
        state = f[state] if state >= 0 else -1
    return out


def _composed(steps: list[list[int]]) -> list[int]:
    return [_after([*steps, [0] * STATES], s)[-1] for s in range(STATES)]


def _with(blocks: DataFrame, column: str, kind: str, value) -> DataFrame:
    """The blocks with a column ``value`` of (codes, last[, exits])."""
    names = [c for c in ("codes", "last", "exits") if c in blocks.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [value(*x) for x in zip(*[b.column(c).to_pylist() for c in names])]
            kind_ = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, kind_)], [*b.schema.names, column])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema)
    return blocks.mapInArrow(run, f"{schema}, {column} {kind}")


def _leaf_steps(codes: str, last: bool, exits: list[int]) -> list[int]:
    got = [trace(codes, s, tuple(exits), last) for s in range(STATES)]
    return [-1 if g is None else g[1] for g in got]


def entered(split: DataFrame, bits: int = BITS) -> DataFrame:
    """The blocks of conversations that span several, with the exact prices at
    their ends (exits) and the state in which the trace enters (entry)."""
    longs = "array<bigint>"
    costs = saved(_with(split, "cost", longs, lambda codes, last: list(row_costs(codes, last))), "op13-costs")
    exits = _through(costs, bits, "cost", longs, block_costs, "exits", longs, F.array(*[F.lit(x) for x in END]),
                     lambda blocks, given: prices_after(blocks, tuple(given)))
    key = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("k"))
    named = exits.select(F.col("conv_id").alias("c"), F.col("node").alias("k"), "exits")
    steps = saved(_with(split.join(named, key).drop("c", "k"), "step", longs, _leaf_steps), "op13-steps")
    entries = _through(steps, bits, "step", longs, _composed, "entry", "bigint", F.lit(START), _after)
    named = entries.select(F.col("conv_id").alias("c"), F.col("node").alias("k"), "entry")
    return steps.join(named, key).drop("c", "k", "step")


def decisions(codes: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows (conv_id, pos, fault, edits): the edits of each row, the inserts before it first."""
    blocks = saved(blocked(codes, bits), "op13-blocks")
    whole = blocks.where("whole").withColumns({"exits": F.array(*[F.lit(x).cast("long") for x in END]), "entry": F.lit(START).cast("long")})
    split = blocks.where("not whole")
    if split.limit(1).count():
        whole = whole.unionByName(entered(split, bits))
    kind = _kind(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [trace(c, s, tuple(x), end)[2] for c, s, x, end in
                    zip(*[b.column(n).to_pylist() for n in ("codes", "entry", "exits", "last")])]
            at = b.column("pos")
            owner = pa.array([i for i, r in enumerate(rows) for _ in r], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").take(owner), at.flatten(), b.column("fault").flatten(), pa.array([e for r in rows for e in r], pa.string())],
                ["conv_id", "pos", "fault", "edits"])
    return whole.select("conv_id", "pos", "fault", "codes", "entry", "exits", "last").mapInArrow(
        run, f"conv_id {kind}, pos long, fault string, edits string")


# --- repaired conversations -------------------------------------------------

def _parts(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of not much more than ``most`` bytes."""
    for b in batches:
        step = max(1, min(4096, b.num_rows * most // max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, was, fault, edit, role, text): all edits of the conversations, each
    conversation in order in one partition. ``was`` is the role before; role and text are null for a
    deleted message; an inserted one has no turn. A dropped row has no edit."""
    kind, turn = _kind(rows), rows.schema["turn"].dataType.simpleString()
    texts = rows.select("conv_id", "pos", F.lit(1).alias("k"), "turn", "role", "text", "gone", F.lit(None).cast("string").alias("fault"),
                        F.lit(None).cast("string").alias("edits"))
    both = texts.unionByName(decided.withColumn("k", F.lit(0)), allowMissingColumns=True)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(n, "conv_id").sortWithinPartitions("conv_id", "pos", "k")
    names = ["conv_id", "turn", "was", "fault", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, fault, edits = object(), START, None, None
        for b in _parts(batches):
            cols = [b.column(c).to_pylist() for c in ("conv_id", "k", "turn", "role", "text", "gone", "fault", "edits")]
            out, owner = [], []
            for i, (c, k, turn_, role, text, gone, f, e) in enumerate(zip(*cols)):
                if c != conv:
                    conv, state = c, START
                if k == 0:
                    fault, edits = f, e
                    continue
                if gone:
                    owner.append(i)
                    out.append((turn_, role, None, None, None, None))
                    continue
                for x in edits:
                    owner.append(i)
                    if x == "D":
                        out.append((turn_, role, fault, x, None, None))
                    elif x == "K":
                        state = KEPT[state, role[:1]]
                        out.append((turn_, role, fault, x, role, text))
                    else:
                        state = NEXT[state]
                        out.append((turn_, role, fault, x, ROLES[state], text) if x == "R" else (None, None, None, x, ROLES[state], ""))
            if out:
                got = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id").take(pa.array(owner)), pa.array(got[0], b.column("turn").type), *[pa.array(g, pa.string()) for g in got[1:]]], names)
    return both.mapInArrow(run, f"conv_id {kind}, turn {turn}, was string, fault string, edit string, role string, text string")


class _Tally:
    """The report of one conversation, from its rows in order."""

    def __init__(self):
        self.turns, self.low, self.high = 0, None, None
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.cost = 0
        self.before, self.audit, self.sha = None, [], hashlib.sha256()
        self.lines = False

    def add(self, turn, was, fault, edit, role, text):
        if edit is None:
            return
        self.audit.append(edit)
        self.cost += {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[edit] + TRUNCATED * (fault == "t" and edit != "D")
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None and turn != self.high:
                self.turns += 1
                self.low = turn if self.low is None else self.low
                self.high = turn
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
        if role is not None:
            self.sha.update((f"\n{role}:{text}" if self.lines else f"{role}:{text}").encode())
            self.lines = True

    def row(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def report(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repaired``, read in that order."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, tally, kind = None, None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([c], kind) for c in [conv]] + [
                pa.array([v], pa.int64() if isinstance(v, int) else pa.string()) for v in tally.row()], names)
        for b in _parts(batches):
            kind, done = b.column(0).type, []
            for c, *rest in zip(*[x.to_pylist() for x in b.columns]):
                if tally is None or c != conv:
                    if tally is not None:
                        done.append(row())
                    conv, tally = c, _Tally()
                tally.add(*rest)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if tally is not None:
            yield row()
    counts = ", ".join(f"{n} long" for n in names[1:7])
    return edits.mapInArrow(run, f"conv_id {_kind(edits)}, {counts}, audit string, repaired_sha256 string")


def repair(damaged: DataFrame, bits: int = BITS) -> DataFrame:
    """All edits of the conversations (see ``repaired``); rows: conv_id, turn, role, text, gone."""
    rows = ordered(damaged)
    return repaired(rows, decisions(coded(rows), bits))


def digest(conversations: DataFrame, bits: int = BITS) -> DataFrame:
    return report(repair(damage(conversations), bits))
