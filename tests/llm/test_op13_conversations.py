"""Repairs against a search over all edits by cost, then letters."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from panelkit.llm import op13_conversations as op

from ..conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    """(every conv_id, rows after damage by conversation)."""
    by = {}
    for c, t, r, x in rows:
        out = by.setdefault(c, [])
        m = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if m == 1:
            x = ""
        if m == 2:
            x = "".join(k for k in x if k not in ".!?")
        if m == 4:
            r = "user"
        out += [(t, r, x)] * (0 if m == 0 else 2 if m == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {c: sorted(v, key=key) for c, v in by.items()}


def follow(state, role):
    """The pattern (s?(ua)+)? as a machine; None where it breaks."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, role))


def brute_repair(rows):
    """(cost, audit, lines), the least of all edits; states keep their least (cost, audit, lines)."""
    seen, faults = set(), []
    for _, r, x in rows:
        if not x.strip(SPACES):
            faults.append("b")
        elif (r, x) in seen:
            faults.append("d")
        else:
            faults.append("t" if x.rstrip(SPACES)[-1] not in ".!?" else "")
        seen.add((r, x))

    def inserts(best):
        for _ in range(4):
            for s, (cost, audit, lines) in list(best.items()):
                for r in ("user", "assistant"):
                    to = follow(s, r[0])
                    if to is not None:
                        new = (cost + 2, audit + "I", lines + (f"{r}:",))
                        best[to] = min(best.get(to, new), new)
        return best
    best = inserts({"": (0, "", ())})
    for (_, r, x), f in zip(rows, faults):
        after = {}
        for s, (cost, audit, lines) in best.items():
            moves = [(s, 3, "D", ())]
            if f not in ("b", "d"):
                t = int(f == "t")
                moves += [(follow(s, r[:1]), t, "K", (f"{r}:{x}",))]
                moves += [(follow(s, n[0]), 2 + t, "R", (f"{n}:{x}",)) for n in ("user", "assistant")]
            for to, c, a, line in moves:
                if to is not None:
                    new = (cost + c, audit + a, lines + line)
                    after[to] = min(after.get(to, new), new)
        best = inserts(after)
    return *min(best[s] for s in ("", "a") if s in best), faults


def expected(rows):
    out = {}
    for c, after in brute_damage(rows).items():
        cost, audit, lines, faults = brute_repair(after)
        turns = {t for t, _, _ in after if t is not None}
        roles = [r[:1] for _, r, _ in after]
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(df, rows, **kw):
    got = op.digest(df, **kw).collect()
    want = expected(rows)
    assert len(got) == len(want) and {r["conv_id"] for r in got} == set(want)
    for r in got:
        mine = tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
        assert mine == want[r["conv_id"]], r["conv_id"]


def conversation(rng, c, n):
    texts = ["Yes.", "No!", "What", "", "  \n", "Why? ", "é.", None, "End.\t"] + [f"Text {i}." for i in range(40)]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None]
    at, out = 0, []
    for k in range(n):
        at += rng.choice([1, 1, 1, 2, 0]) if rng.random() < 0.5 else 1
        role = ("user", "assistant")[k % 2] if rng.random() < 0.6 else rng.choice(roles)
        out.append((c, None if rng.random() < 0.03 else at, role, rng.choice(texts)))
    return out


def test_random_conversations(spark):
    rng = random.Random(1)
    rows = [r for c in range(300) for r in conversation(rng, c, rng.randint(1, 9))]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)


@pytest.mark.parametrize("bits", [2])
def test_conversations_that_span_blocks(spark, bits):
    rng = random.Random(bits)
    rows = [r for c in range(12) for r in conversation(rng, c, rng.randint(1, 40))] + conversation(rng, 99, 90)
    check(spark.createDataFrame(rows, SCHEMA), rows, bits=bits)


def test_small_table(spark):
    t = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    check(t, [tuple(r) for r in t.collect()])


def test_awkward_rows(spark):
    long = "word " * 100_000 + " " * 300_000
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "Same."), (1, None, "user", "Same."), (1, None, "user", "Same."),
            (2, 5, "user", long + "."), (2, 6, "assistant", long), (3, -4, "system", "A."), (3, 9, "user", "B?"), (4, 0, "", ""), (5, 1, "assistant", "x")]
    gone = [(c, t) for c in range(1000, 1100) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    rows += [(c, t, "user", "Gone.") for c, t in gone]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("pos", "kind", "code", "gone", "h", "node", "audit", "fault"):
        df = df.withColumn(c, F.lit("x"))
    check(df, rows)
    lost = [r for r in op.digest(df).collect() if r["conv_id"] in {c for c, _ in gone}]
    assert lost and all(r["audit"] == "" and r["cost"] == 0 and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in lost)


def test_empty_table(spark):
    got = op.digest(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and "repaired_sha256" in got.columns


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(8)
    rows = conversation(rng, 7, 1500)
    check(spark.createDataFrame(rows, SCHEMA).repartition(6), rows)


def test_edits_of_a_conversation(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", False), (1, 1, "user", "There", False), (1, 3, "assistant", "Bye.", False)], f"{SCHEMA}, gone boolean")
    got = [(r["edit"], r["role"], r["text"]) for r in op.repair(rows).collect()]
    want = brute_repair([(0, "user", "Hi."), (1, "user", "There"), (3, "assistant", "Bye.")])
    assert "".join(e for e, _, _ in got) == want[1] and [f"{r}:{t}" for _, r, t in got if r] == list(want[2])


def test_prices_are_dual_and_exact():
    """After the auction no arc is violated, and the origin's price is the shortest length."""
    rng = random.Random(2)
    for _ in range(60):
        codes = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randint(1, 12)))
        arcs, price = op.row_lattice(codes, op.END, True)
        assert all(price[i] <= c + price[j] for i, out in enumerate(arcs) for j, c, _ in out)
        op.auction(arcs, price, 0)
        assert all(price[i] <= c + price[j] for i, out in enumerate(arcs) for j, c, _ in out)
        rows = [(i, {"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "o"), "" if c == "x" else f"{i}" if c.isupper() else f"{i}.")
                for i, c in enumerate(codes)]
        assert price[0] == brute_repair(rows)[0] and "".join(op.trace(codes, 0)[2]) == brute_repair(rows)[1]
