from __future__ import annotations

import itertools
import random
import zlib
from hashlib import sha256

import pytest

from cafetal.llm import convrepair as cr
from tests.conftest import SF_MID

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\f\r"


def seen(rows):
    """(conv, turn, role, text) after damage, written out row by row."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def cheapest(turns):
    """Forward dynamic programme over (state, cost, audit, repaired turns), one turn after the other."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    full = {"u": "user", "a": "assistant"}

    def insert(best):
        for _ in range(3):
            for q, (cost, audit, out) in list(best.items()):
                for r in "ua":
                    if (q, r) in step:
                        new = (cost + 3, audit + "I", (*out, f"{full[r]}:"))
                        best[step[q, r]] = min(best.get(step[q, r], new), new)
        return best

    best = insert({0: (0, "", ())})
    for role, text, must, more in turns:
        new = {}

        def put(q, x):
            if q is not None:
                new[q] = min(new.get(q, x), x)  # noqa: B023

        for q, (cost, audit, out) in best.items():
            put(q, (cost + 4, audit + "D", out))
            if not must:
                put(step.get((q, role[:1])), (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for r in "ua":
                    put(step.get((q, r)), (cost + more + 3, audit + "R", (*out, f"{full[r]}:{text}")))
        best = insert(new)
    return min(best[q] for q in (0, 3) if q in best)


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        after = sorted((r for r in seen(rows) if r[0] == conv),
                       key=lambda r: (r[1] is not None, r[1] or 0, sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        ts = [t for _, t, _, _ in after if t is not None]
        known, marked, counts = set(), [], [0, 0, 0]
        for _, _, role, text in after:
            blank, again = not text.strip(WS), (role, text) in known
            known.add((role, text))
            cut = not blank and not again and text.rstrip(WS)[-1] not in ".!?"
            for k, f in enumerate((blank, again and not blank, cut)):
                counts[k] += f
            marked.append((role, text, blank or again, 3 * cut))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(after))
        cost, audit, turns = cheapest(marked)
        out.append((conv, max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, *counts, illegal, cost, audit,
                    sha256("\n".join(turns).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as __n", "2 as __copies", "'x' as audit").repartition(3)
    got = cr.repair_damaged(df).select("conv_id", *cr._COUNTS[:5], "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in got.collect()), key=str)


def made(rng, conv, n, start=0):
    texts = ["Hi.", "no end", "", " \n", "What?", "yes!  \n", "a\tb", "ok."]
    return [(conv, rng.choice([start + t, start + t, rng.randrange(n), None]), rng.choice(["user", "assistant", "system", "tool", "user", None, ""]),
             rng.choice([rng.choice(texts), f"text {t}.", None])) for t in range(n)]


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = [r for c in range(300) for r in made(rng, c, rng.randrange(1, 9))]
    rows += made(rng, None, 7) + [(1001, t, "user", "again") for t in range(40)]
    rows += [(1002, 3, "assistant", "same.")] * 50 + made(rng, 1003, 90)
    assert run(spark, rows) == brute(rows)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows) == brute(rows)


def test_long_conversation_in_blocks(spark, monkeypatch):
    """A conversation of many blocks gives what one pass gives, for small blocks and fan-in, too."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), f"t{t}" + rng.choice(["", "."])) for t in range(700)]
    rows += [r for c in range(2, 20) for r in made(rng, c, 5)] + [(1, 350, "user", "again.")] * 60
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(cr, "_BLOCK", 2)
    monkeypatch.setattr(cr, "_FAN", 1)
    assert run(spark, rows) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cr.repair_damaged(df).count() == 0 and cr.repaired_turns(df).count() == 0


def test_conversation_without_rows_after_damage(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(conv, 0, "user", "gone.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_turns_of_the_repair(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "More."), (1, 2, "assistant", "Yes."), (1, 3, "system", "x.")]
    got = [tuple(r) for r in cr.repaired_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()]
    assert [(r[2], r[3], r[4]) for r in got] == [("user", "Hi.", "keep"), ("assistant", "", "insert"), ("user", "More.", "keep"),
                                                 ("assistant", "Yes.", "keep")]


@pytest.mark.parametrize("kinds", ["".join(k) for k in itertools.product("sUad", repeat=3)])
def test_every_split_gives_the_same_cells(kinds):
    left = cr.product(cr.product(cr.leaf(kinds[0]), cr.leaf(kinds[1])), cr.leaf(kinds[2]))
    right = cr.product(cr.leaf(kinds[0]), cr.product(cr.leaf(kinds[1]), cr.leaf(kinds[2])))
    assert left == right == cr.parse([(k, 1) for k in kinds])
