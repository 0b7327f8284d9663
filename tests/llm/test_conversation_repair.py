import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pulse.llm.conversation_repair import Repair, damage, repair, reports

from .brute import repair_conversation

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TEXTS = ["Yes.", "No!", "why?", "cut off", "  ", "", "end. \n", "é", "a\nb."]


def _rows(seed, conversations=60, most=14):
    rng = random.Random(seed)
    out = []
    for c in range(conversations):
        for t in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""])
            out.append((c, t + (t > 5), role, f"{rng.choice(TEXTS)}" if rng.random() < 0.5 else f"{t} {rng.choice(TEXTS)}"))
    rng.shuffle(out)
    return out


def _order(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _expected(rows, damaged=False):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text, n = " " if role is None else role, " " if text is None else text, 1
        if damaged:
            lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = {0: "", 1: "", 2: "".join(c for c in text if c not in ".!?")}.get(lot, text)
            role, n = "user" if lot == 4 else role, {0: 0, 3: 2}.get(lot, 1)
        by[conv] += [(turn, role, text)] * n
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, _order(*r[1:])))
        out[conv] = repair_conversation(turns)
    return out


def _found(df):
    """conv_id -> (report, repaired turns), chunks in order."""
    out, rows = {}, sorted(df.collect(), key=lambda r: r["chunk"])
    for r in rows:
        report, turns = out.setdefault(r["conv_id"], ({}, []))
        turns += [(t["role"], t["text"]) for t in r["repaired"]]
        if r["report"] is not None:
            assert not report
            report.update(r["report"].asDict())
    return out


@pytest.mark.parametrize("p", [Repair(), Repair(piece_turns=1), Repair(piece_turns=3)])
@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_brute_force(spark, p, seed):
    rows = _rows(seed)
    assert _found(repair(spark.createDataFrame(rows, SCHEMA).repartition(3), p)) == _expected(rows)


def test_damage(spark):
    rows = _rows(7, 300, 6)
    df = repair(damage(spark.createDataFrame(rows, SCHEMA)), copies="copies")
    want = _expected(rows, damaged=True)
    assert _found(df) == want
    gone = [c for c, (report, _) in want.items() if report["audit"] == "" and report["cost"] == 0]
    assert gone and all(want[c][0]["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for c in gone)


@pytest.mark.parametrize("p", [Repair(), Repair(piece_turns=40)])
def test_one_conversation_holds_most_rows(spark, p):
    rng = random.Random(3)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"{t}.", f"{t}"])) for t in range(700)]
    rows += [(c, t, "user", "x.") for c in range(40) for t in range(2) if c != 5]
    rows += [(5, 9, "user", "copy.")] * 30
    assert _found(repair(spark.createDataFrame(rows, SCHEMA).repartition(8), p)) == _expected(rows)


def test_nulls_ties_and_copies(spark):
    rows = [
        (None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", None),
        (1, 4, "user", "b."), (1, 4, "user", "b."), (1, 4, "assistant", "b."), (1, None, "system", "s."),
        (2, None, "user", "only nulls."), (2, None, "assistant", "x."), (3, -5, "assistant", "a"), (3, 2**40, "user", "b."),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", chunk string, report int")
    assert _found(repair(df)) == _expected(rows)
    assert _found(repair(damage(df), copies="copies")) == _expected(rows, damaged=True)


def test_empty_table(spark):
    out = repair(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and reports(out).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_long_texts(spark):
    rows = [(1, 0, "user", "w " * 10**6 + "."), (1, 1, "assistant", "v" * 10**6), (2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    assert _found(repair(spark.createDataFrame(rows, SCHEMA), Repair(piece_bytes=1000))) == _expected(rows)
