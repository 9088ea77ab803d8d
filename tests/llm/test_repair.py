import hashlib
import itertools
import random
import re
import zlib

import pytest
from helpers_llm import clashing
from pyspark.sql import functions as F

from kontor.llm import repair
from kontor.llm.queries import faulty

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    """(role, text) of ordered rows -> first fault of each."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, letters, repaired rows) by trying every sequence of edits (up to two insertions a gap)."""
    faults = faults_of(rows)
    gap = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    moves = [["D"] + ([] if f in ("blank", "duplicate") else ["K", "Ru", "Ra"]) for f in faults]
    best = None
    for choice in itertools.product(*moves):
        for gaps in itertools.product(gap, repeat=len(rows) + 1):
            cost, letters, out = 0, "", []
            for i in range(len(rows) + 1):
                for r in gaps[i]:
                    cost, letters = cost + 3, letters + "I"
                    out.append((repair.ROLE[r], ""))
                if i == len(rows):
                    break
                m = choice[i]
                letters += m[0]
                cost += {"K": 0, "R": 3, "D": 4}[m[0]] + (3 if faults[i] == "truncated" and m != "D" else 0)
                if m != "D":
                    out.append((rows[i][0] if m == "K" else repair.ROLE[m[1]], rows[i][1]))
            if FORM.fullmatch("".join(r[:1] for r, _ in out) if all(r for r, _ in out) else "x"):
                if best is None or (cost, letters) < best[:2]:
                    best = (cost, letters, out)
    return best


def made(rows):
    seen = set()
    for role, text in rows:
        yield repair.Row(role, text, None, (role, text) in seen)
        seen.add((role, text))


@pytest.mark.parametrize("modulus", [repair.MODULUS, 2])  # with 2, hashes collide all the time
def test_edits_equal_every_sequence_tried(monkeypatch, modulus):
    monkeypatch.setattr(repair, "MODULUS", modulus)
    rnd = random.Random(3)
    for _ in range(60):
        n = rnd.randint(0, 3)
        rows = [(rnd.choice(["system", "user", "assistant", "tool", ""]), rnd.choice(["a.", "b", "", " \n", "c!"])) for _ in range(n)]
        cost, letters, out = brute(rows)
        got = list(repair.edits(made(rows)))
        assert "".join(e.letter for e in got) == letters, rows
        assert sum(e.cost for e in got) == cost
        assert [(e.role, e.text) for e in got if e.letter != "D"] == out


def plain(rows):
    """The same program with whole strings for prefixes."""
    faults = faults_of(rows)
    cells = [(0, "")] + [None] * 3

    def offer(to, state, way):
        if to[state] is None or way < to[state]:
            to[state] = way

    def insert():
        for _ in range(3):
            for moves in (repair.NEXT["u"], repair.NEXT["a"]):
                for s, t in moves.items():
                    if cells[s]:
                        offer(cells, t, (cells[s][0] + 3, cells[s][1] + "I"))

    for (role, _), fault in zip(rows, faults):
        insert()
        out = [None] * 4
        for s, cell in enumerate(cells):
            if not cell:
                continue
            offer(out, s, (cell[0] + 4, cell[1] + "D"))
            if fault not in ("blank", "duplicate"):
                x = 3 if fault == "truncated" else 0
                for initial, moves in repair.NEXT.items():
                    if s in moves and role[:1] == initial:
                        offer(out, moves[s], (cell[0] + x, cell[1] + "K"))
                    elif s in moves and initial != "s":
                        offer(out, moves[s], (cell[0] + x + 3, cell[1] + "R"))
        cells = out
    insert()
    return min(c for c in (cells[0], cells[3]) if c)


@pytest.mark.parametrize("settle", [1, 7, 256])
@pytest.mark.parametrize("kinds", [("user", "assistant"), ("assistant",), ("tool", "user"), ("system", "user", "assistant", "x")])
def test_long_conversations_are_settled_on_the_way(monkeypatch, settle, kinds):
    monkeypatch.setattr(repair, "SETTLE", settle)
    rnd = random.Random(len(kinds) + settle)
    rows = [(rnd.choice(kinds), rnd.choice([f"t{i}.", f"t{i}", "same.", " "])) for i in range(600)]
    got = list(repair.edits(made(rows)))
    assert (sum(e.cost for e in got), "".join(e.letter for e in got)) == plain(rows)


def test_rows_wait_only_until_they_are_settled():
    program = repair.Repair()
    longest = 0
    for i in range(20_000):
        for _ in program.add(repair.Row("user" if i % 3 else "assistant", "x" if i % 7 else "y.")):
            pass
        longest = max(longest, len(program.waiting))
    assert longest <= 2 * repair.SETTLE


def expected(rows):
    """What the query returns, from (conv_id, turn, role, text), by loops."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            role = "user" if lot == 4 else role
            text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            kept += [(turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        pairs = [(role, text) for _, role, text in kept]
        faults, turns = faults_of(pairs), {t for t, _, _ in kept if t is not None}
        got = list(repair.edits(made(pairs)))
        cost, letters = plain(pairs)
        assert "".join(e.letter for e in got) == letters
        said = "\n".join(f"{e.role}:{e.text}" for e in got if e.letter != "D")
        illegal = sum(a[0][:1] + b[0][:1] not in repair.LEGAL for a, b in zip(pairs, pairs[1:]))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, letters, hashlib.sha256(said.encode()).hexdigest(),
        )
    return out


def result(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def test_query_equals_loops_on_odd_conversations(spark):
    rnd = random.Random(11)
    texts = ["Yes.", "No!", "why", "", None, " \n", "é?", "x" * 50_000, "same.", "a\vb"]
    rows = [
        (rnd.choice([None, *range(40)]), rnd.choice([None, *range(9)]), rnd.choice(["system", "user", "assistant", "tool", None, ""]), rnd.choice(texts))
        for _ in range(400)
    ]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"text {t}.") for t in range(1500)]
    rows += rows[:30]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(repair.audits(faulty(clashing(df)), gone=F.col("gone"))) == expected(rows)
    # a conversation all of whose rows are dropped
    gone = next(i for i in range(2000, 4000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    only = result(repair.audits(faulty(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA)), gone=F.col("gone")))
    assert only == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.audits(faulty(spark.createDataFrame([], SCHEMA)), gone=F.col("gone")).collect() == []


def test_repaired_rows(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "hi!"), (1, 2, "user", "hi!"),
        (2, 5, "tool", None), (None, None, "user", "Q?"), (None, 1, "user", "A."),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("x"))
    got = sorted(((str(r.conv_id), r.place, r.turn, r.role, r.text, r.edit) for r in repair.repaired(df).collect()), key=lambda r: r[:2])
    assert got == [
        ("1", 0, 0, "system", "Be kind.", "K"), ("1", 1, None, "user", "", "I"), ("1", 2, 1, "assistant", "Hello.", "K"),
        ("1", 3, 2, "user", "hi!", "K"), ("1", 4, None, "assistant", "", "I"),
        ("None", 0, None, "user", "Q?", "K"), ("None", 1, 1, "assistant", "A.", "R"),
    ]
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
