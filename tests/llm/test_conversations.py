"""Conversation repair against a plain programme over whole rows."""

import hashlib
import random
import zlib

import pytest

from barline.llm import conversations
from barline.llm.conversations import ENDS, NEXT, STATES, SYMBOLS, WANTED, damaged, re_pair, repair, solved

SCHEMA = "conv_id long, turn long, role string, text string, conv string, rank int, block string, kind int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 7, "b", 1) for r in rows], SCHEMA)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        whole = text.rstrip(" \t\n\v\f\r")
        out.append("b" if not whole else "d" if (role, text) in seen else "t" if whole[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def plain(rows):
    """(cost, audit, lines) of the best edits, over full strings."""
    best = {0: (0, "", [])}

    def put(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserted(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                role, to = WANTED[state]
                put(out, to, (cost + 2, audit + "I", [*lines, f"{role}:"]))
        return out

    for (role, text), fault in zip(rows, faults(rows)):
        after, cut = {}, fault == "t"
        for state, (cost, audit, lines) in inserted(best).items():
            put(after, state, (cost + 3, audit + "D", lines))
            if fault not in "bd":
                other, to = WANTED[state]
                put(after, to, (cost + 2 + cut, audit + "R", [*lines, f"{other}:{text}"]))
                if (state, role[:1]) in NEXT:
                    put(after, NEXT[state, role[:1]], (cost + cut, audit + "K", [*lines, f"{role}:{text}"]))
        best = after
    return min(w for s, w in inserted(best).items() if s in (0, 3))


def told(rows):
    """What the report should say of (turn, role, text) rows in order."""
    pairs = [(r, t) for _, r, t in rows]
    cost, audit, lines = plain(pairs)
    turns = [t for t, _, _ in rows if t is not None]
    marks, begins = faults(pairs), [r[:1] for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(begins, begins[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def ordered(rows):
    """(conv, turn, role, text) rows to {conv: rows in the operator's order}."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        out.setdefault(conv, []).append((turn is not None, turn or 0, tie, (turn, role, text)))
    return {c: [r[3] for r in sorted(rs, key=lambda r: r[:3])] for c, rs in out.items()}


def report(found):
    return {r[0]: tuple(r[1:]) for r in found.report.collect()}


def test_rules_spell_the_texts():
    rng = random.Random(1)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(60))] for _ in range(40)] + [[1] * 50, [], [0]]
    short, rules = re_pair(texts, 3)

    def spelt(symbol):
        return [symbol] if symbol < 3 else [x for s in rules[symbol - 3] for x in spelt(s)]

    assert [[x for s in row for x in spelt(s)] for row in short] == texts
    left = [(a, b) for row in short for a, b in zip(row, row[1:])]
    assert len(rules) > 5 and all(left.count(p) < 2 or p[0] == p[1] for p in left)


def test_matrices_against_whole_strings():
    rng = random.Random(2)
    sequences = ["".join(rng.choice(SYMBOLS) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    for sequence, matrix in solved(sequences).items():
        rows, n = [], 0
        for n, c in enumerate(sequence):
            rows.append(("user", " ") if c == "x" else ({"s": "system", "u": "user", "a": "assistant", "o": "tool"}[c.lower()], f"{n}" if c.isupper() else f"{n}."))
        ways = [(matrix[0][j][0] + 2 * len(ENDS[j]), str(matrix[0][j][1]) + ENDS[j]) for j in range(STATES) if matrix[0][j]]
        assert min(ways) == plain(rows)[:2], sequence


def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"),
        (2, None, "system", "Rules."), (2, 0, None, "who"), (2, 5, "user", None), (2, 5, "user", ""), (2, 9, "assistant", "done"),
        (None, 3, "assistant", "first!"), (None, 3, "assistant", "first!"), (None, 3, "", "x."),
        (4, None, None, None), (5, 1, "user", "a\nb: ä\U0001f600."), (5, 1, "User", "a."), (5, 2, "assistant", "w " * 40000),
        (6, -4, "system", "s."), (6, 7, "system", "s!"),
    ]
    want = {c: told(rs) for c, rs in ordered(rows).items()}
    found = repair(frame(spark, rows))
    assert report(found) == want
    lines = {}
    for r in found.turns.orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, rs in ordered(rows).items():
        assert lines.get(conv, []) == plain([r[1:] for r in rs])[2]
    empty = repair(frame(spark, []), all_ids=frame(spark, rows[:1]).select("conv_id"))
    assert report(empty) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair(frame(spark, [])).report.count() == 0


@pytest.mark.parametrize("block", [3, 256])
def test_long_conversations_in_blocks(spark, monkeypatch, block):
    """A hot conversation of many blocks, copies in it far apart."""
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for conv, n in [(7, 700), *((100 + i, rng.randrange(1, 12)) for i in range(40))]:
        for turn in range(n):
            text = rng.choice(["", "same.", f"t{turn}.", f"t{turn}", f"t{turn}!"])
            rows.append((conv, turn + turn // 9, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), text))
    assert report(repair(frame(spark, rows))) == {c: told(rs) for c, rs in ordered(rows).items()}


def test_damage(spark):
    rows = [(c, t, "assistant", "A. B!") for c in range(30) for t in (0, 1, None)]
    got = sorted(map(str, damaged(frame(spark, rows)).collect()))
    want = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        if fate:
            role, text = "user" if fate == 4 else role, "" if fate == 1 else "A B" if fate == 2 else text
            want += [f"Row(conv_id={c}, turn={t}, role='{role}', text='{text}')"] * (2 if fate == 3 else 1)
    assert got == sorted(want)
