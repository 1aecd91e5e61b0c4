"""Operator 11 against a plain search over every sequence of edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from stagecraft.llm import op11_repair as op11

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def brute_audit(rows):
    """(cost, audit) by search from the end; ``rows`` are (initial, must go, truncated)."""
    @lru_cache(None)
    def best(i, state, inserts=0):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if inserts < 3:
            for to in "ua":
                if (state, to) in NEXT and (more := best(i, NEXT[state, to], inserts + 1)):
                    found.append((more[0] + 5, "I" + more[1]))
        if i < len(rows):
            initial, gone, cut = rows[i]
            if more := best(i + 1, state):
                found.append((more[0] + 2, "D" + more[1]))
            if not gone:
                if (state, initial) in NEXT and (more := best(i + 1, NEXT[state, initial])):
                    found.append((more[0] + 5 * cut, "K" + more[1]))
                for to in "ua":
                    if (state, to) in NEXT and (more := best(i + 1, NEXT[state, to])):
                        found.append((more[0] + 1 + 5 * cut, "R" + more[1]))
        return min(found, default=None)
    return best(0, 0)


def or_space(x):
    return " " if x is None else str(x)


def brute(rows, hurt=True):
    """{conv_id: result} of (conv_id, turn, role, text) rows."""
    out, kept = {}, {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{or_space(conv)}:{or_space(turn)}".encode()) % 20 if hurt else 9
        role, text, mine = or_space(role), or_space(text), kept.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, mine in kept.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, symbols = set(), [0, 0, 0], []
        for _, role, text in mine:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            symbols.append((role[:1], fault in (0, 1), int(fault == 2)))
        turns = {t for t, _, _ in mine if t is not None}
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = brute_audit(tuple(symbols))
        state, i, lines = 0, 0, []
        for e in audit:
            to = "a" if state == 2 else "u"
            name, text = ("assistant" if to == "a" else "user"), ""
            if e != "I":
                role, text = mine[i][1:]
                i += 1
                if e == "D":
                    continue
                if e == "K":
                    to, name = role[:1], role
            lines.append(f"{name}:{text}")
            state = NEXT[state, to]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def made(seed, conversations, longest):
    rng, out = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "cut off", " \t", "", None, "Done. ", "a\nb", "ééé."]
    for c in range(conversations):
        turn = rng.choice([0, 0, 1, -3])
        for _ in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "agent"])
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.random()}{rng.choice(['.', '', '?'])}"
            out.append((c, turn if rng.random() < 0.95 else None, role, text))
            turn += rng.choice([1, 1, 1, 1, 0, 2, 5])
    return out


def check(spark, rows, hurt=True):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", piece int, whole string")
    table = op11.damage(table) if hurt else table
    found = op11.repair(table)
    got = found.collect()
    want = brute(rows, hurt)
    assert len(got) == len(want) == len({r["conv_id"] for r in got})
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["conv_id"]][:-1], r["conv_id"]
    return table, found, want


@pytest.mark.parametrize("piece_rows", [op11.PIECE_ROWS, 3])
def test_equals_a_search_over_all_edits(spark, piece_rows, monkeypatch):
    monkeypatch.setattr(op11, "PIECE_ROWS", piece_rows)
    check(spark, made(4, 60, 9))


def test_repaired_rows_and_undamaged_tables(spark):
    rows = made(5, 25, 8)
    table, found, want = check(spark, rows, hurt=False)
    lines = {}
    for r in sorted(op11.repaired_rows(table, found).collect(), key=lambda r: r["turn"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}


def test_long_conversation_over_many_partitions(spark):
    """One conversation holds nearly all rows, with equal rows far apart: pieces join to the whole's result."""
    rng = random.Random(6)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant"]), rng.choice(["Same.", f"t {t}.", f"t {t}"])) for t in range(700)]
    rows += made(1, 12, 5) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho."), (99, None, None, "x")]
    rows = [r if r[0] != 3 else (30, *r[1:]) for r in rows]
    import sys
    sys.setrecursionlimit(20_000)
    check(spark, rows)


def test_grammar_and_ropes():
    rng = random.Random(2)
    sequences = [bytes(rng.choices(range(op11.SYMBOLS), k=rng.randint(0, 60))) for _ in range(40)] + [b"\x03" * 200, b"\x03\x05" * 150, b""]
    compressed, rules = op11.re_pair(sequences)

    def spell(s):
        return bytes([s]) if s < op11.SYMBOLS else spell(rules[s - op11.SYMBOLS][0]) + spell(rules[s - op11.SYMBOLS][1])
    assert [b"".join(spell(int(x)) for x in c) for c in compressed] == sequences
    assert rules and len(compressed[-3]) < 20  # 200 equal rows are a few rules
    matrices = op11.matrices_of(rules)
    for s, c in zip(sequences, compressed):
        whole = {k: (v[0], op11.rope_text(v[1])) for k, v in op11.product(c.tolist(), matrices).items()}
        assert whole == {k: (v[0], op11.rope_text(v[1])) for k, v in op11.product(list(s), matrices).items()}
    a = op11.rope_join("D" * 30, "K" * 30)
    for x, y in ((a, op11.rope_join("D" * 30, "R" * 30)), (a, op11.rope_join("D" * 31, "K" * 29)), ("D", "K"), (a, a)):
        assert op11.rope_less(x, y) == (op11.rope_text(x) < op11.rope_text(y))
        assert op11.rope_less(y, x) == (op11.rope_text(y) < op11.rope_text(x))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op11.repair(op11.damage(empty)).collect() == [] and op11.repair(empty).collect() == []
    gone = next(t for t in range(500) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    check(spark, [(5, gone, "user", "Hi.")])
    check(spark, [(1, -(1 << 62), "user", "Hi."), (1, 1 << 61, "assistant", "Ho.")] + [(2, 1, "user", "x. " * 50_000)] * 3, hurt=False)
