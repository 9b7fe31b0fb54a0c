"""Conversation repair against exhaustive search and a plain reading of the rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from quarry.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, place long, copies string, fault int"


def shape(n):
    """The role initials of a legal conversation of n turns."""
    return "" if n == 0 else "ua" * (n // 2) if n % 2 == 0 else "s" + "ua" * (n // 2) if n > 1 else None


def price(signs, audit):
    """Cost of an audit, None where it does not give a legal conversation."""
    roles = shape(len(audit.replace("D", "")))
    if roles is None:
        return None
    cost, row, place = 0, 0, 0
    for edit in audit:
        sign = signs[row] if edit != "I" else None
        row += edit != "I"
        if edit == "D":
            cost += 4
            continue
        role = roles[place]
        place += 1
        if edit == "I":
            cost += 3
        elif sign == "-":
            return None
        else:
            cost += 3 * sign.isupper() + (3 if edit == "R" else 0)
        if role != sign.lower() if edit == "K" else role == "s":
            return None
    return cost


def exhaustive(signs):
    found = []
    for edits in itertools.product("KRD", repeat=len(signs)):
        for gaps in itertools.product(range(3), repeat=len(signs) + 1):
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
            cost = price(signs, audit)
            if cost is not None:
                found.append((cost, audit))
    return min(found)


def forward(signs):
    """Row by row over the automaton's states."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def inserted(cells):
        for _ in range(4):
            for state, (cost, audit) in list(cells.items()):
                for role in "ua":
                    to = step.get((state, role))
                    if to is not None:
                        cells[to] = min(cells.get(to, (10 ** 9, "")), (cost + 3, audit + "I"))
        return cells

    cells = inserted({0: (0, "")})
    for sign in signs:
        new = {}
        for state, (cost, audit) in cells.items():
            moves = [(state, 4, "D")]
            if sign != "-":
                extra = 3 * sign.isupper()
                moves += [(step[state, sign.lower()], extra, "K")] if (state, sign.lower()) in step else []
                moves += [(step[state, r], 3 + extra, "R") for r in "ua" if (state, r) in step]
            for to, more, edit in moves:
                new[to] = min(new.get(to, (10 ** 9, "")), (cost + more, audit + edit))
        cells = inserted(new)
    return min(cells[q] for q in (0, 3) if q in cells)


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4])
def test_cells_against_all_edits(length):
    every = list(itertools.product("suaxSUA-", repeat=length))
    for signs in every if length < 3 else random.Random(length).sample(every, 60):
        cost, audits = repair.cheapest([repair.parse("".join(signs))])
        assert (cost, "".join(audits)) == exhaustive(signs), signs


def test_spans_of_any_length_and_any_cut():
    rng = random.Random(1)
    for _ in range(200):
        signs = "".join(rng.choice("suauauaxSUAX--") for _ in range(rng.randrange(60)))
        want = forward(signs)
        cuts = sorted(rng.randrange(len(signs) + 1) for _ in range(rng.randrange(4)))
        pieces = [signs[a:b] for a, b in zip([0, *cuts], [*cuts, len(signs)])]
        cost, audits = repair.cheapest([repair.parse(p) for p in pieces])
        assert (cost, "".join(audits)) == want
        assert [len(a.replace("I", "")) for a in audits] == [len(p) for p in pieces]
        assert price(signs, "".join(audits)) == cost


def by_the_rules(rows):
    """The result for rows (conv_id, turn, role, text), one conversation after the other."""
    space = lambda v: " " if v is None else v
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, space(role), space(text)))
    for conv, turns in convs.items():
        kept = []
        for turn, role, text in turns:
            code = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
            role = "user" if code == 4 else role
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            kept += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        signs, seen, count = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
            count[fault] = count.get(fault, 0) + 1
            signs += repair.symbol(role[:1], fault)
        initials = [role[:1] or " " for _, role, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        timed = [t for t, _, _ in kept if t is not None]
        gaps = max(timed) - min(timed) + 1 - len(set(timed)) if timed else 0
        cost, audit = forward(signs)
        roles, said, place, row = shape(len(audit.replace("D", ""))), [], 0, 0
        for edit in audit:
            _, role, text = kept[row] if edit != "I" else (None, "", "")
            row += edit != "I"
            if edit != "D":
                role = role if edit == "K" else {"u": "user", "a": "assistant"}[roles[place]]
                place += 1
                said.append(f"{role}:{text}")
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, 7, "c", 1) for r in rows], SCHEMA)
    found = repair.repaired(df).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    return {r["conv_id"]: tuple(r)[1:] for r in found}


def test_repair_by_the_rules(spark):
    rng = random.Random(2)
    words = ["Yes.", "no", "What?", "", " \t", None, "Go!\n", "é. ", "a.b", "Yes. ", "x" * 50_000 + "."]
    roles = ["system", "user", "assistant", None, "", "tool", "ärger"]
    rows = [(conv, rng.choice([None, *range(6), 9]), rng.choice(roles[:3] * 3 + roles), rng.choice(words))
            for conv in [None, *range(40)] for _ in range(rng.randrange(1, 9))]
    rows += [(1000 + k, 0, "user", "Hi.") for k in range(60)]  # some are dropped whole
    rows += rows[:50]
    assert repaired(spark, rows) == by_the_rules(rows)


def test_one_conversation_over_all_tasks(spark):
    rng = random.Random(3)
    rows = [(1, k // 2, rng.choice(["user", "assistant"]), rng.choice(["So.", "so", "?", "", f"{k}."])) for k in range(2000)]
    rows += [(1, None, "user", "So.")] * 700 + [(2, 0, "system", "Be."), (2, 1, "user", "Why?"), (2, 2, "assistant", "So.")]
    assert repaired(spark, rows) == by_the_rules(rows)


def test_empty_table(spark):
    assert repaired(spark, []) == {}
