"""Repair of conversations against dynamic programming and plain Python rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from batchlens.llm import queries, repair

LEGAL = re.compile(r"(s?(ua)+)?")
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """``(cost, audit, lines)`` over all edits, best first by row and roles so far.

    ``rows`` are (role, text, gone, early). Every useful edit sequence is kept as
    the best per state of the grammar: "", "s", "u" or "a" as the last initial."""
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            new = dict(best)
            for last, (c, a, lines) in best.items():
                give = "assistant" if last == "u" else "user"
                found = (c + 3, a + "I", (*lines, (give, "")))
                if give[0] not in new or found[:2] < new[give[0]][:2]:
                    new[give[0]] = found
            best = new
        return best

    for role, text, gone, early in rows:
        after = {}
        for last, (c, a, lines) in inserted(best).items():
            ways = [(last, 4, "D", lines)]
            if not gone:
                expected = "a" if last == "u" else "u"
                if role[:1] == expected or (last == "" and role[:1] == "s"):
                    ways.append((role[:1], 3 * early, "K", (*lines, (role, text))))
                name = {"u": "user", "a": "assistant"}[expected]
                ways.append((expected, 3 + 3 * early, "R", (*lines, (name, text))))
            for state, extra, letter, new in ways:
                found = (c + extra, a + letter, new)
                if state not in after or found[:2] < after[state][:2]:
                    after[state] = found
        best = after
    return min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])


def expected(rows):
    out = {}
    damaged = {}
    for r in rows:
        conv, turn = r["conv_id"], r["turn"]
        role = " " if r["role"] is None else r["role"]
        text = " " if r["text"] is None else r["text"]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        here = damaged.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here.extend([(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    for conv, here in damaged.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, coded, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in here:
            solid = text.strip(BLANKS)
            blank, twice = not solid, bool(solid) and (role, text) in seen
            early = bool(solid) and not twice and solid[-1] not in ".!?"
            seen.add((role, text))
            n["blank"] += blank
            n["duplicate"] += twice
            n["truncated"] += early
            coded.append((role, text, blank or twice, early))
        turns = {t for t, _, _ in here if t is not None}
        cost, audit, lines = cheapest(coded)
        assert LEGAL.fullmatch("".join(r[0] for r, _ in lines))
        out[conv] = n | {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:], strict=False)),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
        }
    return out


def test_query(spark, sf, conversations):
    found = {r["conv_id"]: r.asDict() for r in queries.op13_conversations(spark, sf).collect()}
    for r in found.values():
        r.pop("conv_id")
    assert found == expected(conversations)


@pytest.mark.parametrize("sizes", [repair.Sizes(rows=4, block=3), repair.Sizes(rows=7, bytes=40, block=64)])
def test_long_conversations_in_parts(spark, sf, conversations, sizes):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    report, lines = repair.repair(repair.damage(rows), sizes)
    found = {r["conv"]: r.asDict() for r in repair.digests(report, lines).collect()}
    for r in found.values():
        r.pop("conv")
    assert found == expected(conversations)


def everything(rows, most):
    """All edit sequences with at most ``most`` insertions in one place."""
    for gaps in itertools.product(range(most + 1), repeat=len(rows) + 1):
        for letters in itertools.product("DKR", repeat=len(rows)):
            audit = "".join("I" * g + e for g, e in zip(gaps, [*letters, ""], strict=True))
            cost = 3 * sum(gaps)
            state, fine = repair.START, True
            for (initial, gone, early), g, letter in zip([*rows, ("", True, False)], gaps, [*letters, "D"], strict=True):
                for _ in range(g):
                    state = repair.NEXT[state]
                if letter == "K":
                    fine &= not gone and state in repair.STEPS.get(initial, ())
                    state = repair.STEPS.get(initial, {}).get(state, state)
                    cost += 3 * early
                elif letter == "R":
                    fine &= not gone
                    state = repair.NEXT[state]
                    cost += 3 + 3 * early
                else:
                    cost += 4
            if fine and state in (repair.START, repair.ANSWER):
                yield cost - 4, audit


def test_search_against_enumeration():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("usax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 4))]
        rows = [(i, g, e and not g) for i, g, e in rows]
        assert repair.closed(repair.solve(rows, 2)) == min(everything(rows, 2))


def test_adverse_rows_end_soon():
    rng = random.Random(6)
    for rows in (
        [("u", False, False)] * 400,
        [("a", False, True)] * 400,
        [(rng.choice("usax "), rng.random() < 0.3, rng.random() < 0.5) for _ in range(400)],
    ):
        cost, audit, _ = cheapest([(i, "", g, e) for i, g, e in rows])
        assert repair.closed(repair.solve(rows, 64)) == (cost, audit)
        assert repair.closed(repair.solve(rows, 7)) == (cost, audit)
