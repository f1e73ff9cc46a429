"""Repair of conversations against exhaustive search and plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm_support import LONG
from tierflow.llm import repair
from tierflow.llm.repair import KEEP, MEANING, NEXT, SYMBOLS, cheapest_repair, digest_turns, repair_conversations

SIGNS = list(SYMBOLS.values())
SCHEMA = "conv_id long, turn long, role string, text string"


def exhaustive(symbols):
    """All edits with up to three insertions in a row."""
    best = None

    def go(i, state, cost, audit, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(symbols) and state in (0, 3):
            best = min(filter(None, (best, (cost, audit))))
        if inserted < 3:
            go(i, NEXT[state], cost + 3, audit + "I", inserted + 1)
        if i < len(symbols):
            initial, fault = MEANING[symbols[i]]
            go(i + 1, state, cost + 4, audit + "D", 0)
            if fault not in "bd":
                more = 3 * (fault == "t")
                if state in KEEP.get(initial, {}):
                    go(i + 1, KEEP[initial][state], cost + more, audit + "K", 0)
                go(i + 1, NEXT[state], cost + more + 3, audit + "R", 0)

    go(0, 0, 0, "", 0)
    return best


def by_strings(symbols):
    """The least (cost, audit) of each state, audits as strings."""

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                offer(best, NEXT[state], (cost + 3, audit + "I"))
        return best

    def offer(best, state, value):
        best[state] = min(value, best.get(state, value))

    best = inserted({0: (0, "")})
    for symbol in symbols:
        initial, fault = MEANING[symbol]
        after = {}
        for state, (cost, audit) in best.items():
            offer(after, state, (cost + 4, audit + "D"))
            if fault not in "bd":
                more = 3 * (fault == "t")
                if state in KEEP.get(initial, {}):
                    offer(after, KEEP[initial][state], (cost + more, audit + "K"))
                offer(after, NEXT[state], (cost + more + 3, audit + "R"))
        best = inserted(after)
    return min(best[s] for s in (0, 3) if s in best)


def test_cheapest_repair_against_exhaustive_search():
    rng = random.Random(2)
    assert cheapest_repair("") == (0, "")
    for _ in range(300):
        symbols = "".join(rng.choices(SIGNS, k=rng.randint(0, 6)))
        assert cheapest_repair(symbols) == exhaustive(symbols) == by_strings(symbols)


def test_long_conversations_keep_numbers_short():
    rng = random.Random(3)
    for _ in range(60):
        symbols = "".join(rng.choices(rng.sample(SIGNS, rng.randint(1, 5)), k=rng.randint(200, 900)))
        assert cheapest_repair(symbols) == by_strings(symbols)
    weights = repair._Weights()
    for symbol in rng.choices(SIGNS, k=20_000):
        weights.turn(*MEANING[symbol])
    assert weights.width == 256


def slow_repair(rows):
    """Reports and digests by plain Python; rows of (conv_id, turn, role, text)."""
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest())
        mine = sorted((r for r in rows if r[0] == conv), key=order)
        seen, symbols = set(), ""
        for _, _, role, text in mine:
            said = text.rstrip(" \t\n\v\f\r")
            fault = "b" if not said else "d" if (role, text) in seen else "-" if said[-1] in ".!?" else "t"
            seen.add((role, text))
            symbols += SYMBOLS[(role[:1] if role[:1] in ("s", "u", "a") else "o") + fault]
        cost, audit = by_strings(symbols)
        i, state, lines = 0, 0, []
        for letter in audit:
            if letter == "I":
                state = NEXT[state]
                lines.append({2: "user", 3: "assistant"}[state] + ":")
                continue
            _, _, role, text = mine[i]
            if letter == "K":
                state = KEEP[role[0]][state]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = NEXT[state]
                lines.append({2: "user", 3: "assistant"}[state] + ":" + text)
            i += 1
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [MEANING[s][0] for s in symbols]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        faults = [sum(MEANING[s][1] == f for s in symbols) for f in "bdt"]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None
        out[conv] = (gaps, *faults, illegal, cost, audit, sha)
    return out


def found(result):
    digests = {r.conv_id: r.sha256 for r in digest_turns(result.turns).collect()}
    return {r.conv_id: (*r[1:], digests.get(r.conv_id)) for r in result.reports.collect()}


@pytest.fixture(scope="module")
def odd_turns():
    rng = random.Random(7)
    roles = ["system", "user", "assistant", "tool", "unknown", "", None, "User", "ass"]
    texts = ["Yes.", "No", "  ", "", None, "Why? \n", " ", "So!\t", "x" * 50 + ".", "日本"]
    rows = [
        (rng.choice([1, 2, 3, 4, None]), rng.choice([None, 0, 1, 2, 3, 7, 7]), rng.choice(roles), rng.choice(texts))
        for _ in range(90)
    ]
    rows += [(5, 0, "user", LONG), (5, 1, "assistant", LONG + ".")]
    rows += [(6, 3, "user", "Again.")] * 9
    rows += [(7, None, None, None), (8, 2, "user", " \n")]
    return rows


def test_repair_against_plain_python(spark, odd_turns):
    turns = spark.createDataFrame(odd_turns, SCHEMA)
    for c in ("digest", "place", "symbol", "cost", "position"):
        turns = turns.withColumn(c, F.lit("x"))
    assert found(repair_conversations(turns)) == slow_repair(odd_turns)


def test_one_conversation_of_many_turns(spark):
    """Its turns are dealt over several tasks and fragments."""
    rng = random.Random(1)
    rows = [
        (1, k, rng.choice(["user", "assistant", "tool"]), rng.choice([f"Turn {k}.", "", "Often.", f"Open {k}"]))
        for k in range(9_000)
    ]
    assert found(repair_conversations(spark.createDataFrame(rows, SCHEMA))) == slow_repair(rows)


def test_no_turns(spark):
    result = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert result.reports.count() == 0 and result.turns.count() == 0
    assert digest_turns(result.turns).count() == 0


def test_all_turns_deleted(spark):
    result = repair_conversations(spark.createDataFrame([(1, 0, "user", " "), (1, 1, "user", "")], SCHEMA))
    assert found(result) == {1: (0, 2, 0, 0, 1, 8, "DD", None)}
