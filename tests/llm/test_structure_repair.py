"""Structure repair: block tables against a direct search over all edits, and whole tables against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from riskframe.llm import structure_repair as sr

SCHEMA = "conv_id long, turn long, role string, text string"
_INSERTS = {0: 2, 1: 2, 2: 3, 3: 2}
_KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def search(rows):
    """Cheapest cost and ASCII-least letters over all scripts; ``rows`` are (initial, fault)."""
    def with_inserts(best):
        for _ in range(3):
            for state, (cost, letters) in list(best.items()):
                to, found = _INSERTS[state], (cost + 5, letters + "I")
                if to not in best or found < best[to]:
                    best[to] = found
        return best

    best = {0: (0, "")}
    for initial, fault in rows:
        following = {}
        for state, (cost, letters) in with_inserts(best).items():
            moves = [("D", 2, state)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, initial) in _KEEPS:
                    moves.append(("K", more, _KEEPS[state, initial]))
                moves.append(("R", 1 + more, _INSERTS[state]))
            for letter, price, to in moves:
                found = (cost + price, letters + letter)
                if to not in following or found < following[to]:
                    following[to] = found
        best = following
    return min(v for s, v in with_inserts(best).items() if s in (0, 3))


def rows_of(symbols):
    return [("", "blank") if c == "x" else (c.lower(), "truncated" if c.isupper() else "") for c in symbols]


def letters_of(edits):
    return "".join(edits).translate(str.maketrans("uaUA", "IIRR"))


@pytest.mark.parametrize("block", [1, 3, 4])
def test_block_tables_find_the_cheapest_and_least_edits(block):
    known = sr.Tables(block)
    assert len(known.vectors) < 200
    rng = random.Random(block)
    short = ["".join(x) for n in range(4) for x in itertools.product(sr.SYMBOLS, repeat=n)]
    for symbols in short + ["".join(rng.choices(sr.SYMBOLS, k=rng.randint(4, 30))) for _ in range(1500)]:
        edits, _ = known.trace(symbols, 0, 0, True)
        cost, letters = search(rows_of(symbols))
        assert (sr.cost_of(symbols, edits), letters_of(edits)) == (cost, letters), symbols
        vector, total, _ = known.back(symbols, 0)
        assert total + known.vectors[vector][0] == cost


def test_ranges_compose():
    """Cut anywhere, the parts' summaries lead to the same edits as the whole."""
    known, rng = sr.tables(), random.Random(5)
    for _ in range(200):
        parts = ["".join(rng.choices(sr.SYMBOLS, k=rng.randint(1, 9))) for _ in range(rng.randint(2, 5))]
        whole, _ = known.trace("".join(parts), 0, 0, True)
        vectors, v = [], 0
        for part in reversed(parts):
            vectors.append(v)
            v = known.back(part, v)[0]
        state, out = 0, []
        for i, (part, right) in enumerate(zip(parts, reversed(vectors), strict=True)):
            edits, state = known.trace(part, right, state, i == len(parts) - 1)
            out += edits
        assert out == whole


def brute_damage(turns):
    out = []
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 4:
            role = "user"
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute_report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))  # stable
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                      else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    heads = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False))
    cost, audit = search(list(zip(heads, faults, strict=True)))
    out, at = [], 0
    for letter in audit:
        made = "assistant" if out and out[-1].startswith("u") else "user"
        if letter == "I":
            out.append(made + ":")
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            out.append((role if letter == "K" else made) + ":" + text)
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute(turns):
    damaged = brute_damage(turns)
    return sorted(((conv, *brute_report([r[1:] for r in damaged if r[0] == conv])) for conv in {t[0] for t in turns}), key=str)


def odd_turns(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", "Why?  ", "More…", None, "a: b!", "é.\x85"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sys"]
    turns = [(conv, turn, rng.choice(roles[:rng.choice([2, 3, 8])]), rng.choice(texts))
             for conv in [*range(40), 2**60 + 1, None, 2**60 + 2] for turn in range(rng.randint(1, 9))]
    turns += [(50, None, "user", "first."), (50, 3, "assistant", "third."), (50, 9, "user", "last"), (51, None, "user", "x.")]
    turns += [(60, t, rng.choice(["user", "assistant", "system"]), f"text {t}{rng.choice(['.', ''])}") for t in range(700)]
    turns.append((52, 2, "user", "A very long text. " * 60_000 + "cut"))
    return turns


def run(spark, turns, tmp_path):
    from riskframe.llm.queries import LLM_QUERIES

    frame = spark.createDataFrame(turns, SCHEMA).selectExpr(
        "*", "1 as __row", "2 as part", "'x' as initial", "3 as seq", "4 as fault")
    frame.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    return LLM_QUERIES["op11_structure_repair"](spark, str(tmp_path))


def test_repair_against_brute_force(spark, tmp_path):
    """Odd rows, null ids beside large ones, and a conversation longer than a range of rows."""
    turns = odd_turns(1)
    got = run(spark, turns, tmp_path)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(turns)


def test_no_turns(spark, tmp_path):
    assert run(spark, [], tmp_path).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = run(spark, [(gone, 0, "user", "Hi.")], tmp_path).collect()
    assert [tuple(r) for r in rows] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_against_brute_force(spark):
    from riskframe.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, LLM_QUERIES["op11_structure_repair"](spark, folder).collect()), key=str) == brute(turns)
