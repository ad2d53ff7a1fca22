import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from florispark.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, cost string, block int"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """All edit sequences that could be cheapest, by trying every edit of every row with up to three insertions before it."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    fault, best = faults(rows), None
    ways = {(0, ""): ""}  # (cost, audit) -> initials
    lines = {(0, ""): ()}
    for (_, role, text), f in zip(rows, fault, strict=True):
        new, new_lines = {}, {}
        for (cost, audit), initials in ways.items():
            for extra in itertools.chain.from_iterable(itertools.product("ua", repeat=n) for n in range(4)):
                head, said = initials + "".join(extra), lines[cost, audit] + tuple((("user", "assistant")[x == "a"], "") for x in extra)
                price, line = cost + 3 * len(extra), audit + "I" * len(extra)
                options = [("D", 4, head, said)]
                if f not in ("blank", "duplicate"):
                    more = 3 * (f == "truncated")
                    options.append(("K", more, head + role[:1] if role else head + "-", (*said, (role, text))))
                    options += [("R", 3 + more, head + r[0], (*said, (r, text))) for r in ("user", "assistant")]
                for letter, p, made, out in options:
                    if GRAMMAR.fullmatch(made) or GRAMMAR.fullmatch(made + "a") or GRAMMAR.fullmatch(made + "ua"):
                        new[price + p, line + letter] = made
                        new_lines[price + p, line + letter] = out
        # of ways that end alike only the cheapest, and of these the least, can win
        ways, lines = {}, {}
        ends = {}
        for k, made in sorted(new.items()):
            end = made[-1:] or "-"
            if end not in ends:
                ends[end] = k
                ways[k], lines[k] = made, new_lines[k]
    for (cost, audit), made in ways.items():
        for tail in ("", "a", "ua"):
            if GRAMMAR.fullmatch(made + tail):
                found = (cost + 3 * len(tail), audit + "I" * len(tail), lines[cost, audit] + tuple((("user", "assistant")[x == "a"], "") for x in tail))
                best = min(best, found) if best else found
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in best[2])
    return gaps, *(fault.count(x) for x in ("blank", "duplicate", "truncated")), illegal, best[0], best[1], hashlib.sha256(text.encode()).hexdigest(), best[2]


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        own = out[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def some(n, seed=7):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8, 13])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hello.", "Yes!", "cut off", "", None, " \n", "Hello.", f"text {turn}?", f"t{turn} end. \t"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn + 1, None]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_steps_and_solutions_by_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        codes = [rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.choice([1, 2, 3, 5, 9]))]
        rows = [(i, ("system", "user", "assistant", "tool")[c & 3], ("", f"say {i}")[c < 8] + ("." if c < 4 else "")) for i, c in enumerate(codes)]
        stretch = [C.steps(C.normal(c)) for c in codes]
        states = C.solve(stretch, C.START, C.TAIL_COST)
        audit = "".join(stretch[i][a][b][1] for i, (a, b) in enumerate(states)) + C.TAIL[states[-1][1]]
        cost = sum(stretch[i][a][b][0] for i, (a, b) in enumerate(states)) + C.TAIL_COST[states[-1][1]]
        assert (cost, audit) == brute(rows)[5:7]


@pytest.mark.parametrize("bits", [1, 12])
def test_whole_tables_against_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    rows = some(120) + [(900, t, "user", f"Again {t // 2}.") for t in range(40)] + [(2**53 + 1, 1, "user", "Hi."), (2**53 + 3, 1, "assistant", "Hi.")]
    got = {r[0]: tuple(r)[1:] for r in C.damage_and_audit(frame(spark, rows).repartition(5)).collect()}
    want = damage(rows)
    assert got.keys() == want.keys()
    for conv, held in want.items():
        assert got[conv] == (brute(held)[:8] if held else (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())), conv


def test_sql_says_the_same(spark):
    rows = some(80, 5)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = sorted(con.execute(C.ORACLE).fetchall(), key=str)
    assert sorted((tuple(r) for r in C.damage_and_audit(frame(spark, rows)).collect()), key=str) == want


@pytest.mark.parametrize("bits", [1, 12])
def test_repaired_rows(spark, bits, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    rows = [r for r in some(60, 11) if r[2] is not None and r[3] is not None]
    got = defaultdict(list)
    for r in sorted(C.repair(frame(spark, rows)).collect(), key=lambda r: r.place):
        got[r.conv_id].append((r.role, r.text))
    per = defaultdict(list)
    for conv, *row in rows:
        per[conv].append(tuple(row))
    assert {c: tuple(got[c]) for c in per} == {c: brute(v)[8] for c, v in per.items()}


def test_a_long_conversation_and_none(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(20_000)]
    r = C.damage_and_audit(frame(spark, rows)).first()
    assert r.audit.count("K") + r.audit.count("D") + r.audit.count("R") == sum(map(len, damage(rows).values()))
    assert C.damage_and_audit(frame(spark, rows).where("false")).count() == 0
    assert C.repair(frame(spark, rows).where("false")).count() == 0
