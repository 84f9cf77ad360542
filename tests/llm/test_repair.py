"""Structure repair against exhaustive search, and trails against strings."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tierkit.llm import repair
from tierkit.llm.queries import op12_structure_repair
from tierkit.llm.trails import Trails

SMALL = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 1, 3])
def test_trails_compare_like_strings_also_when_hashes_collide(prime):
    rng, trails, said = random.Random(7), Trails(prime=prime), {0: ""}
    for _ in range(400):
        at = rng.choice(list(said)[-12:])
        letter = rng.choice("DIKR"[: rng.choice([1, 2, 4])])
        said[trails.grow(at, letter)] = said[at] + letter
    nodes = list(said)
    assert [trails.spell(n) for n in nodes] == list(said.values())
    for a, b in itertools.product(rng.sample(nodes, 120), repeat=2):
        assert trails.less(a, b) == (said[a] < said[b])


def allowed(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def cheapest(rows):
    """(cost, edits, roles and texts) of rows (role, text, fault) by a search that
    knows nothing of states: cheapest first, of equals the least string."""
    heap, best = [(0, "", 0, "", ())], None
    while heap:
        cost, said, i, roles, out = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(rows) and allowed(roles) and (best is None or (cost, said) < best[:2]):
            best = (cost, said, out)
        if cost > 3 * len(rows):  # deleting all is never dearer
            continue
        for r in "ua":
            if allowed_start(roles + r):
                heapq.heappush(heap, (cost + 2, said + "I", i, roles + r, (*out, ({"u": "user", "a": "assistant"}[r], ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, said + "D", i + 1, roles, out))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if allowed_start(roles + (role[:1] or "?")):
                heapq.heappush(heap, (cost + more, said + "K", i + 1, roles + role[:1], (*out, (role, text))))
            for name in ("user", "assistant"):
                if allowed_start(roles + name[0]):
                    heapq.heappush(heap, (cost + 2 + more, said + "R", i + 1, roles + name[0], (*out, (name, text))))
    return best


def allowed_start(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return all(c == "ua"[i % 2] for i, c in enumerate(rest))


def faults(rows):
    """Rows (role, text) with their first fault."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    """Of one conversation's rows (turn, role, text) in order."""
    told = faults([(r, t) for _, r, t in rows])
    cost, audit, out = cheapest(told) if rows else (0, "", ())
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = [sum(f == x for _, _, f in told) for x in ("blank", "duplicate", "truncated")]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *count, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)


def damaged(rows):
    """Damage of (conv, turn, role, text) rows, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        spelled = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        lot = zlib.crc32(spelled.encode()) % 20
        mine = out.setdefault(conv, [])
        if lot == 1:
            text = ""
        elif lot == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif lot == 4:
            role = "user"
        mine += [(turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def test_blocks_give_the_cheapest_and_least_edits():
    for n in range(0, 5):
        for codes in map("".join, itertools.product("dsuaxUA", repeat=n)):
            names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
            rows = [(names[c.lower()], f"t{i}", "blank" if c == "d" else "truncated" if c.isupper() else None) for i, c in enumerate(codes)]
            cost, audit, _ = cheapest(rows)
            for cut in (1, 2, n or 1):
                parts = [codes[i : i + cut] for i in range(0, n, cut)]
                tables = [{e: repair.exits(p, e) for e in range(4)} for p in parts]
                got, passed, tail = repair.route(tables)
                said = ""
                for part, a, b in zip(parts, passed, passed[1:]):
                    trails, best = repair.edits(part, a)
                    said += trails.spell(best[b][1])
                assert (got, said + tail) == (cost, audit), (codes, cut)


def test_query_equals_exhaustive_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_structure_repair(spark, SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {c: brute(v) for c, v in damaged(rows).items()}


def test_faults_nulls_ties_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 2)  # conversations of many blocks
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["Yes.", "No", " \t", None, "", "Why? ", "Yes.", "So!\n", "é…"]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(60)] for _ in range(rng.randint(1, 6))]
    rows += [(100, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}." if i % 7 else "cut") for i in range(300)]
    rows += [(101, 5, "user", "Same.")] * 9 + [(102, 0, "user", "Long word. " * 50_000), (102, 1, "assistant", "x" * 200_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    for c in ("conv", "codes", "edits", "lot", "copy", "place", "a.b"):
        df = df.withColumn(c, F.lit("z"))
    hurt, dropped = repair.damage(df)
    got = {r[0]: tuple(r)[1:] for r in repair.summaries(hurt, place=(F.col("copy"),), dropped=dropped).collect()}
    want = damaged(rows)
    assert set(got) == set(want)
    for conv, v in want.items():
        if len(v) < 12:
            assert got[conv] == brute(v), conv
    (only,) = [v for c, v in want.items() if c == 100]
    told = faults([(r, t) for _, r, t in only])
    codes = "".join("d" if f in ("blank", "duplicate") else r[0].upper() if f else r[0] for r, _, f in told)
    cost, passed, tail = repair.route([{0: repair.exits(codes, 0)}])
    trails, best = repair.edits(codes)
    assert got[100][5:7] == (cost, trails.spell(best[passed[-1]][1]) + tail)
    turns = repair.repaired_turns(hurt, place=(F.col("copy"),)).orderBy("conv_id", "place").collect()
    for conv in want:
        lines = "\n".join(f"{r['role']}:{r['text']}" for r in turns if r["conv_id"] == conv)
        assert hashlib.sha256(lines.encode()).hexdigest() == got[conv][-1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    hurt, dropped = repair.damage(df)
    assert repair.summaries(hurt, dropped=dropped).collect() == []
    assert repair.repaired_turns(hurt).collect() == []
