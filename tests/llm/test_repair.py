"""Conversation repair against enumeration of all edits and against a plain heap search."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from curalis.llm import repair
from tests.conftest import DATA

RIGHT = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\v\f\r"
C = repair.Costs()


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        last = text.rstrip(SPACES)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    return out


def search(rows, costs=C):
    """Cheapest edits, least audit, and the repaired rows, by uniform-cost search over (place, initials so far)."""
    wrong = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, made
        if (i, last) in done:
            continue
        done.add((i, last))
        follow = [x for x in step[last] if x != "s"][0]
        name = {"u": "user", "a": "assistant"}[follow]
        heapq.heappush(heap, (cost + costs.insert, audit + "I", i, follow, (*made, (name, ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + costs.delete, audit + "D", i + 1, last, made))
            if wrong[i] in (None, "truncated"):
                more = costs.truncated if wrong[i] else 0
                heapq.heappush(heap, (cost + costs.rerole + more, audit + "R", i + 1, follow, (*made, (name, text))))
                if role[:1] and role[:1] in step[last]:
                    heapq.heappush(heap, (cost + costs.keep + more, audit + "K", i + 1, role[0], (*made, (role, text))))
    raise AssertionError("no repair")


def enumerated(rows, costs=C):
    """The same by trying every edit of every row, with no insertion (which is never cheapest at the usual costs)."""
    wrong, best = faults(rows), None
    options = [["D"] if w in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for w in wrong]
    for edits in itertools.product(*options):
        kept = [(({"u": "user", "a": "assistant"}[e[1]] if e[0] == "R" else r), t) for e, (r, t) in zip(edits, rows) if e != "D"]
        if all(r for r, _ in kept) and RIGHT.fullmatch("".join(r[0] for r, _ in kept)):
            cost = sum({"D": costs.delete, "K": costs.keep, "R": costs.rerole}[e[0]] + (costs.truncated if e != "D" and w else 0) for e, w in zip(edits, wrong))
            best = min(x for x in (best, (cost, "".join(e[0] for e in edits), tuple(kept))) if x)
    return best


def damage(table):
    """Rows ``(conv, turn, role, text)`` by conversation, as the contract words it."""
    out = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def summary(rows, costs=C):
    md5 = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], md5(x[1], x[2])))
    plain = [x[1:] for x in rows]
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    wrong = Counter(faults(plain))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    cost, audit, made = search(plain, costs)
    joined = "\n".join(f"{r}:{t}" for r, t in made)
    return gaps, wrong["blank"], wrong["duplicate"], wrong["truncated"], illegal, cost, audit, hashlib.sha256(joined.encode()).hexdigest()


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "u", "tool", "", " ", "System"]
    texts = ["Hello.", "Yes!", "Why?", "cut", "Fine. \n", "", " \t", "ok.", "Name it.", "é.", "x ", "a.\x1c"]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randint(0, 99)}.") for _ in range(n)]


def test_search_by_enumeration():
    rng = random.Random(1)
    for _ in range(300):
        rows = some_rows(rng, rng.randint(0, 6))
        assert search(rows) == enumerated(rows)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, key string, kind string, digest string, `a.b` int, id int"


def table(rng, convs=150, longest=30):
    rows = []
    for conv in [None, *range(convs)]:
        for i, (role, text) in enumerate(some_rows(rng, rng.randint(1, longest))):
            turn = None if rng.random() < 0.05 else i + rng.choice([0, 0, 0, 3, -1])
            rows.append((conv, turn, None if rng.random() < 0.03 else role, None if rng.random() < 0.03 else text))
    return [*rows, *rows[:40]]


@pytest.mark.parametrize("run, costs", [(100_000, C), (7, C), (50, repair.Costs(0, 3, 4, 1, 2)), (50, repair.Costs(1, 1, 1, 1, 1))])
def test_repair(spark, monkeypatch, run, costs):
    """Also with costs at which turns are inserted, and with runs shorter than conversations."""
    rng = random.Random(2)
    rows = table(rng)
    df = spark.createDataFrame([(*r, "k", "k", "d", 1, 2) for r in rows], SCHEMA).repartition(5)
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    monkeypatch.setattr(repair, "RUN", run)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.repair(df, costs=costs).collect()}
    assert got == {c: summary(x, costs) for c, x in by_conv.items()}
    assert 2 * costs.insert > costs.delete or any("I" in x[6] for x in got.values())
    turns = {}
    for r in repair.repaired_turns(df, costs=costs).orderBy("conv_id", "place").collect():
        assert r.place == len(turns.setdefault(r.conv_id, []))
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(turns.get(c, [])).encode()).hexdigest() for c in by_conv} == {c: x[-1] for c, x in got.items()}


def test_one_conversation_of_many_long_turns(spark):
    rng = random.Random(3)
    rows = [(7, i, role, text * rng.choice([1, 1, 40_000])) for i, (role, text) in enumerate(some_rows(rng, 3000))]
    got = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [summary([r[1:] for r in rows])]


def test_damage_and_empty_tables(spark):
    rng = random.Random(4)
    rows = table(rng)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.repair(repair.damaged(df), present=F.col("present")).collect()}
    assert got == {c: summary(x) for c, x in damage(rows).items()}
    # A conversation all of whose rows are dropped.
    turn = next(t for t in range(200) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    alone = spark.createDataFrame([(5, turn, "user", "Hi.")], df.schema)
    assert [tuple(r) for r in repair.repair(repair.damaged(alone), present=F.col("present")).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repair(df.limit(0)).count() == 0 and repair.repaired_turns(df.limit(0)).count() == 0


def test_costs_are_checked():
    with pytest.raises(ValueError):
        repair.Costs(insert=0)


def test_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.op12(spark, DATA).collect()}
    assert got == {c: summary(x) for c, x in damage(rows).items()}
