"""op12: least repairs against enumeration, segments that run over tasks, nulls and repeats."""

import random
import re
from functools import lru_cache
from hashlib import sha256
from itertools import product
from zlib import crc32

import pytest

from granary.llm import conversation_repair as cr
from granary.llm.queries import op12_conversation_repair
from llm_help import by_id

SHAPE = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"


def fates(rows):
    """Per row: blank, duplicate, truncated or good."""
    seen, out = set(), []
    for role, text in rows:
        held = text.strip(BLANK)
        out.append("blank" if not held else "duplicate" if (role, text) in seen else "truncated" if held[-1] not in ".!?" else "good")
        seen.add((role, text))
    return out


def by_enumeration(rows, inserts=2):
    """Every edit of a few rows: the least (cost, audit, repaired)."""
    kinds = fates(rows)
    gaps = [x for n in range(inserts + 1) for x in product("ua", repeat=n)]
    found = []
    for edits in product("DKua", repeat=len(rows)):
        if any(e != "D" and k in ("blank", "duplicate") for e, k in zip(edits, kinds)):
            continue
        for put in product(gaps, repeat=len(rows) + 1):
            initials, audit, cost, out = "", "", 0, []
            for i in range(len(rows) + 1):
                for x in put[i]:
                    initials, audit, cost = initials + x, audit + "I", cost + 3
                    out.append(cr.GIVEN[x] + ":")
                if i < len(rows):
                    (role, text), e = rows[i], edits[i]
                    audit += "R" if e in "ua" else e
                    cost += {"D": 4, "K": 0}.get(e, 3) + (3 if e != "D" and kinds[i] == "truncated" else 0)
                    if e != "D":
                        role = role if e == "K" else cr.GIVEN[e]
                        initials += role[:1] or "?"
                        out.append(f"{role}:{text}")
            if SHAPE.match(initials):
                found.append((cost, audit, "\n".join(out)))
    return min(found)


def by_recursion(rows):
    """Least (cost, audit, repaired) over suffixes, as pairs of a number and a string."""
    kinds = fates(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def rest(i, state, put):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text = rows[i]
            cost, audit, out = rest(i + 1, state, 0)
            found.append((cost + 4, "D" + audit, out))
            if kinds[i] in ("truncated", "good"):
                more = 3 * (kinds[i] == "truncated")
                for name, letter, price in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if (state, name[:1]) in step:
                        cost, audit, out = rest(i + 1, step[state, name[:1]], 0)
                        found.append((cost + price + more, letter + audit, (f"{name}:{text}", *out)))
        if put < 3:
            for x in "ua":
                if (state, x) in step:
                    cost, audit, out = rest(i, step[state, x], put + 1)
                    found.append((cost + 3, "I" + audit, (cr.GIVEN[x] + ":", *out)))
        return min(found, default=(10 ** 9, "~", ()))

    cost, audit, out = rest(0, "", 0)
    return cost, audit, "\n".join(out)


def some_rows(rng, n):
    texts = ["Yes.", "No", "a b!", " ", "", "Why?", "x\n"]
    roles = ["user", "assistant", "system", "tool", "", " "]
    return [(rng.choice(roles[:3] if rng.random() < 0.9 else roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}.") for _ in range(n)]


def expected(rows):
    """Contract's row of a conversation from (turn, role, text) in order."""
    kinds = fates([r[1:] for r in rows])
    cost, audit, text = by_recursion(tuple(r[1:] for r in rows))
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": sha256(text.encode()).hexdigest(), "repaired": text,
    }


def held(rows):
    segment, seen = cr.Segment(), set()
    for i, (role, text) in enumerate(rows):
        segment.add(i, role, text, (role, text) not in seen)
        seen.add((role, text))
    return segment


def test_least_edits_by_enumeration():
    rng = random.Random(3)
    for _ in range(60):
        rows = some_rows(rng, rng.randint(0, 3))
        cost, audit = cr.settled(held(rows).rows)
        text = "\n".join(cr.replay(held(rows).rows, audit, 0)[0])
        assert (cost, audit, text) == by_enumeration(rows) == by_recursion(tuple(rows))


def test_least_edits_of_longer_conversations():
    rng = random.Random(4)
    for _ in range(400):
        rows = some_rows(rng, rng.randint(4, 40))
        got = held(rows).whole(1, True)
        want = expected([(i, *r) for i, r in enumerate(rows)])
        assert {k: got[k] for k in want} == want


def conversations(rng):
    rows = []
    for conv in [*range(40), None]:
        for turn in sorted(rng.sample(range(60), rng.randint(1, 30))):
            role, text = some_rows(rng, 1)[0]
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 3])
    # one conversation holds a third of all rows, under null turns, under one turn and under many
    for i in range(300):
        rows.append((7, None if i < 30 else 500 if i < 90 else 500 + i, *some_rows(rng, 1)[0]))
    return rows + [(99, 1, None, None), (99, None, "user", "Yes."), (98, None, None, "No.")]


def grouped(rows):
    from collections import defaultdict

    got = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        got[conv].append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).digest())
    return {c: sorted(v, key=order) for c, v in got.items()}


@pytest.mark.parametrize("segment", [4, 256])
def test_repair_over_tasks_and_segments(spark, segment):
    rows = conversations(random.Random(5))
    random.Random(6).shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, key int, kind string").repartition(4)
    got = by_id(cr.repair(df, segment=segment), "conv_id")
    want = grouped(rows)
    assert set(got) == set(want)
    for conv, held_rows in want.items():
        row = got[conv]
        assert {k: v for k, v in row.items() if k != "conv_id"} == expected(held_rows), conv


def by_contract(rows):
    out = {}
    convs = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        convs.setdefault(conv, [])
        convs[conv] += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    for conv, held_rows in convs.items():
        want = expected(grouped(held_rows).get(conv, []))
        want.pop("repaired")
        out[conv] = {"conv_id": conv, **want}
    return out


def test_query_by_the_contract(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, *some_rows(rng, 1)[0]) for c in range(150) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "Yes."), (5, None, None, "x"), (400, None, None, None)]
    assert any(crc32(f"{c}:{t}".encode()) % 20 == 0 and not any(r[0] == c and r[1] != t for r in rows) for c, t, *_ in rows)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = op12_conversation_repair(spark, str(tmp_path))
    assert by_id(got, "conv_id") == by_contract(rows)


def test_driver_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert by_id(op12_conversation_repair(spark, "/root/testdata/sf0.01"), "conv_id") == by_contract(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string, copies int")
    assert cr.repair(empty).collect() == []


def test_many_copies_of_one_row(spark):
    df = spark.createDataFrame([("c", 1, "user", "Yes.", 1000), ("c", 2, "assistant", "No.", 1)], "conv_id string, turn int, role string, text string, copies int")
    [row] = cr.repair(df, copies_col="copies").collect()
    assert (row.cost, row.audit, row.duplicate, row.repaired) == (4 * 999, "K" + "D" * 999 + "K", 999, "user:Yes.\nassistant:No.")
