"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from wreckline.llm.conversation_repair import cheapest_edits, repair_conversations, text_digests
from wreckline.llm.registry import damaged, op13_conversation_repair

SF = "/root/testdata/sf0.001"
WELL = re.compile(r"(s?(ua)+)?$")


def faults(rows):
    """blank, duplicate, truncated or None of rows (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def search(rows, found):
    """(cost, audit, repaired) by uniform-cost search over edits, without any dynamic program."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, made = heapq.heappop(heap)
        if at == len(rows) and WELL.match(roles):
            return cost, audit, made
        state = (at, roles[-1:], len(roles) == 0)
        if state in done:
            continue
        done.add(state)
        nexts = []
        for r in ("user", "assistant"):
            nexts.append((cost + 3, audit + "I", at, r, ""))
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, made))
            if found[at] not in ("blank", "duplicate"):
                extra = 3 if found[at] == "truncated" else 0
                nexts.append((cost + extra, audit + "K", at + 1, role, text))
                nexts += [(cost + extra + 3, audit + "R", at + 1, r, text) for r in ("user", "assistant")]
        for c, a, n, r, t in nexts:
            i = r[:1]
            if (i in ("s", "u") and not roles) or roles[-1:] + i in ("su", "ua", "au"):
                heapq.heappush(heap, (c, a, n, roles + i, (*made, (r, t))))
    raise AssertionError


def brute(rows):
    """rows: (turn, role, text) of one conversation, in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [(r[1], r[2]) for r in rows]
    found = faults(pairs)
    initials = [r[:1] for r, _ in pairs]
    cost, audit, made = search(pairs, found)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def damage(rows):
    """rows: (conv_id, turn, role, text)"""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def expected(rows, convs):
    return {c: brute([r[1:] for r in rows if r[0] == c]) for c in convs}


def collected(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_cheapest_edits_match_a_search():
    rng = random.Random(4)
    for _ in range(1500):
        rows, found, symbols = [], [], []
        for _ in range(rng.randint(0, 7)):
            i, f = rng.choice([0, 1, 1, 2, 2, 3]), rng.choice([0, 0, 0, 1, 2])
            for _ in range(rng.choice([1, 1, 1, 2, 5])):
                rows.append((["system", "user", "assistant", "tool"][i], "x"))
                found.append([None, "truncated", "blank"][f])
                symbols.append(3 * i + f)
        runs = []
        for s in symbols:
            runs = [*runs[:-1], (s, runs[-1][1] + 1)] if runs and runs[-1][0] == s else [*runs, (s, 1)]
        cost, audit, _ = search(rows, found)
        assert cheapest_edits(runs) == (cost, audit), (rows, found)


def test_long_runs():
    cost, audit = cheapest_edits([(3, 100_001), (5, 70_000), (6, 3)])
    assert len(audit) >= 170_004 and audit.count("D") >= 70_000 and cost > 0


def test_table_matches_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = collected(op13_conversation_repair(spark, SF))
    assert got == expected(damage(given), {r[0] for r in given})


@pytest.mark.parametrize("seed", [1, 2])
def test_edge_cases(spark, tmp_path, seed):
    rng = random.Random(seed)
    texts = [None, "", " \t", "One.", "Two!", "cut", "Three? \n", "é" * 50_000 + ".", "a:b\nc."]
    roles = ["user", "assistant", "system", None, "", "User", "tool"]
    given = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice(roles), rng.choice(texts)) for _ in range(70)]
    given += [(7, 2, "user", "Same.")] * 20 + [(8, None, "user", "Q.")]
    given += [(100 + k, 0, "user", "Lost.") for k in range(40)]  # some lose their only row
    df = spark.createDataFrame([(*r, 1, 2) for r in given], "conv_id long, turn long, role string, text string, audit int, kind int")
    (tmp_path / "t").mkdir()
    df.write.parquet(f"{tmp_path}/t/conversations.parquet")
    assert collected(op13_conversation_repair(spark, f"{tmp_path}/t")) == expected(damage(given), {r[0] for r in given})


def test_repaired_rows_and_empty_table(spark):
    df = spark.createDataFrame([("a", 1, "assistant", "Hi."), ("a", 2, "system", "Ok."), ("b", 1, "user", "")],
                               "conv_id string, turn int, role string, text string")
    summary, repaired = repair_conversations(df)
    assert {r.conv: r.audit for r in summary.collect()} == {"a": "RR", "b": "D"}
    rows = repaired.orderBy("conv", "place").collect()
    assert WELL.match("".join(r.role[0] for r in rows)) and all(r.conv == "a" for r in rows)
    summary, repaired = repair_conversations(df.limit(0))
    assert summary.count() == 0 and repaired.count() == 0 and text_digests(repaired, summary).count() == 0
    assert damaged(df.limit(0)).count() == 0
