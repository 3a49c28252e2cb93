"""Blocks of items read documents once; short items match whole words only."""

from __future__ import annotations

import re

import pytest

from wreckline.llm.decontaminate import Matcher, benchmark_hits, decontaminate, normalised


@pytest.mark.parametrize("item, text, found", [
    ("an", "the answer is unrelated", False),
    ("an", "an answer", True),
    ("an", "what can (an) answer", True),
    ("an", "can", False),
    ("42", "it is 1420", False),
    ("42", "it is 42.", True),
    ("c++", "c++ and", True),
    ("?!", "what?!no", True),
    ("ein wort", "kein wort, ein worte", False),
    ("ein wort", "kein wort, ein wort", True),
])
def test_short_items_match_whole_words(item, text, found):
    hits = Matcher([(1, item)], 0.05).find(text)
    assert bool(hits) == found
    if found:
        edge = [r"(?<![^\W_])" if item[0].isalnum() else "", r"(?![^\W_])" if item[-1].isalnum() else ""]
        end = re.search(edge[0] + re.escape(item) + edge[1], text).end()
        assert hits == [(1, 0, 0, end)]


def test_blocks_and_chunks_read_the_documents_once(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny xi omikron pi rho sigma tau".split()
    items = [(i, " ".join(words[(i * k) % len(words)] for k in range(1, 9))) for i in range(40)] + [(None, "pi"), (3, "rho")]
    rows = [(d, None if d % 50 == 0 else f"{words[d % 19]} {items[d % 40][1].upper()}x " * (1 + d % 3), d) for d in range(600)]
    rows += [(600, "", 0), (600, None, 0), (None, "the pi of it", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = Matcher([(i, normalised(t)) for i, t in items], 0.05)
    want = sorted(((d, *hit) for d, t, _ in rows if t for hit in one.find(normalised(t))), key=str)
    for block, chunk in ((4_000_000, 64_000_000), (200, 64_000_000), (200, 3_000), (1, 1)):
        got = benchmark_hits(docs, benchmark, block_chars=block, chunk_chars=chunk)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Union" not in plan
        assert sorted(map(tuple, got.collect()), key=str) == want
        kept = decontaminate(docs, benchmark, block_chars=block, chunk_chars=chunk)
        hit = {(d, t) for d, t, _ in rows if t and one.find(normalised(t))}
        assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[:2] not in hit), key=str)
