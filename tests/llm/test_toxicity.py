"""Toxicity by compression distance: held-out labels, planted texts and edge cases."""

from __future__ import annotations

import pickle
import random
import zlib

import pytest

from wreckline.llm.registry import op12_toxicity
from wreckline.llm.toxicity import WINDOW, fit_toxicity, score_toxicity, train, windows


def test_windows_hold_the_whole_text():
    for text in ("", " \n", None, "one two", "a b " * 500, "x" * 5000, "é ü\n" * 300):
        made = windows(text)
        assert b"".join(made) == (text or "").strip(" \t\n\x0b\x0c\r").encode()
        assert all(len(w) <= WINDOW + 400 for w in made)


def texts_of(rng, n, bad):
    plain = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    out = []
    for _ in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(60, 200))]
        if bad:
            for _ in range(max(3, len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(["zquxxy", "vwokkj", "yxzzib"])
        out.append(" ".join(w))
    return out


def test_planted_words_are_learned_and_clean_texts_left():
    rng = random.Random(3)
    bad, good = texts_of(random.Random(8), 150, True), texts_of(random.Random(8), 300, False)
    model = pickle.loads(pickle.dumps(train(bad[:100], good[:200])))
    caught = model.scores(bad[100:]) >= 0.5
    blamed = model.scores(good[200:]) >= 0.5
    assert caught.mean() > 0.9 and blamed.mean() < 0.05
    some = bad[100:103] + ["", None] + good[200:203]
    assert model.scores(some).tolist() == pytest.approx([model.scores([t])[0] for t in some])
    long = " ".join(good[200:260])
    assert rng and model.scores([long])[0] < 0.5


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op12_toxicity(spark, sf).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    pairs = [(a > b) + (a == b) / 2 for a, x in judged if x for b, y in judged if not y]
    assert sum(pairs) / len(pairs) > 0.75
    assert sum(s >= 0.5 for s, x in judged if not x) / sum(not x for _, x in judged) < 0.05


def test_edge_cases(spark):
    schema = "doc_id long, text string, toxic int"
    df = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (3, " \t", 9.0), (4, "some words", 9.0), (4, "some words", 9.0)],
                               "doc_id long, text string, SCORE double")
    for labelled, want in (([], 0.0), ([(1, "a b", 1), (2, "c", 1)], 1.0), ([(1, "a b", 0), (2, "c", None)], 0.0)):
        rows = spark.createDataFrame(labelled, schema)
        model = fit_toxicity(rows, rows.select("toxic", "doc_id"))
        out = score_toxicity(df, model)
        assert sorted(out.columns) == ["doc_id", "score", "text"]
        assert {(r.doc_id, r.score) for r in out.collect()} == {(1, 0.0), (2, 0.0), (3, 0.0), (4, want)}
    rows = spark.createDataFrame([(1, "good words here", 0), (2, "zq zq zq", 1), (2, "zq zq zq", 0)], schema)
    both = fit_toxicity(rows, rows)
    assert both.share == 0.5 and score_toxicity(df, both).count() == 5 and score_toxicity(df.limit(0), both).count() == 0
