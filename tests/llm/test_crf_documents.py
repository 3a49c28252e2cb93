"""The line classifier's document scores and its sample against plain Python."""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from wreckline.llm.line_crf import LineModel, _sample, fit_line_model, lines_of, score_quality

TEXTS = ["The roof, it held.\nBUY NOW!!! 50% off\n\nbuy buy now", "one line", "", "été à l'été\n12 34 {x}\n  \nend.", "a\n" * 6]


def own_features(line, before):
    """The own features of a line as the module's docstring and table name them."""
    words = [w for w in re.split(r"[\x20\x09\x0B-\x0D]+", line) if w]
    n, w, c = len(line), max(len(words), 1), max(len(line), 1)
    spaces, upper = sum(x in " \t\x0b\x0c\r" for x in line), sum("A" <= x <= "Z" for x in line)
    digits, symbols = sum("0" <= x <= "9" for x in line), sum(x in "#*$%&|<>{}[]\\^~_=+@" for x in line)
    marks, bangs = sum(x in ".,;:?" for x in line), line.count("!")
    letters = max(n - spaces - upper - digits - symbols - marks - bangs, 1)
    same = sum(a == b for a, b in itertools.pairwise(words))
    return [
        math.log1p(n), math.log1p(len(words)), min((n - spaces) / w, 40), min(symbols / w, 4), upper / c, digits / c,
        min(bangs / w, 3), min(marks / w, 3), same / w, 1 - len(set(words)) / w,
        float(before is not None and before == line and bool(words)), float(letters < 0.5 * c),
    ]


def chain(text):
    lines = text.split("\n")
    own = [own_features(x, lines[i - 1] if i else None) for i, x in enumerate(lines)]
    none = [0.0] * 12
    rows = []
    for i in range(len(lines)):
        left, right = i > 0, i + 1 < len(lines)
        rows.append(own[i] + (own[i - 1] if left else none) + (own[i + 1] if right else none) + [float(left), float(right), 1.0])
    return np.array(rows), [len(x) for x in lines]


def test_features_match_plain_python():
    for _, _, x, chars, first in lines_of(pa.array(TEXTS)):
        for k, text in enumerate(TEXTS):
            rows, sizes = chain(text)
            assert x[first[k]:first[k + 1]] == pytest.approx(rows) and chars[first[k]:first[k + 1]].tolist() == sizes


def test_scores_match_enumerated_labels(spark):
    rng = np.random.default_rng(3)
    model = LineModel(rng.normal(size=39), rng.uniform(0.5, 2, size=39), rng.normal(size=39) / 4, rng.normal(size=(2, 2)))
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_quality(df, model).collect()}
    for k, text in enumerate(TEXTS):
        rows, sizes = chain(text)
        good = ((rows - model.mean) / model.scale) @ model.weights
        total, mean = 0.0, np.zeros(len(good))
        for s in itertools.product([0, 1], repeat=len(good)):
            w = math.exp(sum(g * y for g, y in zip(good, s, strict=True)) + sum(model.move[a, b] for a, b in itertools.pairwise(s)))
            total, mean = total + w, mean + w * np.array(s)
        weight = np.maximum(sizes, 1e-3)
        assert got[k] == pytest.approx(float((mean / total * weight).sum() / weight.sum()))


def test_the_sample_is_bounded_and_holds_rare_labels(spark):
    units = spark.range(5_000).selectExpr("id AS d", "xxhash64(id) AS h", "IF(id < 3, 1, 0) AS y", "10 AS n")
    rows = _sample(units, {0: 4_997, 1: 3}, 100, 1_000_000).collect()
    assert sum(r.y for r in rows) == 3 and len(rows) <= 103 + 1
    assert len(_sample(units, {0: 4_997, 1: 3}, 100, 255).collect()) == 25
    assert {tuple(r) for r in rows} == {tuple(r) for r in _sample(units.repartition(7), {0: 4_997, 1: 3}, 100, 1_000_000).collect()}


def test_repeated_rows_train_once_and_labels_may_stand_apart(spark):
    docs = [(i, f"plain words of line {i}\nand more of them." if i % 2 else f"BUY $$$ {i}!!!\n#### now") for i in range(40)]
    df = spark.createDataFrame([*docs, *[docs[0]] * 500, (None, "nobody's")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, None)], "doc_id long, quality int")
    apart = fit_line_model(df, labels)
    joined = fit_line_model(spark.createDataFrame([(i, t, i % 2) for i, t in docs], "doc_id long, text string, quality int"))
    assert np.array_equal(apart.weights, joined.weights) and np.array_equal(apart.move, joined.move)
