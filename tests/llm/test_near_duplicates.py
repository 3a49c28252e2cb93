"""The n-gram join at other thresholds than its contract's, against brute force."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from wreckline.llm import ngram_join
from wreckline.llm.ngram_join import Windows, ngram_components

from .test_text_models import join_rows, shingles


def components_at(texts, width, percent):
    sets = {k: shingles(t, width) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {k: (len(sets[k]), find(k)) for k in sets}


def share_a_key(x, y, windows):
    hashes, bounds = np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)])
    keys, row = ngram_join.window_keys(hashes, bounds, windows)
    return bool(set(keys[row == 0].tolist()) & set(keys[row == 1].tolist()))


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95])
def test_every_allowed_partner_shares_a_key(percent):
    rng, windows = np.random.default_rng(7), Windows(percent)
    for n in [*range(1, 300), 600, 1000, 1999]:
        y = np.unique(rng.integers(0, 2**64, 100 * n // percent, dtype=np.uint64))
        x = np.sort(rng.choice(y, n, replace=False))  # the largest partner holds the whole set
        if len(x) < len(y):
            assert share_a_key(x, y, windows), (len(x), len(y))
        # Equal sizes, as many shingles exchanged as the threshold allows.
        gone = n * (100 - percent) // (100 + percent)
        if gone:
            z = np.unique(np.concatenate((np.delete(x, rng.choice(n, gone, replace=False)), rng.integers(0, 2**64, gone, dtype=np.uint64))))
            assert share_a_key(x, z, windows), (n, gone)


@pytest.mark.parametrize("block", [1 << 20, 1200])
def test_components_at_another_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = join_rows()
    # 100 and 125 distinct 5-word shingles, 100 of them common: exactly 0.8.
    rows += [(1000 + k, " ".join(f"s{i}" for i in range(n))) for k, n in enumerate((104, 129, 162))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(df, width=5, percent=80).collect()}
    want = components_at(dict(rows), 5, 80)
    assert want[1001] == (125, 1000) and got == want
