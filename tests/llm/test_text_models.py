"""N-gram join, line CRF, language ID and decontamination against brute force."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wreckline.llm import ngram_join
from wreckline.llm.components import components
from wreckline.llm.decontaminate import Matcher, benchmark_hits, decontaminate, myers, normalised, pieces
from wreckline.llm.language_id import fit_text_model, identify_language, markup_language, page_text
from wreckline.llm.line_crf import fit_line_model, forward_backward, lines_of, score_quality
from wreckline.llm.ngram_join import Windows, keep_one, ngram_components
from wreckline.llm.registry import op3_ngram_join, op5_line_crf
from wreckline.llm.shingles import set_keys, shingle_sets

SF = "/root/testdata/sf0.001"


def shingles(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute_components(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {k: (len(sets[k]), find(k)) for k in sets}


def test_shingle_sets_match_brute_force():
    texts = ["a b c d e", None, "", " \t\n", "A b", "a B", "one", "É é É é É", "x " * 5000, "a b c d e", "no\x0bsplit\xa0here \x1f ok"]
    got = {}
    for lo, hi, hashes, bounds in shingle_sets(pa.array(texts)):
        for k in range(lo, hi):
            part = hashes[bounds[k - lo]:bounds[k - lo + 1]]
            assert len(part) == len(shingles(texts[k])) and (np.diff(part) > 0).all() if len(part) > 1 else True
            got[k] = (len(part), *(int(x[k - lo]) for x in set_keys(hashes, bounds)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert (got[i] == got[j]) == (shingles(texts[i]) == shingles(texts[j])), (i, j)


def test_pigeonhole_is_complete():
    """Any two sets at the threshold share a key, for many sizes and overlaps."""
    rng, windows = np.random.default_rng(3), Windows()
    for size in [6, 7, 11, 20, 50, 143, 600, 3000]:
        for _ in range(30):
            x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            gone = rng.integers(0, int(0.15 * len(x)) + 1)
            y = np.delete(x, rng.choice(len(x), gone, replace=False))
            room = max(0, int(100 * len(y) / 85) - len(x) - 0)
            y = np.unique(np.concatenate((y, rng.integers(0, 2**64, rng.integers(0, room + 1), dtype=np.uint64))))
            if 100 * len(np.intersect1d(x, y)) < 85 * len(np.union1d(x, y)) or len(x) == len(y) == gone == 0:
                continue
            hashes, bounds = np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)])
            keys, row = ngram_join.window_keys(hashes, bounds, windows)
            sent = [set(keys[row == k].tolist()) for k in (0, 1)]
            shared = bool(sent[0] & sent[1]) or np.array_equal(x, y)
            assert shared, (size, len(x), len(y))


def family(seed, n, words=60, edits=6):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def join_rows():
    rows = [(1, None), (2, ""), (3, " "), (4, "one two"), (5, "ONE two"), (6, "one"), (7, "a b c d"), (8, "a b c e")]
    i = 100
    for seed, n in ((1, 60), (2, 25), (3, 4)):
        for t in family(seed, n):
            rows.append((i, t))
            i += 1
    rows += [(i + k, "copy of the same text again and again") for k in range(40)]
    return rows


@pytest.mark.parametrize("block", [1 << 20, 1200])
def test_components_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # a small block cuts families into tiles
    rows = join_rows()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n long").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(df).collect()}
    assert got == brute_components(dict(rows))


def test_join_on_the_table_and_edge_cases(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op3_ngram_join(spark, SF).collect()}
    assert got == brute_components(texts)
    twice = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "a b c d e f"), (None, "a b c d e f"), (None, None)], "doc_id long, text string")
    rows = ngram_components(twice).collect()
    assert len(rows) == 6 and {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (2, 1), (None, None)}
    assert sorted(keep_one(twice).collect(), key=str) == sorted(
        spark.createDataFrame([(1, "a b c d e f"), (None, "a b c d e f"), (None, None)], twice.schema).collect(), key=str)
    assert ngram_components(twice.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 199), (199, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    first = np.array([0, 5, 6, 9])
    good, move = rng.normal(size=9), rng.normal(size=(2, 2))
    p, expected = forward_backward(good, move, first)
    moves = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:], strict=True):
        z, marginal, seen = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for s in itertools.product([0, 1], repeat=b - a):
            w = np.exp(sum(good[a + i] * s[i] for i in range(b - a)) + sum(move[x, y] for x, y in itertools.pairwise(s)))
            z += w
            marginal += w * np.array(s)
            for x, y in itertools.pairwise(s):
                seen[x, y] += w
        assert p[a:b] == pytest.approx(marginal / z)
        moves += seen / z
    assert expected == pytest.approx(moves)


def test_line_features_of_edge_texts():
    texts = [None, "", "a\nb", "\n\n", "end\n", "the the the", "é" * 70_000, "one\none"]
    got = [(first, x, chars) for _, _, x, chars, first in lines_of(pa.array(texts))]
    first, x, chars = got[0]
    assert np.diff(first).tolist() == [1, 1, 2, 3, 2, 1, 1, 2]
    assert chars.tolist()[:4] == [0, 0, 1, 1] and np.isfinite(x).all() and chars[first[6]] == 70_000
    assert x[first[5], 8] == pytest.approx(2 / 3) and x[first[7] + 1, 10] == 1


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op5_line_crf(spark, sf).collect()
    assert len(rows) == 1000
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95


def test_classifier_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, text string, quality int")
    model = fit_line_model(none)
    df = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "a\n\nb", 0.5), (3, "a\n\nb", 0.5)], "doc_id long, text string, SCORE double")
    assert [r.score for r in score_quality(df, model).collect()] == [0.5] * 4
    one = fit_line_model(spark.createDataFrame([(1, "x", 1), (2, "y", 1), (3, "z", None)], none.schema))
    assert {r.score for r in score_quality(df, one).collect()} == {1.0}
    assert score_quality(df.limit(0), model).count() == 0


def edit_distance_anywhere(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        now = [i + 1]
        for j, d in enumerate(text):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before), before.index(min(before))


def test_myers_and_matcher_match_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(1, 120)))
        distance, end = edit_distance_anywhere(p, t)
        k = rng.randint(0, len(p) - 1)
        assert myers(p, t, k) == ((distance, end) if distance <= k else None)
    alphabet = "abcdefgh "
    for _ in range(200):
        item = normalised("".join(rng.choice(alphabet) for _ in range(rng.randint(30, 120))))
        noisy = list(item)
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(noisy))
            noisy[at:at + 1] = rng.choice([[], [rng.choice("xyz")], [noisy[at], "q"]])
        text = normalised("".join(rng.choice(alphabet) for _ in range(80)) + "".join(noisy) + "".join(rng.choice(alphabet) for _ in range(80)))
        k = int(0.05 * len(item))
        got = Matcher([(1, item)], 0.05).find(text)
        distance, _ = edit_distance_anywhere(item, text)
        assert [(g[0], g[1]) for g in got] == ([(1, distance)] if distance <= k else [])
    assert "".join(p for _, p in pieces("abcdefg", 2)) == "abcdefg" and len(pieces("abcdefg", 2)) == 3


def test_decontamination_finds_planted_items_and_leaves_the_rest(spark, documents, texts):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    want = {(d, i) for d, t in texts.items() for i, b in items.items() if normalised(b) in normalised(t)}
    for block in (4_000_000, 1500):  # one block of items, and many
        got = {(r.doc_id, r.item_id): r.distance for r in benchmark_hits(documents, benchmark, block_chars=block).collect()}
        assert {k for k, v in got.items() if v == 0} == want
    item = next(iter(items.values()))
    edited = item[:20] + "x" + item[22:60] + "yy" + item[60:]
    docs = spark.createDataFrame(
        [(1, "Before. " + edited.upper().replace(" ", "\n ") + " after.", 7), (2, None, 7), (3, "", 7), (4, item[:len(item) // 2], 7),
         (5, "w " * 100_000 + item, 7), (5, "w " * 100_000 + item, 7)], "doc_id long, text string, item_id int")
    assert sorted(r.doc_id for r in benchmark_hits(docs, benchmark).collect()) == [1, 5, 5]
    kept = decontaminate(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == docs.columns
    assert benchmark_hits(docs, benchmark.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "item_id long, text string")
    assert decontaminate(docs, blank).count() == 6 and decontaminate(docs.limit(0), benchmark).count() == 0


def test_language_of_documents_and_pages(spark, documents):
    from pyspark.sql import functions as F

    judged = identify_language(documents, F.col("text"), F.col("lang"), F.col("source"))
    assert judged.columns == [*documents.columns, "language", "posterior", "kept"]
    assert judged.where("language <> lang OR NOT kept OR posterior > 1").count() == 0
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(
        "page_id", "url", page_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"))
    read = identify_language(pages, F.col("text"), F.col("declared"), F.col("url"))
    assert read.where("language <> declared OR NOT kept").count() == 0


def test_language_evidence_and_edge_cases(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_text_model(docs, F.col("text"), F.col("lang"))
    assert set(model.languages) == {"de", "en", "es", "fr"}
    some = [r.text for r in docs.where("lang = 'de'").orderBy("doc_id").limit(20).collect()]
    rows = [(i, t, "en" if i < 3 else "de", "http://www.site.de/x", 1) for i, t in enumerate(some)]
    rows += [(50, None, "de", "http://site.de/", 1), (51, "", None, None, 1), (52, "12 34 %% --", "de", "", 1), (53, "in", None, "https://site.de:80/a", 1)]
    rng = random.Random(1)
    rows.append((54, " ".join("".join(rng.choice("qxzjvkwyb") for _ in range(7)) for _ in range(40)), "de", "http://site.de/", 1))
    rows.append((55, "Der Hund und die Katze sind mit dem Kind 4045650754681188 ldlooirp.70@mail5.example.com +1 (227) 555-6608", "de", None, 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, address string, Kept int")
    got = {r.doc_id: r for r in identify_language(df, F.col("text"), F.col("lang"), F.col("address"), model).collect()}
    assert len(got) == len(rows)
    assert all(got[i].language == "de" and got[i].kept for i in range(20))  # wrong declarations do not win
    assert not got[50].kept and not got[51].kept and not got[52].kept
    assert got[54].language == "und" and not got[54].kept  # random letters, whatever is declared
    assert got[55].kept  # a few strings that are no words do not make a text foreign
    assert got[53].language == "de"  # two letters: the host decides
    only = identify_language(df, F.col("text"), F.col("lang"), F.col("address"), model, wanted=("en",))
    assert only.where("kept").count() == 0
    assert identify_language(df.limit(0), F.col("text"), F.col("lang"), F.col("address")).count() == 0
