"""The corpus pipeline, stage by stage against brute force, and its registration."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from wreckline.llm.common import staged
from wreckline.llm.decontaminate import normalised
from wreckline.llm.registry import ORACLE_SQL, QUERIES

from .test_near_duplicates import components_at
from .test_sharding_mixing import targets, words

SF = "/root/testdata/sf0.001"


def test_every_stage_on_its_own_input(spark, documents, texts):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "benchmark_free", "mix", "shard"]
    columns = documents.columns

    known = staged(stages["language"](spark, documents, SF), "t-language")
    assert known.columns == columns
    assert {r.doc_id for r in known.collect()} == set(texts)  # every language is one of the model's

    single = staged(stages["near_duplicates"](spark, known, SF), "t-near")
    want = {k for k, (_, c) in components_at(texts, 5, 80).items() if c == k}
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(want)

    clean = staged(stages["benchmark_free"](spark, single, SF), "t-clean")
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {k for k in want if not any(i in normalised(texts[k]) for i in items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want

    mixed = staged(stages["mix"](spark, clean, SF), "t-mix")
    assert mixed.columns == columns
    size, source = defaultdict(int), {}
    for r in clean.collect():
        size[r.source] += words(r.text)
        source[r.doc_id] = r.source
    taken = defaultdict(int)
    times = Counter(r.doc_id for r in mixed.collect())
    for k, n in times.items():
        taken[source[k]] += n * words(texts[k])
        assert n <= 3
    for s, t in targets(size).items():
        assert abs(taken[s] - t) <= max(words(texts[k]) for k in source if source[k] == s) / 2 + 1e-6

    placed = stages["shard"](spark, mixed, SF)
    assert [c for c in placed.columns if c in columns] == columns
    rows = placed.collect()
    assert Counter(r.doc_id for r in rows) == times and {r.shard for r in rows} <= set(range(corpus_pipeline.SHARDS))
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += len(r.text.encode()) + 8
    largest = max(times[k] * (len(texts[k].encode()) + 8) for k in times)
    assert max(load.values()) - min(load.values()) <= largest


def test_columns_named_as_an_operators_keep_their_values(spark, documents):
    from pyspark.sql import functions as F

    names = ["language", "Posterior", "kept", "size", "taken", "times", "target", "source_size", "__key"]
    given = documents.limit(60).select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names])
    for stage in ("language", "mix"):
        out = dict(corpus_pipeline.STAGES)[stage](spark, given, SF)
        assert out.columns == given.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)


def test_an_id_on_two_texts_keeps_both(spark):
    other = " ".join(f"z{i}" for i in range(60))
    rows = [(1, " ".join(f"a{i}" for i in range(60))), (1, other), (1, other), (2, other + " end"), (3, None), (3, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(1, rows[0][1]), (1, other), (3, ""), (3, "")])


def test_run_is_the_stages_in_order(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_registration():
    import __spark_entry__

    queries = __spark_entry__.queries()
    assert set(QUERIES) <= set(queries) and "pipeline" in queries
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_near_duplicates_are_those_of_five_words_and_four_fifths(spark):
    from .test_text_models import family

    rows = [*enumerate(family(11, 30, words=200, edits=6))]
    # 25 of 129 words appended: 5-word similarity 100 / 125, 4-word 101 / 126, under 85 %.
    rows += [(1000 + k, " ".join(f"s{i}" for i in range(n))) for k, n in enumerate((104, 129))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()}
    texts = dict(rows)
    want, narrow = ({k for k, (_, c) in components_at(texts, *x).items() if c == k} for x in ((5, 80), (4, 85)))
    assert got == want and 1001 not in got and 1001 in narrow
