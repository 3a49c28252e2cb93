"""Filter interaction audit against documents counted one by one."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from wreckline.llm.filter_audit import filter_audit, interactions, removal_ranks, standard_filters
from wreckline.llm.registry import op11_filter_audit

SF = "/root/testdata/sf0.001"


def fails(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t))}


def brute(rows, labels):
    """rows: (doc_id, text, lang)"""
    judged = []
    for i, t, lang in rows:
        f = fails(t)
        f["E"] = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in rows)
        q = [x for x in labels if i is not None and x[0] == i]
        judged.append((lang or "", f, any(x[1] == 1 for x in q), any(x[2] == 1 for x in q)))
    out, shapley = {}, {}
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for s, f in enumerate(order, 1):
                gone = [j for j in left if j[1][f]]
                left = [j for j in left if not j[1][f]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, "".join(order), s] = [
                    len(left), len(gone), sum(j[1][f] for j in mine) - len(gone),
                    sum(j[1][f] and sum(j[1].values()) == 1 for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def collected(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def audited(spark, rows, labels):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, mask int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return filter_audit(df, standard_filters(F.col("text")), F.col("lang"), F.col("doc_id"), F.col("text"), known)


def test_table_matches_counting(spark, documents):
    rows = [(r.doc_id, r.text, r.lang) for r in documents.collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = collected(op11_filter_audit(spark, SF))
    assert got == brute(rows, labels) and len(got) == 600 * len({r[2] for r in rows})


def test_edge_cases(spark):
    many = " ".join(f"w{i}" for i in range(120))
    rows = [(1, None, "en"), (2, "", "en"), (2, "", None), (3, many, None), (4, many, ""), (4, many, ""), (5, many + " $", "x"),
            (None, many, "x"), (None, None, "x"), (6, "ABC abc", "x"), (7, "é" * 200_000, "y"), (8, "a " * 100, "y"), (9, many, "z")]
    labels = [(1, 1, 0), (1, 0, 1), (3, 0, 1), (4, 1, None), (None, 1, 1), (9, 1, 1), (77, 1, 1)]
    got = collected(audited(spark, rows, labels))
    assert got == brute(rows, labels)
    assert audited(spark, [], labels).count() == 0
    assert collected(audited(spark, rows, [])) == brute(rows, [])


def test_ranks_are_the_first_failing_position():
    orders, positions, ranks = removal_ranks(4)
    for k, order in enumerate(orders):
        for mask in range(16):
            want = next((s for s, f in enumerate(order) if mask >> f & 1), 4)
            assert ranks[mask, k] == want and (positions[k][order] == np.arange(4)).all()
    counts = np.ones((16, 1), dtype=np.int64)
    assert (interactions(counts)["kept"][:, -1] == 1).all()
