"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

1. Every document gets a mask, the set of filters that it fails. Documents are counted by
   (part, mask, weights): with F filters at most 2^F masks a part, combined before the shuffle.
2. Per part, the masks are a 0/inf matrix and the orders the inverse-permutation matrix of
   each filter's position. Their min-plus product is the removal rank: the first position in
   an order at which a mask is removed (F if never).
3. The counts, scattered by (order, rank), give what each step removes and keeps, and, where a
   filter that fails stands later than the rank, what it would have removed redundantly.

Defined cases: a null part is the empty string; null texts are empty texts; a document fails
the repetition filter if any smaller id has the same text, so rows of the same id do not make each
other repeated and a null id is none and has none; repeated label rows count once, as the
larger label; parts without failures get their zeros; an empty table gives an empty result;
texts are read whole; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, words

#: Fixed values of the filters of ``standard_filters``, in percent where they are shares.
LEAST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
SYMBOLS = r"[#$%&*|]"


def standard_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a text: A few words, B few distinct words, C many capitals, D symbols."""
    value = F.coalesce(text, F.lit(""))
    return {
        "A": F.size(words(value)) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words(value))) < LEAST_DISTINCT * F.size(words(value)),
        "C": 100 * F.regexp_count(value, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(value),
        "D": value.rlike(SYMBOLS),
    }


def masks(df: DataFrame, filters: dict[str, Column], part: Column, doc_id: Column, text: Column) -> DataFrame:
    """(id, part, mask) of every row: bit k is set if the k-th filter fails, and the bit after
    the last if a smaller id has the same text. Runs jobs."""
    value = F.coalesce(text.cast("string"), F.lit(""))
    bits = F.lit(0)
    for k, fails in enumerate(filters.values()):
        bits = bits + F.when(F.coalesce(fails, F.lit(False)), 1 << k).otherwise(0)
    made = staged(df.select(
        doc_id.cast("long").alias("id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        F.md5(F.encode(value, "UTF-8")).alias("digest"), bits.alias("bits")), "masks")
    # Only texts that several ids have can be repeated; written, so that the join's skew can be split.
    least = staged(made.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                   .where("least < most").select("digest", "least"), "repeated")
    repeated = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return made.join(least, "digest", "left").select(
        "id", "part", (F.col("bits") + F.when(repeated, 1 << len(filters)).otherwise(0)).alias("mask"))


def removal_ranks(n_filters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(orders, positions, ranks): filters by order and step; position by order and filter (the
    inverse permutations); and step, from 0, at which an order removes a mask (n_filters: none)."""
    orders = np.array(list(permutations(range(n_filters))), dtype=np.int64).reshape(-1, n_filters)
    positions = np.argsort(orders, axis=1)
    bits = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    far = np.where(bits == 1, 0, n_filters)  # min-plus: 0 where the mask fails, beyond reach elsewhere
    ranks = np.minimum((far[:, None, :] + positions[None, :, :]).min(axis=2), n_filters)
    return orders, positions, ranks


def interactions(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by (order, step) from ``counts`` (mask, weight), where weight 0 is all documents.

    ``removed`` also has the other weights: its shape is (weight, order, step)."""
    n_filters = int(counts.shape[0]).bit_length() - 1
    orders, positions, ranks = removal_ranks(n_filters)
    n_orders, everything = len(orders), counts[:, 0]
    removed = np.zeros((counts.shape[1], n_orders, n_filters + 1), dtype=np.int64)
    order = np.broadcast_to(np.arange(n_orders), ranks.shape)
    for w in range(counts.shape[1]):
        np.add.at(removed[w], (order, ranks), np.broadcast_to(counts[:, w:w + 1], ranks.shape))
    kept = everything.sum() - np.cumsum(removed[0][:, :n_filters], axis=1)
    bits = (np.arange(len(counts))[:, None] >> np.arange(n_filters)) & 1
    redundant = np.zeros((n_orders, n_filters), dtype=np.int64)
    for f in range(n_filters):
        failing = np.flatnonzero(bits[:, f])
        later = ranks[failing] < positions[None, :, f]
        np.add.at(redundant, (order[failing], np.broadcast_to(positions[:, f], later.shape)), later * everything[failing][:, None])
    alone = everything[1 << orders]
    first = np.zeros(n_filters, dtype=np.int64)
    np.add.at(first, orders, removed[0][:, :n_filters])
    return {"orders": orders, "kept": kept, "removed": removed[:, :, :n_filters], "redundant": redundant,
            "unique_fails": alone, "shapley": first[orders]}


def filter_audit(df: DataFrame, filters: dict[str, Column], part: Column, doc_id: Column, text: Column,
                 labels: DataFrame, repeated: str = "E") -> DataFrame:
    """One row per part, order of the filters (and ``repeated``) and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley. ``labels`` has doc_id, quality, toxic."""
    names = [*filters, repeated]
    n, size = len(names), 1 << len(names)
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    judged = masks(df, filters, part, doc_id, text)
    judged = judged.join(known, judged["id"] == known["doc_id"], "left")
    counted = judged.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))

    def audit(table: pa.Table) -> pa.Table:
        counts = np.zeros((size, 3), dtype=np.int64)
        at = table.column("mask").to_numpy()
        for k, c in enumerate(("n", "good", "toxic")):
            counts[at, k] = table.column(c).to_numpy()
        made = interactions(counts)
        orders = ["".join(names[f] for f in o) for o in made["orders"]]
        flat = {c: made[c].ravel() for c in ("kept", "redundant", "unique_fails", "shapley")}
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()] * (len(orders) * n), pa.string()),
            "filter_order": pa.array(np.repeat(orders, n).tolist(), pa.string()),
            "step": pa.array(np.tile(np.arange(1, n + 1), len(orders)), pa.int32()),
            "kept": flat["kept"], "removed": made["removed"][0].ravel(), "redundant": flat["redundant"],
            "unique_fails": flat["unique_fails"], "good_lost": made["removed"][1].ravel(),
            "toxic_lost": made["removed"][2].ravel(), "shapley": flat["shapley"]})

    return counted.groupBy("part").applyInArrow(audit, (
        "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long"))
