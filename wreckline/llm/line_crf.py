"""Quality classifier: a linear-chain conditional random field over lines.

Every line gets features of its own text and of the lines before and after it; the chain
labels lines good or bad, and forward-backward gives each line's probability of being
good given its whole text. A document's score is the mean of these over its lines,
weighted by their length.

Labels exist per document; in training, each line carries its document's label. The fit
uses a sample that is bounded three ways: at most ``MAX_TRAINING_DOCS`` labelled documents
(those of least hash, each class by its share and at least ``MIN_OF_CLASS`` if there are as
many), of at most ``MAX_TRAINING_LINES`` lines each and ``MAX_LINES`` in all. Only ids,
hashes and line counts of the labelled documents are shuffled; the sample's texts are picked
by a broadcast of its ids, their features are computed by Spark tasks, and only numbers
reach the driver. Scoring reads every text whole, in Arrow batches, with nothing shuffled.

Defined cases: null, empty and blank texts are one empty line and score by that; a very
long text is one chain; repeated rows score alike and train once; an id with several labels
or texts trains with each; null labels are ignored; without labels of both kinds every score is the share of label 1, 0.5 with
none; an empty table gives an empty result; extra columns stay unless an output column has
the same name, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

MAX_TRAINING_DOCS = 4_000
MAX_TRAINING_LINES = 400
MAX_LINES = 250_000
MIN_OF_CLASS = 100
ROUNDS = 150
#: Prior precision of the weights.
RIDGE = 1.0
OWN = 12
#: Own features, those of both neighbours, whether there are neighbours, and a constant.
FEATURES = 3 * OWN + 3
_SLAB = 1 << 19

_KIND = np.zeros((256, 7), dtype=np.uint8)  # start, space, upper, digit, symbol, mark, bang
_KIND[:, 0] = [(b & 0xC0) != 0x80 for b in range(256)]
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D], 1] = 1
_KIND[65:91, 2] = 1
_KIND[48:58, 3] = 1
_KIND[[ord(c) for c in "#*$%&|<>{}[]\\^~_=+@"], 4] = 1
_KIND[[ord(c) for c in ".,;:?"], 5] = 1
_KIND[ord("!"), 6] = 1


def _line_features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features, line lengths, first line of each row) of rows of UTF-8 bytes."""
    size = len(raw)
    cut = np.flatnonzero(raw == 10)
    # Every row starts a line; so does the byte after each line feed, even at a row's end.
    begins = np.concatenate((at[:-1], cut + 1))
    owner = np.concatenate((np.arange(len(at) - 1), np.searchsorted(at, cut, side="right") - 1))
    order = np.lexsort((begins, owner))
    begins, owner = begins[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(at)))
    stops = np.concatenate((begins[1:] - 1, at[-1:]))
    last = first[1:] - 1
    stops[last] = at[1:]

    sums = np.zeros((size + 1, _KIND.shape[1]), dtype=np.int64)
    np.cumsum(_KIND[raw], axis=0, out=sums[1:])
    n = (sums[stops] - sums[begins]).astype(np.float64)
    chars = n[:, 0]

    solid = (_KIND[raw, 1] == 0) & (raw != 10)
    before = np.concatenate(([False], solid[:-1]))
    edge = np.zeros(size + 1, dtype=bool)
    edge[at] = True
    starts = np.flatnonzero(solid & (~before | edge[:size]))
    after = np.concatenate((solid[1:], [False]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    # Words as 64-bit hashes: cheap sums of byte powers, mixed.
    weight = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))
    value = raw.astype(np.uint64) + np.uint64(1)
    word = np.cumsum(solid & (~before | edge[:size])) - 1
    place = np.arange(size) - (starts[np.maximum(word, 0)] if len(starts) else 0)
    value *= weight[place & 63]
    value[~solid] = 0
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(value)))
    hashes = total[ends] - total[starts]
    line = np.searchsorted(begins, starts, side="right") - 1
    words = np.bincount(line, minlength=len(begins)).astype(np.float64)
    same = np.zeros(len(begins))
    new = np.zeros(len(begins))
    if len(hashes):
        twin = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        same = np.bincount(line[1:][twin], minlength=len(begins)).astype(np.float64)
        by = np.lexsort((hashes, line))
        fresh = np.ones(len(by), dtype=bool)
        fresh[1:] = (hashes[by][1:] != hashes[by][:-1]) | (line[by][1:] != line[by][:-1])
        new = np.bincount(line[by][fresh], minlength=len(begins)).astype(np.float64)
    lines = total[stops] - total[begins]
    again = np.zeros(len(begins))
    again[1:] = (lines[1:] == lines[:-1]) & (owner[1:] == owner[:-1]) & (words[1:] > 0)

    c, w = np.maximum(chars, 1), np.maximum(words, 1)
    letters = np.maximum(chars - n[:, 1:].sum(axis=1), 1)
    own = np.stack([
        np.log1p(chars), np.log1p(words), np.minimum((chars - n[:, 1]) / w, 40), np.minimum(n[:, 4] / w, 4), n[:, 2] / c,
        n[:, 3] / c, np.minimum(n[:, 6] / w, 3), np.minimum(n[:, 5] / w, 3), same / w, 1 - new / w, again,
        (letters < 0.5 * c).astype(np.float64),
    ], axis=1)
    return own, chars, first


def chain_features(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features with the neighbours' and a constant, one row per line."""
    x = np.zeros((len(own), FEATURES), dtype=np.float64)
    x[:, :OWN] = own
    x[1:, OWN:2 * OWN], x[1:, 3 * OWN] = own[:-1], 1
    x[:-1, 2 * OWN:3 * OWN], x[:-1, 3 * OWN + 1] = own[1:], 1
    heads, tails = first[:-1], first[1:] - 1
    x[heads, OWN:2 * OWN], x[heads, 3 * OWN] = 0, 0
    x[tails, 2 * OWN:3 * OWN], x[tails, 3 * OWN + 1] = 0, 0
    x[:, -1] = 1
    return x


def lines_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, features, line lengths, first line of each row)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _SLAB, side="right")) - 1)
        own, chars, first = _line_features(raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
        yield lo, hi, chain_features(own, first), chars, first
        lo = hi


def _steps(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Chains by falling length, and for each step the chains that reach it."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    reach = np.searchsorted(-length[order], -np.arange(1, (length.max() if len(length) else 0) + 1), side="right")
    return order, [order[:k] for k in reach]


def forward_backward(good: np.ndarray, move: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(line good | text), expected moves 2x2) for log-odds ``good`` of the lines and log
    weights ``move[from, to]`` between neighbours; all chains step together."""
    _, steps = _steps(first)
    psi = np.stack([np.ones(len(good)), np.exp(np.clip(good, -30, 30))], axis=1)
    psi /= psi.sum(axis=1, keepdims=True)
    step = np.exp(move)
    alpha, beta = psi.copy(), np.ones_like(psi)
    for t in range(1, len(steps)):
        at = first[steps[t]] + t
        a = (alpha[at - 1] @ step) * psi[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    expected = np.zeros((2, 2))
    for t in range(len(steps) - 1, 0, -1):
        at = first[steps[t]] + t
        carried = beta[at] * psi[at]
        joint = alpha[at - 1][:, :, None] * step * carried[:, None, :]
        expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = carried @ step.T
        beta[at - 1] = b / b.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1), expected


@dataclass(frozen=True)
class LineModel:
    """Weights over standardised features, and moves; ``prior`` when nothing was learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    prior: float | None = None

    def lines(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return forward_backward(((x - self.mean) / self.scale) @ self.weights, self.move, first)[0]

    def documents(self, x: np.ndarray, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' probabilities, per document."""
        weight = np.maximum(chars, 1e-3)
        p = self.lines(x, first) * weight
        return np.clip(np.add.reduceat(p, first[:-1]) / np.add.reduceat(weight, first[:-1]), 0.0, 1.0)


def fit_chain(x: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> LineModel:
    """Maximum a posteriori weights by adaptive gradient steps on the chains' likelihood,
    every chain weighing alike whatever its length."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[scale < 1e-9] = 0.0, 1.0
    z = x - mean
    z /= scale
    length = np.diff(first)
    y = np.repeat(labels, length).astype(np.float64)
    inside = np.ones(len(z), dtype=bool)
    inside[first[:-1]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inside) - 1].astype(int), y[inside].astype(int)), 1)
    weights, move = np.zeros(z.shape[1]), np.zeros((2, 2))
    state = [np.zeros(z.shape[1] + 4), np.zeros(z.shape[1] + 4)]
    for k in range(1, rounds + 1):
        p, expected = forward_backward(z @ weights, move, first)
        gradient = np.concatenate((z.T @ (y - p) - RIDGE * weights, (seen - expected).ravel() - RIDGE * move.ravel())) / len(z)
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        step = 0.1 * (state[0] / (1 - 0.9**k)) / (np.sqrt(state[1] / (1 - 0.99**k)) + 1e-8)
        weights, move = weights + step[:-4], move + step[-4:].reshape(2, 2)
    return LineModel(mean, scale, weights, move)


def _sample(units: DataFrame, counts: dict[int, int], max_docs: int, max_total: int) -> DataFrame:
    """At most about ``max_docs`` of the (h, y, n, d) rows, with ``max_total`` lines together: of
    each class those of least hash."""
    total = sum(counts.values())
    order = [F.xxhash64("h", "y", "d"), "h", "y", F.col("d").asc_nulls_first()]
    some = None
    for y, count in sorted(counts.items()):
        quota = count if total <= max_docs else max(max_docs * count // total, min(count, MIN_OF_CLASS))
        mine = units.where(F.col("y") == y)
        if quota < count:
            mine = mine.orderBy(*order).limit(quota)
        some = mine if some is None else some.unionByName(mine)
    # One partition of at most about ``max_docs`` rows of numbers and ids.
    before = F.sum("n").over(Window.partitionBy().orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return some.withColumn("upto", before).where(F.col("upto") <= max_total).select("d", "h", "y")


def fit_line_model(
    docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    max_docs: int = MAX_TRAINING_DOCS, max_lines: int = MAX_TRAINING_LINES, max_total: int = MAX_LINES,
) -> LineModel:
    """Fit on a bounded sample of ``docs`` (id, text) with ``labels`` (id, label); without the
    latter ``docs`` has the label itself. The label is 0 or 1. Runs jobs."""
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    own = [F.col(f"`{label}`").cast("int").alias("y")]
    read = docs.select(F.col(f"`{doc_id}`").alias("d"), value.alias("t"), F.xxhash64(value).alias("h"), *(own if labels is None else []))
    lines = (F.length("t") - F.length(F.translate("t", "\n", "")) + 1).alias("n")
    units = read.select(*[c for c in read.columns if c != "t"], lines).where(F.col("n") <= max_lines)
    if labels is not None:
        units = units.join(labels.select(F.col(f"`{doc_id}`").alias("d"), *own).where("y IN (0, 1)"), "d")
    units = staged(units.where("y IN (0, 1)").select("d", "h", "y", "n").distinct(), "labelled-lines")
    counts = {r["y"]: r["c"] for r in units.groupBy("y").agg(F.count("*").alias("c")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = counts.get(1, 0) / total if total else 0.5
        return LineModel(np.zeros(0), np.ones(0), np.zeros(0), np.zeros((2, 2)), share)
    picked = _sample(units, counts, max_docs, max_total).select(
        F.col("d").alias("pd"), F.col("h").alias("ph"), F.col("y").alias("py"))
    same = F.col("d").eqNullSafe(F.col("pd")) & (F.col("h") == F.col("ph"))
    if labels is None:
        same = same & (F.col("y") == F.col("py"))
    rows = read.join(F.broadcast(picked), same).groupBy("d", "h", F.col("py").alias("y")).agg(F.min("t").alias("t"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_pylist()
            for lo, hi, x, _, first in lines_of(batch.column(0)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(y[lo:hi], pa.int32()),
                    pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                ], names=["y", "x"])

    made = rows.select("t", "y").mapInArrow(features, "y int, x binary").toArrow()
    order = pc.sort_indices(made, sort_keys=[("y", "ascending"), ("x", "ascending")])
    made = made.take(order).combine_chunks()  # the same fit whatever the tasks' order
    labelled, held = made.column("y").to_numpy(), made.column("x")
    del made
    chains = [np.frombuffer(b.as_buffer(), dtype=np.float64).reshape(-1, FEATURES) for b in held]
    first = np.concatenate(([0], np.cumsum([len(c) for c in chains])))
    x = np.concatenate(chains)
    del chains, held
    return fit_chain(x, first, labelled)


def score_quality(df: DataFrame, model: LineModel, text: str = "text", name: str = "score") -> DataFrame:
    """Every row with its score (double, 0 to 1); one of the same name is replaced."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower() or c == text])
    held = kept.withColumn("__text", F.col(f"`{text}`").cast("string"))
    at = len(held.columns) - 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.documents(x, chars, first) for _, _, x, chars, first in lines_of(batch.column(at))]
            out = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(out, pa.float64())], names=[*batch.schema.names[:at], name])

    return held.mapInArrow(score, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))
