"""Toxicity by compression distance: two zstandard dictionaries, one trained on toxic and one on
ordinary text, and how much better each compresses the windows of a document.

1. Dictionaries. Both begin with the same ordinary text (``SHARED`` bytes of it), so that
   common words cost the same under either, and end with a trained part of their own
   (``OWN`` bytes): segments that recur in toxic texts, or in other ordinary texts, among the
   words that the first third of the ordinary texts lacks. The difference of a window's two
   compressed lengths then speaks of those parts alone.
2. Windows. A text is cut into pieces of ``WINDOW`` bytes, ended at white space; every
   window of the whole text is compressed under both dictionaries.
3. Calibration. On labelled texts that made no dictionary, the differences' histogram, tail
   means and spread per document are weighed by a logistic fit; a score of 0.5 is the
   threshold at which toxic is as likely as not.

Bounds, all parameters: the fit collects at most ``TEXTS`` distinct labelled texts a class, each
to its first ``TEXT_BYTES`` characters; scoring reads whole texts. The model is about twice
``SHARED + OWN`` bytes, whatever the size of the corpus.

Defined cases: null, empty and blank texts score 0; a text is scored the same wherever and
however often it occurs; labels that are null are not used, and where copies of a text disagree
it counts as toxic; without labelled texts of both classes every text scores the share of toxic
labels (0 if there are none); a word longer than ``LONGEST`` bytes is cut; an empty table
gives an empty result; an input column ``score`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, with_column_replaced

TEXTS = 4_000
TEXT_BYTES = 12_000
SHARED = 1_000_000
OWN = 8_192
WINDOW = 64
LONGEST = 192
LEVEL = 9
#: Bounds of the histogram of differences, in bytes.
LOW, HIGH = -4, 12
#: Windows compressed at a time.
BATCH = 20_000

_WINDOW = re.compile(rb"(?s)[\x20\x09-\x0D]*.{1,%d}[^\x20\x09-\x0D]{0,%d}" % (WINDOW, LONGEST))
_SPACE = b" \t\n\x0b\x0c\r"


def windows(text: str | None) -> list[bytes]:
    """Consecutive pieces of a text that end at white space; none if it has no words."""
    raw = (text or "").encode("utf-8", "replace").strip(_SPACE)
    return [w for w in _WINDOW.findall(raw)]


@dataclass
class ToxicityModel:
    toxic: bytes = b""
    ordinary: bytes = b""
    share: float = 0.0
    weights: np.ndarray | None = None
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    _pair: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_pair": None}

    def differences(self, pieces: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, per window."""
        if self._pair is None:
            self._pair = (_compressor(self.ordinary), _compressor(self.toxic))
        out = [np.zeros(0, dtype=np.int64)]
        for lo in range(0, len(pieces), BATCH):
            some = pieces[lo:lo + BATCH]
            sizes = []
            for compressor in self._pair:
                made = compressor.multi_compress_to_buffer(some, threads=1)
                sizes.append(np.fromiter((len(made[i]) for i in range(len(made))), dtype=np.int64, count=len(made)))
            out.append(sizes[0] - sizes[1])
        return np.concatenate(out)

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(features, number of windows) of each text."""
        made = np.zeros((len(texts), HIGH - LOW + 6))
        counts = np.zeros(len(texts), dtype=np.int64)
        held: list[bytes] = []
        rows: list[tuple[int, int]] = []

        def flush() -> None:
            found = self.differences(held)
            at = 0
            for row, n in rows:
                made[row] = _features(found[at:at + n])
                at += n
            held.clear()
            rows.clear()

        for row, text in enumerate(texts):
            pieces = windows(text)
            counts[row] = len(pieces)
            if pieces:
                held += pieces
                rows.append((row, len(pieces)))
            if len(held) >= BATCH:
                flush()
        flush()
        return made, counts

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            counts = np.array([bool((t or "").strip(_SPACE.decode())) for t in texts], dtype=bool)
            return np.where(counts, self.share, 0.0)
        made, counts = self.features(texts)
        x = np.column_stack(((made - self.centre) / self.spread, np.ones(len(made))))
        return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))), 0.0)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=len(content), min_match=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(
        content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def _features(found: np.ndarray) -> np.ndarray:
    """Histogram, tail means, mean, mean gain, and length of a document's differences."""
    n = len(found)
    bins = np.bincount(np.clip(found, LOW, HIGH) - LOW, minlength=HIGH - LOW + 1) / n
    top = np.sort(found)[::-1]
    return np.concatenate((bins, [
        top[:max(1, n // 20)].mean(), top[:max(1, n // 10)].mean(), top[:max(1, n // 5)].mean(), found.mean(), np.log(n)]))


def _trained(texts: list[bytes]) -> bytes:
    """A dictionary of the segments that recur in the texts; where they are too few to train
    one, their own beginning."""
    try:
        return zstandard.train_dictionary(OWN, texts, k=12, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:OWN]


def _unseen(texts: list[bytes], known: set[bytes]) -> list[bytes]:
    """The texts without the words that are known."""
    return [b"".join(b" " + w for w in t.split() if w not in known) + b" " for t in texts]


def _shared(texts: list[bytes]) -> bytes:
    """Ordinary text, as much of each as fills SHARED bytes."""
    each = max(200, -(-SHARED // max(1, len(texts))))
    return b"\n".join(t[:each] for t in texts)[:SHARED]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic fit, the last for the constant, by Newton's steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[str], ordinary: list[str]) -> ToxicityModel:
    """The model of two lists of texts, in a fixed order."""
    total = len(toxic) + len(ordinary)
    if not toxic or not ordinary:
        return ToxicityModel(share=len(toxic) / total if total else 0.0)
    # Thirds: shared text and dictionaries are made of two, the calibration of the last; where
    # that has too few of a class, all texts calibrate.
    bad = [t.encode("utf-8", "replace") for t in toxic]
    good = [t.encode("utf-8", "replace") for t in ordinary]
    parts = [good[k::3] for k in range(3)]
    made = [b for k, b in enumerate(bad) if k % 3]
    shared, known = _shared(parts[0]), {w for t in parts[0] for w in t.split()}
    model = ToxicityModel(_trained(_unseen(made or bad, known)) + shared,
                          _trained(_unseen(parts[1] or good, known)) + shared, len(bad) / total)
    judged, labels = toxic[::3] + ordinary[2::3], np.array([1.0] * len(toxic[::3]) + [0.0] * len(ordinary[2::3]))
    if len(toxic) < 15 or len(ordinary) < 15:
        judged, labels = toxic + ordinary, np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    x, counts = model.features(judged)
    x, labels = x[counts > 0], labels[counts > 0]
    if len(set(labels)) < 2:
        return ToxicityModel(share=len(bad) / total)
    model.centre, model.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    model.weights = _logistic((x - model.centre) / model.spread, labels)
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
                 texts: int = TEXTS) -> ToxicityModel:
    """Fit on a sample of at most about ``texts`` distinct labelled texts a class, chosen by hash
    of the text; the driver holds their first TEXT_BYTES characters. Runs jobs.

    Only ids, hashes and labels are shuffled; the texts of the sample, whose ids are bounded by
    ``texts``, are picked by a broadcast of those ids.
    """
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    known = labels.where(F.col(f"`{toxic}`").isNotNull()).select(
        F.col(f"`{doc_id}`").alias("id"), (F.col(f"`{toxic}`") == 1).alias("bad"))
    hashed = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(value).alias("h"))
    classes = staged(hashed.join(known, "id").groupBy("h").agg(F.max("bad").alias("bad"), F.min("id").alias("id")), "labelled")
    sizes = {r["bad"]: r["n"] for r in classes.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    found: dict[bool, list[str]] = {}
    for bad in (True, False):
        share = min(1.0, texts / max(1, sizes.get(bad, 0)))
        some = classes.where((F.col("bad") == bad) & (F.pmod(F.xxhash64("h"), F.lit(1_000_000)) < int(1_000_000 * share)))
        picked = F.broadcast(some.orderBy("h").limit(2 * texts).select("id", "h"))
        read = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(value).alias("h"), F.substring(value, 1, TEXT_BYTES).alias("t"))
        held = read.join(picked, ["id", "h"]).groupBy("h").agg(F.min("t").alias("t"))  # repeated rows
        found[bad] = [r["t"] for r in sorted(held.collect(), key=lambda r: r["h"]) if r["t"].strip()]
    return train(found[True], found[False])


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``df`` with ``score``, the probability that its whole text is toxic."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist()))

    return with_column_replaced(df, score=scored(F.col(f"`{text}`").cast("string")))
