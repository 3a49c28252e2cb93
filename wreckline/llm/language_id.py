"""Language identification by Bayesian fusion of four kinds of evidence.

* text: likelihood of its byte trigrams (hashed into ``BUCKETS``) under each language;
* declared language (markup attribute or metadata field): P(declared | language);
* address suffix (last label of the host name): P(suffix | language);
* host: prior over languages, smoothed from host to registered domain to all rows.

A language exists if enough rows declare it, counted over all of them. Its text model is
fitted on distinct texts chosen by hash, about ``MAX_TRAINING_ROWS`` in all, dealt so that
rare languages have theirs whole; the other three tables are grouped counts over every row of what the text
alone says, so noisy declarations weigh as little as they deserve. "No language" is one
more hypothesis with uniform trigrams. Trigrams overlap, so a text counts as at most
``EVIDENCE`` independent ones, which leaves the other evidence its say on short texts.

Defined cases: a null or empty text gives no text evidence and is not kept; null or
unknown declarations, suffixes and hosts give none either; long texts are read whole;
repeated rows are judged alike; an empty table gives an empty result; extra columns stay
unless an output column has the same name, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, with_column_replaced

BUCKETS = 8192
MAX_TRAINING_ROWS = 20_000
#: A declared language is modelled if so many rows declare it, or, in small tables, this
#: share of the rows that declare any.
MIN_SUPPORT = 20
MIN_SHARE = 0.002
EVIDENCE = 60.0
UNKNOWN = "und"
UNKNOWN_PRIOR = 0.001
#: Share of every language's trigrams that are as good as random (names, addresses,
#: numbers), so that a few of them do not make a text foreign to its language.
STRAY = 0.3
MIN_POSTERIOR = 0.5
#: Weight, in rows, of the level above in every smoothed table.
STRENGTH = 5.0
_SLAB = 1 << 18
#: Languages whose trigrams are looked up at a time.
_COLUMNS = 16
#: Steps in which the sampled share of a language's texts is set.
_STEPS = 1 << 40


@dataclass(frozen=True)
class TextModel:
    """Log probability of each trigram bucket per language; the last row is UNKNOWN's."""

    languages: tuple[str, ...]
    log_p: np.ndarray


def _slabs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, trigram buckets, bounds by row) of runs of rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _SLAB, side="right")) - 1)
        b = raw[at[lo]:at[hi]]
        b = np.where((b >= 65) & (b <= 90), b + 32, np.where(b < 65, 32, b)).astype(np.uint32)  # digits, marks: space
        ends = at[lo:hi + 1] - at[lo]
        if len(b) >= 3:
            code = b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]
            row = np.repeat(np.arange(hi - lo), np.diff(ends))
            keep = (row[:-2] == row[2:]) & ~((b[:-2] == 32) & (b[1:-1] == 32)) & ~((b[1:-1] == 32) & (b[2:] == 32))
            code, row = code[keep], row[:-2][keep]
        else:
            code, row = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        code = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        yield lo, hi, code, np.searchsorted(row, np.arange(hi - lo + 1))
        lo = hi


def training_rows(
    df: DataFrame, text: Column, declared: Column, max_rows: int = MAX_TRAINING_ROWS,
) -> tuple[tuple[str, ...], DataFrame]:
    """The languages that exist, and their training rows (lang, text), each once.

    Rows of each declared language are counted over the whole table. Every language has the
    same bound on distinct texts, set so that all together have about ``max_rows`` (but
    ``MIN_SUPPORT`` each); those above it are sampled by hash of the text.
    """
    rows = df.select(F.lower(declared).alias("lang"), text.alias("text")).where("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL")
    counts = staged(
        rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("text").alias("texts")), "declared")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = {r["lang"]: max(1, r["texts"]) for r in counts.where(F.col("n") >= min(MIN_SUPPORT, MIN_SHARE * total)).collect()}
    bound, room, left = max_rows, max_rows, len(found)
    for texts in sorted(found.values()):
        bound = max(MIN_SUPPORT, room // left)
        if texts > bound:
            break
        room, left, bound = room - texts, left - 1, max_rows
    upto = [(lang, min(_STEPS, -(-bound * _STEPS // texts))) for lang, texts in found.items()]
    shares = df.sparkSession.createDataFrame(upto, "lang string, upto long")
    chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("text"), F.lit(_STEPS)) < F.col("upto"))
    return tuple(sorted(found)), chosen.select("lang", "text").distinct()


def fit_text_model(df: DataFrame, text: Column, declared: Column, max_rows: int = MAX_TRAINING_ROWS) -> TextModel:
    """Trigram counts per declared language from its training rows; the driver gets one row
    per language and bucket, as Arrow columns."""
    languages, rows = training_rows(df, text, declared, max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, _, code, bounds in _slabs(batch.column(1)):
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    lang = langs[lo + k]
                    if lang not in sums:
                        sums[lang] = np.zeros(BUCKETS, dtype=np.int64)
                    sums[lang] += np.bincount(code[a:b], minlength=BUCKETS)
        for lang, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used]),
            ], names=["lang", "bucket", "n"])

    counts = staged(
        rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")),
        "trigrams").toArrow()
    table = np.full((len(languages) + 1, BUCKETS), 0.5)
    at = pc.index_in(counts.column("lang"), pa.array(languages, pa.string())).to_numpy()
    table[at, counts.column("bucket").to_numpy()] += counts.column("n").to_numpy()
    shares = table / table.sum(axis=1, keepdims=True)
    return TextModel(languages, np.log((1 - STRAY) * shares + STRAY / BUCKETS))


def with_text_evidence(df: DataFrame, text: Column, model: TextModel, name: str = "__text_ll") -> DataFrame:
    """Adds tempered log-likelihoods per language (and UNKNOWN); null without trigrams."""
    table = np.ascontiguousarray(model.log_p.T)
    columns = {k: np.ascontiguousarray(table[:, k:k + _COLUMNS]) for k in range(0, table.shape[1], _COLUMNS)}
    with_text = df.withColumn(name, text)
    at = with_text.columns.index(name)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[float] | None] = []
            for _, _, code, bounds in _slabs(batch.column(at)):
                n = np.diff(bounds)
                sums = np.zeros((len(n), table.shape[1]))
                if len(code):
                    some = n > 0  # a row without trigrams must not borrow its successor's
                    for k in range(0, table.shape[1], _COLUMNS):
                        sums[some, k:k + _COLUMNS] = np.add.reduceat(columns[k][code], bounds[:-1][some], axis=0)
                sums *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
                out += [row if k else None for row, k in zip(sums.tolist(), n.tolist(), strict=True)]
            column = pa.array(out, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], column], names=[*batch.schema.names[:at], name])

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return with_text.mapInArrow(score, schema)


def _smoothed(counts: str, above: Column, n: int) -> Column:
    """(counts + STRENGTH * above) / (total + STRENGTH), element by element."""
    total = F.aggregate(F.col(counts), F.lit(0.0), lambda a, x: a + x)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: (F.get(F.col(counts), i) + F.lit(STRENGTH) * F.get(above, i)) / (total + F.lit(STRENGTH)))


def _count_arrays(rows: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Rows per best language as an array, by ``keys``: a grouped sum, combined before the shuffle."""
    return rows.groupBy(*keys).agg(
        F.array(*[F.sum(F.when(F.col("best") == i, F.col("rows")).otherwise(0)).cast("double") for i in range(n)]).alias(name))


#: Columns that ``identify_language`` adds.
ADDED = frozenset(("language", "posterior", "kept"))


def identify_language(
    df: DataFrame, text: Column, declared: Column, address: Column, model: TextModel | None = None,
    wanted: tuple[str, ...] | None = None, min_posterior: float = MIN_POSTERIOR,
) -> DataFrame:
    """Every row with language, posterior (double) and kept (boolean): a language is known,
    probable enough and, where ``wanted`` names some, among them. A declared language with too
    few rows for a model is kept where no model claims the text.

    ``address`` is a URL or a plain host or source name. Runs jobs: the model and the
    grouped counts are computed and written first.
    """
    if model is None:
        model = fit_text_model(df, text, declared)
    n = len(model.languages) + 1
    host = F.coalesce(F.nullif(F.regexp_extract(F.lower(address), r"^[a-z][a-z0-9+.-]*://([^/:?#]*)", 1), F.lit("")), F.lower(address))
    labels = F.split(host, r"\.")
    dotted = F.size(labels) > 1
    evidence = df.select(
        "*", F.lower(declared).alias("__declared"), host.alias("__host"),
        F.when(dotted, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(host).alias("__domain"),
        F.when(dotted, F.element_at(labels, -1)).alias("__suffix"))
    scored = with_text_evidence(evidence, text, model)
    best = F.when(F.col("__text_ll").isNull(), n - 1).otherwise(
        F.array_position("__text_ll", F.array_max("__text_ll")) - 1).cast("int")
    seen = staged(
        scored.groupBy(
            F.col("__declared").alias("declared"), F.col("__host").alias("host"), F.col("__domain").alias("domain"),
            F.col("__suffix").alias("suffix"), best.alias("best")).agg(F.count("*").alias("rows")),
        "language-counts")

    start = [(1.0 - UNKNOWN_PRIOR) / max(1, n - 1)] * (n - 1) + [UNKNOWN_PRIOR]
    everything = seen.groupBy("best").agg(F.sum("rows").alias("rows")).collect()  # one row per language
    total = sum(r["rows"] for r in everything)
    share = {r["best"]: r["rows"] for r in everything}
    overall = [(share.get(i, 0) + STRENGTH * start[i]) / (total + STRENGTH) for i in range(n)]
    overall_column = F.array(*[F.lit(float(x)) for x in overall])

    domains = _count_arrays(seen, ["domain"], n, "dc").select(
        "domain", _smoothed("dc", overall_column, n).alias("dp"))
    hosts = _count_arrays(seen, ["host", "domain"], n, "hc").join(domains, "domain").select(
        F.col("host").alias("__h"), _smoothed("hc", F.col("dp"), n).alias("__prior"))
    by_language = F.array(*[F.lit(float(max(share.get(i, 0), 0))) for i in range(n)])

    def given_language(key: str, name: str) -> DataFrame:
        """P(value | language) over P(value), from grouped counts: 1 tells nothing."""
        counted = _count_arrays(seen.where(F.col(key).isNotNull()), [key], n, "c")
        of_value = F.aggregate("c", F.lit(0.0), lambda a, x: a + x) / F.lit(float(max(total, 1)))
        ratio = F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda i: ((F.get(F.col("c"), i) + F.lit(STRENGTH) * of_value) / (F.get(by_language, i) + F.lit(STRENGTH))) / of_value)
        return counted.select(F.col(key).alias(f"__{name}_key"), ratio.alias(f"__{name}"))

    said, ending = given_language("declared", "said"), given_language("suffix", "ending")
    out = scored.join(hosts, F.col("__host") == F.col("__h"), "left")
    out = out.join(said, F.col("__declared") == F.col("__said_key"), "left")
    out = out.join(ending, F.col("__suffix") == F.col("__ending_key"), "left")
    logs = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.coalesce(F.get(F.col("__text_ll"), i), F.lit(0.0))
        + F.log(F.coalesce(F.get(F.col("__prior"), i), F.get(overall_column, i)))
        + F.log(F.coalesce(F.get(F.col("__said"), i), F.lit(1.0)))
        + F.log(F.coalesce(F.get(F.col("__ending"), i), F.lit(1.0))))
    out = out.withColumn("__logs", logs).withColumn("__top", F.array_max("__logs"))
    odds = F.aggregate("__logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    names = F.array(*[F.lit(x) for x in (*model.languages, UNKNOWN)])
    language = F.get(names, (F.array_position("__logs", F.col("__top")) - 1).cast("int"))
    # A declared language with too few rows for a model can not be judged by its letters: where
    # no model claims the text either, the declaration stands.
    rare = (language == UNKNOWN) & ~F.col("__declared").isin(UNKNOWN, "", *model.languages) & F.col("__text_ll").isNotNull()
    out = out.withColumn("__rare", F.coalesce(rare, F.lit(False)))
    out = out.withColumn("__language", F.when(F.col("__rare"), F.col("__declared")).otherwise(language)).withColumn("__posterior", 1.0 / odds)
    kept = (F.col("__language") != UNKNOWN) & (F.col("__posterior") >= min_posterior) & F.col("__text_ll").isNotNull()
    kept = kept | F.col("__rare")
    if wanted is not None:
        kept = kept & F.col("__language").isin(list(wanted))
    out = with_column_replaced(
        out, language=F.col("__language"), posterior=F.col("__posterior"), kept=kept)
    return out.select(*[c for c in df.columns if c.lower() not in ADDED], "language", "posterior", "kept")


def page_text(html: Column) -> Column:
    """A page's text for trigrams: without scripts, styles, comments and tags."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def markup_language(html: Column) -> Column:
    """The language that the html element declares, without its region; null if none."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))
