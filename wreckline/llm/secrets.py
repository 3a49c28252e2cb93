"""Secret scan: fixed patterns plus a Markov comparison of random strings and identifiers.

Base spans come from three fixed patterns. A run of 20 or more token characters that no
base span touches is also a secret when a character Markov model of random strings
explains it better, per transition, than one of ordinary identifiers. Both models are
transition counts from labelled samples: the values that the base patterns find (random)
against the long words that they leave alone (ordinary).

All of it is built-in functions. Positions come from ``split`` and ``regexp_extract_all``
over one pattern: matches and the gaps between them add up to offsets in code points.

Defined cases: null text counts as empty; an empty text has no span; a very long text is
scanned whole; repeated rows give repeated results; an empty table gives an empty result,
and a training table without both kinds of sample gives a model that adds no span; extra
columns stay unless an output column has the same name, which replaces them.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, with_column_replaced

# The base patterns, their least lengths and their order in results.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET)

#: Documents that a model is fitted on, at most (a sample by hash of the text).
MAX_TRAINING_ROWS = 20_000
#: Least mean log-likelihood ratio per transition, in nats.
MIN_LLR = 0.7

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end); those whose ``group`` is
    shorter than ``least`` characters are dropped after matching."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def located(x: Column) -> Column:
        steps = F.transform(
            x["m"],
            lambda m, i: F.struct(
                F.length(F.get(x["gaps"], i)).alias("gap"), F.length(m).alias("n"),
                F.length(F.get(x["g"], i)).alias("value"),
            ),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

        def step(a: Column, s: Column) -> Column:
            begin = a["at"] + s["gap"]
            span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + s["n"]).alias("end")))
            return F.struct(
                (begin + s["n"]).alias("at"),
                F.when(s["value"] >= least, F.concat(a["out"], span)).otherwise(a["out"]).alias("out"),
            )

        return F.aggregate(steps, start, step, lambda a: a["out"])

    return F.when(text.rlike(pattern), let(found, located)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All base spans, ordered by start, then kind."""
    return F.sort_array(F.concat(
        _spans(text, ASSIGN, 0, group=2, least=ASSIGN_MIN), _spans(text, ACCESS, 1), _spans(text, HEX, 2)
    ))


def _transitions(token: Column) -> Column:
    """Codes of a token's character pairs: from * STATES + to, from 0."""
    return F.transform(
        F.sequence(F.lit(1), F.length(token) - 1),
        lambda i: (F.instr(F.lit(ALPHABET), F.substr(token, i, F.lit(1))) - 1) * STATES
        + F.instr(F.lit(ALPHABET), F.substr(token, i + 1, F.lit(1))) - 1,
    )


#: A long word without digits: an ordinary identifier.
PLAIN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{8,}(?![A-Za-z0-9+/_=-])"


def labelled_samples(df: DataFrame, text: str = "text", max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(token, random): values found by the base patterns in all rows, however rare, and long
    words without digits as ordinary identifiers, from at most about ``max_rows`` of the rows
    that have some, chosen by text hash."""
    rows = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    hits = rows.where(F.col("t").rlike(ASSIGN) | F.col("t").rlike(ACCESS) | F.col("t").rlike(HEX))
    worded = rows.where(F.col("t").rlike(PLAIN))
    every = max(1, -(-worded.count() // max_rows))
    worded = worded.where(F.pmod(F.xxhash64("t"), F.lit(every)) == 0)
    value = F.concat(
        F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), lambda g: F.length(g) >= ASSIGN_MIN),
        F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("t", F.lit(HEX), F.lit(0)),
    )
    random = hits.select(F.explode(value).alias("token")).select(
        F.translate("token", ".", "").alias("token"), F.lit(True).alias("random"))
    plain = F.regexp_extract_all("t", F.lit(PLAIN), F.lit(0))
    return random.unionByName(worded.select(F.explode(plain).alias("token"), F.lit(False).alias("random")))


def fit_markov(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of every character transition.

    ``samples`` has token and random. Counts are aggregated by Spark; what reaches the
    driver is bounded by twice the square of the alphabet. Without samples of both kinds
    every ratio is 0.
    """
    pairs = samples.where(F.length("token") > 1).select("random", F.explode(_transitions(F.col("token"))).alias("code"))
    counts = pairs.where((F.col("code") >= 0) & (F.col("code") < STATES * STATES)).groupBy("random", "code").count()
    seen: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for r in counts.collect():
        seen[r["random"]][r["code"]] = r["count"]
    if not seen[True] or not seen[False]:
        return [0.0] * (STATES * STATES)
    first = {k: [0] * STATES for k in seen}
    for k, table in seen.items():
        for code, n in table.items():
            first[k][code // STATES] += n

    def log_p(kind: bool, code: int, weight: float = 0.5) -> float:
        return math.log((seen[kind].get(code, 0) + weight) / (first[kind][code // STATES] + weight * STATES))

    return [log_p(True, c) - log_p(False, c) for c in range(STATES * STATES)]


def _markov_spans(text: Column, base: Column, llr: list[float], least: float) -> Column:
    """Token runs that the model calls random and no base span touches."""
    table = F.from_json(F.lit(json.dumps([round(x, 4) for x in llr])), "array<double>")
    found = F.struct(
        F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)).alias("m"), _spans(text, TOKEN, 3).alias("s")
    )

    def mean(token: Column) -> Column:
        total = F.aggregate(_transitions(token), F.lit(0.0), lambda a, c: a + F.coalesce(F.get(table, c), F.lit(0.0)))
        return total / (F.length(token) - 1)

    def chosen(x: Column) -> Column:
        return F.filter(
            x["s"],
            lambda s, i: F.get(x["m"], i).rlike("[A-Za-z]")
            & (mean(F.get(x["m"], i)) >= least)
            & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )

    return F.when(text.rlike(TOKEN), let(found, chosen)).otherwise(F.array().cast(_SPAN))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secret_scan(df: DataFrame, llr: list[float], text: str = "text", min_llr: float = MIN_LLR) -> DataFrame:
    """Every row with n_assign, n_access, n_hex, n_markov (long), base_sha256, spans and
    redacted_chars (code points covered by any span)."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = with_column_replaced(df, __t=t)
    out = out.withColumn("__base", base_spans(F.col("__t")))
    out = out.withColumn("__more", _markov_spans(F.col("__t"), F.col("__base"), llr, min_llr))
    out = out.withColumn("__all", F.sort_array(F.concat("__base", "__more")))

    def n(kind: int) -> Column:
        return F.size(F.filter("__all", lambda s: s["kind"] == kind)).cast("long")

    cover = F.aggregate(
        "__all", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )
    out = with_column_replaced(
        out, n_assign=n(0), n_access=n(1), n_hex=n(2), n_markov=n(3),
        base_sha256=F.sha2(_joined(F.col("__base")), 256), spans=_joined(F.col("__all")), redacted_chars=cover,
    )
    return out.drop("__t", "__base", "__more", "__all")
