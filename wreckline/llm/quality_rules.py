"""Quality rules: a threshold table compiled into one projection.

``METRICS`` names ratios over the base counts of a text, ``RULES`` bounds them; the table
becomes one boolean expression next to the counts. Everything is built-in JVM functions
on arrays of the row's own words, so a row never leaves its task and nothing is shuffled.

Defined cases: a null text counts as no text (all counts 0, fails the base rule); an
empty text likewise; very long texts are counted whole; repeated rows are judged alike;
an empty table gives an empty result; extra columns stay, unless an output column has
the same name, which then replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, with_column_replaced, words

# The symbols, window and base thresholds of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

# Function words of the languages served, in lower case.
STOP_WORDS = (
    "the of and to a in is it that was for on are as with be by at this from or an not",
    "der die das und in zu den ist von mit sich auf für im dem nicht ein eine als auch",
    "le la les de des du et un une est que qui dans pour pas sur au avec il elle",
    "el la los las de que y en un una es se por con para del al no su lo",
)
PUNCTUATION = ".,;:!?\"'()"


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; None leaves a side open."""

    metric: str
    low: float | None
    high: float | None


RULES = (
    Rule("n_words", MIN_WORDS, 1_000_000),
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.10),
    Rule("stop_word_ratio", 0.03, None),
    Rule("dup_line_ratio", None, 0.30),
    Rule("upper_letter_ratio", None, 0.50),
)


def _windows(hashes: Column) -> Column:
    """A 64-bit hash for every WINDOW-word window, from the words' hashes: each pass doubles
    the span by pairing every hash with the one as far ahead as it already spans."""

    def paired(spans: Column, ahead: int) -> Column:
        return let(
            spans,
            lambda s: F.zip_with(s, F.slice(s, ahead + 1, F.size(s)), lambda x, y: F.xxhash64(x, y)),
        )

    out, span = hashes, 1
    while span < WINDOW:
        out, span = paired(out, span), span * 2
    n = F.size(hashes) - (WINDOW - 1)
    return F.when(n > 1, F.slice(out, F.lit(1), n)).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(windows: Column) -> Column:
    """Words covered by a window that occurs at least twice in the text.

    Only texts with a repeat sort their windows as (hash, position) and compare each with
    its neighbours; the covered words are counted from the repeats' sorted positions.
    """

    def positions(s: Column) -> Column:
        hit = F.filter(
            s,
            lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
            | (F.get(s, k + 1).isNotNull() & (F.get(s, k + 1)["h"] == x["h"])),
        )
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        let(let(ordered, positions), covered)
    )


def _counts(text: Column) -> dict[str, Column]:
    """Base counts of a text that is not null and of its ``__words``."""
    tokens = F.col("__words")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    stop = sorted(set(" ".join(STOP_WORDS).split()))
    chars = F.translate(text, SPACES, "")
    letters = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": F.length(chars).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("__windows")).cast("long"),
        "__lines": F.size(lines),
        "__stop": F.size(F.filter(tokens, lambda w: F.btrim(F.lower(w), F.lit(PUNCTUATION)).isin(stop))),
        "__upper": letters,
    }


def _metrics() -> dict[str, Column]:
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.col
    return {
        "n_words": c("n_words"),
        "mean_word_chars": c("word_chars") / n,
        "symbols_per_word": c("n_symbols") / n,
        "stop_word_ratio": c("__stop") / n,
        "dup_line_ratio": c("n_dup_lines") / F.greatest(c("__lines"), F.lit(1)),
        "upper_letter_ratio": c("__upper") / F.greatest(c("word_chars"), F.lit(1)),
    }


def compile_rules(rules: tuple[Rule, ...], metrics: dict[str, Column]) -> Column:
    """The threshold table as one boolean expression."""
    tests = []
    for r in rules:
        if r.low is not None:
            tests.append(metrics[r.metric] >= F.lit(r.low))
        if r.high is not None:
            tests.append(metrics[r.metric] <= F.lit(r.high))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept (boolean) and failed_rules (the names of the rules it breaks)."""
    base = with_column_replaced(df, __text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    base = base.withColumn("__words", words(F.col("__text")))
    base = base.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    base = base.withColumn("__windows", _windows(F.col("__hashes")))
    counted = with_column_replaced(base, **_counts(F.col("__text")))
    m = _metrics()
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    broken = F.filter(
        F.array(*[F.when(~compile_rules((r,), m), F.lit(r.metric)) for r in rules]), lambda x: x.isNotNull()
    ) if rules else F.array().cast("array<string>")
    out = with_column_replaced(
        counted, base_failed=failed, kept=~failed & compile_rules(rules, m), failed_rules=broken
    )
    return out.drop("__text", "__words", "__hashes", "__windows", "__lines", "__stop", "__upper")
