"""Mixing sources to target weights with Efraimidis-Spirakis keys.

Targets come from the sources' weights by water-filling: no source is repeated more than
``MAX_EPOCHS`` times, and what a source cannot use is reshared by weight. A source first
gets its complete epochs; the rest of its target is a weighted sample without
replacement: each document draws an exponential key, divided by its quality weight, and
documents are taken by ascending key up to the token budget.

The prefix sum never gathers a source. Keys are cut into ``BUCKETS`` ranges by the
exponential's own distribution; sums per (source, range) find the range in which the
budget ends, and only that range's keys are put in order. The outcome is one key per
source, so that documents, texts included, are taken by comparing their own key with it.

Defined cases: a null text has no words; a null id or source is a value of its own, the
null source coming last; an empty text has size 0 and nothing to take; a very long text
counts whole; repeated rows share a key and are taken alike; an empty table gives an
empty result; extra columns stay unless an output column has the same name, which
replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, staged, with_column_replaced, words

MAX_EPOCHS = 3
BUCKETS = 4096
SYMBOLS = "#*$%&|<>"
SEED = "mix-1"


def quality_weight(text: Column) -> Column:
    """0.1 to 1: falls with the share of symbols in a text."""
    t = F.coalesce(text, F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    return 1.0 - 0.9 * F.least(F.lit(1.0), 20.0 * symbols / F.greatest(F.length(t), F.lit(1)))


def sampling_key(doc_id: Column, size: Column, weight: Column, seed: str = SEED) -> Column:
    """An exponential draw, fixed by id, size and seed, over the document's weight."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"), F.lit(seed)))
    uniform = (F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))
    return -F.log(uniform) / weight


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds weight and target to (source, source_size). One row per source: a list that a
    mixture is written for, not data that grows with the documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    cap = F.col("source_size") * max_epochs
    ranked = ranked.withColumn("cap", cap).withColumn("level", F.col("cap") / F.col("weight"))
    # Sources in the order in which they reach their caps; the water level that is left
    # for a source and all after it, once those before it are full.
    order = Window.orderBy("level", "weight", F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    ranked = ranked.withColumn("open", (total - full) / rest)
    level = F.min(F.when(F.col("level") >= F.col("open"), F.struct("level", "open"))).over(Window.partitionBy())["open"]
    return ranked.select(
        "source", "source_size", "weight",
        F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def _epochs(sources: DataFrame) -> DataFrame:
    size = F.greatest(F.col("source_size"), F.lit(1))
    sources = sources.withColumn("epochs", F.floor(F.col("target") / size))
    return sources.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))


def _bucket(key: Column, scale: Column, buckets: int) -> Column:
    return F.least(F.lit(buckets - 1), F.floor(F.lit(float(buckets)) * (1.0 - F.exp(-key * scale)))).cast("int")


def mixing_plan(rows: DataFrame, max_epochs: int = MAX_EPOCHS, buckets: int = BUCKETS) -> DataFrame:
    """One row per source: source_size, target, epochs, scale, and the last key taken in
    the fractional epoch as (last_bucket, last_key). ``rows`` has source, size, weight, key."""
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.avg("weight").alias("scale"))
    scales = sizes.select("source", "scale")
    sources = staged(
        _epochs(source_targets(sizes.drop("scale"), max_epochs)).alias("t").join(
            scales.alias("s"), F.expr("t.source <=> s.source")).select("t.*", "s.scale"),
        "mix-sources")
    keyed = rows.alias("r").join(sources.alias("t"), F.expr("r.source <=> t.source")).select(
        "r.source", "r.size", "r.key", _bucket(F.col("key"), F.col("scale"), buckets).alias("bucket"), "budget")
    keyed = staged(keyed, "mix-keys")
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n"), F.first("budget").alias("budget"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
    ends = sums.withColumn("upto", upto).where(F.col("upto") >= F.col("budget"))
    ends = ends.groupBy("source").agg(F.min(F.struct("bucket", "upto", "n", "budget")).alias("e")).select(
        "source", "e.bucket", (F.col("e.upto") - F.col("e.n")).alias("before"), "e.budget")
    inside = keyed.drop("budget").alias("k").join(
        ends.alias("e"), F.expr("k.source <=> e.source AND k.bucket = e.bucket")).select("k.*", "e.before", "e.budget")
    ties = inside.groupBy("source", "bucket", "key", "before", "budget").agg(F.sum("size").alias("n"))
    done = F.sum("n").over(Window.partitionBy("source").orderBy("key"))
    # A key is taken if the sum comes nearer to the budget with it than without it.
    last = ties.withColumn("mid", F.col("before") + done - F.col("n") / 2).where(F.col("mid") < F.col("budget"))
    last = last.groupBy("source").agg(F.max("key").alias("last_key"))
    return sources.alias("t").join(ends.alias("e"), F.expr("t.source <=> e.source"), "left").join(
        last.alias("l"), F.expr("t.source <=> l.source"), "left"
    ).select(
        "t.source", "t.source_size", "t.target", "t.epochs", "t.scale",
        F.coalesce("e.bucket", F.lit(-1)).alias("last_bucket"),
        F.coalesce("l.last_key", F.lit(-1.0)).alias("last_key"))


#: Columns that ``mix_sources`` adds.
ADDED = frozenset(("size", "source_size", "target", "times", "taken"))


def mix_sources(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weight: Column | None = None, max_epochs: int = MAX_EPOCHS, buckets: int = BUCKETS,
) -> DataFrame:
    """Every row with size, source_size, target, times (how often the mix takes it) and
    taken (words it takes). Runs jobs: the plan is computed from ids, sizes and keys."""
    size = F.size(words(F.col(f"`{text}`"))).cast("long")
    rows = with_column_replaced(df, size=size, __w=weight if weight is not None else quality_weight(F.col(f"`{text}`")))
    rows = rows.withColumn("__key", sampling_key(F.col(f"`{doc_id}`"), F.col("size"), F.col("__w")))
    slim = staged(
        rows.select(F.col(f"`{source}`").alias("source"), "size", F.col("__w").alias("weight"), F.col("__key").alias("key")),
        "mix-rows")
    plan = mixing_plan(slim, max_epochs, buckets).select(F.struct("*").alias("__p"))
    out = rows.join(plan, F.col(f"`{source}`").eqNullSafe(F.col("__p.source")))
    bucket = _bucket(F.col("__key"), F.col("__p.scale"), buckets)
    more = (bucket < F.col("__p.last_bucket")) | (
        (bucket == F.col("__p.last_bucket")) & (F.col("__key") <= F.col("__p.last_key")))
    times = F.col("__p.epochs") + F.when(more, 1).otherwise(0)
    out = with_column_replaced(
        out, source_size=F.col("__p.source_size"), target=F.col("__p.target"), times=times.cast("long"),
        taken=(F.col("size") * times).cast("long"))
    return out.drop("__w", "__key", "__p")


def mixture(df: DataFrame, **options: object) -> DataFrame:
    """The mix itself: every row as often as the mix takes it, with the input's columns."""
    def taken(given: DataFrame) -> DataFrame:
        mixed = mix_sources(given, **options).where("times > 0")
        return mixed.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))

    return apart(df, ADDED, taken)
