"""Hot-key routing: huge groups go through a skew-proof plan, the rest through the cheapest.

Both plans compute the same per-key result, so routing only moves work. Which keys are hot is
known as values before a plan is built: from the list that is kept with the raw zone
(``sources.hot_list``), or, for frames without one, from one job that counts the keys of all
of them (combined before the shuffle). A key needs ``min_rows`` rows to qualify, so a list
holds at most rows / ``min_rows`` keys a table; one that is too long for the driver, as a low
threshold makes it, stays a written table. Where none qualifies the plain plan is all
there is; otherwise each table is read twice, once by either plan.

Rows without a key count as one group: they match nothing in a join, but may be many.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group with at least this many rows is handled by the skew-proof plan.
DEFAULT_HOT_ROWS = 1_000_000
# Keys that are compared as literals; a longer list is joined.
_AS_LITERALS = 1_000
# Listed keys from which a join with them is never planned as a broadcast through the driver.
_NO_BROADCAST = 200_000

_HOT = "_hot_key"
_IS_HOT = "_is_hot"


@dataclass(frozen=True)
class HotKeys:
    """Keys with many rows in some table, and whether the rows without a key are many. Keys too
    many to be held as values are the rows of ``listed`` instead, a written table that has each
    once; ``shuffled`` where they are too many to be broadcast, too."""

    keys: tuple[str, ...] = ()
    nulls: bool = False
    listed: DataFrame | None = None
    shuffled: bool = False

    def __bool__(self) -> bool:
        return self.nulls or bool(self.keys) or self.listed is not None


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Values of ``key`` (never NULL) with ``min_rows`` rows or more, one row each."""
    return key_counts(df, key, min_rows).filter(F.col(_HOT).isNotNull()).select(_HOT)


def key_counts(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """(_hot_key, _rows) of the keys, and of NULL, with ``min_rows`` rows or more."""
    counts = df.groupBy(F.col(key).alias(_HOT)).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") >= min_rows)


def count_hot(frames: list[DataFrame], key: str, min_rows: int) -> HotKeys:
    """Keys that are hot in any of ``frames``, counted and written by one job; read back as values
    unless they are more than the driver takes."""
    from wreckline.sources.sinks import stage_parquet  # sources import the operators

    out = key_counts(frames[0], key, min_rows)
    for df in frames[1:]:
        out = out.unionByName(key_counts(df, key, min_rows))
    # Written without a limit above it: that would count all keys in one task.
    listed = stage_parquet(out.select(_HOT).distinct(), name="hot-keys")
    most = _AS_LITERALS + 2
    taken = listed.limit(most).collect()
    if len(taken) < most:
        found = {r[0] for r in taken}
        return HotKeys(tuple(sorted(k for k in found if k is not None)), None in found)
    nulls = listed.filter(F.col(_HOT).isNull()).count() > 0
    listed = listed.filter(F.col(_HOT).isNotNull())
    shuffled = listed.count() > _NO_BROADCAST
    return HotKeys((), nulls, listed.hint("merge") if shuffled else listed, shuffled)


def split_hot(df: DataFrame, key: str, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot ones).

    Where that takes a shuffle, the rows meet the list once and are written apart: the plans over
    them read each table several times, and would shuffle it for the split at each.
    """
    if hot.listed is None and len(hot.keys) <= _AS_LITERALS:
        listed = F.coalesce(F.col(key).isin(*hot.keys), F.lit(hot.nulls)) if hot.keys else (
            F.col(key).isNull() & F.lit(hot.nulls))
        return df.filter(~listed), df.filter(listed)
    # Their number is known here; whether it is small enough to broadcast is left to Spark.
    names = hot.listed
    if names is None:
        names = df.sparkSession.createDataFrame([(k,) for k in hot.keys], f"{_HOT} string")
    named = df.filter(F.col(key).isNotNull())
    if hot.shuffled:
        from wreckline.sources.sinks import stage_parquet  # sources import the operators

        met = named.join(names, F.col(key) == F.col(_HOT), "left").withColumn(_IS_HOT, F.col(_HOT).isNotNull()).drop(_HOT)
        nameless = df.filter(F.col(key).isNull()).withColumn(_IS_HOT, F.lit(hot.nulls))
        routed = stage_parquet(met.unionByName(nameless), name="routed", partition_by=[_IS_HOT])
        return routed.filter(~F.col(_IS_HOT)).drop(_IS_HOT), routed.filter(_IS_HOT).drop(_IS_HOT)
    cold, rest = (named.join(names, F.col(key) == F.col(_HOT), how) for how in ("left_anti", "left_semi"))
    nameless = df.filter(F.col(key).isNull())
    return (cold, rest.unionByName(nameless)) if hot.nulls else (cold.unionByName(nameless), rest)


def route_hot(
    df: DataFrame,
    key: str,
    plain: Callable[[DataFrame], DataFrame],
    skew_proof: Callable[[DataFrame], DataFrame],
    min_rows: int = DEFAULT_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``plain`` over rows of ordinary keys, ``skew_proof`` over rows of hot ones.

    ``hot`` is the list kept with the zone, or one that a caller shares between several
    tables; otherwise the keys of ``df`` are counted now.
    """
    if hot is None:
        hot = count_hot([df], key, min_rows)
    if not hot:
        return plain(df)
    cold, rest = split_hot(df, key, hot)
    return plain(cold).unionByName(skew_proof(rest))
