"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots; bytes are summed per slot, and a
versioned slot map says which shard holds each slot. A new map fills shards largest slot
first into the least loaded shard; an edit keeps every slot that still fits its shard and
places only the rest, so rebalancing moves few slots. The map is the only state: at most
``slots`` rows whatever the input, which bounds the broadcast and the one-row fold.

Repeated rows are counted before anything is shuffled by slot and dealt out in runs of at
most ``RUN``, each with a slot of its own, so one row repeated without end does not fill
one slot.

Defined cases: a null text has no bytes, a null id hashes like any other value; a very
long text counts its whole size; an empty table gives no rows and an empty map; input
columns are read by name, so extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, staged, with_column_replaced

VIRTUAL_SLOTS = 8192
RUN = 256
#: Bytes that a record takes besides its text (fixed by the contract).
RECORD_BYTES = 8


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def text_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def slot_of(*keys: Column, slots: int = VIRTUAL_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def record_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, run, n): equal rows counted and split into runs."""
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        record_size(F.col(f"`{text}`")).alias("size"),
        text_crc32(F.col(f"`{text}`")).alias("text_crc32"),
    )
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("c"))
    runs = F.explode(F.sequence(F.lit(0), ((F.col("c") - 1) / RUN).cast("int")))
    return counted.withColumn("run", runs).select(
        "doc_id", "size", "text_crc32", "run",
        F.least(F.lit(RUN), F.col("c") - F.col("run") * RUN).cast("int").alias("n"),
    )


def slot_bytes(runs: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """(vslot, bytes, rows) of the slots in use."""
    slot = slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("run"), slots=slots)
    return runs.groupBy(slot.alias("vslot")).agg(
        F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").cast("long").alias("rows")
    )


def _fill(free: Column, loads: Column) -> Column:
    """Place slots (struct of negated bytes and vslot, in order) one after another into
    the shard that holds least so far."""
    kind = "struct<loads:array<bigint>,out:array<struct<vslot:int,shard:int>>>"

    def place(a: Column, s: Column) -> Column:
        def put(k: Column) -> Column:
            return F.struct(
                F.transform(a["loads"], lambda x, i: F.when(i == k, x - s["neg"]).otherwise(x)).alias("loads"),
                F.concat(a["out"], F.array(F.struct(s["vslot"].alias("vslot"), k.alias("shard")))).alias("out"),
            ).cast(kind)

        return let((F.array_position(a["loads"], F.array_min(a["loads"])) - 1).cast("int"), put)

    none = F.array().cast("array<struct<vslot:int,shard:int>>")
    return F.aggregate(free, F.struct(loads.alias("loads"), none.alias("out")).cast(kind), place, lambda a: a["out"])


def edit_slot_map(totals: DataFrame, shards: int, current: DataFrame | None = None) -> DataFrame:
    """The next version of a slot map: (version, vslot, shard, bytes, rows).

    ``totals`` is ``slot_bytes``. Without ``current`` every slot is placed anew. With it,
    each shard keeps its slots, largest first, up to an even share; what exceeds it, and
    slots that are new or on shards that no longer exist, go to the least loaded shards.
    """
    if current is None:
        held = totals.withColumn("was", F.lit(None).cast("int"))
        version = F.lit(1)
    else:
        was = current.select("vslot", F.when(F.col("shard") < shards, F.col("shard")).alias("was"))
        held = totals.join(F.broadcast(was), "vslot", "left")  # at most one row a slot
        version = F.lit((current.agg(F.max("version")).first()[0] or 0) + 1)
    largest = Window.partitionBy("was").orderBy(F.desc("bytes"), "vslot")
    share = F.sum("bytes").over(Window.partitionBy()) / shards
    upto = F.sum("bytes").over(largest.rowsBetween(Window.unboundedPreceding, 0))
    held = held.select("vslot", "bytes", "rows", F.when(upto <= share, F.col("was")).alias("was"))
    free = F.sort_array(F.collect_list(
        F.when(F.col("was").isNull(), F.struct((-F.col("bytes")).alias("neg"), F.col("vslot")))))
    kept = F.collect_list(F.when(F.col("was").isNotNull(), F.struct("was", "bytes")))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda k: F.aggregate(
            F.filter(F.col("kept"), lambda x: x["was"] == k), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]),
    )
    placed = held.agg(free.alias("free"), kept.alias("kept")).select(
        F.explode(_fill(F.col("free"), loads)).alias("p")).select("p.vslot", "p.shard")
    return held.join(F.broadcast(placed), "vslot", "left").select(
        version.alias("version"), "vslot", F.coalesce("was", "shard").alias("shard"), "bytes", "rows")


def save_slot_map(slot_map: DataFrame, path: str, version: int | None = None) -> None:
    """Add a version to a stored map; a version is written once and never changed. A map
    without rows does not know its version and is stored only if that is given."""
    version = version or slot_map.agg(F.max("version")).first()[0]
    if version is not None:
        slot_map.drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/version={version}")


def load_slot_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, the newest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def place_records(runs: DataFrame, slot_map: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, vslot, shard and slot, the record's
    place in its shard (gapless from 0).

    Places are the records of the shard's earlier virtual slots plus the place within the
    slot, so no task orders more than one virtual slot.
    """
    earlier = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    mapped = slot_map.select(
        "vslot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    vslot = slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("run"), slots=slots)
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "run")
    before = F.coalesce(F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = runs.withColumn("vslot", vslot).withColumn("before", before)
    rows = rows.join(F.broadcast(mapped), "vslot")  # at most one row a slot
    return rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "doc_id", "size", "text_crc32", "vslot", "shard",
        (F.col("first") + F.col("before") + F.col("k")).cast("long").alias("slot"))


def shard_records(
    df: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", slots: int = VIRTUAL_SLOTS,
    current: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(placed records, slot map) of a table; ``current`` is a map to edit instead of
    placing every slot anew. Runs jobs: the counted rows and the map are written once."""
    runs = staged(record_runs(df, doc_id, text), "shard-runs")
    slot_map = staged(edit_slot_map(slot_bytes(runs, slots), shards, current), "slot-map")
    return place_records(runs, slot_map, slots), slot_map


def shard_rows(
    df: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", slots: int = VIRTUAL_SLOTS,
) -> DataFrame:
    """Every row, all columns, with vslot and shard. Rows are read twice and never
    shuffled: once for the slots' bytes, once to look their slot up. Copies of one row
    share a slot here (``shard_records`` deals them out)."""
    t = F.col(f"`{text}`")
    rows = with_column_replaced(
        df, vslot=slot_of(F.col(f"`{doc_id}`"), text_crc32(t), F.lit(0), slots=slots))
    totals = rows.groupBy("vslot").agg(F.sum(record_size(t)).alias("bytes"), F.count("*").alias("rows"))
    slot_map = staged(edit_slot_map(staged(totals, "slot-bytes"), shards), "slot-map").select(
        F.col("vslot").alias("__v"), F.col("shard").alias("__s"))
    out = rows.join(F.broadcast(slot_map), F.col("vslot") == F.col("__v"))  # at most one row a slot
    return with_column_replaced(out, shard=F.col("__s")).drop("__v", "__s")
