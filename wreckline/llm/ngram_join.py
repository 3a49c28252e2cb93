"""N-gram Jaccard self-join: every pair of shingle sets at or above a threshold.

1. Equal sets are one class (grouped by two 64-bit keys, combined before the shuffle).
2. Candidates. A set's shingles in hash order give its windows: runs of ``k`` neighbours. Two
   sets of sizes s and r with i common shingles have at least ``(2k-1) i - (k-1)(s+r+1)`` windows
   in common: a shingle that only the first has breaks k of its windows, one that only the
   second has breaks k - 1. So each set sends as keys its windows of least hash, as many as
   make sure that two sets at the threshold send a common one. A key stands for k shingles
   next to each other in both sets, which strangers with a common line rarely have.
3. Keys are combined where they arise: equal keys within a task become star edges at
   once and one copy travels on, so that a key which a third of all sets hold moves one
   row per task. What the stars connect is a family; no true pair leaves its family.
4. Families are compared in size-banded tiles of bounded size. Hashed bitmaps bound the
   overlap of a pair from above by bit counts; pairs that pass, and are not connected
   already, are decided by exact intersection of the sorted arrays.
5. The components of the verified links are the result.

No step collects a key's or family's sets in one task beyond a tile, and no pair is left
out: windows, tiles and bitmaps only ever drop pairs that cannot reach the threshold.

Defined cases: null and empty texts have the empty set, linked with nothing; a text
with fewer words than a shingle has its whole sequence as one; texts are read whole;
repeated rows are in one class; an id on several texts stands for each of them; rows with a
null id stand alone, with a null component; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, staged
from .components import components
from .shingles import mix, set_keys, shingle_sets

WIDTH = 4
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Weight of a block of a family, at most (but for a single larger set): its shingles,
#: and ``SET_WEIGHT`` for each set.
BLOCK = 1 << 20
SET_WEIGHT = 200
#: Keys in one partition of the candidate shuffle, about.
KEYS_PER_PARTITION = 1_000_000
#: Keys that a task gathers before it combines and sends them.
KEYS_HELD = 500_000
#: Shingles in a window, at most, and the share of a set's windows that must be common to
#: its partners for windows of that length to serve.
WIDEST = 3
SHARE = 0.25
#: Growth of size bands, in thousandths of 100 / percent.
_MARGIN = 1003
_U = np.uint64


class Windows:
    """How many windows of each length a set of a given size sends, so that two different
    sets at the threshold send a common one."""

    def __init__(self, percent: int = PERCENT) -> None:
        self.percent = percent
        self._sent: dict[int, tuple[int, ...]] = {}
        # A pair uses the longest windows that serve all pairs whose smaller set is as large.
        self.first = [1]
        for k in range(2, WIDEST + 1):
            short = [m for m in range(1, 400) if self.common(k, m, m) < max(1, SHARE * m)]
            self.first.append(max(self.first[-1], max(short, default=0) + 1) if 399 not in short else 1 << 62)

    def common(self, k: int, s, r):
        """Common windows of k shingles that sets of s and r shingles at the threshold have."""
        both = -(-self.percent * (s + r) // (100 + self.percent))
        return (2 * k - 1) * both - (k - 1) * (s + r + 1)

    def sent(self, s: int) -> tuple[int, ...]:
        """For each length 1 to WIDEST, how many windows a set of s shingles sends."""
        if s not in self._sent:
            r = np.arange(-(-self.percent * s // 100), 100 * s // self.percent + 1)
            both = -(-self.percent * (s + r) // (100 + self.percent))
            r = r[(r != s) | (both < s)]  # sets of this size that differ, at all
            length = np.searchsorted(self.first, np.minimum(r, s), side="right")
            out = []
            for k in range(1, WIDEST + 1):
                own = s - k + 1
                some = r[length == k]
                out.append(min(own, int((own - self.common(k, s, some) + 1).max())) if len(some) else 0)
            self._sent[s] = tuple(out)
        return self._sent[s]


def window_keys(hashes: np.ndarray, bounds: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of every window that the rows send."""
    sizes = np.diff(bounds)
    distinct, which = np.unique(sizes, return_inverse=True)
    sent = np.array([windows.sent(int(n)) if n else (0,) * WIDEST for n in distinct]).reshape(-1, WIDEST)
    owner = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64)
    keys, rows = [hashes[:0]], [np.zeros(0, dtype=np.int64)]
    for k in range(1, WIDEST + 1):
        want = sent[which, k - 1]
        n = len(hashes) - k + 1
        if n <= 0 or not want.any():
            continue
        inside = (owner[:n] == owner[k - 1:]) & (want[owner[:n].astype(np.int64)] > 0)
        at = np.flatnonzero(inside)
        key = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            key = mix(key * _U(0xD6E8FEB86659FD93) + hashes[at + j])
        row = owner[at]
        # Rows ascend already: one sort by (row, leading bits of the key) ranks each row's keys.
        order = np.argsort((row << _U(44)) | (key >> _U(20)))
        row, key = row[order].astype(np.int64), key[order]
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(len(sizes)))[row]
        kept = rank < want[row]
        keys.append(key[kept])
        rows.append(row[kept])
    return np.concatenate(keys), np.concatenate(rows)


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One (key, least node) per key, and edges (least node, node) of keys held by several."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = nodes[new][np.cumsum(new) - 1] if len(keys) else nodes
    other = first != nodes
    return keys[new], nodes[new], first[other], nodes[other]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least node, node) of the components of edges (a, b), without the roots themselves."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = index[:len(a)], index[len(a):]
    root = np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    loose = root != np.arange(len(nodes))
    return nodes[root[loose]], nodes[loose]


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, th) of every row; th tells texts of one id apart."""
    value = F.col(f"`{text}`").cast("string")
    return df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), value.alias("text"), F.xxhash64(value).alias("th"))


def document_sets(df: DataFrame, doc_id: str, text: str, width: int = WIDTH) -> DataFrame:
    """(doc_id, th, n, k1, k2): set size and keys of every row."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, hashes, bounds in shingle_sets(batch.column(1), width):
                k1, k2 = set_keys(hashes, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array(np.diff(bounds)), pa.array(k1), pa.array(k2)],
                    names=["doc_id", "th", "n", "k1", "k2"])

    return _rows(df, doc_id, text).mapInArrow(keyed, "doc_id long, th long, n long, k1 long, k2 long")


def families(df: DataFrame, text: str, keys: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(k1, family) of the sets that share a window key with another set.

    ``keys`` is about how many keys there are; it sets the shuffle's width.
    """
    wide = max(1, -(-keys // KEYS_PER_PARTITION))
    schema = "part int, keys binary, nodes binary, low binary, high binary"

    def packed(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch | None:
        if not len(keys):
            return None
        keys, nodes, low, high = _stars(keys, nodes)
        low, high = _forest(low, high)
        part = ((keys >> _U(32)) * _U(wide)) >> _U(32)  # ascending, as keys are
        ids, at = np.unique(part, return_index=True)
        ends = np.append(at[1:], len(keys))
        turn = np.linspace(0, len(low), len(ids) + 1).astype(int)
        return pa.RecordBatch.from_arrays([
            pa.array(ids.astype(np.int32)),
            pa.array([keys[x:y].tobytes() for x, y in zip(at, ends, strict=True)], pa.binary()),
            pa.array([nodes[x:y].tobytes() for x, y in zip(at, ends, strict=True)], pa.binary()),
            pa.array([low[x:y].tobytes() for x, y in zip(turn[:-1], turn[1:], strict=True)], pa.binary()),
            pa.array([high[x:y].tobytes() for x, y in zip(turn[:-1], turn[1:], strict=True)], pa.binary()),
        ], names=["part", "keys", "nodes", "low", "high"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(percent)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, _, hashes, bounds in shingle_sets(batch.column(0), width):
                nodes = set_keys(hashes, bounds)[0]
                keys, row = window_keys(hashes, bounds, windows)
                held.append((keys, nodes[row]))
                size += len(keys)
                if size >= KEYS_HELD:
                    out = packed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
                    held, size = [], 0
                    if out is not None:
                        yield out
        if held:
            out = packed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
            if out is not None:
                yield out

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[bytes]] = [[], [], [], []]
        for batch in batches:
            for k in range(4):
                columns[k] += batch.column(k + 1).to_pylist()
        keys = np.frombuffer(b"".join(columns[0]), dtype=np.uint64)
        nodes, low, high = (np.frombuffer(b"".join(c), dtype=np.int64) for c in columns[1:])
        _, _, a, b = _stars(keys, nodes)
        a, b = _forest(np.concatenate((a, low)), np.concatenate((b, high)))
        for x in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[x:x + 100_000]), pa.array(b[x:x + 100_000])], names=["a", "b"])

    sent = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(emit, schema)
    edges = sent.repartition(wide, "part").mapInArrow(meet, "a long, b long")
    return components(edges).select(F.col("node").alias("k1"), F.col("root").alias("family"))


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """members (doc_id, th, n, k1, k2, family) with the tiles each belongs to: (tile, side, alone).

    A family of at most BLOCK is one tile. A larger one is cut into bands of size that reach
    one band up at most, and a band above half a BLOCK by hash. Each block meets itself and
    the first block of the next band in one tile (side 0, and 2 for those that only meet
    side 0), and every other block of its band and the next in a tile of their own
    (sides 1 and 2): a member of a band within a block is placed twice.
    """
    band = F.floor(F.log("n") / math.log(_MARGIN / (10 * percent))).cast("int")
    banded = members.withColumn("band", band)
    weight = F.sum(F.col("n") + F.lit(SET_WEIGHT)).alias("weight")
    # Written first: a skewed join is split over tasks where its sides come straight from shuffles.
    sums = staged(banded.groupBy("family", "band").agg(weight), "bands")
    total = sums.groupBy("family").agg(F.sum("weight").alias("all"))
    bands = staged(sums.join(total, "family").select(
        "family", "band", (F.col("all") > BLOCK).alias("alone"),
        F.ceil(F.col("weight") / (BLOCK / 2)).cast("int").alias("salts")), "bands")
    small = bands.where("NOT alone").select("family", "band", F.lit(0).alias("salt"), F.lit(False).alias("alone"),
                                            F.xxhash64("family").alias("tile"), F.lit(0).alias("side"))
    large = bands.where("alone").select("family", "band", "salts")
    x = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    above = large.select("family", (F.col("band") - 1).alias("band"), F.col("salts").alias("over"))
    x = x.join(above, ["family", "band"], "left").withColumn("over", F.coalesce("over", F.lit(0)))
    met = F.expr(
        "concat(array(struct(band AS band, salt AS salt)),"
        " transform(filter(sequence(0, salts - 1), j -> j > salt), j -> struct(band AS band, j AS salt)),"
        " transform(filter(sequence(0, over), j -> j < over), j -> struct(band + 1 AS band, j AS salt)))")
    y = x.withColumn("y", F.explode(met)).withColumn("own", F.expr("y.band = band AND y.salt = salt")).withColumn(
        "joined", F.expr("y.band = band + 1 AND y.salt = 0")).withColumn("tile", F.expr(
            "IF(own OR joined, xxhash64(family, band, salt, 'own'), xxhash64(family, band, salt, y.band, y.salt))"))
    placed = y.select("family", "tile", F.explode(F.expr(
        "CASE WHEN own THEN array(struct(band, salt, 0 AS side)) WHEN joined THEN array(struct(y.band, y.salt, 2 AS side))"
        " ELSE array(struct(band, salt, 1 AS side), struct(y.band, y.salt, 2 AS side)) END")).alias("b"))
    places = staged(small.unionByName(placed.select(
        "family", "b.band", "b.salt", F.lit(True).alias("alone"), "tile", "b.side")), "places")
    salted = banded.join(bands.select("family", "band", F.when(F.col("alone"), F.col("salts")).otherwise(1).alias("salts")),
                         ["family", "band"]).withColumn("salt", F.pmod(F.xxhash64("k1", "k2"), F.col("salts")).cast("int"))
    return salted.join(places, ["family", "band", "salt"]).select("doc_id", "th", "n", "k1", "k2", "tile", "side", "alone")


def _links(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Verified links of a tile that connect all that its links connect."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sides, sets = ids[order], sides[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    bits = 1 << max(8, min(16, int(math.ceil(math.log2(8 * float(np.median(sizes)) + 1)))))
    maps = np.zeros((len(sets), bits // 8), dtype=np.uint8)
    for k, s in enumerate(sets):
        at = np.unique((s & _U(bits - 1)).astype(np.int64))
        np.bitwise_or.at(maps[k], at >> 3, (1 << (at & 7)).astype(np.uint8))
    maps = maps.view(np.uint64)
    label = np.arange(len(sets))
    found = []
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(sizes, 100 * sizes[i] // percent, side="right"))
        near = np.arange(i + 1, end)
        near = near[label[near] != label[i]]
        if sides[i]:
            near = near[sides[near] != sides[i]]
        if not len(near):
            continue
        total = sizes[i] + sizes[near]
        least = -(-percent * total // (100 + percent))  # intersection that the threshold needs
        # Each differing bit is at least one shingle that only one of the two sets has.
        apart = np.bitwise_count(maps[near] ^ maps[i]).sum(axis=1, dtype=np.int64)
        fits = (total - apart) // 2 >= least
        near, least, apart = near[fits], least[fits], apart[fits]
        for k in np.argsort(apart, kind="stable"):
            j = near[k]
            if label[j] == label[i]:
                continue
            where = np.minimum(np.searchsorted(sets[j], sets[i]), len(sets[j]) - 1)
            if int((sets[j][where] == sets[i]).sum()) >= least[k]:
                found.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return found


def verified_links(df: DataFrame, members: DataFrame, doc_id: str, text: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between the first keys (k1) of a family's sets, enough to connect what
    is connected."""
    placed = staged(_tiles(members, percent), "tiles")
    tokens = placed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, -(-tokens // (2 * BLOCK)))
    once = members.select("doc_id", "th", "k1", "k2")
    # One plan at every size: the texts of members are found by a shuffle, never by a
    # broadcast that only small inputs allow.
    texts = _rows(df, doc_id, text).join(once.hint("merge"), ["doc_id", "th"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want1, want2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for lo, hi, hashes, bounds in shingle_sets(batch.column(0), width):
                k1, k2 = set_keys(hashes, bounds)
                same = np.flatnonzero((k1 == want1[lo:hi]) & (k2 == want2[lo:hi]))
                for x in range(0, len(same), 500):
                    some = same[x:x + 500]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(k1[some]), pa.array(k2[some]),
                        pa.array([hashes[bounds[k]:bounds[k + 1]].tobytes() for k in some], pa.binary()),
                    ], names=["k1", "k2", "hashes"])

    made = texts.select("text", "k1", "k2").mapInArrow(sets, "k1 long, k2 long, hashes binary")
    full = made.join(placed, ["k1", "k2"]).select(
        F.when(F.col("alone"), F.col("tile")).otherwise(F.pmod(F.xxhash64("tile"), F.lit(buckets))).alias("unit"),
        "alone", "tile", "side", "k1", "hashes")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        tile = table.column("tile").to_numpy()
        nodes, sides = table.column("k1").to_numpy(), table.column("side").to_numpy()
        blobs = table.column("hashes")
        links: list[tuple[int, int]] = []
        order = np.argsort(tile, kind="stable")
        cuts = np.flatnonzero(np.diff(tile[order])) + 1
        for group in np.split(order, cuts):
            group = group[np.unique(nodes[group], return_index=True)[1]]  # repeated rows
            if len(group) > 1:
                sets = [np.frombuffer(blobs[int(k)].as_buffer(), dtype=np.uint64) for k in group]
                links += _links(nodes[group], sides[group], sets, percent)
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return full.groupBy("alone", "unit").applyInArrow(compare, "a long, b long")


def _judged(df: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """(doc_id, th, n, component, first) of every row: the least id of its component and the
    hash of the text that has it; both null where the set is empty or the id null. Runs jobs."""
    docs = staged(document_sets(df, doc_id, text, width), "sets")
    total = docs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    whole = docs.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(whole.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "th")).alias("rep"), F.first("n").alias("n")), "classes")
    linked = families(df, text, total // 2, width, percent)
    release(df.sparkSession)
    members = staged(classes.join(linked, "k1").select("rep.*", "n", "k1", "k2", "family"), "members")
    roots = components(verified_links(df, members, doc_id, text, width, percent))
    release(df.sparkSession)
    rooted = staged(classes.join(roots, classes["k1"] == roots["node"], "left").select(
        "k1", "k2", "rep", F.coalesce("root", "k1").alias("root")), "roots")
    least = staged(rooted.groupBy("root").agg(F.min("rep").alias("least")), "least")
    joined = rooted.join(least, "root").select("k1", "k2", "least")
    return docs.join(joined, ["k1", "k2"], "left").select(
        "doc_id", "th", "n", *[F.when(F.col("doc_id").isNotNull(), F.col(f"least.{x}")).alias(y)
                               for x, y in (("doc_id", "component"), ("th", "first"))])


def ngram_components(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row. Runs jobs."""
    return _judged(df, doc_id, text, width, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each component the document with the
    least id stays, once (of several texts with that id the one of least hash); rows with a
    null id all stay, and of rows with an empty set one of each id and text."""
    found = _judged(df, doc_id, text, width, percent)
    first = found.where("doc_id IS NOT NULL AND (n = 0 OR component = doc_id AND first = th)").select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    key, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     key.cast("long").alias("__id"), F.xxhash64(value).alias("__th"))
    kept = held.join(first, ["__id", "__th"], "left_semi").dropDuplicates(["__id", "__th"])
    return kept.select("row.*").unionByName(df.where(key.isNull()))
