"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur with up to ``k = floor(m * error_rate)`` edits. Cut into
k + 1 pieces, at least one piece of any such occurrence is exact. One automaton over the
pieces of a block of items scans every document; each hit gives the window in which the
item would lie, windows that overlap are merged, and Myers' bit-parallel algorithm decides
on the exact edit distance of the item to the best substring there.

Texts and items are compared in lower case with white space runs as one space. An item too
short for an edit (under 20 characters at 5 %) must begin and end at word borders, or it would
be found inside longer words.

Items are the stated query set. Their texts travel to the tasks with the code; the automaton,
which is many times larger, is built for one block of items of bounded size at a time.
Documents are read once whatever the number of blocks: a task with several blocks gathers
documents up to ``CHUNK_CHARS`` and takes them through every block before it reads on.
Documents never leave their task, so nothing is shuffled.

Defined cases: null and empty documents have no hits; null and blank items are ignored;
long texts are scanned whole; repeated documents each have their hits, repeated items (or
ids) each count; empty tables give an empty result; other columns are carried only by
``decontaminate``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.05
#: Characters of items in one block, at most (but for a single longer item).
BLOCK_CHARS = 4_000_000
#: Characters of documents that a task holds while it goes through several blocks, about.
CHUNK_CHARS = 64_000_000

Item = tuple[int | None, str]
Hit = tuple[int | None, int, int, int]


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces that differ in length by at most one character, with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(pattern: str, text: str, k: int) -> tuple[int, int] | None:
    """(distance, end) of the pattern's best match with a substring of text, the first of
    equals, if its edit distance is at most k."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    last, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score, best = full, 0, m, None
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | minus
        eq |= (((eq & plus) + plus) ^ plus)
        up = minus | (full & ~(eq | plus))
        down = plus & eq
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up <<= 1
        down <<= 1
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical & full
        if score <= k and (best is None or score < best[0]):
            best = (score, at + 1)
            if not score:
                break
    return best


def at_borders(text: str, begin: int, end: int) -> bool:
    """Whether text[begin:end] cuts through no word (run of letters and digits) at either end."""
    return not (
        (begin > 0 and text[begin - 1].isalnum() and text[begin].isalnum())
        or (end < len(text) and text[end - 1].isalnum() and text[end].isalnum())
    )


class Matcher:
    """Finds a block of items, given as (id, text), in normalised texts."""

    def __init__(self, items: list[Item], error_rate: float) -> None:
        self.items = []
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            k = int(len(text) * error_rate)
            for offset, piece in pieces(text, k):
                where[piece].append((len(self.items), offset))
            self.items.append((item_id, text, k))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[Hit]:
        """(item id, distance, budget, end) of every item that occurs, at its best place."""
        whole: dict[int, int] = {}
        windows: dict[int, list[tuple[int, int]]] = defaultdict(list)
        if not self.items:
            return []
        for end, (size, places) in self.automaton.iter(text):
            for item, offset in places:
                _, pattern, k = self.items[item]
                begin = end + 1 - size - offset
                if not k:  # the piece is the item
                    if item not in whole and at_borders(text, begin, end + 1):
                        whole[item] = end + 1
                    continue
                window = (max(0, begin - k), min(len(text), begin + len(pattern) + k))
                merged = windows[item]
                # Hits come by their ends; a window may still begin before the last one.
                while merged and window[0] <= merged[-1][1]:
                    last = merged.pop()
                    window = (min(window[0], last[0]), max(window[1], last[1]))
                merged.append(window)
        found = [(self.items[item][0], 0, 0, end) for item, end in sorted(whole.items())]
        for item, spans in sorted(windows.items()):
            item_id, pattern, k = self.items[item]
            best = None
            for a, b in spans:
                hit = myers(pattern, text[a:b], k)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], a + hit[1])
            if best:
                found.append((item_id, best[0], k, best[1]))
        return found


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> list[list[Item]]:
    """All normalised items, in blocks of ``block_chars`` characters."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    blocks, size = [], 0
    for r in rows.where("t IS NOT NULL").orderBy("i", "t").toLocalIterator():
        item = normalised(r["t"])
        if not item:
            continue
        if not blocks or size + len(item) > block_chars:
            blocks.append([])
            size = 0
        blocks[-1].append((r["i"], item))
        size += len(item)
    return blocks


def _chunks(batches: Iterator[pa.RecordBatch], at: int, chars: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups whose column ``at`` holds ``chars`` bytes of text, about."""
    chunk, size = [], 0
    for batch in batches:
        chunk.append(batch)
        size += batch.column(at).nbytes
        if size >= chars:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def matched(
    batches: Iterator[pa.RecordBatch], at: int, blocks: list[list[Item]], error_rate: float, chunk_chars: int,
) -> Iterator[tuple[pa.RecordBatch, list[list[Hit]]]]:
    """Each batch with the hits of each of its rows, whose text is in column ``at``. One
    matcher is in memory at a time; a single block's is built once."""
    only = Matcher(blocks[0], error_rate) if len(blocks) == 1 else None
    for chunk in _chunks(batches, at, chunk_chars if len(blocks) > 1 else 0):
        hits: list[list[list[Hit]]] = [[[] for _ in range(batch.num_rows)] for batch in chunk]
        for block in blocks:
            matcher = only or Matcher(block, error_rate)
            for batch, rows in zip(chunk, hits, strict=True):
                for text, row in zip(batch.column(at), rows, strict=True):
                    if given := text.as_py():
                        row += matcher.find(normalised(given))
        yield from zip(chunk, hits, strict=True)


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, distance, budget, ends_at): every document and item that occurs in
    it, with the least edit distance and where that match ends in the normalised text."""
    schema = "doc_id long, item_id long, distance int, budget int, ends_at long"
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    blocks = item_blocks(benchmark, item_id, item_text, block_chars)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in matched(batches, 1, blocks, error_rate, chunk_chars):
            hits = [(d, *hit) for d, row in zip(batch.column(0).to_pylist(), found, strict=True) for hit in row]
            names = ["doc_id", "item_id", "distance", "budget", "ends_at"]
            columns = list(zip(*hits, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return rows.mapInArrow(scan, schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """The documents in which no item occurs, with all their columns."""
    at = docs.columns.index(text)
    blocks = item_blocks(benchmark, item_id, item_text, block_chars)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in matched(batches, at, blocks, error_rate, chunk_chars):
            yield batch.filter(pa.array([not row for row in found], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
