"""Conversation structure repair: the cheapest edits that make a conversation's roles read
``(system)? (user assistant)+``, or nothing, found by a run-length dynamic program.

Rows of a conversation are taken by turn (nulls first), then role, then a digest of the text.
A row's first fault counts: *blank* (nothing but white space), *duplicate* (role and text seen
earlier in the conversation), *truncated* (its last visible character ends no sentence).
Edits: keep (0), give another role (3), delete (4; the only edit for blank and duplicate rows),
insert an empty row (3); a truncated row that stays adds 3. Of the cheapest edits, those with
the least audit string win (``D`` delete, ``I`` insert, ``K`` keep, ``R`` role).

1. Faults are found by grouping: equal rows are counted before the shuffle, and the least turn
   of each (role, text) decides which of them is no duplicate. No texts meet in one task.
2. A row becomes a symbol: role initial and fault. Consecutive equal symbols are a run. Edits
   move through four states (nothing yet, after system, user, assistant), so a symbol is a
   4 x 4 min-plus matrix and a run its power, put together from cached binary powers. Costs to
   the end are known at every run's end; choices are unrolled from there, run by run.
3. The edits meet the texts again in the order of the rows, batch by batch.

What a task holds at a time is a conversation's symbols, a few bytes per run, and its audit,
which is a value of the result; texts only stream. A conversation's rows are put in order by
one task, which sorts with spilling: its audit, and a digest of its text, are sequential.

Defined cases: null texts and roles are ``null_text`` (one space: blank, and of no known
role); role initials other than s, u and a can not be kept; null turns come first and count
for no gap; null ids are one conversation; repeated rows are duplicates; texts of any length
only stream; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KEEP, ROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: No visible character; a last visible character that ends no sentence.
BLANK = r"^[\x20\x09-\x0D]*$"
ENDED = r"[.!?][\x20\x09-\x0D]*$"
INITIALS = ("s", "u", "a", "o")  # o: any other
CLEAN, CUT, DROP = 0, 1, 2
_FAR = 1 << 60
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: States: nothing yet, after system, after user, after assistant.
_STATES = range(4)
_NEXT = (2, 2, 3, 2)  # the state after the user or assistant that the grammar wants
_KEEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
_END = (0, 2 * INSERT, INSERT, 0)
_MAX_LONG = (1 << 63) - 1


def _times(a: tuple, b: tuple) -> tuple:
    """The min-plus product of two matrices."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _apply(m: tuple, after: tuple) -> tuple:
    return tuple(min(m[i][k] + after[k] for k in _STATES) for i in _STATES)


def _steps(symbol: int) -> list[dict[str, tuple[int, int]]]:
    """For each state the edits of a row of this symbol: letter -> (cost, new state)."""
    initial, fault = INITIALS[symbol // 3], symbol % 3
    out = []
    for q in _STATES:
        edits = {"D": (DELETE, q)}
        if fault != DROP:
            more = TRUNCATED if fault == CUT else 0
            if _KEEPS[initial][q] is not None:
                edits["K"] = (KEEP + more, _KEEPS[initial][q])
            edits["R"] = (ROLE + more, _NEXT[q])
        out.append(edits)
    return out


_STEPS = [_steps(s) for s in range(12)]


def _matrix(symbol: int) -> tuple:
    """Min-plus transition of one row: any inserts, then the row's own edit."""
    own = [[_FAR] * 4 for _ in _STATES]
    for q in _STATES:
        for cost, to in _STEPS[symbol][q].values():
            own[q][to] = min(own[q][to], cost)
    none = tuple(tuple(0 if i == j else _FAR for j in _STATES) for i in _STATES)
    insert = tuple(tuple(INSERT if _NEXT[i] == j else 0 if i == j else _FAR for j in _STATES) for i in _STATES)
    closed = _times(insert, _times(insert, none))
    return _times(closed, tuple(map(tuple, own)))


_powers: dict[tuple[int, int], tuple] = {}


def _power(symbol: int, k: int) -> tuple:
    """The transition of 2**k rows of a symbol; kept for the next run."""
    if (symbol, k) not in _powers:
        _powers[symbol, k] = _matrix(symbol) if k == 0 else _times(_power(symbol, k - 1), _power(symbol, k - 1))
    return _powers[symbol, k]


def _before(symbol: int, length: int, after: tuple) -> tuple:
    """Costs to the end before a run, from those after it."""
    k = 0
    while length:
        if length & 1:
            after = _apply(_power(symbol, k), after)
        length, k = length >> 1, k + 1
    return after


_rows: dict[tuple[int, tuple], tuple] = {}


def _row(symbol: int, after: tuple) -> tuple:
    """(least cost, costs before less that, choice by state) of a row whose costs after it, less
    their least, are given; the choice is (letters, new state), least letters first."""
    key = (symbol, after)
    if key not in _rows:
        before = _apply(_power(symbol, 0), after)
        choices = []
        for q in _STATES:
            letters, left, now = "", before[q], q
            while True:
                options = {c: (cost, to) for c, (cost, to) in _STEPS[symbol][now].items() if cost + after[to] == left}
                if INSERT + before[_NEXT[now]] == left:
                    options["I"] = (INSERT, _NEXT[now])
                letter = min(options)
                cost, to = options[letter]
                letters, now, left = letters + letter, to, left - cost
                if letter != "I":
                    break
            choices.append((letters, now))
        low = min(before)
        if len(_rows) > 100_000:
            _rows.clear()
        _rows[key] = (low, tuple(x - low for x in before), tuple(choices))
    return _rows[key]


def _tail(state: int) -> str:
    return "I" * (_END[state] // INSERT)


def cheapest_edits(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of a conversation given as runs (symbol, length) in order."""
    ends = [_END]
    for symbol, length in reversed(runs):
        ends.append(_before(symbol, length, ends[-1]))
    cost = ends[-1][0]
    ends.reverse()
    audit, state = [], 0
    for (symbol, length), after in zip(runs, ends[1:], strict=True):
        low = min(after)
        now, choices = tuple(x - low for x in after), []
        for _ in range(length):  # back from the run's end
            _, now, choice = _row(symbol, now)
            choices.append(choice)
        for choice in reversed(choices):
            letters, state = choice[state]
            audit.append(letters)
    return cost, "".join(audit) + _tail(state)


def _initial(role: Column) -> Column:
    """The place of a role's initial in INITIALS."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def judged_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", null_text: str = " ") -> DataFrame:
    """(conv, turn, role, text, key, copies, first, blank, symbol): distinct rows, the symbol of
    the first copy, and whether that is the first of its role and text. Written."""
    def filled(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text))

    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     filled(role).alias("role"), filled(text).alias("text"))
    distinct = staged(rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
                      .withColumn("key", F.md5(F.encode("text", "UTF-8"))), "turns")
    order = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))
    seen = staged(distinct.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"))
                  .agg(F.min(order).alias("least")), "first")
    joined = distinct.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")))
    fault = F.when(F.col("text").rlike(BLANK) | (order != F.col("least")), DROP).when(
        F.col("text").rlike(ENDED), CLEAN).otherwise(CUT)
    return staged(joined.select(
        "conv", "turn", "role", "text", "key", "copies", (order == F.col("least")).alias("first"),
        F.col("text").rlike(BLANK).alias("blank"), (3 * _initial(F.col("role")) + fault).cast("int").alias("symbol")), "judged")


def _whole(c: Column | str) -> Column:
    """A key of a conversation for the shuffle; null ids are one."""
    return F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("null")), F.col(c).isNull())


def _sorted(df: DataFrame, *by: str) -> DataFrame:
    return df.repartition(_whole("conv")).sortWithinPartitions(F.col("conv").asc_nulls_first(), *by)


def audits(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of
    ``conversations`` (conv), whether it has ``rows`` (from ``judged_rows``) or not. Written."""
    kind = rows.schema["conv"].dataType.simpleString()
    none = F.lit(None)
    marks = conversations.select("conv").distinct().select(
        "conv", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("key"), F.lit(0).cast("long").alias("copies"), F.lit(False).alias("first"),
        F.lit(False).alias("blank"), F.lit(-1).alias("symbol"))
    light = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "key", "copies", "first", "blank", "symbol")
    ordered = _sorted(light.unionByName(marks), "kind", F.col("turn").asc_nulls_first(), "role", "key").select(
        "conv", "turn", "copies", "first", "blank", "symbol")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: dict | None = None

        def begin(conv) -> dict:
            return {"conv": conv, "runs": [], "low": None, "last": None, "turns": 0, "blank": 0, "duplicate": 0,
                    "truncated": 0, "illegal": 0, "initial": None}

        def add(symbol: int, n: int) -> None:
            initial = INITIALS[symbol // 3]
            if now["initial"] is not None and (now["initial"], initial) not in _LEGAL:
                now["illegal"] += 1
            now["illegal"] += n - 1  # equal neighbours never are
            now["initial"] = initial
            if now["runs"] and now["runs"][-1][0] == symbol:
                now["runs"][-1] = (symbol, now["runs"][-1][1] + n)
            else:
                now["runs"].append((symbol, n))

        def done() -> tuple:
            cost, audit = cheapest_edits(now["runs"])
            gaps = 0 if now["low"] is None else now["last"] - now["low"] + 1 - now["turns"]
            return (now["conv"], min(gaps, _MAX_LONG), now["blank"], now["duplicate"], now["truncated"], now["illegal"], cost, audit)

        def batch_of(some: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in some], types[k]) for k in range(8)],
                names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

        types = None
        for batch in batches:
            if types is None:
                types = [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string()]
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for conv, turn, copies, first, blank, symbol in zip(*columns, strict=True):
                if now is None or conv != now["conv"]:
                    if now is not None:
                        out.append(done())
                    now = begin(conv)
                if symbol < 0:
                    continue
                if turn is not None and turn != now["last"]:
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["last"], now["turns"] = turn, now["turns"] + 1
                if blank:
                    now["blank"] += copies
                else:
                    now["duplicate"] += copies - (1 if first else 0)
                    now["truncated"] += symbol % 3 == CUT
                add(symbol, 1)
                if copies > 1:
                    add(symbol // 3 * 3 + DROP, copies - 1)
                if len(out) >= 2000:
                    yield batch_of(out)
                    out = []
        if now is not None:
            out.append(done())
        if out:
            yield batch_of(out)

    return staged(ordered.mapInArrow(solve, (
        f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")), "audits")


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv, place, edit, turn, role, text) of the rows that a conversation's audit leaves, in
    order by ``place`` from 0; inserted rows have no turn and an empty text."""
    kind = rows.schema["conv"].dataType.simpleString()
    none = F.lit(None)
    heads = audited.select("conv", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
                           F.col("audit").alias("text"), none.cast("string").alias("key"), F.lit(0).cast("long").alias("copies"))
    body = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "key", "copies")
    ordered = _sorted(heads.unionByName(body), "kind", F.col("turn").asc_nulls_first(), "role", "key").select(
        "conv", "kind", "turn", "role", "text", "copies")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place, conv = "", 0, 0, 0, None
        out: list[tuple] = []
        size = 0

        def put(letter: str, turn, role: str, text: str) -> None:
            nonlocal place, state, size
            state = _KEEPS[role[:1]][state] if letter == "K" else _NEXT[state]
            out.append((conv, place, letter, turn, role, text))
            place += 1
            size += len(text)

        def wanted() -> str:
            return "assistant" if state == 2 else "user"

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((
                    kinds, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))],
                names=["conv", "place", "edit", "turn", "role", "text"])

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put("I", None, wanted(), "")
                at += 1

        kinds = None
        for batch in batches:
            kinds = batch.schema.field(0).type
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for key, head, turn, role, text, copies in zip(*columns, strict=True):
                if head == 0:
                    audit, at, state, place, conv = text, 0, 0, 0, key
                    inserts()  # of a conversation without rows: none
                    continue
                for _ in range(copies):
                    letter = audit[at]
                    at += 1
                    if letter != "D":
                        put(letter, turn, role if letter == "K" else wanted(), text)
                    inserts()
                if size >= 4_000_000 or len(out) >= 5_000:
                    yield batch_of()
                    out.clear()
                    size = 0
        if out:
            yield batch_of()

    return ordered.mapInArrow(edit, f"conv {kind}, place long, edit string, turn long, role string, text string")


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary, repaired rows) of every conversation; ``conversations`` (with the column
    ``conv``) names those to report that may have lost all their rows. Runs jobs."""
    rows = judged_rows(df, conv, turn, role, text)
    named = (df if conversations is None else conversations).select(F.col(f"`{conv}`").alias("conv"))
    audited = audits(rows, named)
    return audited, repaired_rows(rows, audited)


def text_digests(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's ``role:text`` joined by newlines, streamed in
    order; of the empty text for a conversation (conv) without rows."""
    kind = repaired.schema["conv"].dataType.simpleString()
    marks = conversations.select("conv", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.lit("").alias("text"))
    ordered = _sorted(repaired.select("conv", "place", "role", "text").unionByName(marks), "place")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        conv, state, out, kinds = None, None, [], None

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], kinds), pa.array([r[1] for r in out], pa.string())],
                                              names=["conv", "sha256"])

        for batch in batches:
            kinds = batch.schema.field(0).type
            for key, place, role, text in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if place < 0:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = key, hashlib.sha256()
                    continue
                state.update((("\n" if place else "") + role + ":" + text).encode("utf-8"))
            if len(out) >= 5_000:
                yield batch_of()
                out = []
        if state is not None:
            out.append((conv, state.hexdigest()))
        if out:
            yield batch_of()

    return ordered.mapInArrow(digest, f"conv {kind}, sha256 string")
