"""Cheapest repair of conversations to ``(s?(ua)+)?``, by a dynamic programme over runs.

Rows of a conversation, in the order of their turns (nulls first; then role, then checksum), become symbols:
the initial of the role and the first fault (blank, duplicate, truncated). A repair keeps, reroles,
deletes or inserts rows. Four states are enough (nothing yet, behind s, behind u, behind a), so each
symbol is a 4 x 4 matrix of costs, and costs add and compete (min-plus). Equal consecutive symbols are
one run; a run of n takes the cached binary powers of its matrix.

A conversation may hold any share of the rows, so it is cut where the range-sorted rows are cut into
partitions, and behind every PIECE rows. Of each piece only a matrix travels to the conversation's task,
which says what the rows behind each piece will cost. Then every piece unrolls its choices by itself, for
each state it may be entered in; the states are chained where the repaired rows are put together, in one
ordered pass with constant memory (a checksum over a text cannot be taken in parallel).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import small_batches
from martloom.session import materialize

BLANK = " \t\n\x0b\x0c\r"
PIECE = 1 << 18  # rows of a piece at most
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
NEVER = 1 << 60
STATES = range(4)  # 0 nothing yet, 1 behind s, 2 behind u, 3 behind a
FINAL = (0, 3)
NEEDED = (2, 2, 3, 2)  # the state that the one row which may be made here leads to
NAMES = {2: "user", 3: "assistant"}
GONE = 8  # symbol of rows that must go; the others are 2 * role + truncated
ROLES = {"s": 0, "u": 1, "a": 2}  # any other role: 3

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# --- costs ----------------------------------------------------------------------


@lru_cache(1 << 16)
def _join(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, *(row[k] + b[k][t] for k in STATES)) for t in STATES) for row in a)


@lru_cache(1 << 16)
def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(NEVER, *(row[k] + v[k] for k in STATES)) for row in a)


IDENTITY: Matrix = tuple(tuple(0 if s == t else NEVER for t in STATES) for s in STATES)


def _inserts() -> Matrix:
    one = tuple(tuple(INSERT if NEEDED[s] == t else 0 if s == t else NEVER for t in STATES) for s in STATES)
    return _join(one, _join(one, one))


INSERTS = _inserts()
AT_END = _apply(INSERTS, tuple(0 if s in FINAL else NEVER for s in STATES))  # cost behind the last row


def _kept_to(symbol: int, state: int) -> int | None:
    """State behind a row that is kept, if it may be."""
    role = symbol >> 1
    if role == 0:
        return 1 if state == 0 else None
    return role + 1 if role in (1, 2) and NEEDED[state] == role + 1 else None


@cache
def _moves(symbol: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(edit, cost, next state) that take up a row of this symbol, by edit."""
    moves = [("D", DELETE, state)]
    if symbol != GONE:
        late = TRUNCATED * (symbol & 1)
        to = _kept_to(symbol, state)
        if to is not None:
            moves.append(("K", KEEP + late, to))
        moves.append(("R", REROLE + late, NEEDED[state]))
    return tuple(moves)


@cache
def _power(symbol: int, bit: int) -> Matrix:
    """The symbol's matrix, inserts in front of the row included, to the power 2 ** bit."""
    if bit:
        half = _power(symbol, bit - 1)
        return _join(half, half)
    rows = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, to in _moves(symbol, state):
            rows[state][to] = min(rows[state][to], cost)
    return _join(INSERTS, tuple(map(tuple, rows)))


def _bits(n: int) -> Iterator[int]:
    return (b for b in range(n.bit_length()) if n >> b & 1)


def _over_run(symbol: int, n: int, behind: Vector) -> Vector:
    for bit in _bits(n):
        behind = _apply(_power(symbol, bit), behind)
    return behind


def _matrix(runs: list[list[int]]) -> Matrix:
    total = IDENTITY
    for symbol, n in runs:
        for bit in _bits(n):
            total = _join(total, _power(symbol, bit))
    return total


@cache
def _choices(symbol: int, behind: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """For costs behind a row (least taken off): costs in front of it, and of each state the least cheapest edits and the next state."""
    front = _apply(_power(symbol, 0), behind)

    def edits(state: int) -> tuple[str, int]:
        options = {e: (cost, to) for e, cost, to in _moves(symbol, state)}
        for edit in "DIKR":
            if edit == "I":
                if INSERT + front[NEEDED[state]] == front[state]:
                    more, to = edits(NEEDED[state])
                    return "I" + more, to
            elif edit in options and options[edit][0] + behind[options[edit][1]] == front[state]:
                return edit, options[edit][1]
        raise AssertionError("no edit has the least cost")

    least = min(front)
    return tuple(x - least for x in front), tuple(edits(s) for s in STATES)


def _unroll(runs: list[list[int]], behind: Vector, states: list[int]) -> list[tuple[str, int]]:
    """The cheapest, ASCII-least edits of a piece from each state, and the state they end in."""
    ends = [behind]  # costs behind each run
    for symbol, n in reversed(runs[1:]):
        ends.append(_over_run(symbol, n, ends[-1]))
    written: list[list[str]] = [[] for _ in states]
    states = list(states)
    for (symbol, n), cost in zip(runs, reversed(ends), strict=True):
        tables = []
        least = min(cost)
        cost = tuple(x - least for x in cost)
        for _ in range(n):
            cost, table = _choices(symbol, cost)
            tables.append(table)
        for k, state in enumerate(states):
            for table in reversed(tables):
                edits, state = table[state]
                written[k].append(edits)
            states[k] = state
    return [("".join(w), s) for w, s in zip(written, states, strict=True)]


def _closing(state: int) -> str:
    """Inserts behind the last row."""
    edits = ""
    while state not in FINAL:
        edits, state = edits + "I", NEEDED[state]
    return edits


# --- pieces ---------------------------------------------------------------------


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted rows of a partition: their runs, matrix and counts."""
    part = TaskContext.get().partitionId()
    done: list[tuple] = []
    piece, seq = None, 0

    def finish() -> tuple:
        runs = piece["runs"]
        matrix = [min(x, NEVER) for row in _matrix(runs) for x in row]
        return (
            part, seq, *piece["key"], bytes(s for s, _ in runs), [n for _, n in runs], matrix, piece["blank"], piece["duplicate"],
            piece["truncated"], piece["illegal"], piece["head"], piece["tail"], piece["low"], piece["high"], piece["turns"],
        )

    for conv_id, turn, role, digest, n, blank, truncated, later in _rows(batches):
        if piece is None or piece["key"][0] != conv_id or piece["size"] >= PIECE:
            if piece is not None:
                done.append(finish())
                seq += 1
            if len(done) >= 500:
                yield _batch(done, schema)
                done = []
            piece = {"key": (conv_id, turn, role, digest), "runs": [], "size": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                     "head": role[:1], "tail": None, "low": None, "high": None, "turns": 0}
        initial = role[:1]
        if piece["tail"] is not None and piece["tail"] + initial not in ("su", "ua", "au"):
            piece["illegal"] += 1
        piece["illegal"] += n - 1
        piece["tail"] = initial
        if turn is not None and turn != piece["high"]:
            piece["turns"] += 1
            piece["high"] = turn
            if piece["low"] is None:
                piece["low"] = turn
        fresh = 0 if blank or later else 1
        piece["blank"] += n if blank else 0
        piece["duplicate"] += 0 if blank else n - fresh
        piece["truncated"] += fresh if truncated else 0
        piece["size"] += n
        for symbol, times in ((2 * ROLES.get(initial, 3) + truncated, fresh), (GONE, n - fresh)):
            if times and piece["runs"] and piece["runs"][-1][0] == symbol:
                piece["runs"][-1][1] += times
            elif times:
                piece["runs"].append([symbol, times])
    if piece is not None:
        done.append(finish())
    if done:
        yield _batch(done, schema)


def _costs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of each piece the costs behind it; of a conversation's first piece also the counts and the cost of the whole."""
    done: list[tuple] = []

    def finish(pieces: list[tuple]) -> None:
        blank = duplicate = truncated = illegal = turns = 0
        low = high = tail = None
        for _, _, _, _, b, d, t, i, head, end, first, last, n in pieces:
            blank, duplicate, truncated, illegal = blank + b, duplicate + d, truncated + t, illegal + i
            if tail is not None and tail + head not in ("su", "ua", "au"):
                illegal += 1
            tail = end
            if n:
                turns += n - (first == high)
                low, high = first if low is None else low, last
        gaps = 0 if low is None else high - low + 1 - turns
        behind, found = AT_END, []
        for part, seq, _, flat, *_ in reversed(pieces):
            found.append((part, seq, list(behind)))
            behind = _apply(tuple(tuple(flat[4 * s : 4 * s + 4]) for s in STATES), behind)
        counts = [gaps, blank, duplicate, truncated, illegal, behind[0]]
        for k, row in enumerate(reversed(found)):
            done.append((*row, counts if k == 0 else None))

    held: list[tuple] = []
    for row in _rows(batches):
        if held and held[-1][2] != row[2]:
            finish(held)
            held = []
            if len(done) >= 500:
                yield _batch(done, schema)
                done.clear()
        held.append(row)
    if held:
        finish(held)
    if done:
        yield _batch(done, schema)


def _unrolled(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for conv_id, turn, role, digest, symbols, times, behind, counts in _rows(iter([batch])):
            runs = [list(r) for r in zip(symbols, times, strict=True)]
            # the first piece is entered with nothing yet, so the other states need no edits there
            found = _unroll(runs, tuple(behind), [0] if counts else list(STATES))
            done.append((conv_id, turn, role, digest, None, [e for e, _ in found], [s for _, s in found], counts))
            if sum(len(e) for *_, edits, _, _ in done for e in edits) > 1 << 22:
                yield _batch(done, schema)
                done = []
        if done:
            yield _batch(done, schema)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("row", conv_id, edit, role, text) of every repaired row, then ("end", conv_id, counts, audit)."""
    open_, conv_id = False, None
    counts: list[int] = []
    audit: list[str] = []
    state, edits, at = 0, "", 0

    def inserted() -> tuple:
        nonlocal state
        state = NEEDED[state]
        return "row", conv_id, "I", NAMES[state], ""

    def finish() -> Iterator[tuple]:
        closing = _closing(state)
        for _ in closing:
            yield inserted()
        yield "end", conv_id, counts, "".join(audit) + closing

    for next_id, text, copies, role, piece_edits, piece_states, piece_counts in _rows(batches):
        if not open_ or next_id != conv_id:
            if open_:
                yield from finish()
            open_, conv_id, counts, audit, state, edits, at = True, next_id, [0] * 6, [], 0, "", 0
            continue  # the conversation's own row comes first
        if piece_edits is not None:
            edits, at = piece_edits[state if len(piece_edits) > 1 else 0], 0
            audit.append(edits)
            counts = piece_counts or counts
            continue
        for _ in range(copies):
            while edits[at] == "I":
                yield inserted()
                at += 1
            edit = edits[at]
            at += 1
            if edit == "K":
                state = ROLES[role[:1]] + 1
                yield "row", conv_id, edit, role, text
            elif edit == "R":
                state = NEEDED[state]
                yield "row", conv_id, edit, NAMES[state], text
    if open_:
        yield from finish()


def _reported(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    size, seen, first = 0, hashlib.sha256(), True
    for kind, conv_id, *rest in _walk(batches):
        if kind == "row":
            _, role, text = rest
            seen.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
            continue
        counts, audit = rest
        done.append((conv_id, *counts, audit, seen.hexdigest()))
        size, seen, first = size + len(audit) + 200, hashlib.sha256(), True
        if size > 1 << 22:
            yield _batch(done, schema)
            done, size = [], 0
    if done:
        yield _batch(done, schema)


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    size = position = 0
    for kind, conv_id, *rest in _walk(batches):
        if kind == "end":
            position = 0
            continue
        edit, role, text = rest
        done.append((conv_id, position, role, text, edit))
        position, size = position + 1, size + len(text) + 50
        if size > 1 << 22:
            yield _batch(done, schema)
            done, size = [], 0
    if done:
        yield _batch(done, schema)


# --- frames ---------------------------------------------------------------------


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _map(df: DataFrame, fn: Callable, fields: str | T.StructType) -> DataFrame:
    schema = fields if isinstance(fields, T.StructType) else T._parse_datatype_string(fields)
    arrow = _arrow(schema)
    return df.mapInArrow(lambda batches: fn(batches, arrow), schema)


def _fields(conv: T.DataType, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv) if f.name == "conv_id" else f for f in T._parse_datatype_string(ddl)])


def _assembled(rows: DataFrame, ids: DataFrame, finish: Callable, ddl: str) -> DataFrame:
    """Run the repair over ``rows`` (conv_id, turn, role, text, copies); ``ids`` has every conversation once."""
    spark = small_batches(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType
    key = ["conv_id", "turn", "role", "digest"]
    # equal rows of a turn shrink to one with a count before anything moves
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    held = materialize(
        rows.withColumn("digest", digest).groupBy(*key).agg(F.first("text").alias("text"), F.sum("copies").alias("copies")), "turns"
    )
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    # where a text was first said, of texts said in several turns: stored, so that the join sees plain exchanges and can split a hot text
    again = materialize(
        held.groupBy("conv_id", "digest").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1"), "repeats"
    ).select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first")
    trimmed = F.rtrim("text", F.lit(BLANK))
    faults = held.select(
        *key, "copies", (trimmed == "").alias("blank"), ((trimmed != "") & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated")
    )
    marked = faults.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left").select(
        *key, "copies", "blank", "truncated", (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(turn)).alias("later")
    )
    pieces = materialize(
        _map(
            marked.repartitionByRange(*key).sortWithinPartitions(*key),
            _cut,
            _fields(
                conv,
                "part int, seq int, conv_id int, turn long, role string, digest binary, symbols binary, times array<long>, matrix array<long>, "
                "blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long",
            ),
        ),
        "pieces",
    )
    costs = _map(
        pieces.select("part", "seq", "conv_id", "matrix", "blank", "duplicate", "truncated", "illegal", "head", "tail", "low", "high", "turns")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "seq"),
        _costs,
        "part int, seq int, behind array<long>, counts array<long>",
    )
    edited = _map(
        pieces.join(costs, ["part", "seq"]).select(*key, "symbols", "times", "behind", "counts"),
        _unrolled,
        _fields(conv, "conv_id int, turn long, role string, digest binary, text string, edits array<string>, states array<int>, counts array<long>"),
    )
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in (("edits", "array<string>"), ("states", "array<int>"), ("counts", "array<long>"))}
    empty = {c: F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"))}
    order = [*key, "is_row"]
    columns = [*order, "text", "copies", "edits", "states", "counts"]
    together = (
        held.select(*key, F.lit(True).alias("is_row"), "text", "copies", *nothing.values())
        .unionByName(edited.select(*key, F.lit(False).alias("is_row"), "text", F.lit(None).cast("long").alias("copies"), "edits", "states", "counts"))
        # a conversation's own row has no role, so that it stands first
        .unionByName(
            ids.select("conv_id", *empty.values(), F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("copies"), *nothing.values())
        )
        .select(*columns)
    )
    ordered = together.repartition("conv_id").sortWithinPartitions(*order)
    return _map(ordered.select("conv_id", "text", "copies", "role", "edits", "states", "counts"), finish, _fields(conv, ddl))


def _plain(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    space = F.lit(" ")
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )


REPORT = (
    "conv_id int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def repair(conversations: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: conv_id, position (from 0), role, text, edit (K kept, R reroled, I inserted).

    Reads conv_id, turn, role and text of every row; other columns are not read. A null role or text is one
    space (and so blank, if the text); a null conv_id is a conversation of its own; rows of one turn stand by
    role, then by the checksum of role and text; rows equal in all are duplicates from the second on. Very
    long texts are handled one at a time. An empty table has no conversations.
    """
    rows = _plain(conversations)
    return _assembled(rows, rows.select("conv_id").distinct(), _repaired, "conv_id int, position long, role string, text string, edit string")


def audit(conversations: DataFrame) -> DataFrame:
    """Of every conversation its faults, the cost and edits of the cheapest repair and a checksum of the result (nulls as in ``repair``)."""
    rows = _plain(conversations)
    return _assembled(rows, rows.select("conv_id").distinct(), _reported, REPORT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage by d = crc32(``conv_id:turn``, nulls: a space) mod 20.

    0 drops the row, 1 empties its text, 2 removes the text's ``.!?``, 3 repeats the row, 4 gives it the role user.
    """
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    d = F.crc32(place.cast("binary")) % 20
    return _plain(
        conversations.where(d != 0).select(
            "conv_id",
            "turn",
            F.when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(d == 1, F.lit("")).when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.when(d == 3, 2).otherwise(1).alias("copies"),
        ),
        F.col("copies"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """``audit`` of the damaged rows of every conversation, also of those that lost all rows."""
    return _assembled(damaged(conversations), conversations.select("conv_id").distinct(), _reported, REPORT)
