"""Conversation structure repair (11): cheapest edits to a legal role order, by a checkpointed dynamic program.

A legal conversation's role initials match ``(s?(ua)+)?``.  Rows are kept (free),
get another role (3), are deleted (4; a must for blank and repeated rows) or
an empty turn is inserted (3); a truncated row that stays adds 3.  Of the cheapest
edits those whose initials (``D``, ``I``, ``K``, ``R``) come first in ASCII are taken.

The cost to finish from a row is a vector over the four states of the pattern.
Going backwards, ``walk`` stores these vectors only at every sqrt(n)-th row; going
forwards, it computes one block of them again at a time and takes the least
tight edit.

A conversation may hold a third of all rows, so none is collected.  Rows are
range-sorted and cut into pieces of at most ``PIECE_ROWS`` rows or ``PIECE_CHARS``
characters.  Within a conversation of several pieces, the vector at the end of
each piece comes from the pieces' 4 x 4 cost matrices, multiplied by pointer
doubling, and the state at its start from the pieces' state maps, composed the
same way: log2(pieces) joins of a small row per piece.

Defined cases: a null role or text is one blank; null turns come first; equal
turns are in the order of role and text; rows of a null ``conv_id`` are one
conversation; an empty role has no initial and cannot stay; an empty table
gives no rows; other columns are ignored.  Rows of one conversation, turn, role and first
``PREFIX`` characters share a sorted task, which streams them piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import pieces as smaller
from sparkrec.llm.common import staged

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
PIECE_ROWS = 1024
PIECE_CHARS = 1 << 22
PREFIX = 64
FAR = 1 << 50  # more than any cost
MOST = (1 << 63) - 1  # gaps are cut off here

#: States: nothing yet, after system, after user, after assistant.
STATES = range(4)
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = ("user", "user", "assistant", "user")  # the role that an insertion or a new role has in each state
FINAL = (0, 6, 3, 0)  # cost to finish after the last row

BLANK, REPEATED, CUT, FINE = "blank", "duplicate", "truncated", ""
CODES = {BLANK: 0, REPEATED: 0, CUT: 1, FINE: 2}  # 0: must go
INITIALS = "sua"


def code(fault: str, role: str) -> int:
    """What the edits of a row depend on, in one byte."""
    return CODES[fault] * 4 + (INITIALS.find(role[0]) if role else -1) % 4


def row_edits(c: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use up a row of code ``c``, in ASCII order."""
    kind, initial = divmod(c, 4)
    edits = [("D", DELETE, state)]
    if kind:
        extra = TRUNCATED if kind == CODES[CUT] else 0
        if initial < 3 and INITIALS[initial] in STEPS[state]:
            edits.append(("K", KEEP + extra, STEPS[state][INITIALS[initial]]))
        edits.append(("R", REROLE + extra, STEPS[state][TURN[state][0]]))
    return edits


ROW_EDITS = [[row_edits(c, s) for s in STATES] for c in range(12)]
AFTER_INSERT = [STEPS[s][TURN[s][0]] for s in STATES]


def back(c: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to finish before a row of code ``c``, from those after it."""
    edits = ROW_EDITS[c]
    now = [min(cost + after[to] for _, cost, to in edits[s]) for s in STATES]
    user, assistant = min(now[2], now[3] + INSERT), min(now[3], now[2] + INSERT)
    return min(now[0], user + INSERT), min(now[1], user + INSERT), user, assistant


def walk(codes: bytes, end: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    """(initials of the least tight edits, state after them) of a piece entered in ``state``.

    ``end`` holds the costs to finish after the piece; ``last``: nothing follows.
    """
    n = len(codes)
    block = isqrt(n) + 1
    checkpoints = {n: end}
    cost = end
    for i in range(n - 1, -1, -1):
        cost = back(codes[i], cost)
        if i % block == 0:
            checkpoints[i] = cost
    out = []
    for first in range(0, n, block):
        stop = min(first + block, n)
        costs = [checkpoints[stop]]
        for i in range(stop - 1, first - 1, -1):
            costs.append(back(codes[i], costs[-1]))
        for i in range(first, stop):
            now, after = costs[stop - i], costs[stop - i - 1]
            while True:
                left = now[state]
                letter, _, to = min((e for e in ROW_EDITS[codes[i]][state] if e[1] + after[e[2]] == left), default=("Z", 0, 0))
                if letter > "I" and now[AFTER_INSERT[state]] + INSERT == left:
                    out.append("I")
                    state = AFTER_INSERT[state]
                    continue
                out.append(letter)
                state = to
                break
    while last and FINAL[state]:
        out.append("I")
        state = AFTER_INSERT[state]
    return "".join(out), state


def matrix(codes: bytes) -> list[int]:
    """Least cost from each state before the piece to each state after it, row by row."""
    columns = []
    for to in STATES:
        cost = tuple(0 if s == to else FAR for s in STATES)
        for c in reversed(codes):
            cost = back(c, cost)
        columns.append(cost)
    return [min(columns[to][s], FAR) for s in STATES for to in STATES]


def read_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` of all rows, without null strings."""
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """The test damage: by the row's hash one of five faults, or none."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("fault", F.crc32(name) % 20).filter("fault <> 0")
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def own_fault(text: Column) -> Column:
    """The fault that a row shows by itself."""
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
            .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(FINE))


PIECE = ("conv_id long, part int, seq int, open boolean, codes binary, turns array<long>, roles array<string>, "
         "texts array<string>, faults array<string>, names array<binary>")


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows into pieces; ``open``: the conversation has several pieces or may go on in another task."""
    part, seq = TaskContext.get().partitionId(), 0
    held: list[tuple] = []
    chars = conversations = 0
    several = False
    current: int | None = None
    seen: set[bytes] = set()

    def close(is_open: bool) -> pa.RecordBatch:
        nonlocal seq, held, chars
        turns, roles, texts, faults, names = map(list, zip(*held))
        row = (current, part, seq, is_open, bytes(map(code, faults, roles)), turns, roles, texts, faults, names if is_open else [])
        seq, held, chars = seq + 1, [], 0
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TYPES)], NAMES)

    for batch in smaller(batches):
        for conv, turn, role, text, fault, name in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != current or not conversations:
                if held:
                    yield close(conversations == 1 or several)
                current, seen, several, conversations = conv, set(), False, conversations + 1
            elif len(held) >= most or chars + len(text) > PIECE_CHARS:
                several = True
                yield close(True)
            if fault != BLANK and name in seen:
                fault = REPEATED
            seen.add(name)
            held.append((turn, role, text, fault, name))
            chars += len(text)
    if held:
        yield close(True)


TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string()),
         pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.binary())]
NAMES = [f.split()[0] for f in PIECE.split(", ")]


def cut(rows: DataFrame, piece_rows: int) -> DataFrame:
    """All rows in order as pieces (``PIECE``) numbered ``place`` without gaps, one after the other over all conversations."""
    name = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    keyed = rows.withColumn("fault", own_fault(F.col("text"))).withColumn("name", name)
    order = ["conv_id", "turn", "role"]
    ordered = keyed.repartitionByRange(*order, F.substring("text", 1, PREFIX)).sortWithinPartitions(*order, "text")
    found = staged(ordered.mapInArrow(partial(_cut, most=piece_rows), PIECE), "pieces")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = found.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(  # a row per task
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(parts), "part").withColumn("place", F.col("base") + F.col("seq")).drop("part", "seq", "base")


def repeated_later(chained: DataFrame) -> DataFrame:
    """(place, later): rows of each piece that an earlier task's piece of the conversation holds already.

    Within a task only the first of equal rows is left, so a group holds at most a row per task.
    """
    rows = (chained.select("place", "first", F.posexplode(F.arrays_zip("names", "faults")).alias("at", "r"))
            .filter(~F.col("r.faults").isin(BLANK, REPEATED)))
    order = Window.partitionBy("first", "r.names").orderBy("place")
    return (rows.withColumn("n", F.row_number().over(order)).filter("n > 1")
            .groupBy("place").agg(F.collect_list("at").alias("later")))


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the rows found by ``repeated_later`` marked, and their matrices."""
    for batch in batches:
        codes, matrices, marks = [], [], []
        for raw, faults, later in zip(*(batch.column(n).to_pylist() for n in ("codes", "faults", "later"))):
            raw = bytearray(raw)
            for at in later or []:
                raw[at], faults[at] = raw[at] % 4, REPEATED
            codes.append(bytes(raw))
            marks.append(faults)
            matrices.append(matrix(bytes(raw)))
        yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(codes, pa.binary()), pa.array(marks, pa.list_(pa.string())),
                                          pa.array(matrices, pa.list_(pa.int64()))], ["place", "codes", "faults", "matrix"])


def times(a: Column, b: Column) -> Column:
    """The least-cost product of two 4 x 4 matrices, or of a matrix and a vector (arrays of 16 or 4)."""
    wide = F.size(b) == 16
    cells = F.sequence(F.lit(0), F.size(b) - 1)

    def cell(k: Column) -> Column:
        row, column = F.when(wide, F.floor(k / 4)).otherwise(k), F.when(wide, k % 4).otherwise(0)
        step = F.when(wide, 4).otherwise(1)
        sums = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.get(a, (row * 4 + j).cast("int")) + F.get(b, (j * step + column).cast("int")))
        return F.least(F.array_min(sums), F.lit(FAR))

    return F.transform(cells, cell)


def _doubled(chain: DataFrame, value: str, longest: int, join: object, forward: bool) -> DataFrame:
    """``value`` of each place combined with those of all its conversation's places after (or before) it."""
    step = 1
    while step < longest:
        far = chain.select((F.col("place") - step if forward else F.col("place") + step).alias("place"),
                           F.col("first").alias("far_first"), F.col(value).alias("far"))
        met = chain.join(far, "place", "left")
        near = F.col("far_first") == F.col("first")
        chain = staged(met.withColumn(value, F.when(near, join(F.col(value), F.col("far"))).otherwise(F.col(value)))
                       .drop("far", "far_first"), f"chain-{value}")
        step *= 2
    return chain


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[walk(codes, tuple(end), s, False)[1] for s in STATES]
                 for codes, end in zip(batch.column("codes").to_pylist(), batch.column("end").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("place", "first", "last", "end")),
                                          pa.array(found, pa.list_(pa.int32()))], ["place", "first", "last", "end", "exits"])


def ends_and_states(codes: DataFrame, longest: int) -> DataFrame:
    """(place, end, state): costs after and state before each piece of ``codes`` (place, first, last, codes, matrix)."""
    final = F.array(*(F.lit(c).cast("long") for c in FINAL))
    chain = _doubled(codes.select("place", "first", "last", "matrix"), "matrix", longest, times, True)
    nxt = chain.select((F.col("place") - 1).alias("place"), F.col("first").alias("far_first"), times(F.col("matrix"), final).alias("after"))
    ends = codes.select("place", "first", "last", "codes").join(nxt, "place", "left").select(
        "place", "first", "last", "codes", F.when(F.col("far_first") == F.col("first"), F.col("after")).otherwise(final).alias("end"))
    exits = staged(ends.mapInArrow(_exits, "place long, first long, last long, end array<long>, exits array<int>"), "exits")
    maps = _doubled(exits, "exits", longest, lambda here, before: F.transform(before, lambda s: F.get(here, s)), False)
    entered = maps.select((F.col("place") + 1).alias("place"), F.col("first").alias("far_first"), F.get("exits", F.lit(0)).alias("came"))
    return exits.join(entered, "place", "left").select(
        "place", "end", F.when(F.col("far_first") == F.col("first"), F.col("came")).otherwise(0).alias("state"))


EDITS = "conv_id long, place long, at int, edit string, fault string, turn long, was string, role string, text string"


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 2, pa.int64(), *[pa.string()] * 3]
    names = [f.split()[0] for f in EDITS.split(", ")]
    for batch in smaller(batches, 16):
        rows = []
        for piece in batch.to_pylist():
            state = piece["state"]
            letters, _ = walk(piece["codes"], tuple(piece["end"]), state, piece["place"] == piece["last"])
            given = zip(piece["turns"], piece["roles"], piece["texts"], piece["faults"])
            for at, letter in enumerate(letters):
                turn, was, text, fault = (None, None, "", None) if letter == "I" else next(given)
                role = None if letter == "D" else was if letter == "K" else TURN[state]
                if role:
                    state = STEPS[state][role[0]]
                rows.append((piece["conv_id"], piece["place"], at, letter, fault, turn, was, role, text))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 9, kinds)], names)


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per edit (``EDITS``); those that are not ``D``, by ``place`` and ``at``, are the repaired conversation.

    ``rows`` has conv_id, turn, role and text, strings not null (``read_rows``).
    ``was`` is the role before; ``role`` is null for deleted rows.
    """
    found = cut(rows, piece_rows)
    spans = found.filter("open").groupBy("conv_id").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    spans = staged(spans, "spans")
    longest = spans.agg(F.max(F.col("last") - F.col("first") + 1).alias("n")).first()["n"] or 0
    final = F.array(*(F.lit(c).cast("long") for c in FINAL))
    columns = ["conv_id", "place", "last", "codes", "turns", "roles", "texts", "faults", "end", "state"]
    alone = found.select("*", F.col("place").alias("last"), final.alias("end"), F.lit(0).alias("state"))
    if not longest:
        return alone.select(*columns).mapInArrow(_edit, EDITS)
    alone = alone.filter("NOT open").unionByName(
        alone.filter("open").join(spans.select(F.col("conv_id").alias("c")), F.col("conv_id").eqNullSafe(F.col("c")), "left_anti"))
    chained = found.filter("open").join(spans.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    marks = chained.select("place", "first", "last", "codes", "faults").join(repeated_later(chained), "place", "left")
    mended = staged(marks.select("place", "codes", "faults", "later").mapInArrow(
        _mend, "place long, codes binary, faults array<string>, matrix array<long>"), "mended")
    codes = mended.join(chained.select("place", "first", "last"), "place")
    solved = ends_and_states(codes, longest)
    whole = (chained.drop("codes", "faults").join(mended.select("place", "codes", "faults"), "place").join(solved, "place"))
    return alone.select(*columns).unionByName(whole.select(*columns)).mapInArrow(_edit, EDITS)


DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
PRICE = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted edits to a row per conversation, a row in memory at a time."""
    def rows() -> Iterator[tuple]:
        for batch in smaller(batches):
            yield from zip(*(c.to_pylist() for c in batch.columns))

    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    names = [f.split()[0] for f in DIGEST.split(", ")]
    done: list[tuple] = []
    chars = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    for conv, edits in groupby(rows(), key=lambda r: r[0]):
        counts = {BLANK: 0, REPEATED: 0, CUT: 0, FINE: 0, None: 0}
        sha, audit, between = hashlib.sha256(), [], ""
        low = turn_before = None
        turns = illegal = cost = 0
        before = None
        for _, edit, fault, turn, was, role, text in edits:
            counts[fault] += 1
            audit.append(edit)
            cost += PRICE[edit] + (TRUNCATED if fault == CUT and edit != "D" else 0)
            if edit != "I":
                illegal += before is not None and before + was[:1] not in ("su", "ua", "au")
                before = was[:1]
                if turn is not None:
                    low = turn if low is None else low
                    turns += turn != turn_before
                    turn_before = turn
            if edit != "D":
                sha.update(f"{between}{role}:{text}".encode())
                between = "\n"
        gaps = 0 if low is None else min(turn_before - low + 1 - turns, MOST)
        done.append((conv, gaps, counts[BLANK], counts[REPEATED], counts[CUT], illegal, cost, "".join(audit), sha.hexdigest()))
        chars += len(audit)
        if len(done) == 1000 or chars > PIECE_CHARS:
            yield flush()
            done, chars = [], 0
    if done:
        yield flush()


def digest(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``DIGEST`` of every conversation of ``rows`` (before any damage).

    One SHA-256 and one audit string per conversation are sequential by nature:
    a conversation's edits stream through one task, whose memory holds its audit alone.
    """
    text = F.when(F.col("edit") != "D", F.col("text")).alias("text")
    ordered = edits.select("conv_id", "place", "at", "edit", "fault", "turn", "was", "role", text).repartition("conv_id").sortWithinPartitions(
        "conv_id", "place", "at")
    found = ordered.drop("place", "at").mapInArrow(_digest, DIGEST).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
