"""Repair of damaged conversations by cheapest edits, after Hirschberg.

The rows of a conversation, by turn, are edited until their role initials read
``(s?(ua)+)?``.  Keep costs 0, Rerole (to the role that fits) 1, Delete 2 and
Insert (an empty text of the role that fits) 5; blank and duplicate rows must
go, and a truncated row that stays costs 5 more.  Of the cheapest edits those
whose initials are ASCII-least are taken.

What the rows so far read as is one of four states: nothing, ``s``, ``...u``,
``...a``.  A stretch of rows is cut in its middle; the four costs to come to the
middle and the four to go on from it are added, and of the optimal crossings
the one with the least audit behind it is chosen.  Audits that end in different
states with the same row differ before either ends, so their order is a rank
that is carried along with the costs; no audit is ever kept while rows are
counted.  The halves are then solved alike: space is linear in the rows.

A conversation of up to ``SEGMENT`` rows is solved in one task, with the others
of its hash partition one after the other.  A longer one is sorted over many
tasks and cut into segments.  Each segment gives its costs between all states;
from these, one row per segment, the crossings at the cuts are chosen the same
way, and then every segment is solved on its own.

Cases: null roles and texts are one space each (a blank text; a role of no use
to the grammar); null turns come first; rows of equal turn go by role and then
text, as bytes; a null conversation id is a conversation; an empty table gives
no rows; other columns are not read.  A report holds the audit and the digest
of the repaired text as single values, so the last step of a very long
conversation reads its edits one after the other in one task, in small batches.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import map_arrow, slices, stored

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Rows of a conversation, or of a piece of one, that one task holds.
SEGMENT = 4096
#: Conversations longer than that are broadcast by id up to this number.
BROADCAST_ROWS = 50_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = (b"user", b"user", b"assistant", b"user")
#: initial of a kept row (s, u, a) -> state, by state
KEPT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
LEGAL = {(0, 1), (1, 2), (2, 1)}
FAR = 1 << 60


def _moves(kind: int) -> list[tuple[int, int, int, str]]:
    """(state, state behind the row, cost, edits) of a row of a kind: its
    initial (0 s, 1 u, 2 a, 3 other), +4 if truncated, 8 if it must go."""
    best: dict = {}
    for state in range(4):
        at, before, paid = state, "", 0
        for _ in range(3):
            options = [(at, DELETE, "D")]
            if kind < 8:
                more = CUT_OFF if kind & 4 else 0
                options.append((NEXT[at], REROLE + more, "R"))
                if kind & 3 in KEPT[at]:
                    options.append((KEPT[at][kind & 3], KEEP + more, "K"))
            for to, cost, edit in options:
                new = (paid + cost, before + edit)
                best[state, to] = min(best.get((state, to), new), new)
            at, before, paid = NEXT[at], before + "I", paid + INSERT
    return [(a, b, cost, edits) for (a, b), (cost, edits) in best.items()]


MOVES = [_moves(k) for k in range(9)]
EDITS = [{(a, b): e for a, b, _, e in m} for m in MOVES]
#: From a state to the end: cost and edits.
END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def forward(kinds, lo: int, hi: int, state: int) -> tuple[list[int], list[int]]:
    """Costs to each state behind the row hi - 1, from ``state`` before the row
    lo, and the ranks of the least audits that come to it at that cost."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[state] = 0
    for i in range(lo, hi):
        new: list = [None] * 4
        for a, b, c, edits in MOVES[kinds[i]]:
            if cost[a] < FAR:
                option = (cost[a] + c, rank[a], edits)
                if new[b] is None or option < new[b]:
                    new[b] = option
        cost = [FAR if x is None else x[0] for x in new]
        order = sorted((x[1], x[2], b) for b, x in enumerate(new) if x is not None)
        rank = [0] * 4
        for r, (_, _, b) in enumerate(order):
            rank[b] = r
    return cost, rank


def backward(kinds, lo: int, hi: int, state: int) -> list[int]:
    """Costs from each state before the row lo to ``state`` behind row hi - 1."""
    cost = [FAR] * 4
    cost[state] = 0
    for i in range(hi - 1, lo - 1, -1):
        new = [FAR] * 4
        for a, b, c, _ in MOVES[kinds[i]]:
            new[a] = min(new[a], c + cost[b])
        cost = new
    return cost


def crossing(cost: list[int], rank: list[int], rest: list[int]) -> int:
    """Of the states of least total cost, the one of least audit."""
    return min((cost[s] + rest[s], rank[s], s) for s in range(4) if cost[s] < FAR)[2]


def audit(kinds, state: int = NOTHING, to: int | None = None) -> str:
    """The cheapest, then least edits over rows of ``kinds`` between two
    states; without ``to``, up to the conversation's end."""
    if not len(kinds):
        return END[state][1] if to is None else ""
    tail = ""
    if to is None:
        cost, rank = forward(kinds, 0, len(kinds), state)
        to = crossing(cost, rank, [c for c, _ in END])
        tail = END[to][1]
    out, todo = [], [(0, len(kinds), state, to)]
    while todo:
        lo, hi, a, b = todo.pop()
        if hi - lo == 1:
            out.append(EDITS[kinds[lo]][a, b])
            continue
        mid = (lo + hi) // 2
        c = crossing(*forward(kinds, lo, mid, a), backward(kinds, mid, hi, b))
        todo += [(mid, hi, c, b), (lo, mid, a, c)]
    return "".join(out) + tail


def edited(edits: str, rows, state: int):
    """(edit, role, text) of each edit, over rows (kind, role, text); role and
    text are None where the row goes."""
    rows = iter(rows)
    for e in edits:
        kind, role, text = next(rows) if e != "I" else (0, None, b"")
        if e == "D":
            yield e, None, None
            continue
        if e == "K":
            state = KEPT[state][kind & 3]
        else:
            role, state = ROLE[state], NEXT[state]
        yield e, role, text


def total_cost(edits: str, kinds) -> int:
    price = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
    stays = (e for e in edits if e != "I")
    return sum(price[e] for e in edits) + sum(CUT_OFF for e, k in zip(stays, kinds) if e != "D" and k & 4)


def with_rows(rows: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv_id, turn, role and text (bytes), initial, blank, truncated."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    first = F.substring(role, 1, 1)
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.cast("binary").alias("role"), text.cast("binary").alias("text"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))


def _groups(batches, keys: int):
    """Batches sorted by their first ``keys`` columns -> lists of the rows of
    equal keys."""
    held: list[tuple] = []
    for b in slices(batches):
        for r in zip(*[c.to_pylist() for c in b.columns]):
            if held and r[:keys] != held[0][:keys]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
TURN = "part int, segment bigint, place bigint, edit string, role binary, text binary"


def _faults(blank: bool, duplicate: bool, truncated: bool, initial: int) -> tuple[int, int]:
    """0 blank, 1 duplicate, 2 truncated, 3 none; and the row's kind."""
    fault = 0 if blank else 1 if duplicate else 2 if truncated else 3
    return fault, 8 if fault < 2 else initial + 4 * (fault == 2)


def _illegal(initials) -> int:
    return sum(p not in LEGAL for p in zip(initials, initials[1:]))


def _batched(rows, schema, size=256):
    rows, names = iter(rows), schema.names
    while True:
        cols = list(zip(*[r for _, r in zip(range(size), rows)]))
        if not cols:
            return
        yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(cols, names)], schema=schema)


def _short(batches, schema, report):
    """Whole conversations (conv_id, turn, role, text, initial, blank, truncated)."""
    def solved():
        for rows in _groups(batches, 1):
            seen, faults, kinds = set(), [0] * 4, bytearray()
            for _, _, role, text, initial, blank, truncated in rows:
                fault, kind = _faults(blank, (role, text) in seen, truncated, initial)
                seen.add((role, text))
                faults[fault] += 1
                kinds.append(kind)
            edits = audit(kinds)
            turns = edited(edits, ((k, r[2], r[3]) for k, r in zip(kinds, rows)), NOTHING)
            if not report:
                yield from ((rows[0][0], 0, 0, i, *t) for i, t in enumerate(turns))
                continue
            numbers = [r[1] for r in rows if r[1] is not None]
            gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
            digest = hashlib.sha256(b"\n".join(role + b":" + text for _, role, text in turns if role is not None))
            yield rows[0][0], gaps, *faults[:3], _illegal([r[4] for r in rows]), total_cost(edits, kinds), edits, digest.hexdigest()
    yield from _batched(solved(), schema)


def _numbered(batches, schema, segment):
    """Sorted rows of a range partition -> with part, segment and place."""
    part, last, at = TaskContext.get().partitionId(), (), 0
    for b in slices(batches):
        places, segments = [], []
        for c in b.column("conv_id").to_pylist():
            at = at + 1 if last == (c,) else 0
            last = (c,)
            places.append(at)
            segments.append(at // segment)
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int32()), pa.array(segments, pa.int64()),
                                          pa.array(places, pa.int64())], schema=schema)


def _summaries(batches, schema):
    """(conv_id, part, segment, place, initial, kind, fault) -> one row per
    segment: costs and ranks between all states, counts, first and last initial."""
    def summed():
        for rows in _groups(batches, 3):
            kinds = bytes(r[5] for r in rows)
            both = [forward(kinds, 0, len(kinds), s) for s in range(4)]
            count = [sum(r[6] == f for r in rows) for f in range(3)]
            initials = [r[4] for r in rows]
            yield *rows[0][:3], sum((c for c, _ in both), []), sum((r for _, r in both), []), *count, _illegal(initials), initials[0], initials[-1]
    yield from _batched(summed(), schema)


def _crossings(batches, schema):
    """The segments of a conversation -> each with the states at its ends (the
    last one's end is null), and the conversation's totals."""
    def chosen():
        for rows in _groups(batches, 1):
            rest = [[c for c, _ in END]]
            for r in reversed(rows):
                rest.append([min(r[3][4 * a + b] + rest[-1][b] for b in range(4)) for a in range(4)])
            rest.reverse()
            totals = [sum(r[i] for r in rows) for i in (5, 6, 7, 8)]
            totals[3] += sum((x[10], y[9]) not in LEGAL for x, y in zip(rows, rows[1:]))
            state = NOTHING
            for i, r in enumerate(rows):
                to = crossing(r[3][4 * state:4 * state + 4], r[4][4 * state:4 * state + 4], rest[i + 1])
                yield *r[:3], state, None if i + 1 == len(rows) else to, *totals, rest[0][NOTHING]
                state = to
    yield from _batched(chosen(), schema)


def _solved(batches, schema):
    """(conv_id, part, segment, place, role, text, kind, state, to) -> edits."""
    def turns():
        for rows in _groups(batches, 3):
            state, to = rows[0][7], rows[0][8]
            edits = audit(bytes(r[6] for r in rows), state, to)
            for i, t in enumerate(edited(edits, ((r[6], r[4], r[5]) for r in rows), state)):
                yield *rows[0][:3], i, *t
    yield from _batched(turns(), schema)


def _digests(batches, schema):
    """The edits of whole conversations, in order -> audit and digest."""
    def read():
        last, edits, digest, some = None, [], hashlib.sha256(), False
        for b in slices(batches):
            for conv, edit, role, text in zip(*[b.column(n).to_pylist() for n in ("conv_id", "edit", "role", "text")]):
                if last != (conv,):
                    if last:
                        yield last[0], "".join(edits), digest.hexdigest()
                    last, edits, digest, some = (conv,), [], hashlib.sha256(), False
                edits.append(edit)
                if role is not None:
                    digest.update((b"\n" if some else b"") + role + b":")
                    digest.update(text)
                    some = True
        if last:
            yield last[0], "".join(edits), digest.hexdigest()
    yield from _batched(read(), schema)


def _mapped(rows: DataFrame, fn, fields: str) -> DataFrame:
    """``rows`` through ``fn(batches, schema)``, to conv_id and ``fields``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)
    return map_arrow(rows, lambda it: fn(it, arrow), schema)


def _whole(rows: DataFrame, report: bool) -> DataFrame:
    sort = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*sort)
    return _mapped(dealt, lambda it, schema: _short(it, schema, report), REPORT if report else TURN)


def _cut(rows: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """The edits of long conversations, and their segments with the totals."""
    sort = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    # rows alike in everything may lie in several parts too
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = rows.repartitionByRange(*sort, "row").sortWithinPartitions(*sort, "row").drop("row")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in order.schema.fields[1:])
    order = stored(_mapped(order, lambda it, schema: _numbered(it, schema, segment),
                           fields + ", part int, segment bigint, place bigint"), "ordered")
    digest = F.sha2("text", 256).alias("digest")
    # both sides of this join are plain tables, so a hot key is split
    repeats = stored(order.select("conv_id", "role", digest, "part", "place")
                     .groupBy("conv_id", "role", "digest").agg(F.min(F.struct("part", "place")).alias("first"), F.count("*").alias("n"))
                     .where("n > 1").drop("n"), "repeats").alias("r")
    o = order.select("*", digest).alias("o")
    on = F.col("o.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("o.role") == F.col("r.role")) & (F.col("o.digest") == F.col("r.digest"))
    own = F.struct("o.part", "o.place")
    fault = F.when(F.col("o.blank"), 0).when(F.col("r.first").isNotNull() & (own != F.col("r.first")), 1) \
        .when(F.col("o.truncated"), 2).otherwise(3)
    flagged = stored(o.join(repeats, on, "left").select(*[f"o.{c}" for c in order.columns], fault.alias("fault"))
                     .withColumn("kind", F.expr("IF(fault < 2, 8, initial + IF(fault = 2, 4, 0))")), "flagged")
    by = ["conv_id", "part", "segment"]
    narrow = flagged.select(*by, "place", "initial", "kind", "fault").repartition(*by).sortWithinPartitions(*by, "place")
    summed = _mapped(narrow, _summaries, "part int, segment bigint, costs array<bigint>, ranks array<int>, blank bigint, "
                     "duplicate bigint, truncated bigint, illegal bigint, first int, last int")
    joints = stored(_mapped(summed.repartition("conv_id").sortWithinPartitions(*by), _crossings,
                            "part int, segment bigint, state int, to int, blank bigint, duplicate bigint, truncated bigint, "
                            "illegal bigint, cost bigint"), "segments")
    j = joints.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("segment").alias("s"), "state", "to")
    pieces = flagged.join(j, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("segment") == F.col("s"))) \
        .select(*by, "place", "role", "text", "kind", "state", "to").repartition(*by).sortWithinPartitions(*by, "place")
    return stored(_mapped(pieces, _solved, TURN), "edits"), joints


def _split(rows: DataFrame, segment: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations of at most ``segment`` rows, and the others."""
    many = stored(rows.groupBy("conv_id").count().where(F.col("count") > segment)
                  .select(F.col("conv_id").alias("long_id"), F.lit(True).alias("is_long")), "long")
    n = many.count()
    if not n:
        return rows, None
    marked = rows.join(F.broadcast(many) if n <= BROADCAST_ROWS else many, F.col("conv_id").eqNullSafe(F.col("long_id")), "left")
    return marked.where("is_long IS NULL").select(rows.columns), marked.where("is_long").select(rows.columns)


def repair_report(rows: DataFrame, segment: int = SEGMENT, **columns) -> DataFrame:
    """One row per conversation: conv_id, gaps (numbers missing between the
    least and the greatest turn), blank, duplicate, truncated (rows by their
    first fault), illegal (neighbours whose initials are not su, ua or au), cost
    and audit of the edits, and the SHA-256 of the repaired ``role:text`` lines."""
    whole, long = _split(with_rows(rows, **columns), segment)
    out = _whole(whole, True)
    if long is None:
        return out
    edits, joints = _cut(long, segment)
    read = _mapped(edits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment", "place"), _digests,
                   "audit string, repaired_sha256 string").withColumnRenamed("conv_id", "c")
    gaps = long.groupBy(F.col("conv_id").alias("g")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    totals = joints.select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost").distinct()
    return out.unionByName(totals.join(read, F.col("conv_id").eqNullSafe(F.col("c"))).join(gaps, F.col("conv_id").eqNullSafe(F.col("g")))
                           .select(out.columns))


def repaired_turns(rows: DataFrame, segment: int = SEGMENT, **columns) -> DataFrame:
    """One row per edit: conv_id; part, segment and place, in whose order the
    conversation reads; edit (K, R, D or I); role and text of the repaired
    turn, null where a row was deleted."""
    whole, long = _split(with_rows(rows, **columns), segment)
    out = _whole(whole, False)
    if long is not None:
        out = out.unionByName(_cut(long, segment)[0])
    return out.withColumns({"role": F.col("role").cast("string"), "text": F.col("text").cast("string")})
