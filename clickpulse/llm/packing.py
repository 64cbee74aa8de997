"""Cost-balanced packing of documents into token sequences.

Every document becomes its token ids and one end id.  A sequence costs
``linear * n + quadratic * n**2`` for each piece of ``n`` tokens in it (the
quadratic part is attention within the piece).  Documents are taken by
descending cost, and each goes to the sequence of lowest cost that still has
room for it.

Documents are packed in groups of about ``GROUP_TOKENS`` tokens, as they lie in
their partition, so a task holds one group at a time.  A group of T tokens gets
T // capacity full sequences; where no sequence has room for a whole piece, the
piece is cut.  What is left of all groups (fewer tokens than one sequence of
each) is shuffled into groups of the same size, whatever number of partitions
it came from, and only these end in sequences whose sizes are powers of two:
the capacities add up to the tokens, so no token of padding is needed.

Cases: null and empty texts hold the end id only; repeated rows are packed as
often as they occur; ties go to the smaller position in the partition, then
to the smaller sequence number; an empty table gives no rows; columns other
than the id and the text are not read; bytes that are no UTF-8 count as U+FFFD.
"""

from __future__ import annotations

import zlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import map_arrow, slices, stored, texts_of
from clickpulse.llm.encoders import encoder

CAPACITY = 1024
GROUP_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def capacities(tokens: int, capacity: int) -> list[int]:
    """Sequence sizes that add up to ``tokens``: full ones, then powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class _Room:
    """Sequences by room left; finds the cheapest with at least some room."""

    def __init__(self, sizes: list[int], capacity: int, first: int = 0):
        """``first``: sequences before it are full already."""
        self.n = 1 << capacity.bit_length()
        self.heaps: list[list] = [[] for _ in range(self.n)]
        self.best: list = [None] * (2 * self.n)
        for seq, size in enumerate(sizes[first:], first):
            heappush(self.heaps[size], (0.0, seq))
        for r, h in enumerate(self.heaps):
            self.best[self.n + r] = (*h[0], r) if h else None
        for i in range(self.n - 1, 0, -1):
            self.best[i] = self._less(self.best[2 * i], self.best[2 * i + 1])

    @staticmethod
    def _less(a, b):
        return b if a is None or (b is not None and b < a) else a

    def cheapest(self, least: int):
        """(cost, sequence, room) of lowest cost with room >= ``least``."""
        out, lo, hi = None, least + self.n, 2 * self.n
        while lo < hi:
            if lo & 1:
                out = self._less(out, self.best[lo])
                lo += 1
            if hi & 1:
                hi -= 1
                out = self._less(out, self.best[hi])
            lo >>= 1
            hi >>= 1
        return out

    def put(self, found: tuple, used: int, cost: float) -> None:
        """``used`` tokens go into ``found``, which costs ``cost`` more."""
        before, seq, room = found
        heappop(self.heaps[room])
        heappush(self.heaps[room - used], (before + cost, seq))
        for r in (room, room - used):
            h, i = self.heaps[r], r + self.n
            self.best[i] = (*h[0], r) if h else None
            while i > 1:
                i >>= 1
                self.best[i] = self._less(self.best[2 * i], self.best[2 * i + 1])


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC,
         ends: bool = True) -> list[tuple[int, int, int, int, int]]:
    """(document index, start, length, sequence, offset) of every piece.
    Without ``ends`` there are full sequences only, and what they have no room
    for comes last, in pieces of sequence -1."""
    sizes = capacities(sum(lengths), capacity)
    if not ends:
        sizes = [s for s in sizes if s == capacity]
    todo = [(i, a, min(capacity, n - a)) for i, n in enumerate(lengths) for a in range(0, n, capacity)]
    todo.sort(key=lambda p: -p[2])  # stable; the cost grows with the length
    # pieces as long as a sequence come first and fill the first sequences
    whole = sum(p[2] == capacity for p in todo)
    out = [(doc, start, n, seq, 0) for seq, (doc, start, n) in enumerate(todo[:whole])]
    room = _Room(sizes, capacity, whole)
    for doc, start, n in todo[whole:]:
        while n:
            found = room.cheapest(n) or room.cheapest(1)
            if found is None:
                out.append((doc, start, n, -1, 0))
                break
            _, seq, left = found
            used = min(n, left)
            out.append((doc, start, used, seq, sizes[seq] - left))
            room.put(found, used, linear * used + quadratic * used * used)
            start, n = start + used, n - used
    return out


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
#: Sequences of what the groups had left are numbered from here.
_LEFT = 1 << 62


def _batch(id_type, rows: list[tuple], ids: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:]),
                                       pa.array(ids, pa.binary())], [*_NAMES, "ids"])


def pack_documents(docs: DataFrame, vocabulary: str, *, end_id: int = 0, capacity: int = CAPACITY,
                   linear: float = LINEAR, quadratic: float = QUADRATIC, id_col: str = "doc_id",
                   text_col: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: its document, place there, checksum of its ids
    (little-endian unsigned 32 bit) and place in its sequence."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def first_pass(batches):
        """Full sequences; what is left has no sequence, but its ids."""
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 32
        encode, end = encoder("byte", vocabulary), end_id.to_bytes(4, "little")
        keys: list = []
        raws: list[bytes] = []
        held, id_type = 0, None

        def packed():
            nonlocal base
            lengths = [len(r) // 4 for r in raws]
            rows, ids, top = [], [], base
            for doc, start, n, seq, offset in pack(lengths, capacity, linear, quadratic, False):
                raw = memoryview(raws[doc])[4 * start:4 * (start + n)]
                ids.append(None if seq >= 0 else bytes(raw))
                rows.append((keys[doc], start, n, zlib.crc32(raw), lengths[doc], base + seq if seq >= 0 else None, offset))
                top = max(top, base + seq + 1)
            base = top
            return _batch(id_type, rows, ids)

        for b in slices(batches):
            id_type = b.schema.field(0).type
            for key, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                raw = encode(text) + end
                keys.append(key)
                raws.append(raw)
                held += len(raw) // 4
                if held >= group_tokens:
                    yield packed()
                    keys.clear()
                    raws.clear()
                    held = 0
        if raws:
            yield packed()

    def second_pass(batches):
        """Pieces that are left, packed like documents, with ends."""
        from pyspark import TaskContext
        base = _LEFT + (TaskContext.get().partitionId() << 32)
        held: list[tuple] = []
        size, id_type = 0, None

        def packed():
            nonlocal base
            rows, top = [], base
            for k, start, n, seq, offset in pack([p[2] for p in held], capacity, linear, quadratic):
                key, at, _, _, total, _, _, ids = held[k]
                rows.append((key, at + start, n, zlib.crc32(memoryview(ids)[4 * start:4 * (start + n)]), total, base + seq, offset))
                top = max(top, base + seq + 1)
            base = top
            return _batch(id_type, rows, [None] * len(rows))

        for b in slices(batches):
            id_type = b.schema.field(0).type
            for piece in zip(*[c.to_pylist() for c in b.columns]):
                held.append(piece)
                size += piece[2]
                if size >= group_tokens:
                    yield packed()
                    held.clear()
                    size = 0
        if held:
            yield packed()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in _NAMES[1:]], T.StructField("ids", T.BinaryType())])
    pieces = stored(map_arrow(rows, first_pass, schema), "pieces")
    left = pieces.where("sequence_id IS NULL")
    tokens = left.agg(F.sum("length")).first()[0] or 0
    groups = left.repartition(max(1, -(-tokens // group_tokens)), F.xxhash64("ids", "start"))
    return pieces.where("sequence_id IS NOT NULL").unionByName(map_arrow(groups, second_pass, schema)).select(_NAMES)
