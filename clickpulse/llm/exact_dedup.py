"""Exact duplicates by Grace hashing: records are partitioned to spill files
until each bucket fits an open-addressing table that compares whole texts.

1. A task reads its share of the documents through a table of bounded size and
   writes, to the shared folder, one *part* per distinct text that it holds (the
   text, deflated, its count and the row that stays) and one narrow row per
   document that names its part.  A part closes after ``MEMBERS`` documents, and
   all parts close when the table is full, so neither copies nor memory pile up.
2. Parts are dealt to buckets by hash and each bucket goes through one table.
   A table that is full takes no new text: parts of texts that it does not hold
   are spilled, and the spilled ones are dealt out again by another hash, until
   nothing is spilled.  The first text of a bucket always fits, so every level
   ends some, and all parts of a text end in the same table.
3. A text of more than ``FAN`` parts (copies in very many tasks) is first
   merged under salts, ``FAN`` parts at a time.
4. Documents meet their part's answer in a join on the part, of at most
   ``MEMBERS`` documents each: no group passes through one task.

Cases: null texts count as empty, and empty texts are equal to each other; a
text of any length is compared whole, as its bytes (invalid UTF-8 too).  Of
equal texts the row of largest id stays, null ids are least, and of rows equal
in id and text exactly one stays; an empty table gives no rows; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import free_name, map_arrow, slices, small_batches, stored

#: Bytes that a table holds: texts, and ``OVERHEAD`` for each of them.
TABLE_BYTES = 32 << 20
OVERHEAD = 256
#: Documents of a part, and parts of a text that meet in one task.
MEMBERS = 1 << 16
FAN = 1 << 10
#: Deflated texts need no second compression nor a dictionary, and small pages
#: need no large buffers.
PACKED = {"compression": "uncompressed", "parquet.page.size": 1 << 17, "parquet.enable.dictionary#packed": False}
#: Buckets that a task takes, one after the other, and answers in one file.
TASK_BUCKETS = 4
#: Answers of a bucket that go out in one batch, whatever texts they are of.
ANSWERS = 1 << 12
#: Hashes of texts in very many parts are broadcast up to this number of rows.
BROADCAST_ROWS = 50_000


class ContentTable:
    """Open addressing with linear probing.  A slot holds the number of an
    entry; equal entries have equal hash and equal content."""

    def __init__(self):
        self.hashes, self.texts = array("q"), []
        self.slots, self.mask, self.bytes = array("q", [-1]) * 1024, 1023, 0

    def find(self, h: int, raw: bytes) -> int:
        """The entry of ``raw``, or -1 - slot where it belongs."""
        slots, at = self.slots, h & self.mask
        while (e := slots[at]) >= 0:
            if self.hashes[e] == h and self.texts[e] == raw:
                return e
            at = (at + 1) & self.mask
        return -1 - at

    def add(self, slot: int, h: int, raw: bytes) -> int:
        e = len(self.texts)
        self.slots[slot] = e
        self.hashes.append(h)
        self.texts.append(raw)
        self.bytes += len(raw) + OVERHEAD
        if 2 * e > self.mask:
            self._grow()
        return e

    def _grow(self):
        self.mask = 2 * self.mask + 1
        slots = self.slots = array("q", [-1]) * (self.mask + 1)
        for e, h in enumerate(self.hashes):
            at = h & self.mask
            while slots[at] >= 0:
                at = (at + 1) & self.mask
            slots[at] = e


def _best(a: tuple, b: tuple) -> tuple:
    """The row that stays of two (id, row): largest id, null least."""
    return max(a, b, key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1]))


_PART = ["part", "keep_id", "keep_row", "n", "bytes", "h", "packed"]


def _fields(id_type) -> list:
    kinds = [T.LongType(), id_type, T.LongType(), T.LongType(), T.LongType(), T.LongType(), T.BinaryType()]
    return [T.StructField(n, k) for n, k in zip(_PART, kinds)]


def _merge(batches, table_bytes, members, schema, fresh):
    """Records -> a row (id, row, part) for each, and the parts.  ``fresh``:
    the records are documents (id, h, raw); else they are parts already."""
    table, parts = ContentTable(), []
    seq = (TaskContext.get().partitionId() << 33) if TaskContext.get() else 0

    def closed(entries):
        cols = zip(*[(p[0], p[1][0], p[1][1], p[2], len(raw) + OVERHEAD, h, zlib.compress(raw, 1)) for p, h, raw in entries])
        cols = list(map(list, cols)) or [[]] * 7
        none = [None] * len(cols[0])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([none, none, *cols], schema)], schema=schema)

    def all_parts():
        for i in range(0, len(parts), 256):
            yield closed([(parts[e], table.hashes[e], table.texts[e]) for e in range(i, min(i + 256, len(parts)))])

    for b in slices(batches):
        ids, rows, own = [], [], []
        cols = [b.column(n).to_pylist() for n in (("id", "h", "raw") if fresh else _PART)]
        for rec in zip(*cols):
            if fresh:
                (i, h, raw), row, n = rec, seq, 1
                seq += 1
                keep = (i, row)
            else:
                row, k, r, n, _, h, packed = rec
                i, keep, raw = None, (k, r), zlib.decompress(packed)
            e = table.find(h, raw)
            if e < 0:
                if table.bytes + len(raw) > table_bytes and parts:
                    yield from all_parts()
                    table, parts = ContentTable(), []
                    e = table.find(h, raw)
                e = table.add(-1 - e, h, raw)
                parts.append([row, keep, n, 1])
            elif parts[e][3] >= members:
                yield closed([(parts[e], h, raw)])
                parts[e] = [row, keep, n, 1]
            else:
                p = parts[e]
                p[1], p[2], p[3] = _best(p[1], keep), p[2] + n, p[3] + 1
            ids.append(i)
            rows.append(row)
            own.append(parts[e][0])
        none = [[None] * len(ids)] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([ids, rows, own, *none], schema)], schema=schema)
    yield from all_parts()


def _solve(batches, table_bytes, schema):
    """The parts of a bucket -> for each the answer of its text, or the part
    itself where the table was full before the text came."""
    table, best = ContentTable(), []
    for b in slices(batches):
        spilled = []
        for at, (part, k, r, n, _, h, packed) in enumerate(zip(*[b.column(c).to_pylist() for c in _PART])):
            raw = zlib.decompress(packed)
            e = table.find(h, raw)
            if e < 0 and table.bytes + len(raw) > table_bytes and best:
                spilled.append(at)
                continue
            if e < 0:
                table.add(-1 - e, h, raw)
                best.append([(k, r), n, array("q", [part])])
            else:
                x = best[e]
                x[0], x[1] = _best(x[0], (k, r)), x[1] + n
                x[2].append(part)
        if spilled:
            rest = b.take(pa.array(spilled))
            yield pa.RecordBatch.from_arrays(
                [*[rest.column(c).cast(schema.field(c).type) for c in _PART], pa.nulls(len(spilled), pa.binary())], schema=schema)

    def answers():
        for raw, ((k, r), n, own) in zip(table.texts, best):
            sha = hashlib.sha256(raw).digest()
            for part in own:
                yield part, k, r, n, None, None, None, sha

    rows = answers()
    while some := list(itertools.islice(rows, ANSWERS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _computed(df: DataFrame, fn, schema: T.StructType, name: str, files: int | None = None) -> DataFrame:
    with small_batches(df.sparkSession):
        return stored(map_arrow(df, fn, schema), name, files, PACKED)


def _merged(rows: DataFrame, id_type, table_bytes: int, members: int, fresh: bool) -> tuple[DataFrame, DataFrame]:
    """(id, row, part) of every record, and the parts; one written table."""
    schema = T.StructType([T.StructField("id", id_type), T.StructField("row", T.LongType()), *_fields(id_type)])
    arrow = _arrow(schema)
    out = _computed(rows, lambda it: _merge(it, table_bytes, members, arrow, fresh), schema, "parts")
    return out.where("row IS NOT NULL").select("id", "row", "part"), out.where("h IS NOT NULL").select(_PART)


def _thinned(parts: DataFrame, id_type, table_bytes: int, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """``parts`` with at most ``fan`` of each text, and per round the links
    (row -> part) from parts that are merged."""
    rounds = []
    while True:
        hot = stored(parts.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > fan)
                     .select(F.col("h").alias("hot_h"), F.ceil(F.col("c") / fan).alias("salts")), "hot")
        n = hot.count()
        if not n:
            return parts, rounds
        marked = parts.join(F.broadcast(hot) if n <= BROADCAST_ROWS else hot, F.col("h") == F.col("hot_h"), "left")
        salted = marked.where("salts IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("part"), "salts"))
        links, merged = _merged(salted.repartition("h", "salt").sortWithinPartitions("h", "salt").select(_PART), id_type, table_bytes, fan, False)
        rounds.append(links.where("row <> part"))
        parts = marked.where("salts IS NULL").select(_PART).unionByName(merged)


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES,
                 members: int = MEMBERS, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, keep_id (of the row that stays),
    group_size, kept and text_sha256 (lowercase hex)."""
    if fan < 2:
        raise ValueError("a merge takes two parts at least")
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("raw")) \
        .select("id", F.xxhash64("raw").alias("h"), "raw")
    id_type = rows.schema["id"].dataType
    documents, parts = _merged(rows, id_type, table_bytes, members, True)
    parts, rounds = _thinned(parts, id_type, table_bytes, fan)
    schema = T.StructType([*_fields(id_type), T.StructField("sha", T.BinaryType())])
    arrow, level, answers = _arrow(schema), 0, None
    while True:
        total = parts.agg(F.sum("bytes")).first()[0]
        if not total:
            break
        cores = docs.sparkSession.sparkContext.defaultParallelism
        buckets = max(math.ceil(2 * total / table_bytes), cores)
        dealt = parts.repartition(buckets, F.xxhash64("h", F.lit(level)))
        out = _computed(dealt, lambda it: _solve(it, table_bytes, arrow), schema, "buckets", max(buckets // TASK_BUCKETS, cores))
        found = out.where("h IS NULL").select("part", "keep_id", "keep_row", "n", "sha")
        answers = found if answers is None else answers.unionByName(found)
        parts, level = out.where("h IS NOT NULL").select(_PART), level + 1
    if answers is None:
        return documents.select(F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                                F.lit(True).alias("kept"), F.lit("").alias("text_sha256"))
    for links in reversed(rounds):
        answers = answers.unionByName(links.select(F.col("row").alias("child"), "part").join(answers, "part")
                                      .drop("part").withColumnRenamed("child", "part"))
    return documents.join(answers, "part").select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Of rows equal
    in id and text any one stays."""
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")), 256)
    own, kept_id, kept_sha = (free_name(docs, n) for n in ("own_sha", "kept_id", "kept_sha"))
    keep = exact_copies(docs, id_col, text_col, **options).where("kept") \
        .select(F.col("keep_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    return docs.withColumn(own, digest) \
        .join(keep, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_sha)), "left_semi") \
        .dropDuplicates([id_col, own]).drop(own)
