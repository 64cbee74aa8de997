"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints of 64 bits link at ``MAX_BITS`` = 4 or fewer differing bits.  Cut
into three segments, two such fingerprints have one segment that differs in
at most one bit.  So every fingerprint is indexed under each of its segments
with each one of the segment's bits left out (64 variants); fingerprints that
link share a variant.  Fingerprints of equal variant are verified in place.

Documents of equal fingerprint meet once, in a count by fingerprint, so only
distinct fingerprints are indexed.  A variant that very many of them share is
cut into blocks, and the task of each pair of blocks holds two blocks only.
A task writes a spanning forest of the links it has verified, never all pairs
of a group; the components over these are those over all links.

Cases: a text without words (null and empty too) has fingerprint zero and
links like any other; rows with a null id have a fingerprint, and a component
of null ids alone is null; repeated rows are one fingerprint; an empty table
gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import files_for, free_name, map_arrow, remove, slices, stored
from clickpulse.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints in a block of a variant that many share.
BLOCK = 16_384
#: A list of frequent segment values up to this size is broadcast (it holds
#: two longs a row); a longer one is joined by a shuffle.
BROADCAST_ROWS = 50_000
_CHUNK = 1 << 16


def fingerprint(raw: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's UTF-8 bytes (unsigned)."""
    from xxhash import xxh64_intdigest
    parts = raw.lower().split() if raw else ()
    if not parts:
        return 0
    text = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    n = len(parts) - k + 1
    pieces = map(text.__getitem__, map(slice, starts[:n].tolist(), ends[k - 1:].tolist()))
    h = np.fromiter(map(partial(xxh64_intdigest, seed=SEED), pieces), np.uint64, n)
    set_in = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        bits = np.unpackbits(h[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(set_in * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches, words):
    for b in slices(batches):
        fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                         [b.schema.field(0).name, "fp", *b.schema.names[2:]])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                 also: dict | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and the columns of ``also``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("raw"),
                       *[c.alias(n) for n, c in (also or {}).items()])
    schema = T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType()), *rows.schema.fields[2:]])
    return map_arrow(rows, lambda it: _fingerprints(it, words), schema)


def variants(fps: DataFrame) -> DataFrame:
    """``fps`` (fp) -> fp, key: 64 rows for each fingerprint."""
    bit = F.col("bit")
    first, mask = F.lit(0), F.lit(0)
    for at, n in SEGMENTS:
        first = F.when(bit >= at, at).otherwise(first)
        mask = F.when(bit >= at, (1 << n) - 1).otherwise(mask)
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")) \
        .withColumns({"at": first, "mask": mask}) \
        .selectExpr("fp", "bit", "shiftrightunsigned(fp, at) & mask AS value",
                    "shiftleft(1L, bit - at) AS hole") \
        .selectExpr("fp", "(value & ~hole) | shiftleft(CAST(bit AS BIGINT), 22) AS key")


def frequent(fps: DataFrame, block: int) -> DataFrame:
    """key, blocks: the variants that may hold more fingerprints than a block.
    Counted over the three segment values, not the 64 variants: a variant is
    the union of two values, so one with many has a frequent value."""
    segs = F.array(*[F.expr(f"(shiftrightunsigned(fp, {a}) & {(1 << n) - 1}L) + {a << 22}L") for a, n in SEGMENTS])
    many = fps.select(F.explode(segs).alias("seg")).groupBy("seg").count().where(F.col("count") > block // 2)
    keys = None
    for at, n in SEGMENTS:
        part = many.where(F.expr(f"shiftright(seg, 22) = {at}")).select(
            "count", F.expr(f"seg & {(1 << 22) - 1}L").alias("value"),
            F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")) \
            .selectExpr("count", f"(value & ~shiftleft(1L, i)) | shiftleft(CAST(i + {at} AS BIGINT), 22) AS key")
        keys = part if keys is None else keys.union(part)
    # one of the two values may be just below the bound and so not counted
    return keys.groupBy("key").agg(F.ceil((F.sum("count") + block // 2) / block).cast("int").alias("blocks"))


def forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that span the components of ``values`` (distinct, unsigned)."""
    out, rest = [], values
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found = rest[near]
                out.extend((int(at), int(x)) for x in found)
                todo.extend(found)
                rest = rest[~near]
    return out


def _links(batches, max_bits):
    """Batches sorted by group -> links (a, b) of each group's forest."""
    held = np.empty((3, 0), np.int64)

    def solve(rows: np.ndarray):
        a: list[int] = []
        b: list[int] = []
        new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        starts = np.concatenate(([0], new, [rows.shape[1]]))
        sizes = np.diff(starts)
        fp = rows[2].view(np.uint64)
        pair = starts[:-1][sizes == 2]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= max_bits]
        a.extend(rows[2][pair].tolist())
        b.extend(rows[2][pair + 1].tolist())
        for i in np.flatnonzero(sizes > 2):
            got = forest(np.unique(fp[starts[i]:starts[i + 1]]), max_bits)
            if got:
                x = np.array(got, np.uint64).view(np.int64)
                a.extend(x[:, 0].tolist())
                b.extend(x[:, 1].tolist())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        held = np.concatenate([held, rows], axis=1) if held.shape[1] else rows
        # the last group may go on in the next batch
        last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield solve(held[:, :cut])
            held = held[:, cut:]
    if held.shape[1]:
        yield solve(held)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, many: DataFrame | None = None) -> DataFrame:
    """Distinct ``fps`` (fp) -> (a, b) links whose components are those of all
    pairs at ``max_bits`` or fewer differing bits.  ``many``: the written
    ``frequent`` of the same fingerprints."""
    if max_bits >= 2 * len(SEGMENTS):
        raise ValueError("with three segments, at most 5 bits may differ")
    keyed = variants(fps)
    many = stored(frequent(fps, block), "frequent") if many is None else many
    n = many.count()
    group = [F.lit(0).cast("long").alias("pair")]
    if n:
        hot = keyed.join(F.broadcast(many) if n <= BROADCAST_ROWS else many, "key", "left") \
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")
        keyed = hot.withColumn("own", own) \
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
        group = [(F.least("own", "other") * (1 << 20) + F.greatest("own", "other")).alias("pair")]
    rows = keyed.select("key", *group, "fp").repartition("key", "pair").sortWithinPartitions("key", "pair")
    return map_arrow(rows, lambda it: _links(it, max_bits), "a bigint, b bigint")


def _marked(docs, id_col, text_col, words=SHINGLE_WORDS, max_bits=MAX_BITS, block=BLOCK, also=None) -> tuple[DataFrame, int]:
    """The rows of ``simhash_components``, and a number of partitions that
    suits rows of ``docs``: as many as they were read in, but work for every core."""
    prints = stored(fingerprints(docs, id_col, text_col, words, also), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct", files_for(prints.count()))
    n = distinct.count()
    many = stored(frequent(distinct.select("fp"), block), "frequent")
    parts = connected_components(links(distinct.select("fp"), max_bits, block, many), n)
    by_fp = stored(distinct.join(parts, distinct["fp"] == parts["node"], "left")
                   .select("fp", "first", F.coalesce("component", "fp").alias("group_fp")), "groups", files_for(n))
    # written first: a group of very many fingerprints, and a fingerprint of
    # very many documents, meet plain tables and are split
    least = stored(by_fp.groupBy("group_fp").agg(F.min("first").alias("component_id")), "least", files_for(n))
    named = by_fp.select("fp", "group_fp").join(least, "group_fp")
    read_in = max(len(prints.inputFiles()), docs.sparkSession.sparkContext.defaultParallelism)
    out = stored(prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "group_fp",
        *(also or {})), "components", read_in)
    for used in (prints, distinct, many, parts, by_fp, least):
        remove(used)
    return out, read_in


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = BLOCK,
                       also: dict | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id
    (smallest id reachable over links, its own included), group_fp (the same
    value for the documents of a component) and the columns of ``also``."""
    return _marked(docs, id_col, text_col, words, max_bits, block, also)[0]


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of which one stays per component: the one of smallest id
    (nulls last), then smallest text hash.  Returns the columns of ``docs``."""
    hashed = F.xxhash64(F.col(text_col).cast("string"))
    kept_id, kept_hash = free_name(docs, "kept_id"), free_name(docs, "kept_hash")
    marked, read_in = _marked(docs, id_col, text_col, also={"text_hash": hashed}, **options)
    keep = marked.groupBy("group_fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash")).alias("k")) \
        .select(F.col("k.doc_id").alias(kept_id), F.col("k.text_hash").alias(kept_hash))
    stay = docs.join(keep, F.col(id_col).eqNullSafe(F.col(kept_id)) & (hashed == F.col(kept_hash)), "left_semi")
    # rows repeated in id and text: one of them stays
    repeated = marked.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count()
    if repeated:
        stay = stay.withColumn(kept_hash, hashed).dropDuplicates([id_col, kept_hash]).drop(kept_hash)
    return stay.coalesce(read_in)
