"""Token ids as flat binary files, and their reading through memory maps.

A part of the corpus is three files in one shared folder:

* ``<part>.bin``  the ids of its documents, one after the other, as unsigned
  16-bit (vocabularies up to 65,536 ids) or 32-bit little-endian integers;
* ``<part>.idx``  n + 1 signed 64-bit offsets: document i has the ids from
  offset i up to offset i + 1;
* ``<part>.doc``  the n document ids as signed 64-bit integers.

The manifest, a Parquet table of one row per part, names the files and holds
their counts.  Parts are ranges of the document id, ascending; the number of
ids before a part is a prefix sum over the manifest.  A task writes under a
name of its own attempt and only the manifest makes a file valid, so retries
and lost executors leave no half-written part behind.

Cases: null and empty texts hold the end id only; bytes that are no UTF-8
count as U+FFFD; null ids come first (the
manifest counts them); equal ids are ordered by a hash of their text; an
empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import map_arrow, new_folder, ship, slices, texts_of
from clickpulse.llm.encoders import encoder

#: Documents that one reading task takes from a part.
READ_DOCS = 20_000

MANIFEST = "part int, file string, width int, n_docs bigint, n_nulls bigint, n_tokens bigint"


def _place(uri: str):
    """File system and path of a location (a plain path or a URI)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, *, kind: str = "word", end_id: int = 2,
                      vocab_size: int = 49_408, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files to ``folder`` and return the manifest, read from there."""
    spark = docs.sparkSession
    width = 2 if vocab_size <= 1 << 16 else 4

    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        encode, end = encoder(kind, vocabulary), end_id.to_bytes(4, "little")
        files, store, counts = None, None, [0, 0, 0]
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        for b in slices(batches):
            ids = b.column(0)
            raws = [encode(t) + end for t in texts_of(b.column(1))]
            if files is None:
                store, path = _place(folder)
                store.create_dir(path, recursive=True)
                files = [store.open_output_stream(f"{path}/{name}.{x}") for x in ("bin", "idx", "doc")]
                files[1].write(np.zeros(1, "<i8").tobytes())
            tokens = np.frombuffer(b"".join(raws), "<u4")
            ends = counts[2] + np.cumsum([len(r) // 4 for r in raws])
            files[0].write(tokens.astype(f"<u{width}").tobytes())
            files[1].write(ends.astype("<i8").tobytes())
            files[2].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            counts = [counts[0] + len(raws), counts[1] + ids.null_count, int(ends[-1])]
        if files is not None:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [task.partitionId()], "file": [name], "width": [width], "n_docs": [counts[0]],
                 "n_nulls": [counts[1]], "n_tokens": [counts[2]]},
                pa.schema([("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()),
                           ("n_docs", pa.int64()), ("n_nulls", pa.int64()), ("n_tokens", pa.int64())]))

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    map_arrow(rows, run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest and, per part, the ids of all parts before it.  One row
    per file: the window over it stays small however large the corpus is."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))


def read_token_files(manifest: DataFrame, folder: str, read_docs: int = READ_DOCS) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids before it in
    the corpus), n_tokens and ids_crc32 (over unsigned 32-bit ids)."""
    ship(manifest.sparkSession)

    def run(batches):
        out = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
        store, path = _place(folder)
        local = isinstance(store, pafs.LocalFileSystem)

        def part_of(name: str, kind: str, first: int, last: int) -> np.ndarray:
            """Values first .. last - 1 of a file, mapped where it is local."""
            if last <= first:
                return np.empty(0, kind)
            if local:
                return np.memmap(f"{path}/{name}", kind, "r", first * np.dtype(kind).itemsize, (last - first,))
            with store.open_input_file(f"{path}/{name}") as f:
                size = np.dtype(kind).itemsize
                return np.frombuffer(f.read_at((last - first) * size, first * size), kind)

        for b in batches:
            for r in b.to_pylist():
                for first in range(r["first"], min(r["first"] + read_docs, r["n_docs"]), 1024):
                    last = min(first + 1024, r["first"] + read_docs, r["n_docs"])
                    at = np.asarray(part_of(r["file"] + ".idx", "<i8", first, last + 1))
                    ids = np.asarray(part_of(r["file"] + ".doc", "<i8", first, last))
                    tokens = part_of(r["file"] + ".bin", f"<u{r['width']}", int(at[0]), int(at[-1]))
                    cut = (at - at[0]).tolist()
                    crc = [zlib.crc32(tokens[x:y].astype("<u4").tobytes()) for x, y in zip(cut, cut[1:])]
                    null = np.arange(first, last) < r["n_nulls"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64(), mask=null), pa.array(at[:-1] + r["base"]),
                         pa.array(np.diff(at)), pa.array(crc, pa.int64())], schema=out)

    ranges = with_bases(manifest).withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_docs") - 1, F.lit(read_docs).cast("bigint"))))
    # the number is named, as the rows themselves are so small that they would be put into one task
    ranges = ranges.repartition(max(1, ranges.count()), "file", "first")
    return map_arrow(ranges, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def export_and_read(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    folder = new_folder(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, vocabulary, folder, **options), folder)
