"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch that are turned into Python objects at one time.
SLICE_ROWS = 256
#: Bytes, about, of an Arrow batch under ``small_batches``.
BATCH_BYTES = 2 << 20
#: Rows of a file of a stored table of numbers (a few longs a row).
ROWS_PER_FILE = 20_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="clickpulse-py-"), "clickpulse_package.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(d, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(top)))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent a scratch folder serves, but only in local
    mode, where driver and executors are one machine."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") \
        or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="clickpulse-llm-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def files_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_FILE))


def stored(df: DataFrame, name: str, files: int | None = None, options: dict | None = None) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again: cuts
    the lineage, survives lost executors, and is computed once.  ``files``:
    at most so many, however many partitions a shuffle has.  Hadoop's local
    file system starts two processes for each file, so small tables are to be
    written in as many files as their rows need.  ``options``: of the writer."""
    path = new_folder(df.sparkSession, name)
    df = df if files is None else df.coalesce(files)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote and that nothing will
    read again.  What is still there when the application ends lies in one
    folder, ``llm-<application>`` under the shared one, and may go as a whole."""
    spark = df.sparkSession
    jvm, ours = spark.sparkContext._jvm, f"/llm-{spark.sparkContext.applicationId}/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if ours in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that a task never holds more
    than one piece as Python objects."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


@contextlib.contextmanager
def small_batches(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> Iterator[None]:
    """What is computed meanwhile reads whole texts from Parquet by
    ``SLICE_ROWS`` rows and hands them to Python in batches of about
    ``batch_bytes``; Spark's own 4,096 rows, and 10,000 rows or 64 MB, are held
    by the JVM and the worker for every task."""
    confs = {"spark.sql.parquet.columnarReaderBatchSize": SLICE_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": batch_bytes}
    before = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def texts_of(column: pa.Array) -> list[str | None]:
    """The strings of a column; bytes that are no UTF-8 become U+FFFD."""
    return [None if raw is None else raw.decode("utf-8", "replace") for raw in column.cast(pa.binary()).to_pylist()]


def map_arrow(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def replace_columns(df: DataFrame, new: dict) -> DataFrame:
    """``df`` with columns set; a clashing column (in any case) gives way."""
    names = {n.lower() for n in new}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names],
                     *[e.alias(n) for n, e in new.items()])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text, modulo 4, is 2: rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def crc_ids(raw: bytes) -> int:
    import zlib
    return zlib.crc32(raw)
