"""Running totals and the newest rejections of a stream.

A ``foreachBatch`` sink keeps four small tables, one version per batch: what a
batch adds is computed by the batch operators, and version n is version n - 1
(of the batch before) plus that.  A retried batch rewrites its own version from
the same predecessor, so a restart counts nothing twice; older versions go once
the next but one is written.  The rejections kept are the newest ``n``, so they
stay bounded; reasons are as many as there are different ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators import producer as P
from clickpulse.streaming.sink import _delete, _names

COUNTERS = {"by_type": ("event_type", "published"), "by_reason": ("reason", "rejected")}
TOTALS = ["published", "rejected", "refused", "errors"]
SCHEMAS = {"by_type": "event_type string, published bigint", "by_reason": "reason string, rejected bigint",
           "totals": ", ".join(f"{c} bigint" for c in TOTALS),
           "recent": "rejected_at timestamp, src_id string, payload string, reason string"}


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Batches whose version is complete."""
    return sorted(int(n[6:]) for n in _names(spark, root) if n.startswith("batch=")
                  and "_DONE" in _names(spark, f"{root}/{n}"))


def read_totals(spark: SparkSession, root: str, table: str, before: int | None = None) -> DataFrame:
    """The newest version of a table (``by_type``, ``by_reason``, ``totals`` or
    ``recent``), or the newest of a batch before ``before``."""
    known = [v for v in _versions(spark, root) if before is None or v < before]
    if not known:
        return spark.createDataFrame([], SCHEMAS[table])
    return spark.read.schema(SCHEMAS[table]).parquet(f"{root}/batch={known[-1]}/{table}")


class TotalsSink:
    """``writeStream.foreachBatch(TotalsSink(root))`` over gated records with
    ``ts`` (when a record arrived) and ``tie`` (its id)."""

    def __init__(self, root: str, ts: str = "timestamp", tie: str = "src_id", n: int = 10):
        self.root, self.ts, self.tie, self.n = root.rstrip("/"), ts, tie, n

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        gated = batch.select("gate_status", "reason", "raw_value", P.DOC, self.ts, self.tie).persist()
        try:
            before = {t: read_totals(spark, self.root, t, batch_id) for t in SCHEMAS}
            new = {"by_type": P.published_by_type(gated), "by_reason": P.rejected_by_reason(gated)}
            out = {}
            for table, (key, value) in COUNTERS.items():
                out[table] = before[table].unionByName(new[table]).groupBy(key).agg(F.sum(value).alias(value))
            out["totals"] = before["totals"].unionByName(P.publish_totals(gated)) \
                .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS])
            newest = P.recent_rejections(gated, self.ts, self.tie, self.n).withColumn(self.tie, F.col(self.tie).cast("string")) \
                .withColumnRenamed(self.tie, "src_id")
            out["recent"] = before["recent"].unionByName(newest) \
                .orderBy(F.col("rejected_at").desc(), F.length("src_id").desc(), F.col("src_id").desc()).limit(self.n)
            for table, rows in out.items():
                rows.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}/{table}")
            _mark(spark, f"{self.root}/batch={batch_id}/_DONE")
            for v in _versions(spark, self.root)[:-2]:
                _delete(spark, f"{self.root}/batch={v}")
        finally:
            gated.unpersist()


def _mark(spark: SparkSession, path: str) -> None:
    from clickpulse.streaming.sink import _fs
    fs, p, _ = _fs(spark, path)
    fs.create(p, True).close()


def start_totals(gated: DataFrame, root: str, checkpoint: str, ts: str = "timestamp", tie: str = "src_id", n: int = 10,
                 trigger: dict | None = None, name: str = "clickpulse-totals") -> StreamingQuery:
    return gated.writeStream.foreachBatch(TotalsSink(root, ts, tie, n)).queryName(name) \
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
