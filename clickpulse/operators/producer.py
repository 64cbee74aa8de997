"""Producer-side counters over gated records (published / rejected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.validate import DOC


def published_by_type(gated: DataFrame) -> DataFrame:
    """Published events per event_type (counter ``published_total``)."""
    acc = gated.filter(F.col("gate_status") == "accepted")
    et = F.variant_get(F.col(DOC), "$.event_type", "string")
    return acc.groupBy(et.alias("event_type")).agg(F.count(F.lit(1)).alias("published"))


def rejected_by_reason(gated: DataFrame) -> DataFrame:
    """Rejections per joined reason (counter ``rejected_total``)."""
    rej = gated.filter(F.col("gate_status") == "rejected")
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


def recent_rejections(gated: DataFrame, ts: str = "received_at", tie: str | None = None,
                      n: int = 10) -> DataFrame:
    """The ``n`` newest rejections, newest first (a top-k: each task keeps its
    own n best, the driver merges - TakeOrderedAndProject)."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    rej = gated.filter(F.col("gate_status") == "rejected")
    return rej.orderBy(*order).limit(n).select(
        F.col(ts).alias("rejected_at"), *([tie] if tie else []),
        F.col("raw_value").alias("payload"), "reason")


def publish_totals(gated: DataFrame) -> DataFrame:
    """Running totals as one row (one partial aggregate per task)."""
    s = F.col("gate_status")
    return gated.agg(F.count_if(s == "accepted").alias("published"),
                     F.count_if(s == "rejected").alias("rejected"),
                     F.count_if(s == "refused").alias("refused"),
                     F.count_if(s == "error").alias("errors"))


def publish_events(accepted: DataFrame, fmt: str = "kafka", options: dict | None = None,
                   path: str | None = None, partitions: int | None = None,
                   doc_col: str = "_doc", raw: str = "raw_value") -> DataFrame:
    """Publish accepted events keyed by ``session_id``, the body as received.

    Kafka partitions by key itself.  For a file sink the rows are
    hash-partitioned on the key so one session lands in one output
    partition, as it would in one topic partition - per-session order is the
    point of the key, so a very hot session is, by design, one partition's
    load (as on the broker).  Returns the written (key, value) frame.
    """
    doc = F.col(doc_col)
    out = accepted.select(F.variant_get(doc, "$.session_id", "string").alias("key"),
                          F.col(raw).alias("value"))
    if fmt == "kafka":
        out.write.format("kafka").options(**(options or {})).save()
        return out
    n = partitions or out.sparkSession.sparkContext.defaultParallelism
    out.repartition(n, "key").write.mode("append").format(fmt).options(**(options or {})).save(path)
    return out
