"""Processing latency as mergeable quantile sketches.

Each batch adds, per day of event time, one KLL sketch of write time less event
time (milliseconds); sketches of a day merge without loss of their error bound,
so quantiles over any days are read from a few rows.  A batch overwrites its
own folder; every so many batches the folders are folded into one sketch a day.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.streaming.sink import _batches, _delete, _names, _read_text, _write_text

#: Size of a sketch: 400 keeps ranks within about 0.7 %.
K = 400
QUANTILES = (0.5, 0.95, 0.99)
_SCHEMA = "day date, events bigint, sketch binary"


def latency_sketches(events: DataFrame, written_at: Column, k: int = K) -> DataFrame:
    """day, events and sketch of the latencies of ``events`` (event_time)."""
    late = (F.unix_millis(written_at) - F.unix_millis("event_time")).alias("ms")
    rows = events.filter(F.col("event_time").isNotNull()).select(F.to_date("event_time").alias("day"), late)
    return rows.groupBy("day").agg(F.count("ms").alias("events"), F.kll_sketch_agg_bigint("ms", F.lit(k)).alias("sketch"))


def merged(sketches: DataFrame, *by: str, k: int = K) -> DataFrame:
    return sketches.groupBy(*by).agg(F.sum("events").alias("events"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))


def latency_quantiles(sketches: DataFrame, *by: str, k: int = K) -> DataFrame:
    """events, p50_ms, p95_ms, p99_ms over all days, or per ``by``."""
    m = merged(sketches, *by, k=k)
    q = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(x)).alias(f"p{round(100 * x)}_ms") for x in QUANTILES]
    return m.filter(F.col("events") > 0).select(*by, "events", *q)


def _state(spark: SparkSession, root: str) -> dict:
    known = [int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in _names(spark, f"{root}/manifest")) if m]
    if not known:
        return {"version": 0, "folded": {}}
    return json.loads(_read_text(spark, f"{root}/manifest/{max(known)}.json"))


def _open(spark: SparkSession, root: str, state: dict) -> list[tuple[int, int]]:
    return [(r, b) for r, b in _batches(spark, root) if b > state["folded"].get(str(r), -1)]


def read_latency(spark: SparkSession, root: str) -> DataFrame:
    """The sketches kept: of folded batches one a day, and those of newer ones."""
    root = root.rstrip("/")
    state = _state(spark, root)
    paths = [f"{root}/changelog/run={r}/batch_id={b}" for r, b in _open(spark, root, state)]
    if state["version"]:
        paths.append(f"{root}/table/version={state['version']}")
    if not paths:
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(*paths)


def compact_latency(spark: SparkSession, root: str) -> None:
    """Fold the batches into one sketch a day.  The files read stay until the
    next fold, for readers under way."""
    root = root.rstrip("/")
    state = _state(spark, root)
    batches = _open(spark, root, state)
    for r, b in set(_batches(spark, root)) - set(batches):
        _delete(spark, f"{root}/changelog/run={r}/batch_id={b}")
    if not batches:
        return
    version, folded = state["version"] + 1, dict(state["folded"])
    merged(read_latency(spark, root), "day").coalesce(1).write.mode("overwrite").parquet(f"{root}/table/version={version}")
    for r, b in batches:
        folded[str(r)] = max(b, folded.get(str(r), -1))
    _write_text(spark, f"{root}/manifest/{version}.json", json.dumps({"version": version, "folded": folded}))
    for kind, name in (("manifest", "{}.json"), ("table", "version={}")):
        _delete(spark, f"{root}/{kind}/{name.format(version - 2)}")


class LatencySink:
    """``foreachBatch`` over parsed events."""

    def __init__(self, root: str, run: int, compact_every: int = 60):
        self.root, self.run, self.compact_every = root.rstrip("/"), run, compact_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        now = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
        latency_sketches(batch, now).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/changelog/run={self.run}/batch_id={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            compact_latency(batch.sparkSession, self.root)


def start_latency(events: DataFrame, root: str, checkpoint: str, run: int, compact_every: int = 60,
                  trigger: dict | None = None, name: str = "clickpulse-latency") -> StreamingQuery:
    return events.select("event_time").writeStream.foreachBatch(LatencySink(root, run, compact_every)).queryName(name) \
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
