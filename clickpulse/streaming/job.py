"""The streaming job: one source, two queries.

    raw records -> decode -> stream validation -+-> invalid -> DLQ envelopes -> dlq sink (append)
                                                +-> valid -> parse -> event_time -> watermark
                                                       -> sliding-window metrics -> idempotent sink (update)

Both queries share the operator code used in batch.  Each has its own
checkpoint under the configured folder, so a restart resumes offsets, window
state and the run id; the process ends when either query ends
(``awaitAnyTermination``).
"""

from __future__ import annotations

import json
import sys
import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from clickpulse.operators.dlq import to_dlq
from clickpulse.operators.metrics import page_metrics, parse_events, with_event_time
from clickpulse.operators.validate import accept_gate, split_valid, with_future_guard, with_stream_validation
from clickpulse.sources.records import decode_records
from clickpulse.streaming.alerts import start_alerts
from clickpulse.streaming.late import start_late
from clickpulse.streaming.latency import start_latency
from clickpulse.streaming.sink import MetricsSink, _delete, _fs, _names, run_id
from clickpulse.streaming.storage import partition_calendar
from clickpulse.streaming.totals import start_totals
from clickpulse.streaming.users import exact_page_metrics


@dataclass
class JobConfig:
    metrics_root: str
    checkpoint: str                        # shared folder; a restart names the same one
    dlq_path: str | None = None            # file DLQ (json); None with dlq_kafka
    dlq_kafka: dict | None = None          # kafka sink options (topic, servers, ...)
    watermark: str = "2 minutes"
    length: str = "60 seconds"
    slide: str | None = "10 seconds"
    distinct: str = "approx"
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    progress_path: str | None = None       # progress rows of every batch (json)
    alerts_path: str | None = None         # transitions of the live alert rules
    late_path: str | None = None           # rows that the watermark drops
    totals_path: str | None = None         # running totals and newest rejections
    latency_path: str | None = None        # latency sketches per day
    compact_every: int | None = 60         # batches between compactions of the store; None: never
    calendar_days_ahead: int | None = None  # quarantine windows outside the partition calendar
    max_future_skew: str | None = None     # e.g. "1 hour": far-future events -> DLQ


def metrics_stream(validated: DataFrame, cfg: JobConfig) -> DataFrame:
    valid, _ = split_valid(validated)
    events = with_event_time(parse_events(valid)).withWatermark("event_time", cfg.watermark)
    if cfg.distinct == "exact":
        return exact_page_metrics(events, cfg.length, cfg.slide)
    return page_metrics(events, cfg.length, cfg.slide, distinct=cfg.distinct, streaming=True)


def dlq_stream(validated: DataFrame) -> DataFrame:
    _, invalid = split_valid(validated)
    return to_dlq(invalid)


def start(spark: SparkSession, raw: DataFrame, cfg: JobConfig) -> tuple[StreamingQuery, ...]:
    """Start the DLQ and metrics queries over a Kafka-shaped raw stream, and
    behind them the queries beside the job that the configuration names."""
    ckpt = cfg.checkpoint.rstrip("/")
    validated = with_stream_validation(decode_records(raw))
    if cfg.max_future_skew:
        validated = with_future_guard(validated, cfg.max_future_skew)

    dlq = dlq_stream(validated).writeStream.outputMode("append").queryName(_name("dlq")) \
        .option("checkpointLocation", f"{ckpt}/dlq").trigger(**cfg.trigger)
    dlq = dlq.format("kafka").options(**cfg.dlq_kafka) if cfg.dlq_kafka else dlq.format("json").option("path", cfg.dlq_path)

    run = run_id(spark, cfg.metrics_root, ckpt)
    metrics = (metrics_stream(validated, cfg).writeStream.queryName(_name("metrics"))
               .foreachBatch(_sink(spark, cfg, run)).outputMode("update")
               .option("checkpointLocation", f"{ckpt}/metrics").trigger(**cfg.trigger))
    if cfg.progress_path:
        spark.streams.addListener(ProgressTable(spark, cfg.progress_path))
    return dlq.start(), metrics.start(), *_beside(raw, validated, cfg, run)


def _beside(raw: DataFrame, validated: DataFrame, cfg: JobConfig, run: int) -> list[StreamingQuery]:
    ckpt, out = cfg.checkpoint.rstrip("/"), []
    if cfg.alerts_path or cfg.totals_path:
        # a record is known by its place in the source
        place = F.concat_ws("-", F.lpad(F.col("partition").cast("string"), 10, "0"), F.lpad(F.col("offset").cast("string"), 19, "0"))
        gated = accept_gate(decode_records(raw.withColumns({"received_at": F.col("timestamp"), "src_id": place})))
    if cfg.alerts_path:
        out.append(start_alerts(gated, cfg.alerts_path, f"{ckpt}/alerts", trigger=cfg.trigger, name=_name("alerts")))
    if cfg.totals_path:
        out.append(start_totals(gated, cfg.totals_path, f"{ckpt}/totals", "received_at", trigger=cfg.trigger, name=_name("totals")))
    events = with_event_time(parse_events(split_valid(validated)[0]))
    if cfg.late_path:
        out.append(start_late(events, cfg.late_path, f"{ckpt}/late", cfg.length, cfg.slide, cfg.watermark, cfg.trigger, _name("late"),
                              own_batch=cfg.distinct == "exact"))
    if cfg.latency_path:
        out.append(start_latency(events, cfg.latency_path, f"{ckpt}/latency", run, trigger=cfg.trigger, name=_name("latency")))
    return out


def _name(kind: str) -> str:
    return f"clickpulse-{kind}-{uuid.uuid4().hex[:8]}"


def _sink(spark: SparkSession, cfg: JobConfig, run: int):
    """The sink of a run; with a calendar, that of the batch's own day."""
    if cfg.calendar_days_ahead is None:
        return MetricsSink(cfg.metrics_root, run, None, cfg.compact_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        today = batch.sparkSession.sql("SELECT current_date()").first()[0]
        calendar = partition_calendar(batch.sparkSession, today, cfg.calendar_days_ahead)
        MetricsSink(cfg.metrics_root, run, calendar, cfg.compact_every)(batch, batch_id)
    return write


def run_forever(spark: SparkSession, raw: DataFrame, cfg: JobConfig) -> None:
    start(spark, raw, cfg)
    spark.streams.awaitAnyTermination()


PROGRESS_SCHEMA = ("query string, run_id string, batch_id long, input_rows long, rows_dropped_by_watermark long, "
                   "watermark string, trigger_ms long, add_batch_ms long, sources string")


def progress_row(p) -> tuple:
    """One row of PROGRESS_SCHEMA from a progress report."""
    d = p.durationMs or {}
    dropped = sum((s.numRowsDroppedByWatermark or 0) for s in (p.stateOperators or []))
    sources = [{"description": s.description, "endOffset": _offsets(s.endOffset), "latestOffset": _offsets(s.latestOffset)}
               for s in (p.sources or [])]
    return (p.name, str(p.runId), p.batchId, p.numInputRows, dropped, (p.eventTime or {}).get("watermark"),
            d.get("triggerExecution"), d.get("addBatch"), json.dumps(sources))


def _offsets(x):
    try:
        return json.loads(x) if isinstance(x, str) else x
    except ValueError:
        return x


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of every batch of every query in a table by date.

    The listener only takes a row into a buffer; a thread of its own writes the
    buffer as one file per date (every ``flush_rows`` rows or ``flush_s``
    seconds, and when a query ends) and merges a date's files when there are
    more than ``max_files``.  A merge leaves rows twice at worst, which reading
    drops; a driver that dies loses at most the buffer."""

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = 100, flush_s: float = 60, max_files: int = 20):
        self.spark, self.path = spark, path.rstrip("/")
        self.flush_rows, self.flush_s, self.max_files = flush_rows, flush_s, max_files
        self._rows: list[tuple] = []
        self._lock, self._writing, self._wake = threading.Lock(), threading.Lock(), threading.Event()
        threading.Thread(target=self._run, daemon=True, name="clickpulse-progress").start()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(progress_row(event.progress), event.progress.timestamp[:10])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._wake.set()

    def add(self, row: tuple, date: str) -> None:
        with self._lock:
            self._rows.append((*row, date))
            full = len(self._rows) >= self.flush_rows
        if full:
            self._wake.set()

    def _run(self) -> None:
        while True:
            self._wake.wait(self.flush_s)
            self._wake.clear()
            try:
                self.flush()
            except Exception as e:  # the rows are still held; the next round tries again
                if self.spark.sparkContext._jsc is None:
                    return
                print(f"progress table: {e}", file=sys.stderr)

    def flush(self) -> None:
        """Write what is buffered, and merge dates of many files."""
        with self._writing:
            with self._lock:
                rows, self._rows = self._rows, []
            if not rows:
                return
            try:
                self.spark.createDataFrame(rows, PROGRESS_SCHEMA + ", date string").coalesce(1) \
                    .write.mode("append").partitionBy("date").json(self.path)
            except BaseException:
                with self._lock:
                    self._rows = rows + self._rows
                raise
            for date in {r[-1] for r in rows}:
                self._merge(f"{self.path}/date={date}")

    def _merge(self, folder: str) -> None:
        fs, p, jvm = _fs(self.spark, folder)
        old = [n for n in _names(self.spark, folder) if n.endswith(".json")]
        if len(old) <= self.max_files:
            return
        tmp = f"{self.path}/_merge-{uuid.uuid4().hex}"
        _distinct(self.spark.read.schema(PROGRESS_SCHEMA).json([f"{folder}/{n}" for n in old])).coalesce(1).write.json(tmp)
        for n in _names(self.spark, tmp):
            if n.endswith(".json"):
                fs.rename(jvm.org.apache.hadoop.fs.Path(f"{tmp}/{n}"), jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}"))
        for n in old:
            _delete(self.spark, f"{folder}/{n}")
        _delete(self.spark, tmp)


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates(["query", "run_id", "batch_id"])


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """The recorded progress: batch id, input rows, rows dropped by the
    watermark, watermark, durations (ms), source offsets, date."""
    return _distinct(spark.read.schema(PROGRESS_SCHEMA + ", date string").json(path))


def offsets_frame(progress: DataFrame) -> DataFrame:
    """Per source partition, end offset against latest offset (the input of
    ``consumer_lag``) in the newest recorded batch of each query run."""
    newest = progress.groupBy("query", "run_id").agg(F.max_by("sources", "batch_id").alias("sources"))
    kind = "array<struct<endOffset:map<string,map<string,bigint>>,latestOffset:map<string,map<string,bigint>>>>"
    src = newest.select("query", F.explode(F.from_json("sources", kind)).alias("s"))
    topics = src.select("query", F.explode("s.endOffset").alias("topic", "ends"), F.col("s.latestOffset").alias("latest"))
    parts = topics.select("query", "topic", F.explode("ends").alias("p", "committed_offset"), "latest")
    end = F.try_element_at(F.try_element_at("latest", F.col("topic")), F.col("p"))
    return parts.select("query", "topic", F.col("p").cast("int").alias("partition"), "committed_offset",
                        F.coalesce(end, F.col("committed_offset")).alias("end_offset"))
