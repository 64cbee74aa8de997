"""Rows that the watermark drops, kept as a side table.

The windowed aggregate drops a (row, window) pair when the window had ended at
the watermark that held in the batch before.  Here rows are spread over a
fixed number of keys, and each key follows the engine's watermark with an
event-time timer that is always due as soon as the watermark moves: timers run
behind a batch's rows, so while rows are handled the key's state names the
watermark of the batch before, whatever the engine did in between.  Nothing
else is kept.  A query of the same source, trigger and watermark as the
metrics query sees the same batches and so names exactly its dropped pairs.

Rows are compared as column batches; only late ones are taken apart.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from clickpulse.operators.metrics import interval_seconds, page_key
from clickpulse.session import ship_package

US = 1_000_000
#: Keys that rows are spread over.
KEYS = 64


class LateProcessor(StatefulProcessor):
    """Emits the late pairs of its rows; state: the watermark (ms) known."""

    def __init__(self, columns: list[str], length_s: int, slide_s: int, own_batch: bool = False):
        self.columns, self.length, self.slide, self.own_batch = columns, length_s * US, slide_s * US, own_batch

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("watermark", "ms bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._follow(0)

    def _follow(self, ms: int) -> None:
        self.known.update((ms,))
        self.handle.registerTimer(ms + 1)

    def handleInputRows(self, key, rows, timerValues):
        known = self.known.get()[0] if self.known.exists() else 0
        mark = 1000 * (max(0, timerValues.getCurrentWatermarkInMs()) if self.own_batch else known)
        for batch in rows:
            late = batch[batch["event_us"] < mark]
            if mark and len(late):
                yield self._pairs(late, mark)

    def _pairs(self, late: pd.DataFrame, mark: int) -> pd.DataFrame:
        newest = late["event_us"] // self.slide * self.slide
        parts = []
        for back in range(0, self.length, self.slide):
            start = newest - back
            part = late.assign(start_us=start, end_us=start + self.length, mark_us=mark)
            parts.append(part[(part["end_us"] <= mark) & (part["event_us"] < part["end_us"])])
        return pd.concat(parts)[[*self.columns, "event_us", "start_us", "end_us", "mark_us"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._follow(timerValues.getCurrentWatermarkInMs())
        return iter(())

    def close(self) -> None:
        pass


CARRIED = ["event_id", "user_id", "session_id", "event_type", "page_url"]


def late_pairs(events: DataFrame, length: str = "60 seconds", slide: str | None = "10 seconds",
               watermark: str = "2 minutes", carried: list[str] | None = None, keys: int = KEYS,
               own_batch: bool = False) -> DataFrame:
    """A stream of the dropped pairs of ``events`` (parsed, with event_time and
    without a watermark yet): the event's columns, event_time, window_start,
    window_end, and the watermark behind which the window had ended.  That is
    the watermark of the batch before, as for the windowed aggregate, or with
    ``own_batch`` that of the row's own batch, as for exact users."""
    spark, carried = events.sparkSession, carried or CARRIED
    ship_package(spark)
    marked = events.withColumn("page_url", page_key(F.col("page_url"))).withWatermark("event_time", watermark)
    # the engine must not drop them here too: the time goes on as a number
    rows = marked.filter(F.col("event_time").isNotNull()).select(
        F.pmod(F.xxhash64(*carried, "event_time"), F.lit(keys)).cast("int").alias("bucket"),
        *carried, F.unix_micros("event_time").alias("event_us"))
    number = [T.StructField(n, T.LongType()) for n in ("event_us", "start_us", "end_us", "mark_us")]
    schema = T.StructType([*[events.schema[c] for c in carried], *number])
    known = spark.range(keys).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("begin"))
    processor = LateProcessor(carried, interval_seconds(length), interval_seconds(slide or length), own_batch)
    found = rows.groupBy("bucket").transformWithStateInPandas(processor, schema, "Append", "EventTime", known.groupBy("bucket"))
    return found.select(*carried, F.timestamp_micros("event_us").alias("event_time"), F.timestamp_micros("start_us").alias("window_start"),
                        F.timestamp_micros("end_us").alias("window_end"), F.timestamp_micros("mark_us").alias("watermark"))


def start_late(events: DataFrame, path: str, checkpoint: str, length: str = "60 seconds", slide: str | None = "10 seconds",
               watermark: str = "2 minutes", trigger: dict | None = None, name: str = "clickpulse-late",
               own_batch: bool = False) -> StreamingQuery:
    """Append the dropped pairs to the table at ``path``, each once."""
    return late_pairs(events, length, slide, watermark, own_batch=own_batch).writeStream.format("parquet").queryName(name).outputMode("append") \
        .option("path", path).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def late_audit(pairs: DataFrame) -> DataFrame:
    """Per page: late events, dropped pairs, and how far behind the watermark
    the worst of them came (seconds)."""
    behind = (F.unix_micros("watermark") - F.unix_micros("window_end")) / US
    return pairs.groupBy("page_url").agg(F.count_distinct("event_id", "event_time").alias("events"), F.count("*").alias("pairs"),
                                         F.max(behind).alias("worst_behind_s"))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
