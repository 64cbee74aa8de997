"""Table maintenance: partition calendar, routing check, quarantine, snapshots, retention."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse import contracts as C

TABLE = "windowed_user_metrics"


def _calendar_of(days: DataFrame, day_col: str, days_ahead: int, prefix: str) -> DataFrame:
    d = F.col(day_col)
    span = F.sequence(F.date_sub(d, 1), F.date_add(d, days_ahead), F.expr("INTERVAL 1 DAY"))
    out = days.select(F.explode(span).alias("range_from")).distinct()
    return out.select(F.concat(F.lit(prefix + "_"), F.date_format("range_from", "yyyyMMdd")).alias("partition"),
                      "range_from", F.date_add("range_from", 1).alias("range_to"))


def partition_calendar(spark: SparkSession, as_of: dt.date | str, days_ahead: int = 3,
                       prefix: str = TABLE) -> DataFrame:
    """Daily partitions the maintenance job ensures at ``as_of`` (UTC day):
    [as_of - 1, as_of + days_ahead], each ``[d, d + 1)``."""
    days = spark.range(1).select(F.lit(str(as_of)).cast("date").alias("d"))
    return _calendar_of(days, "d", days_ahead, prefix)


def partition_calendar_for(run_days: DataFrame, day_col: str = "day", days_ahead: int = 3,
                           prefix: str = TABLE) -> DataFrame:
    """Union of the calendars ensured by one run per day in ``run_days``."""
    return _calendar_of(run_days, day_col, days_ahead, prefix)


NO_PARTITION = "no partition for window_start"
TOO_LONG = "page_url longer than column width"


def routing_reason(metrics: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """``metrics`` with ``reason``: why no partition takes the row (its day is
    not in the calendar, or its page_url exceeds the column width), else null.
    One left join on the day; no calendar takes every day."""
    wide = F.when(F.char_length("page_url") > C.PAGE_URL_MAX, TOO_LONG)
    if calendar is None:
        return metrics.withColumn("reason", wide)
    cal = calendar.select(F.col("range_from").alias("_day"), F.lit(True).alias("_routed")).distinct()
    flagged = metrics.withColumn("_day", F.to_date("window_start")).join(cal, "_day", "left")
    return flagged.withColumn("reason", F.when(F.col("_routed").isNull(), NO_PARTITION).otherwise(wide)) \
        .drop("_day", "_routed")


def unroutable_metrics(metrics: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """The rows that would make a whole batch fail, with the reason; the sink
    puts them into quarantine."""
    return routing_reason(metrics, calendar).filter(F.col("reason").isNotNull())


# -- quarantine ---------------------------------------------------------------

def replay_quarantine(spark: SparkSession, store: str, calendar: DataFrame | None = None) -> int:
    """Rows that went to quarantine for want of a partition return to the store
    once ``calendar`` (none: any day) has their day; returns how many.

    They keep the version of the batch that wrote them, so a newer value of the
    same key stays, and the manifest that makes them readable also marks the
    (batch, day) they came from, so they return once however often this runs.
    """
    from clickpulse.streaming import sink as SK
    store = store.rstrip("/")
    state = SK.manifest(spark, store)
    if not [n for n in SK._names(spark, f"{store}/quarantine") if n.startswith("run=")]:
        return 0
    held = spark.read.schema(SK._STORED.format("reason string, run bigint, batch_id bigint, ")).parquet(f"{store}/quarantine") \
        .filter(F.col("reason") == NO_PARTITION)
    mark = F.concat_ws("/", "run", "batch_id", "window_date")
    known = spark.createDataFrame([(m,) for m in state["replayed"]], "mark string")
    waiting = routing_reason(held.drop("reason").withColumn("mark", mark).join(known, "mark", "left_anti"), calendar) \
        .filter(F.col("reason").isNull()).drop("reason")
    version = state["version"] + 1
    at = f"{store}/returned/version={version}"
    (waiting.withColumn("written", SK._batch_version(F.col("run"), F.col("batch_id"))).drop("run", "batch_id")
        .repartition("window_date", "mark").write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("window_date").parquet(at))
    back = spark.read.schema(SK._STORED.format("mark string, ")).parquet(at)
    marks = {r["mark"]: r["n"] for r in back.groupBy("mark").agg(F.count("*").alias("n")).collect()}  # batches x days
    if not marks:
        SK._delete(spark, at)
        return 0
    zones = {str(r["window_date"]): [r["lo"], r["hi"], 0] for r in SK._zones_of(back).collect()}
    SK._write_text(spark, f"{store}/zones/returned={version}.json", json.dumps(zones), replace=True)
    SK._publish(spark, store, {**state, "version": version, "returned": [*state["returned"], version],
                               "replayed": sorted({*state["replayed"], *marks})})
    return sum(marks.values())


# -- snapshots ----------------------------------------------------------------

def _copied(spark: SparkSession, dumps: str) -> set[tuple[str, int]]:
    from clickpulse.streaming.sink import _names
    out = set()
    for v in _names(spark, f"{dumps}/days"):
        if v.startswith("version="):
            out |= {(d[12:], int(v[8:])) for d in _names(spark, f"{dumps}/days/{v}") if d.startswith("window_date=")}
    return out


def snapshots(spark: SparkSession, dumps: str) -> dict[str, dict]:
    """The snapshots in a folder of dumps, by date."""
    from clickpulse.streaming.sink import _names, _read_text
    names = [n for n in _names(spark, f"{dumps}/snapshots") if n.endswith(".json") and not n.startswith(".")]
    return {n[:-5]: json.loads(_read_text(spark, f"{dumps}/snapshots/{n}")) for n in sorted(names)}


def _day_paths(dumps: str, days: dict) -> list[str]:
    return [f"{dumps}/days/version={v}/window_date={d}" for d, v in sorted(days.items())]


def _read_days(spark: SparkSession, dumps: str, days: dict) -> DataFrame:
    from clickpulse.streaming.sink import VALUE_COLS, _STORED
    cols = [*C.METRICS_PK, *VALUE_COLS, "window_date"]
    if not days:
        return spark.createDataFrame([], _STORED.format("")).select(cols)
    return spark.read.schema(_STORED.format("written bigint, version bigint, ")).option("basePath", f"{dumps}/days") \
        .parquet(*_day_paths(dumps, days)).select(cols)


def snapshot(spark: SparkSession, store: str, dumps: str, date: dt.date | str) -> list[str]:
    """A dump of the store named by date.  It names the immutable version of
    every compacted day; only days whose version is in no earlier dump are
    copied, by the executors, and returned.  Count and checksum of each day are
    recorded when it is copied."""
    from clickpulse.streaming import sink as SK
    store, dumps = store.rstrip("/"), dumps.rstrip("/")
    SK.compact_metrics(spark, store)
    state = SK.manifest(spark, store)
    checks, named = {}, set()
    for known in snapshots(spark, dumps).values():
        checks.update({(d, v): known["checks"][d] for d, v in known["days"].items()})
        named |= set(known["days"].items())
    # a day counts as copied if a dump names it; what a failed night left is written anew
    new = {d: v for d, v in state["days"].items() if (d, v) not in named & _copied(spark, dumps)}
    if new:
        rows = spark.read.schema(SK._STORED.format("written bigint, version bigint, ")).option("basePath", f"{store}/table") \
            .parquet(*SK._table_paths(store, {"days": new}))
        rows.hint("rebalance", "version", "window_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("version", "window_date").parquet(f"{dumps}/days")
        per_day = fingerprint_by(_read_days(spark, dumps, new), "window_date").collect()
        checks.update({(str(r["window_date"]), new[str(r["window_date"])]): [r["rows"], str(r["checksum"])] for r in per_day})
    SK._write_text(spark, f"{dumps}/snapshots/{date}.json", json.dumps(
        {"days": state["days"], "window_seconds": state["window_seconds"],
         "checks": {d: checks[d, v] for d, v in state["days"].items()}}), replace=True)
    return sorted(new)


def restore(spark: SparkSession, dumps: str, date: dt.date | str) -> DataFrame:
    """The rows of one snapshot."""
    known = snapshots(spark, dumps.rstrip("/"))
    if str(date) not in known:
        raise ValueError(f"there is no snapshot of {date}")
    return _read_days(spark, dumps.rstrip("/"), known[str(date)]["days"])


def _differs(rows: DataFrame, checks: dict) -> list[str]:
    """Days whose count or checksum is not the recorded one."""
    got = {str(r["window_date"]): [r["rows"], str(r["checksum"])] for r in fingerprint_by(rows, "window_date").collect()}
    return sorted(d for d in {*got, *checks} if got.get(d) != checks.get(d))


def restore_store(spark: SparkSession, dumps: str, date: dt.date | str, store: str) -> int:
    """Reload the metrics store from a snapshot and verify count and checksum
    of every day; returns the rows.  The store keeps its old state if the
    snapshot itself does not match what was recorded with it."""
    from clickpulse.streaming.sink import read_metrics, replace_all
    rows = restore(spark, dumps, date)
    checks = snapshots(spark, dumps.rstrip("/"))[str(date)]["checks"]
    if bad := _differs(rows, checks):
        raise ValueError(f"the snapshot of {date} is damaged: {bad[:5]}")
    replace_all(spark, store, rows)
    if bad := _differs(read_metrics(spark, store).select(*rows.columns), checks):
        raise ValueError(f"the restored store differs from the snapshot: {bad[:5]}")
    return sum(n for n, _ in checks.values())


def prune_snapshots(spark: SparkSession, dumps: str, as_of: dt.date | str, days: int = 7) -> tuple[list[str], list[str]]:
    """Snapshots older than ``days`` days at ``as_of`` go, and then the files of
    days that no snapshot left names.  Returns both."""
    from clickpulse.streaming.sink import _delete
    dumps = dumps.rstrip("/")
    day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    known = snapshots(spark, dumps)
    old = [d for d in known if dt.date.fromisoformat(d) < day - dt.timedelta(days=days)]
    for d in old:
        _delete(spark, f"{dumps}/snapshots/{d}.json")
    named = {x for d, s in known.items() if d not in old for x in s["days"].items()}
    gone = [p for d, v in sorted(_copied(spark, dumps) - named) for p in _day_paths(dumps, {d: v})]
    for path in gone:
        _delete(spark, path)
    return old, gone


def fingerprint_by(df: DataFrame, day: str) -> DataFrame:
    """Per day: row count and order-free checksum of the other columns."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns) if c != day])
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("checksum"))


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Row count + order-free checksum, to verify a restore."""
    cols = cols or df.columns
    h = F.xxhash64(*[F.col(c) for c in cols])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("checksum"))


def retention_prune(df: DataFrame, date_col: str, as_of: dt.date | str | Column, days: int = 7) -> DataFrame:
    """Per partition day: keep or drop under a ``days`` retention at ``as_of``
    (dumps older than ``days`` days are deleted)."""
    a = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    per_day = df.groupBy(F.col(date_col).alias("partition_date")).agg(F.count(F.lit(1)).alias("rows"))
    return per_day.withColumn("action", F.when(F.col("partition_date") < F.date_sub(a, days), "drop")
                              .otherwise("keep"))


def delete_metric_days(spark: SparkSession, store: str, before: dt.date | str) -> list[dt.date]:
    """Delete the days of metrics before ``before`` from the store, for good;
    returns them.  No maintenance job does this by itself: the nightly
    retention is that of the dumps (``prune_snapshots``)."""
    from clickpulse.streaming.sink import drop_days
    return drop_days(spark, store, before if isinstance(before, dt.date) else dt.date.fromisoformat(str(before)))
