"""The metrics store: idempotent sink, incremental compaction, pruned reads.

Layout under ``<root>``::

    changelog/run=<r>/batch_id=<n>/window_date=<d>/part-*.parquet
    zones/run=<r>/batch_id=<n>.json                       zone map of a batch
    quarantine/run=<r>/batch_id=<n>/part-*.parquet        rows the table cannot hold
    returned/version=<v>/window_date=<d>/part-*.parquet   rows that came back from quarantine
    table/version=<v>/window_date=<d>/part-*.parquet      compacted days
    manifest/<v>.json                                     what version v consists of

Each micro-batch overwrites its own ``run/batch_id`` directory, so a retried
or replayed batch replaces what it wrote before; the run id is kept beside the
stream's checkpoint, so a restart goes on with the same one.  A manifest names
the version of every compacted day, the batches that are folded into them and
the window length.  ``compact_metrics`` folds the newer batches only, writes
new versions of the days they touch, and then the next manifest; a reader
sees the old manifest or the new one.  Files that a manifest no longer names
are deleted by the next compaction, so a reader that is under way keeps its
files.  A row keeps the version of the batch that wrote it, so a row that
returns late never overwrites a newer one.  The zone map names the least and
greatest ``updated_at`` of every day (and a least number of its rows), from
which panels on ``updated_at`` prune days.  Rows never pass through the driver;
what it lists is directory names (one per batch that is not folded yet, and one
per day) and the zones.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse import contracts as C

VALUE_COLS = ["active_users", "cart_additions", "purchases", "cart_abandonment_rate", "updated_at"]
#: A batch's version is ``run * RUN_STEP + batch_id + 1``.
RUN_STEP = 1 << 40
#: Rows that a task writes of a day of a batch, about.
ROWS_PER_WRITER = 500_000


# -- files of the store ------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write a small file whole: to a hidden name first, then renamed."""
    folder, name = path.rsplit("/", 1)
    fs, tmp, jvm = _fs(spark, f"{folder}/.{name}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    to = jvm.org.apache.hadoop.fs.Path(path)
    if replace:
        fs.delete(to, False)
    if not fs.rename(tmp, to):
        raise IOError(f"{path} exists already: two compactions at the same time?")


_EMPTY = {"version": 0, "days": {}, "folded": {}, "window_seconds": None, "garbage": [], "zones": {}, "returned": [], "replayed": []}


def manifest(spark: SparkSession, root: str) -> dict:
    """The newest manifest; an empty store has version 0."""
    versions = [int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in _names(spark, f"{root}/manifest")) if m]
    if not versions:
        return dict(_EMPTY)
    return {**_EMPTY, **json.loads(_read_text(spark, f"{root}/manifest/{max(versions)}.json"))}


def _batches(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """(run, batch) of every directory of the changelog."""
    runs = [n for n in _names(spark, f"{root}/changelog") if n.startswith("run=")]
    return sorted((int(r[4:]), int(b[9:])) for r in runs for b in _names(spark, f"{root}/changelog/{r}")
                  if b.startswith("batch_id="))


def open_batches(spark: SparkSession, root: str, state: dict) -> list[tuple[int, int]]:
    """(run, batch) of the changelog that the manifest has not folded."""
    return [(r, b) for r, b in _batches(spark, root) if b > state["folded"].get(str(r), -1)]


def run_id(spark: SparkSession, root: str, checkpoint: str) -> int:
    """The run id of a checkpoint: the one it was given at its first start, or
    now one above every run that the store has seen.  No clock is involved."""
    place = f"{checkpoint.rstrip('/')}/run_id"
    known = _read_text(spark, place)
    if known is not None:
        return int(known)
    seen = [int(n[4:]) for n in _names(spark, f"{root}/changelog") if n.startswith("run=")]
    run = max([0, *seen, *map(int, manifest(spark, root)["folded"])]) + 1
    _write_text(spark, place, str(run))
    return run


# -- writing -----------------------------------------------------------------

def to_table_rows(metrics: DataFrame) -> DataFrame:
    """Metrics rows in table shape: PK + values + ``window_date`` (UTC day of
    window_start).  ``updated_at`` is the write time unless the input already
    carries one."""
    m = metrics
    if "updated_at" not in m.columns:
        m = m.withColumn("updated_at", F.current_timestamp())
    return m.select(*C.METRICS_PK, "active_users", "cart_additions", "purchases",
                    "cart_abandonment_rate", "updated_at",
                    F.to_date("window_start").alias("window_date"))


class MetricsSink:
    """``foreachBatch`` callable: ``writeStream.foreachBatch(MetricsSink(root, run))``.
    Failures propagate so Spark retries the batch.  With ``compact_every`` the
    changelog is folded after every so many batches, so it stays short."""

    def __init__(self, root: str, run: int, calendar: DataFrame | None = None, compact_every: int | None = None):
        self.root, self.run, self.calendar, self.compact_every = root.rstrip("/"), run, calendar, compact_every

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        upsert_metrics(batch_df, batch_id, self.root, self.run, self.calendar)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            compact_metrics(batch_df.sparkSession, self.root)


def upsert_metrics(batch_df: DataFrame, batch_id: int, root: str, run: int = 1,
                   calendar: DataFrame | None = None) -> bool:
    """Write one micro-batch of metrics idempotently; False for an empty batch.

    Rows that no partition of ``calendar`` (none: any day) takes, or whose
    page_url is too long, go to the quarantine with a reason instead of failing
    the batch.  The batch is persisted so that the two writes and the
    emptiness check share one evaluation of the stateful plan.
    """
    from clickpulse.streaming.storage import routing_reason
    rows = routing_reason(to_table_rows(batch_df), calendar).persist()
    try:
        zones, n_bad = {}, 0
        for r in _zones_of(rows, "reason").collect():
            if r["reason"]:
                n_bad += r["rows"]
            else:
                zones[str(r["window_date"])] = [r["lo"], r["hi"], r["rows"]]
        if not zones and not n_bad:
            return False
        at = f"run={run}/batch_id={batch_id}"
        good = rows.filter(F.col("reason").isNull()).drop("reason")
        # a day has as many writers as its rows need
        many = {d: -(-z[2] // ROWS_PER_WRITER) for d, z in zones.items()}
        more = F.create_map(*[F.lit(x) for d, n in many.items() if n > 1 for x in (d, n)]) if max(many.values(), default=1) > 1 else None
        n = F.lit(1) if more is None else F.coalesce(F.try_element_at(more, F.col("window_date").cast("string")), F.lit(1))
        (good.repartition(max(1, sum(many.values())), "window_date", F.pmod(F.hash("page_url"), n))
             .sortWithinPartitions(*C.METRICS_PK)
             .write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("window_date").parquet(f"{root}/changelog/{at}"))
        _write_text(batch_df.sparkSession, f"{root}/zones/{at}.json", json.dumps(zones), replace=True)
        if n_bad:
            rows.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{root}/quarantine/{at}")
        return True
    finally:
        rows.unpersist()


def _zones_of(rows: DataFrame, *more: str) -> DataFrame:
    """Per day: least and greatest ``updated_at`` (microseconds), and the rows."""
    us = F.unix_micros("updated_at")
    return rows.groupBy("window_date", *[F.col(c).isNotNull().alias(c) for c in more]).agg(
        F.min(us).alias("lo"), F.max(us).alias("hi"), F.count("*").alias("rows"))


# -- reading -----------------------------------------------------------------

def latest_metrics(changelog: DataFrame, version: str = "version", keep: str | None = None) -> DataFrame:
    """One row per PK: the values of the largest ``version`` (a BIGINT), which
    goes on as the column ``keep``.

    ``max_by`` per fixed-width value keeps every aggregate buffer fixed-width:
    a hash aggregate - no sort, no single-task group, as a key has a row per
    version.  Few keys have more than one, so the rows are dealt out by key
    first and a task that scans holds none of them.  ``window_date`` follows
    from the key and is grouped along, so that a filter on it reaches the
    scans below.
    """
    keys = [*C.METRICS_PK, *(["window_date"] if "window_date" in changelog.columns else [])]
    vals = [c for c in changelog.columns if c not in (*keys, version)]
    return changelog.repartition(*keys).groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in vals],
                                        *([F.max(version).alias(keep)] if keep else []))


def _batch_version(run: int | Column, batch: int | Column):
    return run * RUN_STEP + batch + 1


def _table_paths(root: str, state: dict, days=None) -> list[str]:
    return [f"{root}/table/version={v}/window_date={d}" for d, v in sorted(state["days"].items())
            if days is None or d in days]


_STORED = "window_start timestamp, window_end timestamp, page_url string, active_users bigint, cart_additions bigint, " \
          "purchases bigint, cart_abandonment_rate double, updated_at timestamp, {}window_date date"


def _parts(spark: SparkSession, root: str, state: dict, batches: list[tuple[int, int]], days=None) -> list[DataFrame]:
    cols = [*C.METRICS_PK, *VALUE_COLS, "window_date"]
    written = F.coalesce("written", F.lit(0).cast("bigint")).alias("version")
    out = []
    back = [f"{root}/returned/version={v}/window_date={d}" for v in state["returned"] for d in _returned_days(spark, root, v)
            if days is None or d in days]
    for folder, paths in (("table", _table_paths(root, state, days)), ("returned", back)):
        if paths:
            t = spark.read.schema(_STORED.format("written bigint, version bigint, ")).option("basePath", f"{root}/{folder}").parquet(*paths)
            out.append(t.select(*cols, written))
    if batches:
        log = spark.read.schema(_STORED.format("run bigint, batch_id bigint, ")).option("basePath", f"{root}/changelog") \
            .parquet(*[f"{root}/changelog/run={r}/batch_id={b}" for r, b in batches])
        out.append(log.select(*cols, _batch_version(F.col("run"), F.col("batch_id")).alias("version")))
    return out


def _returned_days(spark: SparkSession, root: str, version: int) -> list[str]:
    return [n[12:] for n in _names(spark, f"{root}/returned/version={version}") if n.startswith("window_date=")]


def _union(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def store_zones(spark: SparkSession, root: str, state: dict, batches: list[tuple[int, int]]) -> dict | None:
    """Per day: least and greatest ``updated_at`` of any of its parts, and the
    rows of its largest part (it has that many at least).  None if the zones of
    a part are not known."""
    if set(state["days"]) - set(state["zones"]):
        return None
    parts = [state["zones"]]
    for path in [f"zones/run={r}/batch_id={b}.json" for r, b in batches] + [f"zones/returned={v}.json" for v in state["returned"]]:
        text = _read_text(spark, f"{root}/{path}")
        if text is None:
            return None
        parts.append(json.loads(text))
    out: dict = {}
    for part in parts:
        for d, (lo, hi, n) in part.items():
            a = out.get(d, (lo, hi, n))
            out[d] = (min(a[0], lo), max(a[1], hi), max(a[2], n))
    return out


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The metrics table as dashboards see it: the compacted days and the
    batches after them, latest-wins per PK.

    ``window_date`` is a partition column of both, so a filter on it prunes
    both scans.  Its metadata carries what the serving queries need to make
    such filters: the window length and the days the store holds.
    """
    root = root.rstrip("/")
    state = manifest(spark, root)
    batches = open_batches(spark, root, state)
    parts = _parts(spark, root, state, batches)
    if not parts:
        return spark.createDataFrame([], _STORED.format(""))
    days = sorted({*state["days"], *(d for b in batches for d in _batch_days(spark, root, b)),
                   *(d for v in state["returned"] for d in _returned_days(spark, root, v))})
    length = state["window_seconds"] or _window_seconds(parts[-1])
    return with_store_facts(latest_metrics(_union(parts)), length, days, store_zones(spark, root, state, batches))


def with_store_facts(metrics: DataFrame, window_seconds: int | None, days: list[str] | None = None,
                     zones: dict | None = None) -> DataFrame:
    """``metrics`` with the facts that serving queries prune by: the window
    length, the days there are, and per day least and greatest ``updated_at``
    and a least number of rows."""
    listed = [{"day": d, "lo": z[0], "hi": z[1], "rows": z[2]} for d, z in sorted((zones or {}).items())] or None
    facts = {k: v for k, v in (("window_seconds", window_seconds), ("days", days), ("zones", listed)) if v is not None}
    return metrics.withMetadata("window_date", facts)


def _batch_days(spark: SparkSession, root: str, batch: tuple[int, int]) -> list[str]:
    names = _names(spark, f"{root}/changelog/run={batch[0]}/batch_id={batch[1]}")
    return [n[12:] for n in names if n.startswith("window_date=")]


def _window_seconds(rows: DataFrame) -> int | None:
    """The longest window of a part of the store."""
    return rows.agg(F.max((F.unix_micros("window_end") - F.unix_micros("window_start")) / 1_000_000).cast("bigint")).first()[0]


# -- compaction --------------------------------------------------------------

def compact_metrics(spark: SparkSession, root: str) -> list[dt.date]:
    """Fold the batches that are not folded yet into new versions of the days
    they touch; other days keep their files.  Returns the days rewritten."""
    root = root.rstrip("/")
    state = manifest(spark, root)
    batches = open_batches(spark, root, state)
    touched = sorted({*(d for b in batches for d in _batch_days(spark, root, b)),
                      *(d for v in state["returned"] for d in _returned_days(spark, root, v))})
    for path in state["garbage"]:  # named by no manifest since the last compaction
        _delete(spark, f"{root}/{path}")
    for run, batch in set(_batches(spark, root)) - set(batches):  # folded, then replayed: the same rows again
        _delete(spark, f"{root}/changelog/run={run}/batch_id={batch}")
        _delete(spark, f"{root}/zones/run={run}/batch_id={batch}.json")
    if not batches and not state["garbage"] and not state["returned"]:
        return []
    version, days, garbage, zones = state["version"] + 1, dict(state["days"]), [], dict(state["zones"])
    length = state["window_seconds"]
    if touched:
        parts = _parts(spark, root, state, batches, set(touched))
        # a part that this version's failed attempt left is replaced whole
        (latest_metrics(_union(parts), keep="written").hint("rebalance", "window_date").sortWithinPartitions(*C.METRICS_PK)
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("window_date").parquet(f"{root}/table/version={version}"))
        length = max(length or 0, _window_seconds(parts[-1]) or 0) or None
        zones.update(_table_zones(spark, root, version))
        for d in touched:
            if d in days:
                garbage.append(f"table/version={days[d]}/window_date={d}")
            days[d] = version
    garbage += [kind.format(v) for v in state["returned"] for kind in ("returned/version={}", "zones/returned={}.json")]
    folded = dict(state["folded"])
    for run, batch in batches:
        folded[str(run)] = max(batch, folded.get(str(run), -1))
        garbage += [f"changelog/run={run}/batch_id={batch}", f"zones/run={run}/batch_id={batch}.json"]
    _publish(spark, root, {**state, "version": version, "days": days, "folded": folded, "window_seconds": length,
                           "garbage": garbage, "zones": zones, "returned": []})
    return [dt.date.fromisoformat(d) for d in touched]


def _table_zones(spark: SparkSession, root: str, version: int) -> dict:
    """Zones of the days that a version of the table holds."""
    at = f"{root}/table/version={version}"
    if not _names(spark, at):
        return {}
    rows = spark.read.schema("updated_at timestamp, window_date date").parquet(at)
    return {str(r["window_date"]): [r["lo"], r["hi"], r["rows"]] for r in _zones_of(rows).collect()}


def _publish(spark, root, state: dict) -> None:
    version = state["version"]
    _write_text(spark, f"{root}/manifest/{version}.json", json.dumps(state))
    for n in _names(spark, f"{root}/manifest"):
        m = re.fullmatch(r"(\d+)\.json", n)
        if m and int(m[1]) < version - 1:
            _delete(spark, f"{root}/manifest/{n}")


def drop_days(spark: SparkSession, root: str, before: dt.date) -> list[dt.date]:
    """Days of metrics before ``before`` leave the store for good, from the
    table and from the changelog (which is folded first, so that no later
    compaction brings them back).  Returns the days dropped."""
    root = root.rstrip("/")
    compact_metrics(spark, root)
    state = manifest(spark, root)
    gone = sorted(d for d in state["days"] if dt.date.fromisoformat(d) < before)
    if gone:
        garbage = state["garbage"] + [f"table/version={state['days'][d]}/window_date={d}" for d in gone]
        _publish(spark, root, {**state, "version": state["version"] + 1, "garbage": garbage,
                               **{k: {d: v for d, v in state[k].items() if d not in gone} for k in ("days", "zones")}})
    return [dt.date.fromisoformat(d) for d in gone]


def replace_all(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """The store holds ``rows`` (table shape) and nothing else; batches written
    so far count as folded."""
    root = root.rstrip("/")
    state = manifest(spark, root)
    version = state["version"] + 1
    newest = max([0, *(_batch_version(r, b) for r, b in _batches(spark, root)),
                  *(_batch_version(int(r), b) for r, b in state["folded"].items())])
    (rows.select(*C.METRICS_PK, *VALUE_COLS, F.to_date("window_start").alias("window_date"), F.lit(newest).cast("bigint").alias("written"))
        .hint("rebalance", "window_date").sortWithinPartitions(*C.METRICS_PK)
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("window_date").parquet(f"{root}/table/version={version}"))
    days = [n[12:] for n in _names(spark, f"{root}/table/version={version}") if n.startswith("window_date=")]
    folded, garbage = dict(state["folded"]), list(state["garbage"])
    for run, batch in open_batches(spark, root, state):
        folded[str(run)] = max(batch, folded.get(str(run), -1))
        garbage += [f"changelog/run={run}/batch_id={batch}", f"zones/run={run}/batch_id={batch}.json"]
    garbage += [kind.format(v) for v in state["returned"] for kind in ("returned/version={}", "zones/returned={}.json")]
    garbage += [f"table/version={v}/window_date={d}" for d, v in state["days"].items()]
    length = _window_seconds(rows) or state["window_seconds"]
    _publish(spark, root, {**state, "version": version, "days": {d: version for d in days}, "folded": folded, "window_seconds": length,
                           "garbage": garbage, "zones": _table_zones(spark, root, version), "returned": []})
