"""Dashboard (serving) queries over the metrics table.

Each takes the metrics table as readers see it (one row per PK; see
``streaming.sink.latest_metrics``) and returns a small result.  ``as_of``
replaces the dashboards' ``now()`` so results are reproducible; it may be a
literal or a Column (for example a scalar subquery).  ``t_from``/``t_to``
replace the dashboard time filter; the default range is the dashboards'
30 minutes before ``as_of``.

"Latest window" is the newest window that has ENDED at ``as_of``.  Its panels
take one pass: one aggregate per ``window_end``, of which the newest stays.

When the table comes from the store (``streaming.sink.read_metrics``), it is
partitioned by ``window_date``, the day of ``window_start``, and the column's
metadata names the window length and the days there are.  From these follow
exact bounds on ``window_date`` that prune the scan, whatever the length of a
window; without the length, a partitioned table is an error, not a guess.
The metadata also holds the store's zone map, least and greatest ``updated_at``
of every day: freshness is read from it alone, and the panels on ``updated_at``
read only the days it cannot rule out.  (An update never takes a row's time
back, so the greatest time of a day's files is that of its rows.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_RANGE = dt.timedelta(minutes=30)


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("timestamp")


def _zones(metrics: DataFrame) -> list[dict] | None:
    """The store's zone map: day, lo, hi (microseconds) and rows (at least)."""
    if "window_date" not in metrics.columns:
        return None
    return metrics.schema["window_date"].metadata.get("zones") or None


def _micros(x) -> int | None:
    """A literal time in microseconds; None for a Column."""
    if x is None or isinstance(x, Column):
        return None
    t = x if isinstance(x, dt.datetime) else dt.datetime.fromisoformat(str(x))
    t = t.replace(tzinfo=dt.timezone.utc) if t.tzinfo is None else t
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def _updated_within(metrics: DataFrame, lo: int | None, hi: int | None) -> DataFrame:
    """The days that may hold an ``updated_at`` of [lo, hi]."""
    zones = _zones(metrics)
    if zones is None or (lo is None and hi is None):
        return metrics
    days = [z["day"] for z in zones if (lo is None or z["hi"] >= lo) and (hi is None or z["lo"] <= hi)]
    if len(days) == len(zones):
        return metrics
    if not days:
        return metrics.filter(F.lit(False))
    return metrics.filter(F.col("window_date").isin([dt.date.fromisoformat(d) for d in days]))


def as_of_default(metrics: DataFrame) -> Column:
    """Newest update in the table: from the zone map, or a scalar subquery."""
    if zones := _zones(metrics):
        return F.timestamp_micros(F.lit(max(z["hi"] for z in zones)))
    return metrics.select(F.max("updated_at")).scalar()


def _as_of(metrics: DataFrame, as_of) -> Column:
    return as_of_default(metrics) if as_of is None else _ts(as_of)


def _facts(metrics: DataFrame) -> dict | None:
    """Window length (seconds) and days of a store; None without partitions."""
    if "window_date" not in metrics.columns:
        return None
    facts = metrics.schema["window_date"].metadata
    if not facts.get("window_seconds"):
        raise ValueError("the table is partitioned by window_date but names no window length; "
                         "read it with read_metrics, or name it with with_store_facts")
    return facts


def _prune(metrics: DataFrame, lo: Column | None, hi: Column | None) -> DataFrame:
    """Add the ``window_date`` range implied by window_end bounds: a window
    starts its length before it ends."""
    facts = _facts(metrics)
    if facts is None:
        return metrics
    cond = F.lit(True)
    if lo is not None:
        first = lo - F.make_dt_interval(secs=F.lit(facts["window_seconds"]))
        cond = cond & (F.col("window_date") >= F.to_date(first))
    if hi is not None:
        cond = cond & (F.col("window_date") <= F.to_date(hi))
    return metrics.filter(cond)


def _ended(metrics: DataFrame, as_of) -> DataFrame:
    """The windows that ended at ``as_of``, at least back to the newest.  All
    windows of a day have ended one window length after its midnight, so the
    newest such day that the store holds bounds the newest ended window."""
    a = _as_of(metrics, as_of)
    facts = _facts(metrics)
    if facts and facts.get("days") and not isinstance(as_of, Column) and as_of is not None:
        now = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None) if now.tzinfo else now
        span = dt.timedelta(days=1, seconds=facts["window_seconds"])
        over = [d for d in facts["days"] if dt.datetime.fromisoformat(d) + span <= now]
        if over:
            metrics = metrics.filter(F.col("window_date") >= F.lit(max(over)).cast("date"))
    return _prune(metrics, None, a).filter(F.col("window_end") <= a)


def _of_latest(metrics: DataFrame, as_of, *values: Column) -> DataFrame:
    """One row of aggregates over the latest window, or none."""
    per = _ended(metrics, as_of).groupBy("window_end").agg(*values)
    return per.orderBy(F.col("window_end").desc()).limit(1)


def latest_window_end(metrics: DataFrame, as_of=None) -> Column:
    return _ended(metrics, as_of).select(F.max("window_end")).scalar()


def latest_window(metrics: DataFrame, as_of=None) -> DataFrame:
    """All rows of the latest window."""
    return _ended(metrics, as_of).filter(F.col("window_end") == latest_window_end(metrics, as_of))


def _range(metrics: DataFrame, col: str, as_of=None, t_from=None, t_to=None,
           whole: bool = False) -> DataFrame:
    hi = _ts(t_to) if t_to is not None else _as_of(metrics, as_of)
    if col == "updated_at":
        end = _micros(t_to if t_to is not None else as_of)
        if end is None and t_to is None and as_of is None and _zones(metrics):
            end = max(z["hi"] for z in _zones(metrics))
        begin = _micros(t_from) if t_from is not None else None if whole or end is None else end - DEFAULT_RANGE // dt.timedelta(microseconds=1)
        metrics = _updated_within(metrics, begin, end)
    if whole and t_from is None:
        return metrics.filter(F.col(col) <= hi)
    lo = _ts(t_from) if t_from is not None else hi - F.expr("INTERVAL 30 MINUTES")
    m = _prune(metrics, lo, hi) if col.startswith("window") else metrics
    return m.filter(F.col(col).between(lo, hi))


# -- executive dashboard ----------------------------------------------------

def _latest_sum(metrics: DataFrame, as_of, column: str, name: str) -> DataFrame:
    one = _of_latest(metrics, as_of, F.sum(column).alias("n"))
    return one.agg(F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias(name))


def latest_active_users(metrics: DataFrame, as_of=None) -> DataFrame:
    """Sum over pages of active users in the latest window (a user on two
    pages counts twice, as the panel title says)."""
    return _latest_sum(metrics, as_of, "active_users", "users")


def latest_cart_adds(metrics: DataFrame, as_of=None) -> DataFrame:
    return _latest_sum(metrics, as_of, "cart_additions", "cart_adds")


def latest_purchases(metrics: DataFrame, as_of=None) -> DataFrame:
    return _latest_sum(metrics, as_of, "purchases", "purchases")


def _ratio(adds: Column, purchases: Column) -> Column:
    """(adds - purchases) / nullif(adds, 0) as double; null when adds = 0."""
    return F.try_divide((adds - purchases).cast("double"), F.nullif(adds, F.lit(0)))


def latest_abandonment(metrics: DataFrame, as_of=None) -> DataFrame:
    one = _of_latest(metrics, as_of, _ratio(F.sum("cart_additions"), F.sum("purchases")).alias("r"))
    return one.agg(F.coalesce(F.max("r"), F.lit(0.0)).alias("abandonment"))


def funnel_series(metrics: DataFrame, as_of=None, t_from=None, t_to=None, whole=False) -> DataFrame:
    r = _range(metrics, "window_end", as_of, t_from, t_to, whole)
    return (r.groupBy(F.col("window_end").alias("time"))
             .agg(F.sum("cart_additions").cast("bigint").alias("cart_additions"),
                  F.sum("purchases").cast("bigint").alias("purchases"))
             .orderBy("time"))


def abandonment_trend(metrics: DataFrame, as_of=None, t_from=None, t_to=None, whole=False) -> DataFrame:
    """Per window_end; null when no cart additions (no coalesce, unlike the stat)."""
    r = _range(metrics, "window_end", as_of, t_from, t_to, whole)
    return (r.groupBy(F.col("window_end").alias("time"))
             .agg(_ratio(F.sum("cart_additions"), F.sum("purchases")).alias("abandonment"))
             .orderBy("time"))


def top_pages(metrics: DataFrame, as_of=None, n: int = 15) -> DataFrame:
    """Latest window's pages by active users (page_url breaks ties so the
    top-k is deterministic).  The newest window's rows come first in one
    top-k; where it has fewer than ``n`` pages, older rows fill up and go."""
    best = _ended(metrics, as_of).select("window_end", "page_url", "active_users", "cart_additions", "purchases",
                                         F.round("cart_abandonment_rate", 3).alias("abandonment")) \
        .orderBy(F.col("window_end").desc(), F.col("active_users").desc(), F.col("page_url")).limit(n)
    newest = F.max("window_end").over(Window.partitionBy())  # over at most n rows
    return best.withColumn("newest", newest).filter("window_end = newest").drop("newest", "window_end") \
        .orderBy(F.col("active_users").desc(), F.col("page_url"))


# -- engineering dashboard --------------------------------------------------

def freshness_seconds(metrics: DataFrame, as_of=None) -> DataFrame:
    """Seconds since the newest update; with a zone map no row is read."""
    a = _as_of(metrics, as_of)
    if zones := _zones(metrics):
        lag = (F.unix_micros(a) - F.lit(max(z["hi"] for z in zones))) / 1e6
        return metrics.sparkSession.range(1).select(lag.alias("seconds"))
    lag = (F.unix_micros(a) - F.unix_micros(F.max("updated_at"))) / 1e6
    return metrics.agg(F.coalesce(lag, F.lit(0.0)).alias("seconds"))


def latest_page_count(metrics: DataFrame, as_of=None) -> DataFrame:
    one = _of_latest(metrics, as_of, F.count(F.lit(1)).alias("n"))
    return one.agg(F.coalesce(F.max("n"), F.lit(0)).alias("pages"))


def rows_last_24h(metrics: DataFrame, as_of=None) -> DataFrame:
    a = _as_of(metrics, as_of)
    lo = a - F.expr("INTERVAL 24 HOURS")
    if _facts(metrics):
        metrics = metrics.filter(F.col("window_date") >= F.to_date(lo))
    return metrics.filter(F.col("window_start") > lo).agg(F.count(F.lit(1)).alias("rows"))


def upserts_per_minute(metrics: DataFrame, as_of=None, t_from=None, t_to=None, whole=False) -> DataFrame:
    """Rows by the minute of their LAST update (so it undercounts upserts
    that were later overwritten - as the panel does)."""
    r = _range(metrics, "updated_at", as_of, t_from, t_to, whole)
    return (r.groupBy(F.date_trunc("minute", "updated_at").alias("time"))
             .agg(F.count(F.lit(1)).alias("rows")).orderBy("time"))


def pages_per_window(metrics: DataFrame, as_of=None, t_from=None, t_to=None, whole=False) -> DataFrame:
    r = _range(metrics, "window_end", as_of, t_from, t_to, whole)
    return (r.groupBy(F.col("window_end").alias("time"))
             .agg(F.count_distinct("page_url").alias("pages")).orderBy("time"))


def recent_upserts(metrics: DataFrame, n: int = 5) -> DataFrame:
    """Operator check: the ``n`` most recently updated rows (PK breaks ties).
    With a zone map, days are taken from the newest down until they hold ``n``
    rows; a day whose newest update is older than all of theirs is not read."""
    have, least = 0, None
    for z in sorted(_zones(metrics) or [], key=lambda z: (-z["hi"], z["day"])):
        if have >= n:
            break
        have, least = have + z["rows"], z["lo"] if least is None else min(least, z["lo"])
    if have >= n:
        metrics = _updated_within(metrics, least, None)
    return metrics.orderBy(F.col("updated_at").desc(), F.col("window_start").desc(),
                           F.col("window_end").desc(), F.col("page_url")).limit(n)
