"""Stream-health operators: sliding event counts and alert rules.

The rules look at the gated ingestion stream directly: how many events were
accepted or rejected in ``(t - range, t]`` at every evaluation step t.  Events
are counted per step first (map-side partial counts), and only these counts
are spread over the steps whose range they fall into, so the work after the
first aggregate grows with the number of busy steps, not with the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_S = 15  # rule evaluation interval
US = 1_000_000

# Names, severities and limits of the rules.
HIGH_REJECT, NO_PUBLISH = "HighDLQRate", "ProducerPublishRateZero"
ALERTS = {HIGH_REJECT: "critical", NO_PUBLISH: "warning"}
REJECTS_PER_SECOND, REJECT_RANGE_S, REJECT_FOR_S = 1.0, 120, 60
PUBLISH_RANGE_S, PUBLISH_FOR_S = 300, 120


def _us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _ceil_step(us: Column, step_s: int) -> Column:
    s = step_s * US
    return (F.ceil(us / F.lit(s)) * s).cast("bigint")


def step_counts(gated: DataFrame, arrival: str = "src_ts", step_s: int = STEP_S) -> DataFrame:
    """ts, accepted, rejected: gated events of ``(ts - step, ts]`` for every
    step that has any."""
    g = gated.filter(F.col("gate_status").isin("accepted", "rejected") & F.col(arrival).isNotNull())
    t = _ceil_step(_us(F.col(arrival)), step_s)
    per = g.groupBy(t.alias("t")).agg(F.count_if(F.col("gate_status") == "accepted").alias("accepted"),
                                      F.count_if(F.col("gate_status") == "rejected").alias("rejected"))
    return per.select(F.timestamp_micros("t").alias("ts"), "accepted", "rejected")


def sliding_counts(counts: DataFrame, range_s: int, step_s: int = STEP_S) -> DataFrame:
    """ts, accepted, rejected: events of ``(ts - range, ts]`` at every step
    where there are any.  ``range_s`` is a multiple of the step, so a step's
    events lie in the range of that step and of the next range / step - 1."""
    if range_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    t = _us(F.col("ts"))
    ahead = F.sequence(t, t + (range_s - step_s) * US, F.lit(step_s * US).cast("bigint"))
    e = counts.select("accepted", "rejected", F.explode(ahead).alias("t"))
    return e.groupBy("t").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")) \
        .select(F.timestamp_micros("t").alias("ts"), "accepted", "rejected")


def time_spine(counts: DataFrame, step_s: int = STEP_S) -> DataFrame:
    """Every evaluation step from the first to the last in ``counts``,
    generated per day so no single task builds the whole range."""
    b = counts.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    days = b.select("lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("d"))
    # the number is named: the days are few bytes, and would be put into one task
    days = days.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "d")
    day_lo = F.greatest(_us(F.col("lo")), _us(F.col("d").cast("timestamp")))
    day_hi = F.least(_us(F.col("hi")), _us(F.date_add("d", 1).cast("timestamp")) - 1)
    first = _ceil_step(day_lo, step_s)
    last = (F.floor(day_hi / F.lit(step_s * US)) * (step_s * US)).cast("bigint")
    steps = days.filter(last >= first).select(F.explode(F.sequence(first, last, F.lit(step_s * US).cast("bigint"))).alias("t"))
    return steps.select(F.timestamp_micros("t").alias("ts"))


def sustained(cond: DataFrame, keys: list[str], for_s: int, step_s: int = STEP_S) -> DataFrame:
    """The ``for:`` clause of a rule - firing at t when the condition held at
    every evaluation in [t - for, t].  ``cond`` holds the (keys, ts) rows where
    it was true.  Each true step is exploded onto the next for/step steps and
    a step fires when all for/step + 1 of them arrived: a parallel groupBy, no
    ordered single-partition window."""
    n = for_s // step_s
    e = cond.select(*keys, F.explode(F.sequence(_us(F.col("ts")),
                                                _us(F.col("ts")) + n * step_s * US,
                                                F.lit(step_s * US).cast("bigint"))).alias("t"))
    fired = e.groupBy(*keys, "t").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == n + 1)
    return fired.select(*keys, F.timestamp_micros("t").alias("ts"))


def _alert(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("alertname", F.lit(name)).withColumn("severity", F.lit(ALERTS[name]))


def alert_high_reject(counts: DataFrame, per_second: float = REJECTS_PER_SECOND) -> DataFrame:
    """More than ``per_second`` rejections a second over 2 min, for 1 min."""
    high = sliding_counts(counts, REJECT_RANGE_S).filter(F.col("rejected") / REJECT_RANGE_S > per_second)
    return _alert(sustained(high.select("ts"), [], REJECT_FOR_S), HIGH_REJECT)


def alert_no_publish(counts: DataFrame) -> DataFrame:
    """No accepted event in the last 5 min, for 2 min, between the first and
    the last step with any gated event."""
    some = sliding_counts(counts, PUBLISH_RANGE_S).filter(F.col("accepted") > 0).select("ts")
    quiet = time_spine(counts).join(some, "ts", "left_anti")
    return _alert(sustained(quiet, [], PUBLISH_FOR_S), NO_PUBLISH)


def alert_groups(alerts: DataFrame) -> DataFrame:
    """Firing evaluations grouped by (alertname, severity)."""
    return alerts.groupBy("alertname", "severity").agg(
        F.min("ts").alias("first_firing"), F.max("ts").alias("last_firing"),
        F.count(F.lit(1)).alias("firing_evaluations"))
