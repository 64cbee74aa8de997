"""Alert rules that run beside the job, on processing time.

Each rule is one key of a stateful operator.  Its state holds the events it
counts per evaluation step, for as many steps as its range has, and since when
its condition holds; processing-time timers evaluate it at every step, so the
rule for silence fires although nothing arrives.  Tasks count their records
before the shuffle, so a rule gets a few rows per batch.  A slow heartbeat
stream makes the rules known before the first record.

Steps that pass while no batch runs are evaluated by the next one, in order;
records count for the step in which the job takes them, as a counter that is
scraped would.  A stop of the job therefore counts as silence.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from clickpulse.operators import health as H
from clickpulse.session import ship_package


@dataclass(frozen=True)
class LiveRule:
    """``status`` events of the last ``range_s`` seconds are more than
    ``per_second`` (or, at None, there are none) at every step of ``for_s``."""
    name: str
    severity: str
    status: str
    range_s: int
    for_s: int
    per_second: float | None = None

    def holds(self, events: int) -> bool:
        return events == 0 if self.per_second is None else events / self.range_s > self.per_second


RULES = (LiveRule(H.HIGH_REJECT, H.ALERTS[H.HIGH_REJECT], "rejected", H.REJECT_RANGE_S, H.REJECT_FOR_S, H.REJECTS_PER_SECOND),
         LiveRule(H.NO_PUBLISH, H.ALERTS[H.NO_PUBLISH], "accepted", H.PUBLISH_RANGE_S, H.PUBLISH_FOR_S))

TRANSITIONS = T.StructType([T.StructField("alertname", T.StringType()), T.StructField("severity", T.StringType()),
                            T.StructField("state", T.StringType()), T.StructField("at", T.TimestampType()),
                            T.StructField("since", T.TimestampType()), T.StructField("events", T.LongType())])
PENDING, FIRING, RESOLVED = "pending", "firing", "resolved"


def _time(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).replace(tzinfo=None)


class RuleProcessor(StatefulProcessor):
    """Counts per step, and (evaluated up to, true since or -1, firing)."""

    def __init__(self, rules, step_s: int = H.STEP_S):
        self.rules, self.step = {r.name: r for r in rules}, step_s * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "step bigint", "n bigint")
        self.status = handle.getValueState("status", "evaluated bigint, since bigint, firing boolean")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        n = sum(r["n"] for r in rows)
        if n:
            step = (-(-now // self.step) * self.step,)
            known = self.counts.getValue(step)
            self.counts.updateValue(step, (n + (known[0] if known else 0),))
        if not self.status.exists():
            begin = now // self.step * self.step
            self.status.update((begin, -1, False))
            self.handle.registerTimer(begin + self.step)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        rule = self.rules.get(key[0])
        if rule is None:  # a rule that a restart no longer has
            self.counts.clear()
            self.status.clear()
            return
        until = timerValues.getCurrentProcessingTimeInMs() // self.step * self.step
        evaluated, since, firing = self.status.get()
        counts = {k[0]: v[0] for k, v in self.counts.iterator()}
        for at in range(evaluated + self.step, until + 1, self.step):
            events = sum(n for s, n in counts.items() if at - rule.range_s * 1000 < s <= at)
            state = None
            if rule.holds(events):
                if since < 0:
                    since, state = at, PENDING
                if not firing and at - since >= rule.for_s * 1000:
                    firing, state = True, FIRING
            elif since >= 0:
                state = RESOLVED if firing else None
                began, since, firing = since, -1, False
                if state:
                    yield self._row(rule, state, at, began, events)
                continue
            if state:
                yield self._row(rule, state, at, since, events)
        for s in counts:
            if s <= until - rule.range_s * 1000:
                self.counts.removeKey((s,))
        self.status.update((max(evaluated, until), since, firing))
        self.handle.registerTimer(max(evaluated, until) + self.step)

    @staticmethod
    def _row(rule, state, at, since, events):
        from pyspark.sql import Row
        return Row(alertname=rule.name, severity=rule.severity, state=state, at=_time(at), since=_time(since), events=events)

    def close(self) -> None:
        pass


def _tally(batches):
    """Records per gate status, one row for each in a batch."""
    for b in batches:
        found = pc.value_counts(b.column(0).cast(pa.string()))
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["status", "n"])


def rule_inputs(gated: DataFrame, rules=RULES) -> DataFrame:
    """alertname, n: how many records of a rule's status a task has met."""
    ship_package(gated.sparkSession)
    table = F.array(*[F.struct(F.lit(r.status).alias("s"), F.lit(r.name).alias("alertname")) for r in rules])
    counted = gated.select("gate_status").mapInArrow(_tally, "status string, n bigint")
    named = counted.select(F.explode(F.filter(table, lambda r: r["s"] == F.col("status"))).alias("r"), "n")
    return named.select("r.alertname", "n")


def heartbeat(spark: SparkSession, rules=RULES) -> DataFrame:
    """Every rule, once a second, with nothing to count."""
    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return beat.select(F.explode(F.array(*[F.lit(r.name) for r in rules])).alias("alertname"), F.lit(0).cast("long").alias("n"))


def alert_transitions(gated: DataFrame, rules=RULES, step_s: int = H.STEP_S) -> DataFrame:
    """A stream of what becomes of each rule: pending, firing, resolved, the
    evaluation at which it did, since when the condition holds or held, and
    the events in range."""
    inputs = rule_inputs(gated, rules).unionByName(heartbeat(gated.sparkSession, rules))
    return inputs.groupBy("alertname").transformWithState(RuleProcessor(rules, step_s), TRANSITIONS, "Append", "ProcessingTime")


def start_alerts(gated: DataFrame, path: str, checkpoint: str, rules=RULES, step_s: int = H.STEP_S,
                 trigger: dict | None = None, name: str = "clickpulse-alerts") -> StreamingQuery:
    """Run the rules; transitions are appended to the table at ``path``, each
    once.  Rules and pending times go on after a restart on ``checkpoint``."""
    return alert_transitions(gated, rules, step_s).writeStream.format("parquet").queryName(name).outputMode("append") \
        .option("path", path).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"processingTime": f"{step_s} seconds"})).start()


def current_alerts(transitions: DataFrame) -> DataFrame:
    """Rules that are pending or firing after the transitions so far."""
    last = transitions.groupBy("alertname").agg(F.max_by(F.struct("severity", "state", "at", "since", "events"),
                                                         F.struct("at", F.col("state") != PENDING)).alias("t"))
    return last.select("alertname", "t.*").filter(F.col("state") != RESOLVED)
