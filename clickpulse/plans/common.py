"""Shared pipeline stages for registered queries (lazy DataFrames)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.metrics import events_pipeline, page_metrics
from clickpulse.operators.validate import with_stream_validation, with_contract_errors, accept_gate
from clickpulse.fixtures import load_raw

LABELS = ["src_id", "cls", "src_ts"]


def ensure_settings(spark: SparkSession) -> None:
    """Settings that the results depend on."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.variant.allowDuplicateKeys", "true")):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_settings(spark)
    return load_raw(spark, sf_dir)


def validated(spark, sf_dir) -> DataFrame:
    return with_stream_validation(raw(spark, sf_dir))


def contract(spark, sf_dir) -> DataFrame:
    return with_contract_errors(raw(spark, sf_dir))


def gated(spark, sf_dir) -> DataFrame:
    return accept_gate(raw(spark, sf_dir))


def events(spark, sf_dir) -> DataFrame:
    return events_pipeline(raw(spark, sf_dir), keep=LABELS + ["msg_key", "partition", "offset"])


def metrics(spark, sf_dir, length="60 seconds", slide="10 seconds", distinct="exact",
            strategy="expand", updated_at="event_time") -> DataFrame:
    """Exact page metrics; ``updated_at`` derived deterministically as the
    newest event time of the group (the live sink stamps wall-clock time)."""
    return page_metrics(events(spark, sf_dir), length, slide, distinct=distinct,
                        strategy=strategy, updated_at=updated_at)


def ntz(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = col.cast("timestamp_ntz")
    return out.alias(name or (c if isinstance(c, str) else "ts"))


def r6(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or (c if isinstance(c, str) else "x"))
