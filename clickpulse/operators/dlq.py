"""Dead-letter envelopes and their analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse import contracts as C
from clickpulse.operators.validate import error_class, with_contract_errors

FAILURE_REASON = "schema_validation_error"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def envelope_struct(raw: Column, error: Column, partition: Column, offset: Column,
                    failed_at: Column | None = None) -> Column:
    if failed_at is None:
        failed_at = F.date_format(F.current_timestamp(), ISO_UTC)
    return F.struct(
        F.coalesce(raw, F.lit("")).alias("original_payload"),
        F.lit(FAILURE_REASON).alias("failure_reason"),
        F.when(error.isNotNull() & (error != ""), F.array(error))
         .otherwise(F.array().cast("array<string>")).alias("validation_errors"),
        failed_at.alias("failed_at"),
        partition.cast("int").alias("source_partition"),
        offset.cast("bigint").alias("source_offset"),
    )


def to_dlq(df: DataFrame, failed_at: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Invalid records -> (key, value) rows for the dead-letter sink.

    ``value`` is the JSON envelope; nulls are written as JSON null
    (``ignoreNullFields=false``) so the closed envelope contract holds.
    """
    env = envelope_struct(F.col("raw_value"), F.col("validation_error"), F.col("partition"),
                          F.col("offset"), failed_at)
    return df.select(*(keep or []),
                     F.coalesce(F.col("msg_key"), F.lit(C.DLQ_DEFAULT_KEY)).alias("key"),
                     F.to_json(env, {"ignoreNullFields": "false"}).alias("value"))


def parse_dlq(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope JSON -> typed columns."""
    return df.withColumn("_env", F.from_json(F.col(value), C.DLQ_SCHEMA)).select(
        *[c for c in df.columns if c != value], "_env.*")


def validate_dlq(df: DataFrame, value: str = "value") -> DataFrame:
    """Check envelopes against the closed DLQ contract."""
    return with_contract_errors(df, C.DLQ_CONTRACT, raw=value)


def dlq_breakdown(dlq: DataFrame) -> DataFrame:
    """Dead letters by failure_reason and error class (text before ':')."""
    p = parse_dlq(dlq)
    first = F.element_at(F.col("validation_errors"), 1)
    return (p.groupBy("failure_reason", error_class(first).alias("error_class"))
             .agg(F.count(F.lit(1)).alias("dead_letters")))
