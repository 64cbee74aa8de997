"""The data contracts: event contract, dead-letter envelope, typed schemas.

The two contracts are JSON-Schema (Draft-07) documents.  They are kept as
plain dicts; ``clickpulse.functions.contract.compile_contract`` turns them
into Spark Column expressions that run on executors.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original contract for right results.
# ---------------------------------------------------------------------------
UNKNOWN_PAGE = "/unknown"
DLQ_DEFAULT_KEY = "dlq_key"

EVENT_CONTRACT = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "type": "object",
    "required": ["schema_version", "event_id", "user_id", "session_id",
                 "event_type", "timestamp"],
    "properties": {
        "schema_version": {"type": "string", "const": "1.0"},
        "event_id": {"type": "string", "format": "uuid"},
        "user_id": {"type": "string", "minLength": 1, "maxLength": 64},
        "session_id": {"type": "string", "minLength": 1, "maxLength": 64},
        "event_type": {"type": "string",
                       "enum": ["page_view", "cart_add", "purchase", "page_exit"]},
        "page_url": {"type": "string", "maxLength": 512},
        "product_id": {"type": ["string", "null"], "maxLength": 64},
        "product_category": {"type": ["string", "null"], "maxLength": 64},
        "price_inr": {"type": ["number", "null"], "minimum": 0},
        "timestamp": {"type": "string", "format": "date-time"},
    },
    "additionalProperties": False,
}

DLQ_CONTRACT = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "type": "object",
    "required": ["original_payload", "failure_reason", "validation_errors",
                 "failed_at"],
    "properties": {
        "original_payload": {"type": "string"},
        "failure_reason": {"type": "string",
                           "enum": ["schema_validation_error",
                                    "deserialization_error"]},
        "validation_errors": {"type": "array", "items": {"type": "string"}},
        "failed_at": {"type": "string", "format": "date-time"},
        "source_partition": {"type": ["integer", "null"]},
        "source_offset": {"type": ["integer", "null"]},
    },
    "additionalProperties": False,
}
# ---------------------------------------------------------------------------

SCHEMA_VERSION = EVENT_CONTRACT["properties"]["schema_version"]["const"]
EVENT_TYPES = EVENT_CONTRACT["properties"]["event_type"]["enum"]
REQUIRED_FIELDS = EVENT_CONTRACT["required"]

_SPARK_TYPES = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(),
                "array": T.ArrayType(T.StringType())}


def typed_schema(contract: dict, **other) -> T.StructType:
    """The Spark schema of a contract's properties, in their order; ``other``
    names fields with a type of their own."""
    def kind(sub):
        names = [sub["type"]] if isinstance(sub["type"], str) else sub["type"]
        return _SPARK_TYPES[next(n for n in names if n != "null")]
    return T.StructType([T.StructField(n, other.get(n) or kind(sub)) for n, sub in contract["properties"].items()])


# Typed events and dead letters as the jobs see them (never inferred).
EVENT_SCHEMA = typed_schema(EVENT_CONTRACT)
DLQ_SCHEMA = typed_schema(DLQ_CONTRACT, source_partition=T.IntegerType())

# Raw record layout after decoding a Kafka (or file) record.
RAW_SCHEMA = T.StructType([
    T.StructField("msg_key", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# The metrics table: PK (window_start, window_end, page_url), partitioned by
# the UTC day of window_start.
METRICS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("window_end", T.TimestampType(), False),
    T.StructField("page_url", T.StringType(), False),
    T.StructField("active_users", T.LongType()),
    T.StructField("cart_additions", T.LongType()),
    T.StructField("purchases", T.LongType()),
    T.StructField("cart_abandonment_rate", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])
METRICS_PK = ["window_start", "window_end", "page_url"]
PAGE_URL_MAX = 512
