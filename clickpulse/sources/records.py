"""Read raw click records (Kafka or files) and decode them.

Kafka is the production source.  The connector jar is not always on the
classpath (it is not in the test image), so the same reader takes any file
format that carries Kafka-shaped rows and the tests drive it through files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kafka record layout (binary key / value) as the Kafka source produces it.
KAFKA_RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def kafka_options(bootstrap: str, topic: str, security_protocol: str = "PLAINTEXT",
                  sasl_mechanism: str | None = None, jaas_config: str | None = None,
                  starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                  max_offsets_per_trigger: int | None = None) -> dict:
    """Options of the Kafka source.  SASL settings are only passed when the
    protocol is a SASL one.  ``maxOffsetsPerTrigger`` bounds a micro-batch so
    a backlog after an outage is drained in steps instead of one huge batch."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if "SASL" in security_protocol.upper():
        opts["kafka.security.protocol"] = security_protocol
        if sasl_mechanism:
            opts["kafka.sasl.mechanism"] = sasl_mechanism
        if jaas_config:
            opts["kafka.sasl.jaas.config"] = jaas_config
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_sink_options(bootstrap: str, topic: str, checkpoint: str | None = None,
                       security_protocol: str = "PLAINTEXT", sasl_mechanism: str | None = None,
                       jaas_config: str | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    if "SASL" in security_protocol.upper():
        opts["kafka.security.protocol"] = security_protocol
        if sasl_mechanism:
            opts["kafka.sasl.mechanism"] = sasl_mechanism
        if jaas_config:
            opts["kafka.sasl.jaas.config"] = jaas_config
    return opts


def read_records(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None, stream: bool = True,
                 schema: T.StructType | None = None) -> DataFrame:
    """Kafka-shaped records from ``fmt`` (kafka, parquet, json, ...).

    For file formats the schema is fixed (never inferred); the default is the
    Kafka record layout so decoded output is the same whatever the source.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(schema or KAFKA_RECORD_SCHEMA)
    return reader.load(path) if path else reader.load()


def decode_records(df: DataFrame) -> DataFrame:
    """Kafka key/value bytes -> text; keep partition and offset.

    Extra columns (test labels) are carried along untouched.
    """
    extra = [c for c in df.columns if c not in ("key", "value", "partition", "offset",
                                                "topic", "timestamp", "timestampType")]
    return df.select(*extra,
                     F.col("key").cast("string").alias("msg_key"),
                     F.col("value").cast("string").alias("raw_value"),
                     F.col("partition").cast("int").alias("partition"),
                     F.col("offset").cast("bigint").alias("offset"))
