"""What a stopped stream keeps: its state stores, read as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: operatorId, operatorName,
    stateStoreName, numPartitions, minBatchId, maxBatchId."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None,
               batch: int | None = None) -> DataFrame:
    """partition_id, key and value of the state as the last batch (or ``batch``)
    left it; ``variable`` names a state variable of a stateful processor."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def _size(rows: DataFrame):
    """Bytes of a row's key and value in their row format, about: 8 for each
    field, and the length of text and binary ones."""
    parts, total = [c for c in ("key", "value", "user_map_key", "user_map_value", "list_element") if c in rows.columns], F.lit(0).cast("bigint")
    for c in parts:
        for f in rows.schema[c].dataType.fields:
            total = total + 8
            if f.dataType.simpleString() in ("string", "binary"):
                total = total + F.coalesce(F.octet_length(F.col(f"`{c}`.`{f.name}`")), F.lit(0))
    return total.alias("size")


def state_by_partition(rows: DataFrame) -> DataFrame:
    """State rows and bytes per partition: uneven ones show a hot key."""
    return rows.select("partition_id", _size(rows)).groupBy("partition_id") \
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).orderBy(F.col("bytes").desc(), "partition_id")


def state_by_page(rows: DataFrame, n: int | None = None) -> DataFrame:
    """State rows and bytes per page, the hottest first."""
    page = next(f.name for f in rows.schema["key"].dataType.fields if f.dataType.simpleString() == "string")
    out = rows.select(F.col(f"key.`{page}`").alias("page_url"), _size(rows)).groupBy("page_url") \
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).orderBy(F.col("bytes").desc(), "page_url")
    return out if n is None else out.limit(n)


def open_windows(rows: DataFrame) -> DataFrame:
    """window_start, window_end and page_url of a windowed aggregate's state."""
    fields = rows.schema["key"].dataType.fields
    window = next(f.name for f in fields if f.dataType.typeName() == "struct")
    page = next(f.name for f in fields if f.dataType.simpleString() == "string")
    w = F.col(f"key.`{window}`")
    return rows.select(w["start"].alias("window_start"), w["end"].alias("window_end"), F.col(f"key.`{page}`").alias("page_url"))
