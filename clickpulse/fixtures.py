"""Fixtures: the driver's ``events`` table -> Kafka-shaped raw click records.

The test tables carry typed events (event_id, ts, user_id, event_type,
value, props).  This adapter renders them as the JSON payloads the
original pipeline consumes, and damages a deterministic share of them
(16 classes, first match wins) so every validation rule is exercised.  The
same transformation is written in DuckDB SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.sources.records import decode_records

# Damage classes as (class, modulus, remainder), first match wins.
DAMAGE_CLASSES = [
    ("empty", 101, 1), ("truncated", 103, 2), ("not_object", 107, 3),
    ("missing_user", 109, 4), ("bad_version", 113, 5), ("bad_ts", 127, 6),
    ("price_text", 131, 7), ("extra_key", 137, 8), ("no_page", 139, 9),
    ("blank_page", 149, 10), ("bad_uuid", 151, 11), ("blank_user", 157, 12),
    ("list_type", 163, 13), ("month_ts", 167, 14), ("neg_price", 173, 15),
    ("trailing", 179, 16),
]
# Source event_type -> contract event_type ("error" stays as is).
EVENT_TYPE_MAP = {"view": "page_view", "click": "cart_add", "signup": "page_exit"}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _damage_class(eid):
    c = None
    for name, mod, rem in DAMAGE_CLASSES:
        cond = (eid % mod) == rem
        c = F.when(cond, name) if c is None else c.when(cond, name)
    return c.otherwise("clean")


def kafka_records(events: DataFrame) -> DataFrame:
    """Typed events -> rows shaped like the Kafka source (binary key/value).

    Pure projection: no shuffle, runs in one codegen stage per partition.
    """
    from clickpulse.functions import memo_column
    stage_a, stage_a2, stage_b, stage_c = memo_column("kafka_records", _adapter_columns)
    e = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    return e.select(*stage_a).select(*stage_a2).select(*stage_b).select(*stage_c)


def _adapter_columns():
    cls = F.col("cls")
    uid_md5 = F.md5(F.col("event_id").cast("string"))
    uid = F.concat_ws("-", F.substring(uid_md5, 1, 8), F.substring(uid_md5, 9, 4),
                      F.substring(uid_md5, 13, 4), F.substring(uid_md5, 17, 4),
                      F.substring(uid_md5, 21, 12))
    et = F.col("event_type")
    mapped = None
    for src, dst in EVENT_TYPE_MAP.items():
        mapped = F.when(et == src, dst) if mapped is None else mapped.when(et == src, dst)
    mapped = mapped.otherwise(et)
    stage_a = [
        "event_id", "user_id", "value", "ts",
        _damage_class(F.col("event_id")).alias("cls"),
        uid.alias("uid"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("tss"),
        F.get_json_object("props", "$.k").alias("k"),
        mapped.alias("et"),
    ]
    user = F.col("user_id").cast("string")
    session = F.concat(F.lit("ses_"), user, F.lit("_"), F.col("dd"))
    prod = F.col("et").isin("cart_add", "purchase")
    p1 = F.concat(
        F.lit('{"schema_version":"'), F.when(cls == "bad_version", "2.0").otherwise("1.0"),
        F.lit('","event_id":"'), F.when(cls == "bad_uuid", "not-a-uuid").otherwise(F.col("uid")), F.lit('"'),
        F.when(cls == "missing_user", "").when(cls == "blank_user", ',"user_id":""')
         .otherwise(F.concat(F.lit(',"user_id":"usr_'), user, F.lit('"'))),
        F.lit(',"session_id":"'), session, F.lit('"'),
        F.lit(',"event_type":'),
        F.when(cls == "list_type", F.concat(F.lit('["'), F.col("et"), F.lit('"]')))
         .otherwise(F.concat(F.lit('"'), F.col("et"), F.lit('"'))),
        F.when(cls == "no_page", "").when(cls == "blank_page", ',"page_url":""')
         .otherwise(F.concat(F.lit(',"page_url":"/page/'), F.col("k"), F.lit('"'))),
    )
    full = F.concat(
        p1,
        F.when(prod, F.concat(F.lit(',"product_id":"prod_'), F.col("k"),
                              F.lit('","product_category":"cat_'),
                              (F.col("k").cast("int") % 10).cast("string"), F.lit('"')))
         .otherwise(',"product_id":null,"product_category":null'),
        F.lit(',"price_inr":'),
        F.when(cls == "price_text", '"not-a-number"').when(cls == "neg_price", "-1.0")
         .when(prod, F.col("value").cast("string")).otherwise("null"),
        F.lit(',"timestamp":"'),
        F.when(cls == "bad_ts", "not-a-date").when(cls == "month_ts", F.col("mon")).otherwise(F.col("tss")),
        F.lit('"'),
        F.when(cls == "extra_key", ',"invalid_field":true').otherwise(""),
        F.lit("}"),
    )
    raw = (F.when(cls == "empty", F.lit(None).cast("string"))
           .when(cls == "truncated", F.expr("substr(__full, 1, length(__full) - 5)"))
           .when(cls == "not_object", "[1,2]")
           .when(cls == "trailing", F.concat(F.col("__full"), F.lit(" x")))
           .otherwise(F.col("__full")))
    stage_a2 = [c for c in ["event_id", "user_id", "value", "ts", "cls", "uid", "tss", "k", "et"]] + [
        # month and day come from the one formatted text (no second formatter)
        F.substring("tss", 1, 7).alias("mon"),
        F.concat(F.substring("tss", 1, 4), F.substring("tss", 6, 2), F.substring("tss", 9, 2)).alias("dd")]
    stage_b = ["event_id", "cls", "ts", session.alias("session_key"), full.alias("__full")]
    stage_c = [F.col("event_id").alias("src_id"), "cls", F.col("ts").alias("src_ts"),
               F.col("session_key").cast("binary").alias("key"),
               raw.cast("binary").alias("value"),
               F.lit("clickstream-events").alias("topic"),
               (F.col("event_id") % 6).cast("int").alias("partition"),
               F.floor(F.col("event_id") / 6).cast("bigint").alias("offset")]
    return stage_a, stage_a2, stage_b, stage_c


def raw_records(events: DataFrame) -> DataFrame:
    """Decoded raw records: src_id, cls, src_ts (test labels: source id,
    damage class, source time as arrival time), msg_key, raw_value,
    partition, offset."""
    return decode_records(kafka_records(events))


#: A session may name how many partitions the adapter deals its input to.  Off
#: by default: on a cluster the scan has splits enough.  A single small file of
#: one row group is one task, and then a caller may want to spread it.
INPUT_PARTITIONS = "spark.clickpulse.inputPartitions"


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_table(spark, sf_dir, "events")
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return raw_records(events.repartition(int(parts)) if parts else events)
