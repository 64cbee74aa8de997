"""SparkSession construction and cluster-level settings."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  UTC is required: the metrics table, the
# dashboards and the oracle all work in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a repeated key in an event keeps its last value, as in Python
    "spark.sql.variant.allowDuplicateKeys": "true",
}


JIT_HUGE_METHODS = "-XX:-DontCompileHugeMethods"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "clickpulse", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    ``master`` is only set when given (a cluster submit supplies its own).
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            conf.setdefault("spark.driver.memory", os.environ.get("CLICKPULSE_DRIVER_MEMORY", "8g"))
            # generated code for the rule cascades has methods above HotSpot's
            # 8000-byte JIT limit; without this they run interpreted (2x
            # slower contract validation).  Clusters: add the same flag to
            # spark.{driver,executor}.extraJavaOptions in their defaults.
            conf.setdefault("spark.driver.extraJavaOptions", JIT_HUGE_METHODS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Unset, it is an error on a cluster, where executors share no local folder.
    In local mode (one machine) a scratch folder serves, as in tests.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="clickpulse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_root(spark), *parts)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again: cuts
    the lineage, survives lost executors, and is computed once."""
    path = checkpoint_path(df.sparkSession, f"clickpulse-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for operators
    whose state is kept by Python code."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    out = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="clickpulse-zip-"), "clickpulse_stream"), "zip",
                              os.path.dirname(top), os.path.basename(top))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)
