"""Column helpers (all native Spark expressions; no Python UDFs)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_fenced(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that later filters cannot be pushed beneath.

    Catalyst pushes a filter on a computed column below the projection that
    computes it by inlining the definition - an expensive expression (a JSON
    parse, a rule cascade) is then evaluated in the filter AND in the
    projection, and nested definitions multiply.  Producing the columns from a
    one-row ``inline`` generator keeps them as real attributes: a predicate
    on generator output stays above the generator, so each expression runs
    once per row.  Streaming-safe (stateless).
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


_MEMO: dict = {}


def memo_column(key, build):
    """Build a (large) Column expression once per application and reuse it.

    Expressions here reference columns by name only, so one unresolved
    expression serves every DataFrame; building the rule cascades through
    Py4J costs seconds, reusing them costs nothing.  Expressions of an
    application that ended belong to a JVM that is gone and are dropped.
    """
    from pyspark import SparkContext
    app = SparkContext._active_spark_context.applicationId
    if _MEMO.get("app") != app:
        _MEMO.clear()
        _MEMO["app"] = app
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]
