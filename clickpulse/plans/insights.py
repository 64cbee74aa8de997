"""Queries the product documents promise beyond the dashboards: revenue,
dead-letter breakdown, processing latency, consumer lag, page popularity and
the purchase funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.metrics import page_key


def gmv_series(events: DataFrame, length: str = "60 seconds", slide: str | None = "10 seconds") -> DataFrame:
    """Revenue (sum of price_inr over purchases) per sliding window."""
    p = events.filter(F.col("event_type") == "purchase")
    g = p.groupBy(F.window("event_time", length, slide or length).alias("w")).agg(
        F.coalesce(F.sum("price_inr"), F.lit(0.0)).alias("gmv"), F.count(F.lit(1)).alias("purchases"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "gmv", "purchases")


def processing_latency(events: DataFrame, processed_at: str) -> DataFrame:
    """Seconds from event time to processing time, per event."""
    lat = (F.unix_micros(F.col(processed_at).cast("timestamp")) - F.unix_micros("event_time")) / 1e6
    return events.select(lat.alias("latency_s"))


def latency_percentiles(latency: DataFrame, accuracy: int = 10000) -> DataFrame:
    """p50 / p95 / p99 with a bounded-memory quantile sketch (exact
    percentiles would pull every value of the group into one buffer)."""
    q = F.percentile_approx("latency_s", [0.5, 0.95, 0.99], accuracy)
    return latency.agg(q.alias("q")).select(F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"),
                                            F.col("q")[2].alias("p99"))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Per partition: end offset - committed offset (and the total)."""
    return offsets.select("partition", "end_offset", "committed_offset",
                          (F.col("end_offset") - F.col("committed_offset")).alias("lag"))


def page_popularity(events: DataFrame, n: int | None = None) -> DataFrame:
    """All pages with their views, users and events; with ``n`` the ``n`` pages
    of most views, in that order (page_url breaks ties)."""
    g = events.groupBy(page_key(F.col("page_url")).alias("page_url")).agg(
        F.count_if(F.col("event_type") == "page_view").alias("views"),
        F.count_distinct("user_id").alias("users"),
        F.count(F.lit(1)).alias("events"))
    return g if n is None else g.orderBy(F.col("views").desc(), F.col("page_url")).limit(n)


def funnel_conversion(events: DataFrame) -> DataFrame:
    """page_view -> cart_add -> purchase: stage counts and step ratios."""
    et = F.col("event_type")
    g = events.agg(F.count_if(et == "page_view").alias("views"),
                   F.count_if(et == "cart_add").alias("cart_adds"),
                   F.count_if(et == "purchase").alias("purchases"))
    return g.select("views", "cart_adds", "purchases",
                    F.try_divide(F.col("cart_adds").cast("double"), F.nullif("views", F.lit(0))).alias("view_to_cart"),
                    F.try_divide(F.col("purchases").cast("double"), F.nullif("cart_adds", F.lit(0))).alias("cart_to_purchase"),
                    F.try_divide(F.col("purchases").cast("double"), F.nullif("views", F.lit(0))).alias("view_to_purchase"))
