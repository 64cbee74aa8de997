"""Event parsing and sliding-window page metrics.

``page_metrics`` is the flagship operator: per (sliding window, page) the
number of active users, cart additions, purchases and the cart-abandonment
rate.  It is a plain ``groupBy(window, page).agg(...)`` so the same code runs
as a batch job and as a stateful streaming aggregation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse import contracts as C
from clickpulse.functions import jsonval as J
from clickpulse.functions.timefmt import event_time
from clickpulse.operators.validate import DOC

STRING_FIELDS = [f.name for f in C.EVENT_SCHEMA.fields if f.name != "price_inr"]


def parse_events(df: DataFrame, keep: list[str] | None = None, method: str = "variant") -> DataFrame:
    """Typed event columns from the payload (unknown keys dropped).

    ``method='variant'`` reads the VARIANT the validator already parsed (no
    second JSON parse); ``'from_json'`` parses the text with the fixed
    EVENT_SCHEMA in PERMISSIVE mode.  Both give text for scalar fields
    (numbers become their text) and null for a price that is not a number.
    """
    keep = keep or []
    if method == "variant" and DOC in df.columns:
        doc = F.col(DOC)
        cols = []
        for f in C.EVENT_SCHEMA.fields:
            path = "$['" + f.name + "']"
            if f.name == "price_inr":
                v = J.field(doc, f.name)
                cols.append(F.when(J.kind(v).isin("integer", "number"),
                                   F.variant_get(v, "$", "double")).alias(f.name))
            else:
                cols.append(F.variant_get(doc, path, "string").alias(f.name))
        return df.select(*keep, *cols)
    data = F.from_json(F.col("raw_value"), C.EVENT_SCHEMA)
    return df.select(*keep, data.alias("_data")).select(*keep, "_data.*")


def with_event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """``event_time`` TIMESTAMP from the validated timestamp text (null, not a
    failed task, for a bad one)."""
    return df.withColumn("event_time", event_time(F.col(col)))


def page_key(page_url: Column) -> Column:
    """Metrics key of a page: null or blank page_url -> '/unknown'.  Blank and
    null are merged BEFORE grouping so they form one group (one PK row)."""
    return F.coalesce(F.nullif(page_url, F.lit("")), F.lit(C.UNKNOWN_PAGE))


def valid_events(df: DataFrame) -> DataFrame:
    """Rows with a usable event time (the window drops the others anyway)."""
    return df.filter(F.col("event_time").isNotNull())


_UNIT = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(text: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", text)
    if not m:
        raise ValueError(f"unsupported interval {text!r}")
    return int(m.group(1)) * _UNIT[m.group(2)]


def abandonment(adds: Column, purchases: Column) -> Column:
    """(adds - purchases) / adds when adds > 0 else 0.0 (not clipped: may be
    negative when purchases exceed adds)."""
    return F.when(adds > 0, (adds - purchases) / adds).otherwise(F.lit(0.0))


#: Relative standard deviation of the estimate, and how many of them (and how
#: many users, which matters for tiny groups) it may be off.
HLL_RSD, BOUND_SDS, BOUND_USERS = 0.05, 5, 1


def within_bound(estimate: str, exact: str) -> Column:
    """Is an HLL++ estimate within its error bound of the exact count?"""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(
        F.lit(float(BOUND_USERS)), F.col(exact) * (HLL_RSD * BOUND_SDS))


def _flatten(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     *[c for c in df.columns if c != "window"])


def page_metrics(events: DataFrame, length: str = "60 seconds", slide: str | None = "10 seconds",
                 distinct: str = "approx", strategy: str = "expand",
                 streaming: bool | None = None, updated_at: str | None = None) -> DataFrame:
    """Per (window, page): active_users, cart_additions, purchases,
    cart_abandonment_rate.  Windows are epoch-aligned ``[start, end)``;
    ``slide=None`` gives tumbling windows.

    distinct: ``approx`` (HLL++, as the original pipeline), ``exact`` (count distinct;
    ``size(collect_set)`` on streams, where count-distinct is rejected) or, in
    batch, ``both`` (exact, and the estimate as ``estimated_users``).

    strategy: ``expand`` lets Catalyst expand each row into its windows, which
    a batch shuffles by window, page and user; ``bucketed`` (batch, exact) works
    on slide-sized buckets and never multiplies the rows by length/slide - the
    better plan when that ratio is large.  The caller chooses; both give the
    same rows.

    updated_at: ``None`` (no column), ``'event_time'`` (newest event time of
    the group - deterministic, for replays and oracles) or ``'now'``.
    """
    streaming = events.isStreaming if streaming is None else streaming
    slide = slide or length
    L, S = interval_seconds(length), interval_seconds(slide)
    if strategy == "bucketed":
        if streaming or distinct != "exact":
            raise ValueError("the bucketed strategy is for batch inputs and exact distinct users")
        return _page_metrics_bucketed(events, L, S, updated_at)

    # one row per event and window; hardly any two share window, page and user,
    # so a batch deals them out before any aggregate: what a task then holds
    # follows the size of a shuffle partition, not that of its input split
    rows = events.select(F.window("event_time", length, slide).alias("window"),
                         page_key(F.col("page_url")).alias("page_url"), "user_id",
                         F.when(F.col("event_type") == "cart_add", 1).otherwise(0).alias("adds"),
                         F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("buys"),
                         *(["event_time"] if updated_at == "event_time" else []))
    if not streaming:
        rows = rows.repartition("window", "page_url", "user_id")
    if distinct in ("exact", "both"):
        users = (F.size(F.collect_set("user_id")) if streaming else F.count_distinct("user_id"))
    else:
        users = F.approx_count_distinct("user_id")
    agg = (rows.groupBy("window", "page_url")
           .agg(users.cast("bigint").alias("active_users"),
                *([F.approx_count_distinct("user_id").alias("estimated_users")] if distinct == "both" else []),
                F.sum("adds").cast("bigint").alias("cart_additions"),
                F.sum("buys").cast("bigint").alias("purchases"),
                *([F.max("event_time").alias("updated_at")] if updated_at == "event_time" else [])))
    agg = agg.withColumn("cart_abandonment_rate", abandonment(F.col("cart_additions"), F.col("purchases")))
    if updated_at == "now":
        agg = agg.withColumn("updated_at", F.current_timestamp())
    return _flatten(agg)


def _page_metrics_bucketed(events: DataFrame, L: int, S: int, updated_at: str | None = None) -> DataFrame:
    """Windows of L seconds every S seconds from S-second buckets.

    A bucket b is in the windows that start from b - L + S to b, so it enters
    at the first of these and leaves at b + S.  A (page, user, bucket) row
    therefore gives two points, however many windows it is in: what it adds
    when it enters and takes away when it leaves.  A user counts once while any
    of its buckets is in the window: its spans that overlap or touch are one,
    which adds the user at its begin and takes it away at its end.  Running
    sums over the points of a page, cut by day, give the values from one point
    to the next; they are the same for all windows that start in between, and
    only the result is expanded into these.  The newest event of a window is
    that of the bucket that entered last.
    """
    if L % S:
        raise ValueError("bucketed strategy needs length to be a multiple of slide")
    us = F.unix_micros(F.col("event_time"))
    bucket = (F.floor(us / (S * 1_000_000)) * S).cast("bigint")
    base = events.filter(F.col("event_time").isNotNull()).select(
        bucket.alias("b"), page_key(F.col("page_url")).alias("page_url"), "user_id", "event_type", "event_time")
    seen = base.groupBy("page_url", "user_id", "b").agg(
        F.sum(F.when(F.col("event_type") == "cart_add", 1).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("p"),
        F.max("event_time").alias("u"))
    visits = Window.partitionBy("page_url", "user_id").orderBy("b")
    begins = F.coalesce(F.col("b") - F.lag("b").over(visits) > L, F.lit(True)) & F.col("user_id").isNotNull()
    ends = F.coalesce(F.lead("b").over(visits) - F.col("b") > L, F.lit(True)) & F.col("user_id").isNotNull()
    spans = seen.select("*", begins.cast("bigint").alias("begins"), ends.cast("bigint").alias("ends"))
    enter = F.struct((F.col("b") - (L - S)).alias("t"), F.lit(1).cast("bigint").alias("n"), F.col("begins").alias("users"),
                     F.col("a"), F.col("p"), F.col("u"))
    leave = F.struct((F.col("b") + S).alias("t"), F.lit(-1).cast("bigint").alias("n"), (-F.col("ends")).alias("users"),
                     (-F.col("a")).alias("a"), (-F.col("p")).alias("p"), F.lit(None).cast("timestamp").alias("u"))
    sums = ["n", "users", "a", "p"]
    points = spans.select("page_url", F.inline(F.array(enter, leave))).groupBy("page_url", "t").agg(
        *[F.sum(c).alias(c) for c in sums], F.max("u").alias("u")).withColumn("day", F.floor(F.col("t") / 86400))
    state = _running(points, sums)
    lasts = state.filter("n > 0").select(
        F.explode(F.sequence(F.col("t"), F.col("until") - S, F.lit(S).cast("bigint"))).alias("t"), "page_url", *sums, "u")
    extra = {"event_time": [F.col("u").alias("updated_at")], "now": [F.current_timestamp().alias("updated_at")]}
    return lasts.select(
        F.timestamp_seconds(F.col("t")).alias("window_start"),
        F.timestamp_seconds(F.col("t") + L).alias("window_end"),
        "page_url", F.col("users").alias("active_users"), F.col("a").alias("cart_additions"), F.col("p").alias("purchases"),
        abandonment(F.col("a"), F.col("p")).alias("cart_abandonment_rate"),
        *extra.get(updated_at, []))


def _running(points: DataFrame, sums: list[str]) -> DataFrame:
    """Per point of a page: the running ``sums``, the newest ``u`` so far, and
    ``until``, the next point.  Days are summed in parallel; a table of one
    row per page and day carries what the earlier days add up to."""
    within = Window.partitionBy("page_url", "day").orderBy("t")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    inside = points.select("page_url", "day", "t", *[F.sum(c).over(upto).alias(c) for c in sums],
                           F.max("u").over(upto).alias("u"), F.lead("t").over(within).alias("until"))
    by_day = Window.partitionBy("page_url").orderBy("day")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    days = points.groupBy("page_url", "day").agg(*[F.sum(c).alias(c) for c in sums], F.max("u").alias("u"), F.min("t").alias("t"))
    days = days.select("page_url", "day", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums],
                       F.max("u").over(before).alias("u_before"), F.lead("t").over(by_day).alias("next_day"))
    return inside.join(days, ["page_url", "day"]).select(
        "page_url", "t", *[(F.col(c) + F.col(f"{c}_before")).cast("bigint").alias(c) for c in sums],
        F.greatest("u", "u_before").alias("u"), F.coalesce("until", "next_day").alias("until"))


def events_pipeline(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """raw records -> validated, parsed, timed events (the valid branch)."""
    from clickpulse.operators.validate import with_stream_validation, route_valid
    v = route_valid(with_stream_validation(raw))
    return with_event_time(parse_events(v, keep=keep))
