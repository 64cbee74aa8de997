import json

import pytest
from pyspark.sql import functions as F

from clickpulse.operators.metrics import events_pipeline, page_metrics
from clickpulse.fixtures import load_raw
from conftest import SF0001, rows_of

KEY = ["window_start", "window_end", "page_url"]


def _events(spark):
    return events_pipeline(load_raw(spark, SF0001))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_bucketed_equals_expand(spark):
    ev = _events(spark)
    cols = KEY + ["active_users", "cart_additions", "purchases", "updated_at"]
    for length, slide in [("60 seconds", "10 seconds"), ("1 hour", "10 minutes"), ("2 days", "1 day"), ("1 hour", None)]:
        a = page_metrics(ev, length, slide, distinct="exact", strategy="expand", updated_at="event_time")
        b = page_metrics(ev, length, slide, distinct="exact", strategy="bucketed", updated_at="event_time")
        assert _rows(a, cols) == _rows(b, cols)


def test_bucketed_counts_users_over_gaps_and_nulls(spark):
    import datetime as dt
    t0 = dt.datetime(2025, 1, 1, 23, 59, 0)
    rows = [(t0 + dt.timedelta(seconds=s), p, u, "page_view") for p, u, at in
            [("/a", "u", (0, 5, 30, 59, 60, 61, 119, 121, 400)), ("/a", "v", (61,)), ("/a", None, (10, 500)),
             ("", "u", (0,)), (None, "u", (3,)), ("/b", "w", (0, 60, 120, 180))] for s in at]
    ev = spark.createDataFrame(rows, "event_time timestamp, page_url string, user_id string, event_type string")
    cols = KEY + ["active_users", "cart_additions", "purchases"]
    for length, slide in [("60 seconds", "10 seconds"), ("60 seconds", "60 seconds"), ("2 minutes", "30 seconds")]:
        a = page_metrics(ev, length, slide, distinct="exact")
        b = page_metrics(ev, length, slide, distinct="exact", strategy="bucketed")
        assert _rows(a, cols) == _rows(b, cols)


def test_one_estimate_whatever_the_strategy(spark):
    ev = _events(spark)
    with pytest.raises(ValueError):
        page_metrics(ev, "1 hour", "1 minute", distinct="approx", strategy="bucketed")
    from clickpulse.operators.metrics import within_bound
    both = page_metrics(ev, "1 day", "12 hours", distinct="both")
    alone = page_metrics(ev, "1 day", "12 hours", distinct="approx")
    assert _rows(both.select(*KEY, "estimated_users"), KEY + ["estimated_users"]) == \
        _rows(alone.select(*KEY, "active_users"), KEY + ["active_users"])
    assert both.filter(~within_bound("estimated_users", "active_users")).count() == 0
    crowd = spark.range(6000).selectExpr("TIMESTAMP '2025-01-01 10:00:00' + make_interval(0,0,0,0,0,0,id % 3600) AS event_time",
                                         "'/p' AS page_url", "CAST(id % 3000 AS string) AS user_id", "'page_view' AS event_type")
    values = {r.active_users for s in ("1 hour", "5 minutes") for r in
              page_metrics(crowd, "1 hour", s, distinct="approx").filter("window_start = '2025-01-01 10:00:00'").collect()}
    assert len(values) == 1 and abs(values.pop() - 3000) <= 750


def test_blank_and_null_page_merge(spark):
    base = {"schema_version": "1.0", "event_id": "7c9e6679-7425-40de-944b-e07fc1f90ae7",
            "session_id": "s", "event_type": "cart_add", "timestamp": "2026-09-18T10:00:05Z"}
    p = [json.dumps({**base, "user_id": "a", "page_url": ""}), json.dumps({**base, "user_id": "b"})]
    m = page_metrics(events_pipeline(rows_of(spark, p)), distinct="exact")
    rows = m.filter(F.col("window_start") == "2026-09-18 10:00:00").collect()
    assert len(rows) == 1 and rows[0].page_url == "/unknown"
    assert rows[0].active_users == 2 and rows[0].cart_additions == 2


def test_abandonment_may_be_negative_and_zero_guarded(spark):
    base = {"schema_version": "1.0", "event_id": "7c9e6679-7425-40de-944b-e07fc1f90ae7",
            "session_id": "s", "user_id": "u", "page_url": "/p", "timestamp": "2026-09-18T10:00:05Z"}
    p = [json.dumps({**base, "event_type": t}) for t in ["cart_add", "purchase", "purchase"]]
    p2 = [json.dumps({**base, "event_type": "page_view", "page_url": "/v"})]
    m = page_metrics(events_pipeline(rows_of(spark, p + p2)), "60 seconds", None, distinct="exact")
    got = {r.page_url: r.cart_abandonment_rate for r in m.collect()}
    assert got == {"/p": -1.0, "/v": 0.0}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_native_partial_agg_and_pushdown(spark):
    ev = _events(spark)
    plan = _plan(page_metrics(ev, distinct="exact"))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "partial_" in plan  # map-side partial aggregation before the exchange
    scan = load_raw(spark, SF0001).filter(F.col("src_ts") > "2024-01-15").select("src_id")
    p = _plan(scan)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_validation_computed_once(spark):
    """A filter on the verdict must not be pushed below the parse."""
    from clickpulse.operators.validate import route_valid, with_stream_validation
    v = route_valid(with_stream_validation(load_raw(spark, SF0001)))
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize("distinct", ["exact", "approx", "both"])
def test_no_scan_task_holds_groups(spark, distinct):
    """Hardly any two rows share window, page and user: an aggregate before the
    shuffle would hold all windows of an input split."""
    ev = spark.createDataFrame([("2024-01-01 00:00:05", "/a", "u", "cart_add"), ("2024-01-01 00:00:06", "/a", "u", "purchase"),
                                ("2024-01-01 00:00:07", "/a", None, "purchase"), (None, "/a", "v", "purchase")],
                               "event_time string, page_url string, user_id string, event_type string") \
        .withColumn("event_time", F.to_timestamp("event_time"))
    m = page_metrics(ev, distinct=distinct, updated_at="event_time")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange hashpartitioning") > plan.rindex("Aggregate")
    assert {tuple(r) for r in m.select("active_users", "cart_additions", "purchases").collect()} == {(1, 1, 2)}
    assert m.count() == 6


def test_no_scan_task_of_the_table_holds_its_keys(spark):
    from clickpulse.streaming.sink import latest_metrics
    log = spark.createDataFrame([(1, 2, "/a", 5, 1), (1, 2, "/a", 6, 2), (1, 2, "/b", 7, 1)],
                                "window_start long, window_end long, page_url string, active_users long, version long")
    latest = latest_metrics(log)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange hashpartitioning") > plan.rindex("Aggregate")
    assert sorted(map(tuple, latest.collect())) == [(1, 2, "/a", 6), (1, 2, "/b", 7)]
