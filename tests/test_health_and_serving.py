import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import health as H
from clickpulse.operators.metrics import events_pipeline, page_metrics
from clickpulse.operators.producer import publish_events
from clickpulse.operators.validate import accept_gate
from clickpulse.plans import insights as I
from clickpulse.plans import serving as S
from clickpulse.sources.records import kafka_options
from clickpulse.fixtures import load_raw
from clickpulse.streaming import sink as SK
from conftest import SF0001, rows_of

T0 = dt.datetime(2026, 1, 1, 0, 0, 0)


def _gated(spark, pts):
    """(second, status) -> gated events."""
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), st) for s, st in pts], "src_ts timestamp, gate_status string")


def _seconds(df):
    return sorted(int((r.ts - T0).total_seconds()) for r in df.collect())


def _brute_fires(pts, holds, for_s, lo, hi):
    ok = {t for t in range(lo, hi + 15, 15) if holds(t)}
    return [t for t in range(lo, hi + for_s + 15, 15) if all(x in ok for x in range(t - for_s, t + 15, 15))]


def test_sliding_counts_match_brute_force(spark):
    pts = [(s, "accepted") for s in (0, 1, 14, 15, 16, 200, 600)] + [(s, "rejected") for s in (15, 31, 600)] + [(5, "refused"), (7, "error")]
    for rng in (15, 120, 300):
        got = {(int((r.ts - T0).total_seconds()), r.accepted, r.rejected)
               for r in H.sliding_counts(H.step_counts(_gated(spark, pts)), rng).collect()}
        want = set()
        for t in range(0, 1000, 15):
            n = [sum(1 for s, st in pts if st == k and t - rng < s <= t) for k in ("accepted", "rejected")]
            if any(n):
                want.add((t, *n))
        assert got == want
    with pytest.raises(ValueError):
        H.sliding_counts(H.step_counts(_gated(spark, pts)), 20)


def test_high_reject_fires_on_a_burst(spark):
    """150 rejections at 600-630 s: over one a second for two minutes."""
    pts = [(0, "accepted"), (2000, "accepted")] + [(600 + i % 31, "rejected") for i in range(150)]
    fired = _seconds(H.alert_high_reject(H.step_counts(_gated(spark, pts))))
    rate = lambda t: sum(1 for s, st in pts if st == "rejected" and t - 120 < s <= t) / 120
    assert fired == _brute_fires(pts, lambda t: rate(t) > 1, 60, 0, 2000) and fired
    assert 615 not in fired and 2000 - 2000 % 15 not in fired
    assert _seconds(H.alert_high_reject(H.step_counts(_gated(spark, pts[:100])))) == []


def test_no_publish_fires_in_a_gap(spark):
    """Accepted events every 30 s but for 1000-2000 s; rejections go on."""
    pts = [(s, "accepted") for s in [*range(0, 1000, 30), *range(2010, 3000, 30)]] + [(s, "rejected") for s in range(0, 3000, 100)]
    counts = H.step_counts(_gated(spark, pts))
    fired = _seconds(H.alert_no_publish(counts))
    quiet = lambda t: not any(st == "accepted" and t - 300 < s <= t for s, st in pts)
    assert fired == [t for t in _brute_fires(pts, quiet, 120, 0, 2985) if t <= 2985] and fired
    assert 1290 not in fired and 2025 not in fired
    g = H.alert_groups(H.alert_no_publish(counts)).collect()
    assert [(r.alertname, r.severity, r.firing_evaluations) for r in g] == [("ProducerPublishRateZero", "warning", len(fired))]


def test_health_leaves_nothing_cached(spark):
    counts = H.step_counts(accept_gate(load_raw(spark, SF0001)))
    H.alert_no_publish(counts).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_sustained_requires_every_step(spark):
    steps = [0, 15, 30, 45, 60, 75, 105, 120, 135, 150, 165]  # 90 missing
    cond = spark.createDataFrame([(T0 + dt.timedelta(seconds=s),) for s in steps], "ts timestamp")
    assert _seconds(H.sustained(cond, [], 60)) == [60, 75, 165]


def test_time_spine_spans_days(spark):
    spine = H.time_spine(H.step_counts(_gated(spark, [(0, "accepted"), (86400 + 30, "accepted")])))
    assert spine.count() == (86400 + 30) // 15 + 1
    assert spine.select(F.countDistinct("ts")).first()[0] == spine.count()


def test_the_spine_of_two_years_is_built_by_many_tasks(spark):
    ends = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-01'), (TIMESTAMP '2025-12-31') AS t(ts)").selectExpr("ts", "1L AS accepted", "0L AS rejected")
    per_task = [r["n"] for r in H.time_spine(ends).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 730 * 5760 + 1 and max(per_task) < 3 * sum(per_task) / 8


def test_publish_keyed_by_session_and_unchanged(spark, scratch):
    acc = accept_gate(load_raw(spark, SF0001)).filter("gate_status = 'accepted'")
    out = os.path.join(scratch, "pub")
    publish_events(acc, fmt="json", path=out, partitions=4)
    files = spark.read.json(out).withColumn("f", F.input_file_name())
    per_key = files.groupBy("key").agg(F.countDistinct("f").alias("n"))
    assert per_key.filter("n > 1").count() == 0
    assert files.count() == acc.count()
    assert sorted(r.value for r in files.collect()) == sorted(r.raw_value for r in acc.collect())
    body = json.dumps({"timestamp": "2025-03-04T05:06:07Z", "event_type": "purchase", "schema_version": "1.0", "user_id": "visitor-7",
                       "session_id": "visit-9", "event_id": "7c9e6679-7425-40de-944b-e07fc1f90ae7"})[:-1] + ', "price_inr": 2999.00}'
    one = publish_events(accept_gate(rows_of(spark, [body])).filter("gate_status = 'accepted'"), fmt="json",
                         path=os.path.join(scratch, "one"), partitions=1)
    assert [(r.key, r.value) for r in one.collect()] == [("visit-9", body)]


def test_page_popularity_returns_every_page(spark):
    ev = events_pipeline(load_raw(spark, SF0001))
    pages = I.page_popularity(ev)
    assert pages.count() == ev.select(F.coalesce(F.nullif("page_url", F.lit("")), F.lit("/unknown"))).distinct().count() > 20
    assert [r.page_url for r in I.page_popularity(ev, 3).collect()] == \
        [r.page_url for r in pages.orderBy(F.desc("views"), "page_url").limit(3).collect()]


def _plain(spark, length="60 seconds", slide="10 seconds"):
    return page_metrics(events_pipeline(load_raw(spark, SF0001)), length, slide, distinct="exact", updated_at="event_time")


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


PANELS = [S.latest_active_users, S.latest_cart_adds, S.latest_purchases, S.latest_abandonment, S.funnel_series,
          S.abandonment_trend, S.top_pages, S.latest_page_count, S.rows_last_24h, S.pages_per_window]


@pytest.mark.parametrize("length,slide", [("60 seconds", "10 seconds"), ("3 days", "1 day")])
def test_panels_agree_on_a_plain_table_and_the_store(spark, scratch, length, slide):
    m = _plain(spark, length, slide)
    rows = SK.to_table_rows(m).cache()
    SK.replace_all(spark, scratch, rows)
    store = SK.read_metrics(spark, scratch)
    plain = rows.drop("window_date")
    for as_of in (dt.datetime(2024, 1, 20, 12), dt.datetime(2024, 1, 3), dt.datetime(2030, 1, 1), dt.datetime(1990, 1, 1)):
        for panel in PANELS:
            assert sorted(map(str, panel(store, as_of=as_of).collect())) == sorted(map(str, panel(plain, as_of=as_of).collect())), (panel, as_of)
    rows.unpersist()


def test_panels_read_the_store_once_and_pruned(spark, scratch):
    SK.replace_all(spark, scratch, SK.to_table_rows(_plain(spark)))
    store = SK.read_metrics(spark, scratch)
    for panel in (S.latest_active_users, S.latest_abandonment, S.top_pages, S.latest_page_count, S.rows_last_24h, S.funnel_series):
        plan = _executed(panel(store, as_of=dt.datetime(2024, 1, 20, 12)))
        assert plan.count("FileScan parquet") == 1, panel
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "window_date" in filters and ">=" in filters, (panel, filters)


def test_a_partitioned_table_without_its_window_length_is_an_error(spark):
    rows = SK.to_table_rows(_plain(spark, "3 days", "1 day"))
    with pytest.raises(ValueError):
        S.latest_active_users(rows, as_of="2024-01-20 12:00:00")
    known = SK.with_store_facts(rows, 3 * 86400)
    assert S.latest_active_users(known, as_of="2024-01-20 12:00:00").first().users == \
        S.latest_active_users(rows.drop("window_date"), as_of="2024-01-20 12:00:00").first().users > 0


def test_kafka_options():
    o = kafka_options("b:9092", "t", "SASL_PLAINTEXT", "SCRAM-SHA-512", "jaas", max_offsets_per_trigger=1000)
    assert o["kafka.security.protocol"] == "SASL_PLAINTEXT" and o["kafka.sasl.jaas.config"] == "jaas"
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
    assert o["maxOffsetsPerTrigger"] == "1000"
    assert "kafka.sasl.mechanism" not in kafka_options("b", "t", "PLAINTEXT", "X", "Y")


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace
    from clickpulse.session import checkpoint_root
    conf = SimpleNamespace(get=lambda k, d=None: None)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(SimpleNamespace(sparkContext=sc))
