import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from clickpulse.operators.metrics import events_pipeline, page_metrics
from clickpulse.sources.records import KAFKA_RECORD_SCHEMA, read_records
from clickpulse.fixtures import kafka_records, load_table
from clickpulse.streaming import sink as SK
from clickpulse.streaming import storage as ST
from clickpulse.streaming.job import JobConfig, offsets_frame, progress_frame, start
from conftest import SF0001

KEY = ["window_start", "window_end", "page_url"]
VALS = ["active_users", "cart_additions", "purchases", "cart_abandonment_rate"]


def _payload(t, user="u1", page="/p", et="page_view"):
    return json.dumps({"schema_version": "1.0", "event_id": "7c9e6679-7425-40de-944b-e07fc1f90ae7",
                       "user_id": user, "session_id": "s1", "event_type": et, "page_url": page,
                       "timestamp": t})


def _write_file(spark, folder, idx, payloads):
    rows = [(b"k", p.encode(), "t", 0, idx * 100 + i, dt.datetime(2026, 1, 1)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, KAFKA_RECORD_SCHEMA).coalesce(1)
    tmp = os.path.join(folder, f"_tmp{idx}")
    df.write.mode("overwrite").parquet(tmp)
    part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
    dst = os.path.join(folder, f"f{idx:03d}.parquet")
    os.rename(os.path.join(tmp, part), dst)
    os.utime(dst, (1_700_000_000 + idx, 1_700_000_000 + idx))


def _run(spark, src, root, ckpt, distinct="exact", max_files=None, **more):
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    raw = read_records(spark, "parquet", opts, path=src, stream=True)
    cfg = JobConfig(metrics_root=os.path.join(root, "store"), dlq_path=os.path.join(root, "dlq"),
                    checkpoint=ckpt, distinct=distinct, trigger={"availableNow": True}, **more)
    qs = start(spark, raw, cfg)
    for q in qs:
        q.awaitTermination(180)
    return qs


def _batch_rows(spark, folder):
    return spark.read.parquet(folder).collect()


@pytest.mark.parametrize("distinct", ["approx", "exact"])
def test_late_data_rule(spark, scratch, distinct):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    files = [["2026-09-18T10:00:05Z"], ["2026-09-18T10:10:00Z"], ["2026-09-18T10:10:01Z"],
             ["2026-09-18T10:00:07Z", "2026-09-18T10:08:30Z", "2026-09-18T10:07:59Z"]]
    for i, ts in enumerate(files):
        _write_file(spark, src, i, [_payload(t) for t in ts])
    root = os.path.join(scratch, "out")
    progress = os.path.join(scratch, "progress")
    _, mq = _run(spark, src, root, os.path.join(scratch, "ck"), distinct, max_files=1, progress_path=progress)
    b3 = spark.read.parquet(os.path.join(root, "store", "changelog")).filter("batch_id = 3")
    starts = sorted(r.window_start.strftime("%H:%M:%S") for r in b3.collect())
    assert starts == ["10:07:10", "10:07:20", "10:07:30", "10:07:40", "10:07:50",
                      "10:08:00", "10:08:10", "10:08:20", "10:08:30"]
    counts = {r.window_start.strftime("%H:%M:%S"): r.active_users for r in b3.collect()}
    assert counts["10:07:40"] == 1  # 10:07:59 and 10:08:30 - same user
    for _ in range(100):  # the listener writes on its own
        seen = progress_frame(spark, progress).filter(F.col("query") == mq.name) if os.path.exists(progress) else None
        if seen is not None and seen.filter("batch_id = 3").count():
            break
        time.sleep(0.2)
    assert {r.batch_id for r in seen.collect()} >= {0, 1, 2, 3}
    if distinct == "approx":  # the engine drops rows; exact users judge them window by window
        assert seen.filter("rows_dropped_by_watermark > 0").count() >= 1


def test_stream_batch_parity_restart_and_dlq(spark, scratch):
    ev = load_table(spark, SF0001, "events")
    recs = kafka_records(ev).drop("src_id", "cls", "src_ts").withColumn("timestamp", F.col("offset").cast("timestamp"))
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = recs.orderBy("offset", "partition").collect()
    half = len(rows) // 2
    for idx, chunk in enumerate([rows[:half], rows[half:]]):
        df = spark.createDataFrame(chunk, KAFKA_RECORD_SCHEMA).coalesce(1)
        tmp = os.path.join(scratch, f"_t{idx}")
        df.write.parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        os.rename(os.path.join(tmp, part), os.path.join(src, f"f{idx}.parquet"))
        if idx == 0:  # first run sees only the first file, then the job stops
            _run(spark, src, os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    _run(spark, src, os.path.join(scratch, "out"), os.path.join(scratch, "ck"))  # restart
    got = SK.read_metrics(spark, os.path.join(scratch, "out", "store"))
    from clickpulse.fixtures import raw_records
    want = page_metrics(events_pipeline(raw_records(ev)), distinct="exact")
    cols = KEY + VALS
    a = sorted(tuple(r[c] for c in cols) for r in got.select(*cols).collect())
    b = sorted(tuple(r[c] for c in cols) for r in want.select(*cols).collect())
    assert a == b
    dlq = spark.read.json(os.path.join(scratch, "out", "dlq"))
    assert dlq.count() == 1000 - 739
    from clickpulse.operators.dlq import validate_dlq
    assert validate_dlq(dlq).filter("contract_status <> 'valid'").count() == 0


def _rows(df):
    return sorted(tuple(r[c] for c in KEY + VALS) for r in df.collect())


def _metrics(spark):
    from clickpulse.fixtures import load_raw
    return page_metrics(events_pipeline(load_raw(spark, SF0001)), distinct="exact", updated_at="event_time")


def test_replay_is_idempotent_and_compaction_is_incremental(spark, scratch):
    root = os.path.join(scratch, "store")
    m = _metrics(spark)
    assert SK.upsert_metrics(m, 0, root, run=1)
    before = _rows(SK.read_metrics(spark, root))
    assert SK.upsert_metrics(m, 0, root, run=1)  # replay of the same batch
    assert _rows(SK.read_metrics(spark, root)) == before == _rows(m)
    assert not SK.upsert_metrics(m.limit(0), 1, root, run=1)  # empty batch: no write
    assert not os.path.exists(os.path.join(root, "changelog", "run=1", "batch_id=1"))
    all_days = SK.compact_metrics(spark, root)
    assert len(all_days) > 5 and SK.compact_metrics(spark, root) == []
    assert _rows(SK.read_metrics(spark, root)) == before
    # one changed day: one day is rewritten, the others keep their files
    kept = SK.manifest(spark, root)["days"]
    one = m.orderBy(*KEY).limit(1).withColumn("active_users", F.lit(999).cast("bigint"))
    SK.upsert_metrics(one, 2, root, run=1)
    latest = SK.read_metrics(spark, root)
    assert latest.filter("active_users = 999").count() == 1 and latest.count() == len(before)
    days = SK.compact_metrics(spark, root)
    now = SK.manifest(spark, root)["days"]
    assert len(days) == 1 and [d for d in now if now[d] != kept[d]] == [days[0].isoformat()]
    after = SK.read_metrics(spark, root)
    assert after.filter("active_users = 999").count() == 1 and after.count() == len(before)
    # a folded batch that is replayed changes nothing, and what no manifest
    # names is gone after the next compaction
    SK.upsert_metrics(one, 2, root, run=1)
    assert after.count() == SK.read_metrics(spark, root).count() == len(before)
    SK.compact_metrics(spark, root)
    runs = os.path.join(root, "changelog", "run=1")
    assert not [d for d in os.listdir(runs) if d.startswith("batch_id=")]
    assert not os.path.exists(os.path.join(root, "table", f"version={kept[days[0].isoformat()]}", f"window_date={days[0]}"))
    assert after.count() == len(before)


def test_a_reader_sees_the_old_state_or_the_new_one(spark, scratch):
    root = os.path.join(scratch, "store")
    m = _metrics(spark)
    SK.upsert_metrics(m, 0, root, run=1)
    SK.compact_metrics(spark, root)
    SK.upsert_metrics(m.withColumn("active_users", F.col("active_users") + 1), 1, root, run=1)
    under_way = SK.read_metrics(spark, root)
    want = _rows(under_way)
    SK.compact_metrics(spark, root)  # while the reader holds its plan
    assert _rows(under_way) == want == _rows(SK.read_metrics(spark, root))
    # a compaction that dies before its manifest leaves the old state
    SK.upsert_metrics(m, 2, root, run=1)
    want = _rows(SK.read_metrics(spark, root))
    publish, SK._publish = SK._publish, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            SK.compact_metrics(spark, root)
    finally:
        SK._publish = publish
    assert _rows(SK.read_metrics(spark, root)) == want
    SK.compact_metrics(spark, root)
    assert _rows(SK.read_metrics(spark, root)) == want == _rows(m)


def test_reader_plan_prunes_every_scan_and_hashes(spark, scratch):
    root = os.path.join(scratch, "store")
    m = _metrics(spark)
    SK.upsert_metrics(m, 0, root, run=1)
    SK.compact_metrics(spark, root)
    SK.upsert_metrics(m, 1, root, run=1)
    day = SK.read_metrics(spark, root).filter("window_date = DATE '2024-01-10'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("PartitionFilters: [isnotnull(window_date") == 2
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert day.count() == m.filter(F.to_date("window_start") == "2024-01-10").count() > 0


def test_run_id_is_kept_with_the_checkpoint(spark, scratch):
    root, m = os.path.join(scratch, "store"), _metrics(spark).orderBy(*KEY).limit(50)
    first = SK.run_id(spark, root, os.path.join(scratch, "ck1"))
    assert first == SK.run_id(spark, root, os.path.join(scratch, "ck1")) == 1
    SK.MetricsSink(root, first)(m, 0)
    SK.MetricsSink(root, SK.run_id(spark, root, os.path.join(scratch, "ck1")))(m, 0)  # replay after a restart
    assert os.listdir(os.path.join(root, "changelog")) == ["run=1"]
    second = SK.run_id(spark, root, os.path.join(scratch, "ck2"))  # a new checkpoint comes later
    SK.MetricsSink(root, second)(m.withColumn("active_users", F.lit(7).cast("bigint")), 0)
    assert second == 2 and {r.active_users for r in SK.read_metrics(spark, root).collect()} == {7}
    SK.compact_metrics(spark, root)
    assert SK.run_id(spark, root, os.path.join(scratch, "ck3")) == 3


def test_rows_without_a_partition_go_to_quarantine(spark, scratch):
    root, m = os.path.join(scratch, "store"), _metrics(spark)
    long_page = m.orderBy(*KEY).limit(1).withColumn("page_url", F.lit("/" + "x" * 600))
    SK.upsert_metrics(m.unionByName(long_page), 0, root, run=1, calendar=ST.partition_calendar(spark, "2024-01-10", 3))
    bad = spark.read.parquet(os.path.join(root, "quarantine"))
    good = SK.read_metrics(spark, root)
    assert good.count() + bad.count() == m.count() + 1 and good.count() > 0
    assert good.agg(F.min("window_date").cast("string"), F.max("window_date").cast("string")).first()[:] == ("2024-01-09", "2024-01-13")
    assert {r.reason for r in bad.select("reason").distinct().collect()} <= {ST.NO_PARTITION, ST.TOO_LONG}
    assert sorted(map(str, bad.select(*KEY, "reason").collect())) == sorted(map(str, ST.unroutable_metrics(
        m.unionByName(long_page), ST.partition_calendar(spark, "2024-01-10", 3)).select(*KEY, "reason").collect()))
    SK.upsert_metrics(long_page, 1, root, run=1)
    assert spark.read.parquet(os.path.join(root, "quarantine")).filter("batch_id = 1").first().reason == ST.TOO_LONG


def test_metric_days_are_deleted_only_when_named(spark, scratch):
    root, m = os.path.join(scratch, "store"), _metrics(spark)
    SK.upsert_metrics(m, 0, root, run=1)
    SK.compact_metrics(spark, root)
    SK.upsert_metrics(m, 1, root, run=1)  # old days are in the changelog as well
    days = {r.window_date for r in SK.to_table_rows(m).select("window_date").distinct().collect()}
    gone = ST.delete_metric_days(spark, root, "2024-01-24")
    assert gone == sorted(d for d in days if d < dt.date(2024, 1, 24)) and gone
    want = _rows(m.filter(F.to_date("window_start") >= "2024-01-24"))
    assert _rows(SK.read_metrics(spark, root)) == want
    SK.compact_metrics(spark, root)
    assert _rows(SK.read_metrics(spark, root)) == want
    left = {d for _, ds, _ in os.walk(os.path.join(root, "table")) for d in ds if d.startswith("window_date=")}
    assert min(left) == "window_date=2024-01-24"


def _files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, ns in os.walk(folder) for n in ns if n.endswith(".parquet")}


def test_snapshots_copy_changed_days_only(spark, scratch):
    root, dumps, m = os.path.join(scratch, "store"), os.path.join(scratch, "dumps"), _metrics(spark)
    SK.upsert_metrics(m, 0, root, run=1)
    copied = ST.snapshot(spark, root, dumps, "2024-02-01")
    assert copied == sorted(SK.manifest(spark, root)["days"]) and len(copied) > 5
    first, files = _rows(SK.read_metrics(spark, root)), _files(dumps)
    one = m.orderBy(*KEY).limit(1).withColumn("active_users", F.lit(999).cast("bigint"))
    SK.upsert_metrics(one, 1, root, run=1)
    day = one.select(F.to_date("window_start").cast("string")).first()[0]
    assert ST.snapshot(spark, root, dumps, "2024-02-02") == [day]  # the second night copies one day
    second = _rows(SK.read_metrics(spark, root))
    assert first != second and files.items() <= _files(dumps).items()
    assert ST.snapshot(spark, root, dumps, "2024-02-03") == []
    for date, want in (("2024-02-01", first), ("2024-02-02", second)):
        assert _rows(ST.restore(spark, dumps, date)) == want
        assert ST.restore_store(spark, dumps, date, root) == len(want)
        assert _rows(SK.read_metrics(spark, root)) == want
        SK.compact_metrics(spark, root)
        assert _rows(SK.read_metrics(spark, root)) == want
    with pytest.raises(ValueError):
        ST.restore_store(spark, dumps, "2024-03-01", root)
    # old dumps go, and with them only the files that no younger dump names
    assert ST.prune_snapshots(spark, dumps, "2024-02-08") == ([], [])
    old, gone = ST.prune_snapshots(spark, dumps, "2024-02-09")
    assert old == ["2024-02-01"] and [os.path.basename(p) for p in gone] == [f"window_date={day}"]
    assert _rows(ST.restore(spark, dumps, "2024-02-02")) == second
    assert not ST._differs(ST.restore(spark, dumps, "2024-02-02"), ST.snapshots(spark, dumps)["2024-02-02"]["checks"])
    with pytest.raises(ValueError):
        ST.restore(spark, dumps, "2024-02-01")


def test_a_damaged_snapshot_leaves_the_store_alone(spark, scratch):
    root, dumps, m = os.path.join(scratch, "store"), os.path.join(scratch, "dumps"), _metrics(spark)
    SK.upsert_metrics(m, 0, root, run=1)
    ST.snapshot(spark, root, dumps, "2024-02-01")
    os.remove(sorted(_files(dumps))[0])
    SK.upsert_metrics(m.withColumn("active_users", F.lit(5).cast("bigint")), 1, root, run=1)
    with pytest.raises(ValueError):
        ST.restore_store(spark, dumps, "2024-02-01", root)
    assert {r.active_users for r in SK.read_metrics(spark, root).select("active_users").distinct().collect()} == {5}


def test_quarantined_rows_return_once_and_newer_values_stay(spark, scratch):
    root, m = os.path.join(scratch, "store"), _metrics(spark)
    long_page = m.orderBy(*KEY).limit(1).withColumn("page_url", F.lit("/" + "x" * 600))
    SK.upsert_metrics(m.unionByName(long_page), 0, root, run=1, calendar=ST.partition_calendar(spark, "2024-01-10", 3))
    held = spark.read.parquet(os.path.join(root, "quarantine")).filter(F.col("reason") == ST.NO_PARTITION)
    n = held.count()
    newer = m.filter(F.to_date("window_start") == "2024-01-20").withColumn("active_users", F.lit(77).cast("bigint"))
    SK.upsert_metrics(newer, 1, root, run=1)  # its day exists by now
    SK.compact_metrics(spark, root)
    part = ST.partition_calendar(spark, "2024-01-20", 3)
    back = held.filter(F.to_date("window_start").between(F.lit("2024-01-19").cast("date"), F.lit("2024-01-23").cast("date"))).count()
    assert ST.replay_quarantine(spark, root, part) == back > 0
    assert ST.replay_quarantine(spark, root, part) == 0  # marked in the manifest

    def right(days):
        want = m.filter(F.to_date("window_start").isin([dt.date(2024, 1, d) for d in days]))
        want = want.withColumn("active_users", F.when(F.to_date("window_start") == "2024-01-20", F.lit(77)).otherwise(F.col("active_users")))
        assert _rows(SK.read_metrics(spark, root)) == _rows(want)

    right([*range(9, 14), *range(19, 24)])
    assert ST.replay_quarantine(spark, root) == n - back - 1  # every day exists: the rest returns, but for the overlong page
    right(range(1, 32))
    SK.compact_metrics(spark, root)
    right(range(1, 32))
    SK.compact_metrics(spark, root)
    assert ST.replay_quarantine(spark, root) == 0 and not os.listdir(os.path.join(root, "returned"))
    right(range(1, 32))  # the overlong page never returns


def test_every_part_of_the_two_batch_store_is_needed(spark):
    """metrics_latest and metrics_reader: without batch 0, batch 1 or the
    compacted days the answer is another one."""
    from clickpulse.plans import registry as R
    want = _rows(_metrics(spark))
    for compact in (False, True):
        root = R._two_batches(spark, SF0001, compact)
        state = SK.manifest(spark, root)
        batches = SK.open_batches(spark, root, state)
        assert _rows(SK.read_metrics(spark, root)) == want
        parts = SK._parts(spark, root, state, batches)
        if compact:
            assert state["days"] and batches == [(1, 1)] and len(parts) == 2
            alone = [[p] for p in parts]
        else:
            assert not state["days"] and batches == [(1, 0), (1, 1)]
            alone = [SK._parts(spark, root, state, [b]) for b in batches]
        for part in alone:
            rows = SK.latest_metrics(SK._union(part))
            assert 0 < rows.count() < len(want) or _rows(rows) != want
        newest = SK.latest_metrics(SK._union(alone[-1]))
        assert 0 < newest.count() < len(want)  # batch 1 holds the changed groups only


def test_a_batch_of_one_day_has_as_many_writers_as_it_needs(spark, scratch, monkeypatch):
    root, m = os.path.join(scratch, "store"), _metrics(spark).filter(F.to_date("window_start") == "2024-01-10")
    monkeypatch.setattr(SK, "ROWS_PER_WRITER", 10)
    SK.upsert_metrics(m, 0, root, run=1)
    n = m.count()
    assert len(_files(os.path.join(root, "changelog"))) > min(8, n // 20)
    assert _rows(SK.read_metrics(spark, root)) == _rows(m)


def test_zone_map_prunes_the_panels_on_update_times(spark, scratch):
    from clickpulse.plans import serving as S
    root, m = os.path.join(scratch, "store"), _metrics(spark)
    days = F.to_date("window_start")
    SK.upsert_metrics(m.filter(days < "2024-01-20"), 0, root, run=1)
    SK.compact_metrics(spark, root)
    SK.upsert_metrics(m.filter(days >= "2024-01-20"), 1, root, run=1)
    store = SK.read_metrics(spark, root)
    plain = m.withColumn("window_date", days).drop("window_date")
    now = plain.agg(F.max("updated_at").cast("timestamp_ntz")).first()[0] + dt.timedelta(minutes=7)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    fresh = S.freshness_seconds(store, now)
    assert "FileScan" not in plan(fresh) and fresh.first() == S.freshness_seconds(plain, now).first()
    for got, want in ((S.upserts_per_minute(store, now), S.upserts_per_minute(plain, now)),
                      (S.recent_upserts(store), S.recent_upserts(plain)),
                      (S.upserts_per_minute(store, "2024-01-15 12:00:00"), S.upserts_per_minute(plain, "2024-01-15 12:00:00")),
                      (S.upserts_per_minute(store, now, whole=True), S.upserts_per_minute(plain, now, whole=True))):
        assert [tuple(r[c] for c in want.columns) for r in got.collect()] == [tuple(r) for r in want.collect()]
    for pruned in (S.upserts_per_minute(store, now), S.recent_upserts(store)):
        text = plan(pruned)
        assert "PartitionFilters: [" in text and "window_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert S.upserts_per_minute(store, "2023-01-01").count() == 0
    # zones that a store does not have: the panels read the rows
    state = SK.manifest(spark, root)
    SK._publish(spark, root, {**state, "version": state["version"] + 1, "zones": {}})
    assert S.freshness_seconds(SK.read_metrics(spark, root), now).first() == S.freshness_seconds(plain, now).first()


def test_partition_calendar(spark):
    cal = ST.partition_calendar(spark, "2026-09-18", 3).orderBy("range_from").collect()
    assert [r.partition for r in cal] == [f"windowed_user_metrics_202609{d}" for d in range(17, 22)]
    assert all((r.range_to - r.range_from).days == 1 for r in cal)


@pytest.mark.parametrize("guard", [None, "1 hour"])
def test_future_poison(spark, scratch, guard):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _write_file(spark, src, 0, [_payload("2099-01-01T00:00:00Z", user="evil")])
    _write_file(spark, src, 1, [_payload("2026-09-18T09:00:00Z", page="/spacer")])  # spacer batch
    _write_file(spark, src, 2, [_payload("2026-09-18T10:00:05Z"), _payload("2026-09-18T10:00:15Z", user="u2")])
    root = os.path.join(scratch, "out")
    raw = read_records(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=src, stream=True)
    cfg = JobConfig(metrics_root=os.path.join(root, "store"), dlq_path=os.path.join(root, "dlq"),
                    checkpoint=os.path.join(scratch, "ck"), distinct="exact",
                    trigger={"availableNow": True}, max_future_skew=guard)
    qs = start(spark, raw, cfg)
    spark.streams.awaitAnyTermination(180)  # dual query: returns when either ends
    for q in qs:
        q.awaitTermination(180)
    got = SK.read_metrics(spark, os.path.join(root, "store"))
    normal = got.filter((F.col("window_start") < "2030-01-01") & (F.col("page_url") == "/p")).count()
    if guard:
        assert normal == 7  # 10:00:05 and 10:00:15 windows, all kept
        dlq = spark.read.json(os.path.join(root, "dlq")).collect()
        assert len(dlq) == 1 and "too far in the future" in dlq[0].value
    else:
        assert normal == 0  # the poisoned watermark made them late


def test_default_mode_and_command_line(spark, scratch):
    """The job as the command starts it: approximate users, progress recorded,
    a second run goes on where the first ended."""
    from clickpulse.streaming.__main__ import main, parser
    from clickpulse.operators.metrics import within_bound
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    times = [f"2026-09-18T10:{i // 60:02d}:{i % 60:02d}Z" for i in range(0, 300, 3)]
    _write_file(spark, src, 0, [_payload(t, user=f"u{i}") for i, t in enumerate(times)] + ["{bad"])
    args = ["--source", "parquet", "--source-path", src, "--metrics-root", os.path.join(scratch, "store"),
            "--checkpoint", os.path.join(scratch, "ck"), "--dlq-path", os.path.join(scratch, "dlq"),
            "--progress-path", os.path.join(scratch, "progress"), "--compact-every", "1", "--available-now",
            *(x for n in ("late", "totals", "latency") for x in (f"--{n}-path", os.path.join(scratch, n)))]
    assert parser().parse_args(args).distinct == "approx"
    main(args)
    _write_file(spark, src, 1, [_payload("2026-09-18T10:04:59Z", user="late")])
    main(args)
    got = SK.read_metrics(spark, os.path.join(scratch, "store"))
    raw = spark.read.schema(KAFKA_RECORD_SCHEMA).parquet(src)
    from clickpulse.sources.records import decode_records
    exact = page_metrics(events_pipeline(decode_records(raw)), distinct="exact").withColumnRenamed("active_users", "exact")
    j = got.join(exact.select(*KEY, "exact"), KEY)
    assert j.count() == got.count() == exact.count()
    assert j.filter(~within_bound("active_users", "exact")).count() == 0
    assert spark.read.json(os.path.join(scratch, "dlq")).count() == 1
    assert os.listdir(os.path.join(scratch, "store", "changelog")) == ["run=1"]
    state = SK.manifest(spark, os.path.join(scratch, "store"))
    assert state["version"] >= 2 and SK.open_batches(spark, os.path.join(scratch, "store"), state) == []
    from clickpulse.streaming.latency import latency_quantiles, read_latency
    from clickpulse.streaming.totals import read_totals
    assert read_totals(spark, os.path.join(scratch, "totals"), "totals").first()[:] == (101, 0, 0, 1)
    assert latency_quantiles(read_latency(spark, os.path.join(scratch, "latency"))).first()["events"] == 101
    assert spark.read.parquet(os.path.join(scratch, "late")).count() == 0  # nothing came late
    for bad in (["--metrics-root", "x", "--checkpoint", "y", "--dlq-path", "z"], ["--source", "parquet", *args[4:]],
                [*args, "--alerts-path", "a"]):
        with pytest.raises(SystemExit):
            main(bad)


def test_offsets_of_recorded_progress(spark):
    from clickpulse.plans.insights import consumer_lag
    from clickpulse.streaming.job import PROGRESS_SCHEMA
    source = lambda end, latest: json.dumps([{"description": "k", "endOffset": end, "latestOffset": latest}])
    rows = [("m", "r1", 4, 10, 0, None, 5, 4, source({"t": {"0": 7, "1": 9}}, {"t": {"0": 8, "1": 9}})),
            ("m", "r1", 5, 10, 0, None, 5, 4, source({"t": {"0": 8, "1": 12}}, {"t": {"0": 20, "1": 12}})),
            ("files", "r2", 0, 1, 0, None, 5, 4, json.dumps([{"description": "f", "endOffset": {"logOffset": 0}, "latestOffset": None}]))]
    o = offsets_frame(spark.createDataFrame(rows, PROGRESS_SCHEMA))
    got = {(r.topic, r.partition): (r.committed_offset, r.end_offset) for r in o.collect()}
    assert got == {("t", 0): (8, 20), ("t", 1): (12, 12)}
    assert {r.partition: r.lag for r in consumer_lag(o).collect()} == {0: 12, 1: 0}
