"""Operators that run beside the job: live alerts, late rows, exact users, totals."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from clickpulse.operators.metrics import events_pipeline, page_metrics, parse_events, with_event_time
from clickpulse.operators.validate import accept_gate, split_valid, with_stream_validation
from clickpulse.sources.records import decode_records, read_records
from clickpulse.streaming import alerts as A
from clickpulse.streaming import late as L
from test_streaming import _payload, _write_file


def _gated(spark, src):
    return accept_gate(decode_records(read_records(spark, "parquet", {}, path=src, stream=True)))


def _wait(ready, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if ready():
            return
        time.sleep(0.3)
    raise AssertionError("nothing happened in time")


def _seen(spark, path):
    if not os.path.exists(os.path.join(path, "_spark_metadata")):
        return []
    rows = spark.read.schema(A.TRANSITIONS).parquet(path).orderBy("at").collect()
    return [(r.alertname, r.state) for r in rows]


def test_silence_fires_without_input_and_ends_with_the_next_event(spark, scratch):
    src, out, ck = (os.path.join(scratch, d) for d in ("in", "alerts", "ck"))
    os.makedirs(src)
    rules = (A.LiveRule("quiet", "warning", "accepted", 2, 2),)

    def go():
        return A.start_alerts(_gated(spark, src), out, ck, rules, step_s=1, trigger={"processingTime": "1 second"}, name="alerts-test")

    q = go()
    try:
        _wait(lambda: _seen(spark, out)[-1:] == [("quiet", "firing")])  # no record has ever come
    finally:
        q.stop()
    assert _seen(spark, out) == [("quiet", "pending"), ("quiet", "firing")]
    first = spark.read.parquet(out).filter("state = 'firing'").first()
    assert first["at"] - first["since"] >= dt.timedelta(seconds=2) and first["events"] == 0
    q = go()  # the restart goes on with a firing rule: it fires no second time
    try:
        time.sleep(4)
        assert _seen(spark, out) == [("quiet", "pending"), ("quiet", "firing")]
        assert [r.alertname for r in A.current_alerts(spark.read.parquet(out)).collect()] == ["quiet"]
        _write_file(spark, src, 0, [_payload("2026-09-18T10:00:05Z")])
        _wait(lambda: ("quiet", "resolved") in _seen(spark, out))
        _wait(lambda: _seen(spark, out).count(("quiet", "firing")) == 2)  # silence again
    finally:
        q.stop()
    assert [s for _, s in _seen(spark, out)] == ["pending", "firing", "resolved", "pending", "firing"]


def test_rule_steps_match_the_batch_rules(spark):
    """The processor, step by step against the batch operators on the same counts."""
    import random
    from clickpulse.operators import health as H
    rng, step = random.Random(2), 15
    arrivals = sorted(rng.choice([rng.uniform(0, 600), rng.uniform(1500, 1600), rng.uniform(2400, 3600)]) for _ in range(900))
    t0 = 1_700_000_010
    rows = [(t0 + a, "accepted" if rng.random() < 0.6 else "rejected") for a in arrivals]

    class Values(dict):
        def getValue(self, k): return self.get(k)
        def updateValue(self, k, v): self[k] = v
        def iterator(self): return list(self.items())
        def removeKey(self, k): self.pop(k)

    class Value:
        v = None
        def exists(self): return self.v is not None
        def get(self): return self.v
        def update(self, v): self.v = v

    class Now:
        def __init__(self, ms): self.ms = ms
        def getCurrentProcessingTimeInMs(self): return self.ms

    class Handle:
        def getMapState(self, *a): return Values()
        def getValueState(self, *a): return Value()
        def registerTimer(self, ms): self.timer = ms

    for rule in (A.LiveRule("high", "critical", "rejected", 120, 60, 0.4), A.LiveRule("quiet", "warning", "accepted", 300, 120)):
        p, handle, out = A.RuleProcessor([rule], step), Handle(), []
        p.init(handle)
        first = int(t0 * 1000)
        own = [(int(t * 1000), s) for t, s in rows if s == rule.status]
        list(p.handleInputRows((rule.name,), [{"n": 0}], Now(first - 1)))
        last = int((t0 + 3700) * 1000)
        i = 0
        for ms in range(first, last, 5000):  # batches of five seconds
            n = 0
            while i < len(own) and own[i][0] <= ms:
                n, i = n + 1, i + 1
            list(p.handleInputRows((rule.name,), [{"n": n}], Now(ms)))
            if handle.timer <= ms:
                out += list(p.handleExpiredTimer((rule.name,), Now(ms), None))
        begins = [r["at"] for r in out if r["state"] == "firing"]
        ends = [r["at"] for r in out if r["state"] == "resolved"]
        # the batch operators, on records that count when their batch takes them
        taken = [(dt.datetime.fromtimestamp(-(-(ms - first) // 5000) * 5 + first / 1000, dt.timezone.utc).replace(tzinfo=None), s) for ms, s in own]
        edge = [(dt.datetime.fromtimestamp(x / 1000, dt.timezone.utc).replace(tzinfo=None), "rejected" if rule.status == "accepted" else "refused")
                for x in (first, last)]
        counts = H.step_counts(spark.createDataFrame(taken + edge, "src_ts timestamp, gate_status string"))
        if rule.per_second is None:
            some = H.sliding_counts(counts, rule.range_s).filter("accepted > 0").select("ts")
            cond = H.time_spine(counts).join(some, "ts", "left_anti")
        else:
            cond = H.sliding_counts(counts, rule.range_s).filter(F.col("rejected") / rule.range_s > rule.per_second).select("ts")
        fired = sorted(r["ts"] for r in H.sustained(cond, [], rule.for_s).collect())
        d = dt.timedelta(seconds=step)
        want = [t for t in fired if t - d not in fired]
        assert begins == want and begins
        assert ends == [t + d for t in fired if t + d not in fired][:len(ends)] and len(ends) >= len(begins) - 1


def _late_stream(spark, src):
    raw = read_records(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=src, stream=True)
    valid, _ = split_valid(with_stream_validation(decode_records(raw)))
    return with_event_time(parse_events(valid))


def test_late_rows_go_to_a_side_table_once(spark, scratch):
    src, out, ck = (os.path.join(scratch, d) for d in ("in", "late", "ck"))
    os.makedirs(src)
    files = [["10:00:05"], ["10:10:00"], ["10:10:01"], ["10:00:07", "10:08:30", "10:07:59"]]
    for i, ts in enumerate(files):
        _write_file(spark, src, i, [_payload(f"2026-09-18T{t}Z") for t in ts])

    def go():
        q = L.start_late(_late_stream(spark, src), out, ck, trigger={"availableNow": True}, name="late-test")
        q.awaitTermination(120)
        return sorted((r.event_time.strftime("%H:%M:%S"), r.window_start.strftime("%H:%M:%S")) for r in L.read_late(spark, out).collect())

    want = [("10:00:07", f"09:59:{s}") for s in range(10, 60, 10) if s > 0] + [("10:00:07", "10:00:00"), ("10:07:59", "10:07:00")]
    assert go() == sorted(want)
    assert go() == sorted(want)  # a restart adds nothing
    _write_file(spark, src, 4, [_payload("2026-09-18T10:07:58Z"), _payload("2026-09-18T10:12:00Z")])
    assert go() == sorted([*want, ("10:07:58", "10:07:00")])
    audit = L.late_audit(L.read_late(spark, out)).first()
    assert (audit.page_url, audit.events, audit.pairs) == ("/p", 3, 8) and audit.worst_behind_s > 400


def _stream(spark, src):
    return _late_stream(spark, src).withWatermark("event_time", "2 minutes")


def _exact_run(spark, src, root, ck):
    from clickpulse.streaming import sink as SK
    from clickpulse.streaming.users import exact_page_metrics
    q = exact_page_metrics(_stream(spark, src)).writeStream.foreachBatch(SK.MetricsSink(root, 1)).outputMode("update") \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination(180)


def test_exact_users_match_the_batch_with_bounded_state(spark, scratch):
    import random
    from clickpulse.streaming import inspect as I
    from clickpulse.streaming import sink as SK
    src, root, ck = (os.path.join(scratch, d) for d in ("in", "store", "ck"))
    os.makedirs(src)
    rng, t0 = random.Random(5), dt.datetime(2026, 9, 18, 10)
    every = []
    for i in range(4):  # files overlap in time by less than the watermark
        rows = [_payload((t0 + dt.timedelta(seconds=60 * i + rng.randint(0, 100))).strftime("%Y-%m-%dT%H:%M:%SZ"),
                         user=f"u{rng.randint(0, 12)}", page=rng.choice(["/a", "/a", "/b", ""]),
                         et=rng.choice(["page_view", "cart_add", "purchase"])) for _ in range(60)]
        every += rows
        _write_file(spark, src, i, rows)
        if i == 1:
            _exact_run(spark, src, root, ck)
    _exact_run(spark, src, root, ck)  # a restart goes on
    raw = decode_records(read_records(spark, "parquet", {}, path=src, stream=False))
    want = page_metrics(events_pipeline(raw), distinct="exact")
    cols = ["window_start", "window_end", "page_url", "active_users", "cart_additions", "purchases", "cart_abandonment_rate"]
    assert sorted(map(tuple, SK.read_metrics(spark, root).select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # state: a row per page and user, not one per window and user; it ends with the windows
    users = I.state_rows(spark, ck, variable="users")
    assert 0 < users.count() <= 3 * 13 and want.agg(F.sum("active_users")).first()[0] > 4 * users.count()
    _write_file(spark, src, 8, [_payload("2026-09-18T12:00:00Z", user="v", page="/c")])
    _write_file(spark, src, 9, [_payload("2026-09-18T12:00:01Z", user="v", page="/c")])
    _exact_run(spark, src, root, ck)
    left = I.state_rows(spark, ck, variable="users").select("key.page_url").distinct().collect()
    assert [r.page_url for r in left] == ["/c"]
    assert I.state_rows(spark, ck, variable="windows").count() == 6


def test_totals_equal_the_batch_operators_after_every_batch(spark, scratch):
    from clickpulse.operators import producer as P
    from clickpulse.streaming.totals import read_totals, start_totals
    src, root, ck = (os.path.join(scratch, d) for d in ("in", "totals", "ck"))
    os.makedirs(src)

    def gate(stream):
        raw = read_records(spark, "parquet", {"maxFilesPerTrigger": "1"} if stream else {}, path=src, stream=stream)
        return accept_gate(decode_records(raw.withColumns({"received_at": F.col("timestamp"), "src_id": F.col("offset")})))

    for i in range(3):
        _write_file(spark, src, i, [_payload("2026-09-18T10:00:05Z", et=e) for e in ("page_view", "cart_add", "nonsense")] + ["{}", "{bad"]
                    + [_payload("2026-09-18T10:00:05Z", user="") for _ in range(6 * i)])
        q = start_totals(gate(True), root, ck, "received_at", trigger={"availableNow": True}, name="totals-test")  # each time a restart
        q.awaitTermination(120)
        g = gate(False)
        for table, want in (("by_type", P.published_by_type(g)), ("by_reason", P.rejected_by_reason(g)), ("totals", P.publish_totals(g))):
            assert sorted(map(str, read_totals(spark, root, table).collect())) == sorted(map(str, want.collect()))
        want = [(r.rejected_at, str(r.src_id), r.payload, r.reason) for r in P.recent_rejections(g, "received_at", "src_id").collect()]
        assert sorted(map(tuple, read_totals(spark, root, "recent").collect())) == sorted(want)
    assert read_totals(spark, root, "recent").count() == 10
    assert len([d for d in os.listdir(root) if d.startswith("batch=")]) == 2


def test_latency_sketches_merge_within_their_error(spark, scratch):
    from clickpulse.streaming import latency as Y
    now = F.lit("2026-09-20 00:00:00").cast("timestamp")
    root = os.path.join(scratch, "latency")
    events = spark.range(40_000).select(F.timestamp_micros(1_789_689_600_000_000 + (F.col("id") * 7919 % 40_000) * 4_000_000).alias("event_time"))
    for b in range(4):  # batches of interleaved events over two days
        part = events.filter(F.unix_seconds("event_time") % 16 == 4 * b)
        Y.latency_sketches(part, now).coalesce(1).write.mode("overwrite").parquet(f"{root}/changelog/run=1/batch_id={b}")
        if b == 2:
            Y.compact_latency(spark, root)
    exact = events.select(F.to_date("event_time").alias("day"), (F.unix_millis(now) - F.unix_millis("event_time")).alias("ms"))
    for by in ([], ["day"]):
        got = {tuple(r[c] for c in by): r for r in Y.latency_quantiles(Y.read_latency(spark, root), *by).collect()}
        for key, r in got.items():
            mine = exact.filter(F.col("day") == key[0]) if by else exact
            n = mine.count()
            assert r["events"] == n
            for q, name in zip(Y.QUANTILES, ("p50_ms", "p95_ms", "p99_ms")):
                rank = mine.filter(F.col("ms") <= r[name]).count() / n
                assert abs(rank - q) < 0.015
    Y.compact_latency(spark, root)
    assert Y.read_latency(spark, root).count() == exact.select("day").distinct().count()


def test_latency_of_a_stream_is_from_real_write_times(spark, scratch):
    from clickpulse.streaming import latency as Y
    src, root, ck = (os.path.join(scratch, d) for d in ("in", "latency", "ck"))
    os.makedirs(src)
    stamp = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=50)
    for i in range(2):
        _write_file(spark, src, i, [_payload(stamp.strftime("%Y-%m-%dT%H:%M:%SZ")) for _ in range(20)])
    Y.start_latency(_late_stream(spark, src), root, ck, 1, compact_every=1, trigger={"availableNow": True}).awaitTermination(120)
    r = Y.latency_quantiles(Y.read_latency(spark, root)).first()
    assert r["events"] == 40 and 49_000 < r["p50_ms"] <= r["p99_ms"] < 50_000 + 120_000


def test_state_is_read_as_a_table(spark, scratch):
    from clickpulse.streaming import inspect as I
    src, ck = (os.path.join(scratch, d) for d in ("in", "ck"))
    os.makedirs(src)
    _write_file(spark, src, 0, [_payload(f"2026-09-18T10:00:{i:02d}Z", user=f"u{i}", page="/hot" if i < 50 else "/cold") for i in range(60)])
    q = page_metrics(_stream(spark, src), distinct="approx", streaming=True).writeStream.outputMode("update") \
        .foreachBatch(lambda b, i: b.write.format("noop").mode("overwrite").save()).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination(120)
    ops = I.state_operators(spark, ck).collect()
    assert [r["operatorName"] for r in ops] == ["stateStoreSave"]
    rows = I.state_rows(spark, ck)
    raw = decode_records(read_records(spark, "parquet", {}, path=src, stream=False))
    want = page_metrics(events_pipeline(raw), distinct="exact").select("window_start", "window_end", "page_url")
    assert sorted(map(tuple, I.open_windows(rows).collect())) == sorted(map(tuple, want.collect()))
    pages = I.state_by_page(rows).collect()
    assert [r.page_url for r in pages] == ["/hot", "/cold"] and pages[0]["rows"] > pages[1]["rows"]
    parts = I.state_by_partition(rows).collect()
    assert sum(r["rows"] for r in parts) == rows.count() and all(r["bytes"] > 0 for r in parts)


def test_progress_table_stays_small_and_loses_no_row(spark, scratch):
    from clickpulse.streaming.job import ProgressTable, progress_frame
    path = os.path.join(scratch, "progress")
    table = ProgressTable(spark, path, flush_rows=25, flush_s=3600, max_files=6)
    for i in range(1000):
        table.add(("q", "r", i, 1, 0, None, 1, 1, "[]"), "2026-09-18" if i < 900 else "2026-09-19")
        if i % 25 == 24:
            table.flush()  # the table's own thread may have been first
    table.flush()
    rows = progress_frame(spark, path)
    assert rows.count() == 1000 and {r.batch_id for r in rows.collect()} == set(range(1000))
    files = [n for d, _, ns in os.walk(path) for n in ns if n.endswith(".json")]
    assert len(files) <= 2 * 7 + 2
    assert not [n for n in os.listdir(path) if n.startswith("_merge")]
