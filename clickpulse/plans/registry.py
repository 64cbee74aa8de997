"""Registry of named queries (one per operator of the inventory) and their
DuckDB oracles.  Every query reads the driver's tables (``events``) through
the adapter and runs over the whole table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.plans import common as K
from clickpulse.plans import oracle as O
from clickpulse.operators import dlq as D
from clickpulse.operators import metrics as M
from clickpulse.operators import producer as P
from clickpulse.operators import validate as V
from clickpulse.session import checkpoint_path, stored

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


W = O.with_
BASE = (O.ADAPTER,)
SV = (O.ADAPTER, O.STREAM)
EV = (O.ADAPTER, O.STREAM, O.EVENTS)
CV = (O.ADAPTER, O.CONTRACT)
GT = (O.ADAPTER, O.CONTRACT, O.GATE)

# ---------------------------------------------------------------- 2.1 / 2.2


@register("decode_records", W(*BASE) + """
SELECT src_id, cls, msg_key, raw_value, "partition", "offset" FROM raw""")
def q_decode(spark, sf):
    return K.raw(spark, sf).select("src_id", "cls", "msg_key", "raw_value", "partition", "offset")


@register("stream_validate", W(*SV) + " SELECT src_id, cls, validation_error FROM sv")
def q_stream_validate(spark, sf):
    return K.validated(spark, sf).select("src_id", "cls", "validation_error")


@register("route_valid", W(*SV) + """
SELECT src_id, msg_key, "partition", "offset" FROM sv WHERE validation_error IS NULL""")
def q_route_valid(spark, sf):
    return V.route_valid(K.validated(spark, sf)).select("src_id", "msg_key", "partition", "offset")


@register("route_invalid", W(*SV) + """
SELECT src_id, validation_error FROM sv WHERE validation_error IS NOT NULL""")
def q_route_invalid(spark, sf):
    return V.route_invalid(K.validated(spark, sf)).select("src_id", "validation_error")


def _contract_out(df: DataFrame) -> DataFrame:
    return df.select(
        "src_id", "contract_status",
        F.coalesce(F.size("validation_errors"), F.lit(0)).cast("bigint").alias("n_errors"),
        F.array_join(F.array_sort(F.array_distinct("violated")), ",").alias("rules"))


@register("contract_validate", W(*CV) + """
SELECT src_id, contract_status, CAST(coalesce(n_errors, 0) AS BIGINT) AS n_errors, tags AS rules FROM cv""")
def q_contract_validate(spark, sf):
    return _contract_out(K.contract(spark, sf))


@register("contract_join_errors", W(*CV) + """
SELECT src_id, reason FROM cv WHERE contract_status = 'invalid'""")
def q_contract_join(spark, sf):
    c = K.contract(spark, sf)
    return c.filter(F.col("contract_status") == "invalid").select(
        "src_id", V.join_errors(F.col("validation_errors")).alias("reason"))


def _dlq(spark, sf) -> DataFrame:
    return D.to_dlq(V.route_invalid(K.validated(spark, sf)), keep=["src_id"])


def _dlq_oracle_rules() -> str:
    from clickpulse import contracts as C
    rules = O.contract_rules("v", C.DLQ_CONTRACT)
    n = " + ".join(f"({m} IS NOT NULL)::INT" for _, m in rules)
    return n


@register("contract_validate_dlq", W(*SV) + """,
env AS (SELECT src_id, CAST(json_object('original_payload', coalesce(raw_value, ''),
   'failure_reason', 'schema_validation_error',
   'validation_errors', [validation_error],
   'failed_at', strftime(now() AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f+00:00'),
   'source_partition', "partition", 'source_offset', "offset") AS VARCHAR) AS v
   FROM sv WHERE validation_error IS NOT NULL)
SELECT src_id, CASE WHEN n = 0 THEN 'valid' ELSE 'invalid' END AS dlq_status, CAST(n AS BIGINT) AS n_errors
FROM (SELECT src_id, """ + _dlq_oracle_rules() + " AS n FROM env)")
def q_contract_dlq(spark, sf):
    d = D.validate_dlq(_dlq(spark, sf))
    return d.select("src_id", F.col("contract_status").alias("dlq_status"),
                    F.size("validation_errors").cast("bigint").alias("n_errors"))


@register("dlq_envelope", W(*SV) + """
SELECT src_id, coalesce(msg_key, 'dlq_key') AS "key", coalesce(raw_value, '') AS original_payload,
  'schema_validation_error' AS failure_reason, CAST(1 AS INT) AS n_errors, validation_error AS first_error,
  "partition" AS source_partition, "offset" AS source_offset
FROM sv WHERE validation_error IS NOT NULL""")
def q_dlq_envelope(spark, sf):
    p = D.parse_dlq(_dlq(spark, sf))
    return p.select("src_id", "key", "original_payload", "failure_reason",
                    F.size("validation_errors").alias("n_errors"),
                    F.element_at("validation_errors", 1).alias("first_error"),
                    "source_partition", "source_offset")


@register("accept_gate", W(*GT) + """
SELECT src_id, gate_status, CASE gate_status WHEN 'refused' THEN 'Missing JSON payload'
  WHEN 'rejected' THEN 'Schema Validation Failed: ' || reason WHEN 'accepted' THEN 'Event published' END AS message
FROM gate""")
def q_accept_gate(spark, sf):
    return K.gated(spark, sf).select("src_id", "gate_status", "message")


@register("published_by_type", W(*GT) + """
SELECT json_extract_string(raw_value, '$.event_type') AS event_type, count(*) AS published
FROM gate WHERE gate_status = 'accepted' GROUP BY 1""")
def q_published(spark, sf):
    return P.published_by_type(K.gated(spark, sf))


@register("rejected_by_reason", W(*GT) + """
SELECT reason, count(*) AS rejected FROM gate WHERE gate_status = 'rejected' GROUP BY 1""")
def q_rejected(spark, sf):
    return P.rejected_by_reason(K.gated(spark, sf))


@register("recent_rejections", W(*GT) + """
SELECT src_ts AS rejected_at, src_id, raw_value AS payload, reason FROM gate
WHERE gate_status = 'rejected' ORDER BY src_ts DESC, src_id DESC LIMIT 10""")
def q_recent_rejections(spark, sf):
    r = P.recent_rejections(K.gated(spark, sf), ts="src_ts", tie="src_id", n=10)
    return r.select(K.ntz("rejected_at"), "src_id", "payload", "reason")


@register("publish_totals", W(*GT) + """
SELECT count(*) FILTER (WHERE gate_status = 'accepted') AS published,
       count(*) FILTER (WHERE gate_status = 'rejected') AS rejected,
       count(*) FILTER (WHERE gate_status = 'refused') AS refused,
       count(*) FILTER (WHERE gate_status = 'error') AS errors FROM gate""")
def q_publish_totals(spark, sf):
    return P.publish_totals(K.gated(spark, sf))


# ---------------------------------------------------------------- 2.3

@register("parse_events", W(*EV) + """
SELECT src_id, schema_version, event_id, user_id, session_id, event_type, page_url, product_id,
  product_category, round(price_inr, 6) AS price_inr, "timestamp" FROM ev""")
def q_parse_events(spark, sf):
    e = K.events(spark, sf)
    return e.select("src_id", "schema_version", "event_id", "user_id", "session_id", "event_type",
                    "page_url", "product_id", "product_category", K.r6("price_inr"), "timestamp")


@register("event_time", W(*EV) + " SELECT src_id, event_time FROM ev")
def q_event_time(spark, sf):
    return K.events(spark, sf).select("src_id", K.ntz("event_time"))


@register("page_key", W(*EV) + """
SELECT src_id, coalesce(nullif(page_url, ''), '/unknown') AS page_url FROM ev""")
def q_page_key(spark, sf):
    return K.events(spark, sf).select("src_id", M.page_key(F.col("page_url")).alias("page_url"))


@register("valid_filter", W(*EV) + """
SELECT src_id, event_type FROM ev WHERE event_time IS NOT NULL""")
def q_valid_filter(spark, sf):
    return M.valid_events(K.events(spark, sf)).select("src_id", "event_type")


# ---------------------------------------------------------------- 2.4

@register("sliding_window", W(*EV, O.windows(60, 10)) + """
SELECT src_id, window_start, window_end FROM winx""")
def q_sliding_window(spark, sf):
    e = K.events(spark, sf)
    w = e.select("src_id", F.window("event_time", "60 seconds", "10 seconds").alias("w"))
    return w.select("src_id", K.ntz("w.start", "window_start"), K.ntz("w.end", "window_end"))


def _metric_cols(df: DataFrame, *cols: str) -> DataFrame:
    out = [K.ntz("window_start"), K.ntz("window_end"), "page_url"]
    for c in cols:
        if c == "cart_abandonment_rate":
            out.append(K.r6(c))
        elif c == "updated_at":
            out.append(K.ntz(c))
        else:
            out.append(c)
    return df.select(*out)


def _metric_oracle(length: int, slide: int, *cols: str) -> str:
    sel = ["window_start", "window_end", "page_url"] + [
        f"round({c}, 6) AS {c}" if c == "cart_abandonment_rate" else c for c in cols]
    return W(*EV, O.metrics(length, slide)) + " SELECT " + ", ".join(sel) + " FROM m"


ALL_METRICS = ("active_users", "cart_additions", "purchases", "cart_abandonment_rate", "updated_at")

for _name, _cols in [("active_users_exact", ("active_users",)),
                     ("cart_additions", ("cart_additions",)),
                     ("purchases", ("purchases",)),
                     ("cart_abandonment", ("cart_additions", "purchases", "cart_abandonment_rate"))]:
    def _q(spark, sf, _cols=_cols):
        return _metric_cols(K.metrics(spark, sf), *_cols)
    register(_name, _metric_oracle(60, 10, *_cols))(_q)


@register("page_metrics", _metric_oracle(60, 10, *ALL_METRICS))
def q_page_metrics(spark, sf):
    """Flagship: all metrics per (60 s / 10 s window, page), exact distinct."""
    return _metric_cols(K.metrics(spark, sf), *ALL_METRICS)


@register("page_metrics_hourly", _metric_oracle(3600, 600, *ALL_METRICS))
def q_page_metrics_hourly(spark, sf):
    return _metric_cols(K.metrics(spark, sf, "1 hour", "10 minutes"), *ALL_METRICS)


@register("page_metrics_tumbling", _metric_oracle(60, 60, *ALL_METRICS))
def q_page_metrics_tumbling(spark, sf):
    return _metric_cols(K.metrics(spark, sf, "60 seconds", None), *ALL_METRICS)


@register("page_metrics_bucketed", _metric_oracle(3600, 60, *ALL_METRICS))
def q_page_metrics_bucketed(spark, sf):
    """1 h windows sliding every minute (60 windows per event): the bucketed
    strategy pre-aggregates per minute before expanding."""
    return _metric_cols(K.metrics(spark, sf, "1 hour", "1 minute", strategy="bucketed"), *ALL_METRICS)


def _approx_checked(spark, sf) -> DataFrame:
    """Exact metrics and whether the HLL++ estimate of the streaming default
    lies within its bound, from one aggregate over the same windows."""
    return M.page_metrics(K.events(spark, sf), distinct="both", updated_at=None)


@register("active_users_approx", W(*EV, O.metrics(60, 10)) + """
SELECT window_start, window_end, page_url, active_users, true AS estimate_within_bound FROM m""")
def q_active_users_approx(spark, sf):
    d = _approx_checked(spark, sf)
    return _metric_cols(d.withColumn("estimate_within_bound", M.within_bound("estimated_users", "active_users")),
                        "active_users", "estimate_within_bound")


@register("page_metrics_approx", W(*EV, O.metrics(3600, 600)) + """
SELECT window_start, window_end, page_url, active_users, cart_additions, purchases,
  round(cart_abandonment_rate, 6) AS cart_abandonment_rate, true AS estimate_within_bound FROM m""")
def q_page_metrics_approx(spark, sf):
    d = M.page_metrics(K.events(spark, sf), "1 hour", "10 minutes", distinct="both", updated_at=None)
    return _metric_cols(d.withColumn("estimate_within_bound", M.within_bound("estimated_users", "active_users")),
                        "active_users", "cart_additions", "purchases", "cart_abandonment_rate", "estimate_within_bound")


# ---------------------------------------------------------------- 2.6 serving

from clickpulse.plans import serving as S  # noqa: E402
from clickpulse.streaming import sink as SK  # noqa: E402
from clickpulse.streaming import storage as ST  # noqa: E402


_STORES: dict = {}


def _stamp(spark, path: str) -> tuple:
    """What changes when the files of an input change."""
    fs, p, _ = SK._fs(spark, path)
    files = fs.listStatus(p)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def _store(spark, sf) -> tuple[DataFrame, dt.datetime]:
    """The metrics store that the panels read, and their 'now': midnight after
    its newest update.  Built once per application and input (its files,
    their sizes and times), as the stream builds it once for all dashboards;
    every panel reads it anew."""
    key = (spark.sparkContext.applicationId, sf, _stamp(spark, f"{sf.rstrip('/')}/events.parquet"))
    if key not in _STORES:
        root = checkpoint_path(spark, f"clickpulse-store-{uuid.uuid4().hex}")
        SK.replace_all(spark, root, SK.to_table_rows(K.metrics(spark, sf)))
        newest = SK.read_metrics(spark, root).agg(F.max("updated_at").cast("timestamp_ntz")).first()[0]
        now = None if newest is None else dt.datetime.combine(newest.date() + dt.timedelta(days=1), dt.time())
        _STORES[key] = (root, now)
    root, now = _STORES[key]
    return SK.read_metrics(spark, root), now


MS = (O.ADAPTER, O.STREAM, O.EVENTS, O.metrics(60, 10),
      "nowt AS (SELECT date_trunc('day', max(updated_at)) + INTERVAL 1 DAY AS as_of FROM m)",
      "lw AS (SELECT * FROM m WHERE window_end = (SELECT max(window_end) FROM m WHERE window_end <= (SELECT as_of FROM nowt)))",
      "rng AS (SELECT * FROM m WHERE window_end <= (SELECT as_of FROM nowt))")


def _serve(name, fn, sql, **kw):
    def q(spark, sf):
        m, now = _store(spark, sf)
        out = fn(m, as_of=now, **kw)
        return out.select(*[K.ntz(c) if t == "timestamp" else (K.r6(c) if t == "double" else c)
                            for c, t in out.dtypes])
    register(name, W(*MS) + " " + sql)(q)


_serve("latest_active_users", S.latest_active_users,
       "SELECT CAST(coalesce(sum(active_users), 0) AS BIGINT) AS users FROM lw")
_serve("latest_cart_adds", S.latest_cart_adds,
       "SELECT CAST(coalesce(sum(cart_additions), 0) AS BIGINT) AS cart_adds FROM lw")
_serve("latest_purchases", S.latest_purchases,
       "SELECT CAST(coalesce(sum(purchases), 0) AS BIGINT) AS purchases FROM lw")
_serve("latest_abandonment", S.latest_abandonment,
       "SELECT coalesce(CAST(sum(cart_additions) - sum(purchases) AS DOUBLE) / nullif(sum(cart_additions), 0), 0.0) AS abandonment FROM lw")
_serve("funnel_series", S.funnel_series,
       "SELECT window_end AS time, CAST(sum(cart_additions) AS BIGINT) AS cart_additions, "
       "CAST(sum(purchases) AS BIGINT) AS purchases FROM rng GROUP BY 1 ORDER BY 1", whole=True)
_serve("top_pages", S.top_pages,
       "SELECT page_url, active_users, cart_additions, purchases, round(cart_abandonment_rate, 3) AS abandonment "
       "FROM lw ORDER BY active_users DESC, page_url LIMIT 15")
_serve("freshness_seconds", S.freshness_seconds,
       "SELECT coalesce(epoch((SELECT as_of FROM nowt) - max(updated_at)), 0.0) AS seconds FROM m")
_serve("latest_page_count", S.latest_page_count, "SELECT count(*) AS pages FROM lw")
_serve("rows_last_24h", S.rows_last_24h,
       "SELECT count(*) AS rows FROM m WHERE window_start > (SELECT as_of FROM nowt) - INTERVAL 24 HOURS")
_serve("pages_per_window", S.pages_per_window,
       "SELECT window_end AS time, count(DISTINCT page_url) AS pages FROM rng GROUP BY 1 ORDER BY 1", whole=True)


@register("abandonment_trend", W(*MS) + """
SELECT window_end AS time, round(CAST(sum(cart_additions) - sum(purchases) AS DOUBLE) / nullif(sum(cart_additions), 0), 6)
  AS abandonment FROM rng GROUP BY 1 ORDER BY 1""")
def q_abandonment_trend(spark, sf):
    m, now = _store(spark, sf)
    t = S.abandonment_trend(m, as_of=now, whole=True)
    return t.select(K.ntz("time"), K.r6("abandonment"))


@register("upserts_per_minute", W(*MS) + """
SELECT date_trunc('minute', updated_at) AS time, count(*) AS rows FROM m
WHERE updated_at <= (SELECT as_of FROM nowt) GROUP BY 1 ORDER BY 1""")
def q_upserts_per_minute(spark, sf):
    m, now = _store(spark, sf)
    return S.upserts_per_minute(m, as_of=now, whole=True).select(K.ntz("time"), "rows")


@register("recent_upserts", W(*EV, O.metrics(60, 10)) + """
SELECT window_start, window_end, page_url, active_users, cart_additions, purchases,
  round(cart_abandonment_rate, 6) AS cart_abandonment_rate, updated_at FROM m
ORDER BY updated_at DESC, window_start DESC, window_end DESC, page_url LIMIT 5""")
def q_recent_upserts(spark, sf):
    return _metric_cols(S.recent_upserts(_store(spark, sf)[0]), *ALL_METRICS)


# ---------------------------------------------------------------- 2.1 storage


def _two_batches(spark, sf, compact: bool) -> str:
    """A store that the sink wrote in two batches, as a stream in update mode
    does: the groups as they stood after seven eighths of the records, and only
    those that the other records changed, as they stand after all.  The groups
    that did not change must come from batch 0, or from the compacted days."""
    root = checkpoint_path(spark, f"clickpulse-batches-{uuid.uuid4().hex}")
    ev = stored(K.events(spark, sf).select("offset", "event_time", "page_url", "user_id", "event_type"), "events")
    late = F.col("offset") % 8 == 0
    SK.upsert_metrics(M.page_metrics(ev.filter(~late), distinct="exact", updated_at="event_time"), 0, root, run=1)
    if compact:
        SK.compact_metrics(spark, root)
    key = ["window_start", "window_end", "page_url"]
    changed = M.page_metrics(ev.filter(late), updated_at=None).select(key)
    every = M.page_metrics(ev, distinct="exact", updated_at="event_time")
    SK.upsert_metrics(every.join(changed, key, "left_semi"), 1, root, run=1)
    return root


@register("metrics_latest", _metric_oracle(60, 10, *ALL_METRICS))
def q_metrics_latest(spark, sf):
    """A changelog of two batches, latest-wins per PK: the batch aggregate."""
    return _metric_cols(SK.read_metrics(spark, _two_batches(spark, sf, False)), *ALL_METRICS)


@register("metrics_reader", _metric_oracle(60, 10, *ALL_METRICS))
def q_metrics_reader(spark, sf):
    """Compacted days with a newer batch over them, as a reader sees it."""
    return _metric_cols(SK.read_metrics(spark, _two_batches(spark, sf, True)), *ALL_METRICS)


@register("metrics_table", W(*EV, O.metrics(60, 10)) + """
SELECT window_start, window_end, page_url, active_users, cart_additions, purchases,
  round(cart_abandonment_rate, 6) AS cart_abandonment_rate, updated_at,
  CAST(window_start AS DATE) AS window_date FROM m""")
def q_metrics_table(spark, sf):
    rows = SK.to_table_rows(K.metrics(spark, sf))
    return _metric_cols(rows, *ALL_METRICS, "window_date")


def _run_days(spark, sf):
    return K.events(spark, sf).select(F.to_date("event_time").alias("day")).distinct()


@register("partition_calendar", W(*EV) + """,
days AS (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM ev),
cal AS (SELECT DISTINCT CAST(d + INTERVAL (i) DAY AS DATE) AS range_from FROM days, range(-1, 4) t(i))
SELECT 'windowed_user_metrics_' || strftime(range_from, '%Y%m%d') AS "partition", range_from,
  CAST(range_from + INTERVAL 1 DAY AS DATE) AS range_to FROM cal""")
def q_partition_calendar(spark, sf):
    """Partitions ensured by a daily run on every day the stream had events."""
    return ST.partition_calendar_for(_run_days(spark, sf), "day", 3)


@register("unroutable_metrics", W(*EV, O.metrics(60, 10)) + """,
runs AS (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM ev WHERE date_diff('day', DATE '1970-01-01', CAST(event_time AS DATE)) % 6 = 0),
cal AS (SELECT DISTINCT CAST(d + INTERVAL (i) DAY AS DATE) AS range_from FROM runs, range(-1, 4) t(i))
SELECT window_start, window_end, page_url, 'no partition for window_start' AS reason FROM m
WHERE CAST(window_start AS DATE) NOT IN (SELECT range_from FROM cal)
UNION ALL
SELECT window_start, window_end, page_url, 'page_url longer than column width' FROM m
WHERE CAST(window_start AS DATE) IN (SELECT range_from FROM cal) AND length(page_url) > 512""")
def q_unroutable(spark, sf):
    """Windows that would fail the insert if maintenance had run on every
    sixth day only (each run ensures five days)."""
    m = K.metrics(spark, sf)
    runs = _run_days(spark, sf).filter(F.unix_date("day") % 6 == 0)
    cal = ST.partition_calendar_for(runs, "day", 3)
    return ST.unroutable_metrics(m, cal).select(K.ntz("window_start"), K.ntz("window_end"), "page_url", "reason")


@register("retention_prune", W(*EV, O.metrics(60, 10)) + """,
t AS (SELECT CAST(window_start AS DATE) AS partition_date FROM m)
SELECT partition_date, count(*) AS rows,
  CASE WHEN partition_date < (SELECT max(partition_date) FROM t) - INTERVAL 7 DAY THEN 'drop' ELSE 'keep' END AS action
FROM t GROUP BY 1""")
def q_retention(spark, sf):
    rows = SK.to_table_rows(K.metrics(spark, sf))
    as_of = rows.select(F.max("window_date")).scalar()
    return ST.retention_prune(rows, "window_date", as_of, 7)


# ---------------------------------------------------------------- 2.7 health

from clickpulse.operators import health as H  # noqa: E402

HS = (O.ADAPTER, O.CONTRACT, O.GATE, O.GATED_EVENTS)


def _counts(spark, sf):
    """Gated events per step, written once: the spine and the ranges of the
    alert rules all read this small table."""
    return stored(H.step_counts(K.gated(spark, sf)), "step_counts")


def _alert_out(df):
    return df.select(K.ntz("ts"), *[c for c in df.columns if c not in ("ts",)])


@register("sliding_counts", W(*HS, O.steps_with("120", "r2")) + """
SELECT ts, accepted, rejected FROM r2 WHERE accepted + rejected > 0""")
def q_sliding_counts(spark, sf):
    """Accepted and rejected events of the last 2 min at every 15 s step."""
    c = H.sliding_counts(H.step_counts(K.gated(spark, sf)), 120)
    return c.select(K.ntz("ts"), "accepted", "rejected")


@register("sustained", W(*HS, O.steps_with("120", "r2")) + """,
held AS (SELECT 'accepted' AS gate_status, ts FROM r2 WHERE accepted > 0
         UNION ALL SELECT 'rejected', ts FROM r2 WHERE rejected > 0)
SELECT gate_status, ts FROM """ + O.sustained_sql("held", "gate_status", 60))
def q_sustained(spark, sf):
    """'for: 1m' over 'some event in the last 2 min', per gate status."""
    c = H.sliding_counts(H.step_counts(K.gated(spark, sf)), 120)
    held = c.select("ts", F.inline(F.array(*[F.struct(F.lit(s).alias("gate_status"), F.col(s).alias("n"))
                                             for s in ("accepted", "rejected")]))).filter("n > 0")
    return H.sustained(held.select("gate_status", "ts"), ["gate_status"], 60).select("gate_status", K.ntz("ts"))


ALERT_HIGH = O.steps_with("120", "rr") + ", hv AS (SELECT ts FROM rr WHERE rejected > 120)"
ALERT_QUIET = O.steps_with("300", "rp") + ", zs AS (SELECT ts FROM rp WHERE accepted = 0 AND ts <= (SELECT max(step) FROM gts))"


#: The table has far fewer rejections than the rule's one a second; the query
#: asks for any rejection in the range, so that the rule fires.
SOME_REJECTS = 0.001
ALERT_SOME = O.steps_with("120", "rr") + f", hv AS (SELECT ts FROM rr WHERE rejected > {120 * SOME_REJECTS})"


@register("alert_high_reject", W(*HS, ALERT_SOME) + """
SELECT ts, 'HighDLQRate' AS alertname, 'critical' AS severity FROM """ + O.sustained_sql("hv", "", 60))
def q_alert_high_reject(spark, sf):
    return _alert_out(H.alert_high_reject(H.step_counts(K.gated(spark, sf)), SOME_REJECTS))


@register("alert_no_publish", W(*HS, ALERT_QUIET) + """
SELECT ts, 'ProducerPublishRateZero' AS alertname, 'warning' AS severity FROM """ + O.sustained_sql("zs", "", 120))
def q_alert_no_publish(spark, sf):
    return _alert_out(H.alert_no_publish(_counts(spark, sf)))


@register("alert_groups", W(*HS, ALERT_HIGH, ALERT_QUIET) + f""",
alerts AS (
  SELECT ts, 'HighDLQRate' AS alertname, 'critical' AS severity FROM {O.sustained_sql("hv", "", 60)}
  UNION ALL SELECT ts, 'ProducerPublishRateZero', 'warning' FROM {O.sustained_sql("zs", "", 120)})
SELECT alertname, severity, min(ts) AS first_firing, max(ts) AS last_firing, count(*) AS firing_evaluations
FROM alerts GROUP BY ALL""")
def q_alert_groups(spark, sf):
    c = _counts(spark, sf)
    g = H.alert_groups(H.alert_high_reject(c).unionByName(H.alert_no_publish(c)))
    return g.select("alertname", "severity", K.ntz("first_firing"), K.ntz("last_firing"), "firing_evaluations")


# ---------------------------------------------------------------- 2.8 documented extras

from clickpulse.plans import insights as I  # noqa: E402


@register("gmv_series", W(*EV, O.windows(60, 10)) + """
SELECT window_start, window_end, round(coalesce(sum(price_inr), 0.0), 6) AS gmv, count(*) AS purchases
FROM winx WHERE event_type = 'purchase' GROUP BY ALL""")
def q_gmv(spark, sf):
    g = I.gmv_series(K.events(spark, sf))
    return g.select(K.ntz("window_start"), K.ntz("window_end"), K.r6("gmv"), "purchases")


@register("dlq_breakdown", W(*SV) + """
SELECT 'schema_validation_error' AS failure_reason, split_part(validation_error, ':', 1) AS error_class,
  count(*) AS dead_letters FROM sv WHERE validation_error IS NOT NULL GROUP BY ALL""")
def q_dlq_breakdown(spark, sf):
    return D.dlq_breakdown(_dlq(spark, sf))


@register("consumer_lag", W(*SV) + """
SELECT "partition", max("offset") + 1 AS end_offset,
  coalesce(max("offset") FILTER (WHERE validation_error IS NULL) + 1, 0) AS committed_offset,
  max("offset") + 1 - coalesce(max("offset") FILTER (WHERE validation_error IS NULL) + 1, 0) AS lag
FROM sv GROUP BY 1""")
def q_consumer_lag(spark, sf):
    """Per partition, how far the newest valid record is behind the newest
    record: the lag of a consumer of the valid branch."""
    offs = K.validated(spark, sf).groupBy("partition").agg(
        (F.max("offset") + 1).alias("end_offset"),
        F.coalesce(F.max(F.when(F.col("validation_error").isNull(), F.col("offset"))) + 1, F.lit(0)).alias("committed_offset"))
    return I.consumer_lag(offs)


@register("page_popularity", W(*EV) + """
SELECT coalesce(nullif(page_url, ''), '/unknown') AS page_url,
  count(*) FILTER (WHERE event_type = 'page_view') AS views, count(DISTINCT user_id) AS users, count(*) AS events
FROM ev GROUP BY 1""")
def q_page_popularity(spark, sf):
    return I.page_popularity(K.events(spark, sf))


@register("funnel_conversion", W(*EV) + """,
f AS (SELECT count(*) FILTER (WHERE event_type = 'page_view') AS views,
  count(*) FILTER (WHERE event_type = 'cart_add') AS cart_adds,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM ev)
SELECT views, cart_adds, purchases, round(cart_adds / nullif(views, 0), 6) AS view_to_cart,
  round(purchases / nullif(cart_adds, 0), 6) AS cart_to_purchase, round(purchases / nullif(views, 0), 6) AS view_to_purchase
FROM f""")
def q_funnel(spark, sf):
    f = I.funnel_conversion(K.events(spark, sf))
    return f.select("views", "cart_adds", "purchases", K.r6("view_to_cart"), K.r6("cart_to_purchase"),
                    K.r6("view_to_purchase"))
