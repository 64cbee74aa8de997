import datetime as dt
import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickpulse import contracts as C
from clickpulse.functions import jsonval as J
from clickpulse.operators import dlq as D
from clickpulse.operators import validate as V
from clickpulse.fixtures import load_raw
from conftest import SF0001, rows_of

UUID = "7c9e6679-7425-40de-944b-e07fc1f90ae7"


def ev(**kw):
    base = {"schema_version": "1.0", "event_id": UUID, "user_id": "visitor-7", "session_id": "visit-9",
            "event_type": "page_view", "page_url": "/shop/shoes", "timestamp": "2025-03-04T05:06:07Z"}
    base.update(kw)
    return {k: v for k, v in base.items() if v is not _DROP}


_DROP = object()


def verdicts(spark, payloads):
    df = V.with_stream_validation(rows_of(spark, payloads))
    return [r.validation_error for r in df.orderBy("src_id").collect()]


def test_one_case_per_rule(spark):
    out = verdicts(spark, [
        json.dumps(ev()),
        json.dumps(ev(event_id=_DROP)),
        json.dumps(ev(schema_version="2.0")),
        json.dumps(ev(event_type="scrolled")),
    ])
    assert out[0] is None
    assert out[1].startswith("Missing required fields") and "event_id" in out[1]
    assert out[2] == "Unsupported schema_version: 2.0"
    assert out[3] == "Invalid event_type: scrolled"


def test_rule_order_and_messages(spark):
    out = verdicts(spark, [
        None, "", '{"a":1', "[1,2]",
        json.dumps(ev(user_id=None, timestamp=_DROP)),
        json.dumps(ev(schema_version=1.0)),
        json.dumps(ev(event_type=["cart_add"])),
        json.dumps(ev(timestamp="2024-01")),
        json.dumps(ev(timestamp=12)),
        json.dumps(ev()) + " x",
        json.dumps(ev(schema_version="7", invalid_field=True, event_type=_DROP)),
    ])
    assert out[0] == out[1] == "Empty payload"
    assert out[2].startswith("JSON parse error: ")
    assert out[3] == "Payload is not a JSON object"
    assert out[4] == "Missing required fields: user_id, timestamp"
    assert out[5] == "Unsupported schema_version: 1.0"
    assert out[6] == "Invalid event_type: ['cart_add']"
    assert out[7] == "Invalid ISO timestamp format: 2024-01"
    assert out[8] == "Invalid ISO timestamp format: 12"
    assert out[9].startswith("JSON parse error: ")
    assert out[10] == "Missing required fields: event_type"


def test_timestamps(spark):
    ok = ["2026-09-18T10:00:00Z", "2026-09-18T10:00:00+05:30", "2026-09-18", "2026-09-18T10",
          "2026-09-18T10:00:00.1234567Z", "2026-09-18 10:00:00", "2026-09-18T10:00:00+05", "2026-09-18T10:00:00+0530",
          "2026-09-18T10:00:00+05:30:15", "2026-09-18T10:00Z", "2026-09-18T10+02:00"]
    bad = ["20260918T100000", "2026-09", "2026", "10:00", "2026-09-18T24:00:00",
           "2026-09-18t10:00:00z", "2026-02-30T10:00:00", "not-a-date"]
    out = verdicts(spark, [json.dumps(ev(timestamp=t)) for t in ok + bad])
    assert out[:len(ok)] == [None] * len(ok)
    assert all(o and o.startswith("Invalid ISO timestamp") for o in out[len(ok):])


GOLDEN_STREAM = {"Empty payload": 10, "JSON parse error": 16, "Payload is not a JSON object": 10,
                 "Missing required fields": 10, "Unsupported schema_version": 9,
                 "Invalid event_type": 195, "Invalid ISO timestamp format": 11, None: 739}


def test_golden_stream_counts(spark):
    v = V.with_stream_validation(load_raw(spark, SF0001))
    got = {r.c: r.n for r in v.groupBy(V.error_class(F.col("validation_error")).alias("c"))
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == GOLDEN_STREAM


def test_golden_contract_counts(spark):
    c = V.with_contract_errors(load_raw(spark, SF0001))
    got = {r.contract_status: r.n for r in c.groupBy("contract_status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"valid": 709, "invalid": 265, "unparseable": 26}
    both = V.with_stream_validation(c.drop("_doc"))
    n = both.filter("validation_error IS NULL AND contract_status = 'invalid'").count()
    assert n == 30


def test_contract_messages(spark):
    payloads = [json.dumps(ev(price_inr="not-a-number")), json.dumps(ev(price_inr=-1.0)),
                json.dumps(ev(event_id="not-a-uuid")), json.dumps(ev(user_id="")),
                json.dumps(ev(invalid_field=True)), json.dumps(ev(user_id=_DROP)), "[1,2]",
                json.dumps(ev(price_inr=2999.00, product_id="p", product_category=None))]
    c = V.with_contract_errors(rows_of(spark, payloads)).orderBy("src_id").collect()
    msgs = [r.validation_errors for r in c]
    assert msgs[0] == ["[price_inr]: 'not-a-number' is not of type 'number', 'null'"]
    assert msgs[1] == ["[price_inr]: -1.0 is less than the minimum of 0"]
    assert msgs[2] == ["[event_id]: 'not-a-uuid' is not a 'uuid'"]
    assert msgs[3] == ["[user_id]: '' should be non-empty"]
    assert msgs[4] == ["[root]: Additional properties are not allowed ('invalid_field' was unexpected)"]
    assert msgs[5] == ["[root]: 'user_id' is a required property"]
    assert msgs[6] == ["[root]: [1, 2] is not of type 'object'"]
    assert msgs[7] == []


def test_accept_gate(spark):
    payloads = ["{}", "[]", '""', "0", "null", "false", None, "", "{bad", "[1]", json.dumps(ev())]
    g = V.accept_gate(rows_of(spark, payloads)).orderBy("src_id").collect()
    assert [r.gate_status for r in g] == ["refused"] * 6 + ["error"] * 3 + ["rejected", "accepted"]
    assert g[0].message == "Missing JSON payload"
    assert g[9].message.startswith("Schema Validation Failed: [root]:")


def test_repeated_keys_keep_the_last_value(spark):
    good = json.dumps(ev())
    twice = good[:-1] + ', "page_url": "/last", "event_type": "purchase"}'
    worse = good[:-1] + ', "schema_version": "3.0"}'
    extra = good[:-1] + ', "odd": 1, "odd": 2}'
    from clickpulse.operators.metrics import parse_events
    v = V.with_stream_validation(rows_of(spark, [twice, worse, extra]))
    assert [r.validation_error for r in v.orderBy("src_id").collect()] == [None, "Unsupported schema_version: 3.0", None]
    row = parse_events(v.filter("src_id = 0")).first()
    assert (row.page_url, row.event_type) == ("/last", "purchase")
    c = V.with_contract_errors(rows_of(spark, [twice, extra])).orderBy("src_id").collect()
    assert c[0].contract_status == "valid"
    assert c[1].validation_errors == ["[root]: Additional properties are not allowed ('odd' was unexpected)"]


def test_validation_of_a_parsed_frame_parses_no_second_time(spark):
    rows = rows_of(spark, [json.dumps(ev()), "{", None, json.dumps(ev(user_id=None))])
    plain = [r.validation_error for r in V.with_stream_validation(rows).orderBy("src_id").collect()]
    again = V.with_stream_validation(V.with_doc(rows))
    assert [r.validation_error for r in again.orderBy("src_id").collect()] == plain
    assert again._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def _python_time(text):
    try:
        t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    t = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


# Forms that Spark can represent: whole dates, extended clock, offsets of up
# to 18 hours without fractions, at most six digits of a fraction.
clock = st.sampled_from(["", "T10", "T23:59", " 00:00:00", "T10:20:30.5", "T10:20:30,123456", "T24:00", "T9:00"])
offset = st.sampled_from(["", "Z", "+05", "-0730", "+05:30", "-05:30:15", "+053015", "+5", "+05:3", "+18:00", "z"])
day = st.sampled_from(["2024-02-29", "2023-02-29", "2025-12-31", "1969-07-20", "2025-1-1", "2025-13-01"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(day, clock, offset), min_size=10, max_size=40))
def test_event_times_match_python(spark, parts):
    from clickpulse.functions.timefmt import event_time
    texts = sorted({d + c + (o if c else "") for d, c, o in parts})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", F.unix_micros(event_time(F.col("t"))).alias("us")).collect():
        assert r.us == _python_time(r.t), r.t


def test_dlq_envelope_conforms(spark):
    raw = rows_of(spark, ['{"half": [1'], partition=1).withColumn("offset", F.lit(977).cast("long"))
    inv = V.route_invalid(V.with_stream_validation(raw))
    out = D.validate_dlq(D.to_dlq(inv)).collect()[0]
    assert out.contract_status == "valid", out.validation_errors
    env = json.loads(out.value)
    assert env["source_partition"] == 1 and env["source_offset"] == 977
    assert env["failure_reason"] == "schema_validation_error"
    assert set(env) == set(C.DLQ_CONTRACT["properties"])


def test_dlq_contract_catches_bad_envelopes(spark):
    bad = [json.dumps({"original_payload": 1, "failure_reason": "x", "validation_errors": ["a", 2],
                       "failed_at": "yesterday", "source_partition": 1.5, "extra": 0})]
    out = D.validate_dlq(rows_of(spark, bad).withColumnRenamed("raw_value", "value")).collect()[0]
    tags = sorted(set(out.violated))
    assert tags == ["failed_at:format", "failure_reason:enum", "original_payload:type",
                    "root:additionalProperties", "source_partition:type", "validation_errors:items"]


# Independent oracle: Python's json.loads.  VARIANT rejects bare NaN and
# Infinity, which json.loads accepts (documented deviation).
json_text = st.one_of(
    st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5),
                 lambda ch: st.lists(ch, max_size=3) | st.dictionaries(st.text(max_size=3), ch, max_size=3),
                 max_leaves=6).map(json.dumps),
    st.text(alphabet='{}[]",:0123456789 abtrufalsen\\', max_size=12))


@settings(max_examples=40, deadline=None)
@given(st.lists(json_text, min_size=1, max_size=25))
def test_strict_json_matches_python(spark, texts):
    def py_ok(t):
        try:
            json.loads(t, parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
            return True
        except Exception:  # noqa: BLE001
            return False
    df = rows_of(spark, texts).select("src_id", "raw_value",
                                      J.strict_json(F.col("raw_value")).isNotNull().alias("ok"))
    for r in df.collect():
        assert r.ok == py_ok(r.raw_value), r.raw_value


def test_strict_json_wrapper_escapes(spark):
    """Texts that close a single wrapper early (found by the property test)."""
    cases = {"0]": False, "0}": False, "0}]": False, "0]}": False, '{"a":1}]': False,
             '{"a":1}}': False, "[1]]": False, "0],[1": False, '{"a":"]"}': True, '"}"': True,
             " {\"a\":1} ": True, "1,2": False}
    df = rows_of(spark, list(cases)).select("raw_value", J.strict_json(F.col("raw_value")).isNotNull().alias("ok"))
    assert {r.raw_value: r.ok for r in df.collect()} == cases
