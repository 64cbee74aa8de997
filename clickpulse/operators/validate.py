"""Validation and routing.

Two validators exist, as in the pipeline being rebuilt:

* the stream validator (``with_stream_validation``) reports the FIRST failing
  rule of seven, as plain text; null means valid;
* the contract validator (``with_contract_errors``) reports EVERY violation of
  the JSON-Schema contract as ``"[path]: message"``.

Both are single native expressions over one strict parse of the payload, so
filters above them still push down and the whole check stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse import contracts as C
from clickpulse.functions import jsonval as J
from clickpulse.functions import memo_column, with_fenced
from clickpulse.functions.contract import any_violation, messages_of, tagged_errors, tags_of, value_columns
from clickpulse.functions.timefmt import event_time

DOC = "_doc"  # VARIANT of the parsed payload, carried for downstream parsing

# Stream verdict message texts (prefixes as the original pipeline).
MSG_EMPTY = "Empty payload"
MSG_PARSE = "JSON parse error: "
MSG_NOT_OBJECT = "Payload is not a JSON object"
MSG_MISSING = "Missing required fields: "
MSG_VERSION = "Unsupported schema_version: "
MSG_EVENT_TYPE = "Invalid event_type: "
MSG_TIMESTAMP = "Invalid ISO timestamp format: "
# Our own detail for parse failures (the Python decoder's position text is not
# reproducible outside Python).
PARSE_DETAIL = "not a single valid JSON document"
FALSY_JSON = r'^[ \t\n\r]*(\{[ \t\n\r]*\}|\[[ \t\n\r]*\]|""|false|null|-?0(\.0*)?([eE][+-]?[0-9]+)?)[ \t\n\r]*$'


def with_doc(df: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Add the strict-parsed payload as a VARIANT column (one parse per row)."""
    if DOC in df.columns:
        return df
    w, doc = memo_column(("doc", raw), lambda: (J.wrapped_json(F.col(raw)),
                                                J.single_document(F.col("_wrapped"))))
    d = with_fenced(df, _wrapped=w)
    return with_fenced(d, **{DOC: doc}).drop("_wrapped")


_STRING_RULE_FIELDS = ["schema_version", "event_type", "timestamp"]


def _field_columns(doc: Column, wrapped: Column | None = None) -> dict:
    """Per-field facts the rules need, fenced once: presence of each
    required field and the text of the three string-checked fields.  With
    ``wrapped`` the fields are read in place from the parse."""
    fld = (lambda f: J.wrapped_field(wrapped, f)) if wrapped is not None else (lambda f: J.field(doc, f))
    cols = {f"_p_{f}": J.is_present(fld(f)) for f in C.REQUIRED_FIELDS}
    cols.update({f"_s_{f}": J.string_or_null(fld(f)) for f in _STRING_RULE_FIELDS})
    return cols


def stream_error(raw: Column, doc: Column, facts: dict | None = None) -> Column:
    """First failing stream rule as text; null when the payload is valid.

    ``facts`` may map the ``_field_columns`` names to precomputed columns."""
    facts = facts or _field_columns(doc)
    missing = F.concat_ws(", ", *[F.when(~facts[f"_p_{f}"], F.lit(f)) for f in C.REQUIRED_FIELDS])
    sv, et, ts = (facts[f"_s_{f}"] for f in _STRING_RULE_FIELDS)
    return (F.when(raw.isNull() | (raw == ""), F.lit(MSG_EMPTY))
            .when(doc.isNull(), F.lit(MSG_PARSE + PARSE_DETAIL))
            .when(J.root_kind(raw) != "object", F.lit(MSG_NOT_OBJECT))
            .when(missing != "", F.concat(F.lit(MSG_MISSING), missing))
            .when(F.coalesce(sv != C.SCHEMA_VERSION, F.lit(True)),
                  F.concat(F.lit(MSG_VERSION), J.py_str(J.field(doc, "schema_version"))))
            .when(F.coalesce(~et.isin(*C.EVENT_TYPES), F.lit(True)),
                  F.concat(F.lit(MSG_EVENT_TYPE), J.py_str(J.field(doc, "event_type"))))
            .when(event_time(ts).isNull(),
                  F.concat(F.lit(MSG_TIMESTAMP), J.py_str(J.field(doc, "timestamp")))))


def with_stream_validation(df: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Add ``validation_error`` (null = valid) and the parsed ``_doc``.

    The parse and the document are fenced (a filter on a parsed field never
    re-runs the parse); the per-field facts are a plain projection, where
    codegen shares common subexpressions; the verdict is fenced again so a
    filter on it stays above."""
    def build():
        w = J.wrapped_json(F.col(raw))
        doc = J.single_document(F.col("_wrapped"))
        facts = _field_columns(F.col(DOC), F.col("_wrapped"))
        err = stream_error(F.col(raw), F.col(DOC), {k: F.col(k) for k in facts})
        return w, doc, facts, err
    w, doc, facts, err = memo_column(("stream_validation", raw), build)
    if DOC in df.columns:  # parsed before: read the fields from the document
        facts = memo_column("document_facts", lambda: _field_columns(F.col(DOC)))
        d = df
    else:
        d = with_fenced(with_fenced(df, _wrapped=w), **{DOC: doc})
    d = d.select("*", *[c.alias(k) for k, c in facts.items()]).drop("_wrapped")
    d = with_fenced(d, validation_error=err)
    return d.drop(*facts)


def error_class(msg: Column) -> Column:
    """Rule class of a verdict message: the text before the first ':'."""
    return F.when(msg.isNotNull(), F.split_part(msg, F.lit(":"), F.lit(1)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) - complete and disjoint on ``validation_error``."""
    return (df.filter(F.col("validation_error").isNull()),
            df.filter(F.col("validation_error").isNotNull()))


def route_valid(df: DataFrame) -> DataFrame:
    return split_valid(df)[0]


def route_invalid(df: DataFrame) -> DataFrame:
    return split_valid(df)[1]


def with_contract_errors(df: DataFrame, contract: dict = C.EVENT_CONTRACT, raw: str = "raw_value",
                         enforce_datetime: bool = True, doc_col: str | None = None) -> DataFrame:
    """Add ``validation_errors`` (ARRAY<STRING>, empty = valid; null when the
    payload is empty or not parseable), ``violated`` rule tags and
    ``contract_status`` in {valid, invalid, unparseable}."""
    d = df if doc_col else with_doc(df, raw)

    def build():
        doc = F.col(doc_col or DOC)
        vals = value_columns(contract, doc, F.col(raw))
        refs = {k: F.col(k) for k in vals}
        bad = any_violation(contract, doc, enforce_datetime, refs)
        tagged = (F.when(doc.isNull(), F.lit(None).cast("array<string>"))
                  .when(F.col("_bad"), tagged_errors(contract, doc, enforce_datetime, refs))
                  .otherwise(F.array().cast("array<string>")))
        return vals, bad, tagged
    key = ("contract", tuple(contract.get("properties", {})), raw, doc_col, enforce_datetime)
    vals, bad, tagged = memo_column(key, build)
    # a plain projection: codegen evaluates common subexpressions once
    # (generator arguments get no such elimination); the fences that follow
    # keep filters from being pushed beneath it
    d = d.select("*", *[c.alias(k) for k, c in vals.items()])
    # the verdict bit is fenced: status filters stay above it
    d = with_fenced(d, _bad=bad)
    # messages are a plain projection: queries that only need the status
    # (counters, routing) prune them away and never build them
    d = d.select("*", tagged.alias("_tagged"))
    d = d.select(*[c for c in d.columns if c != "_tagged" and c not in vals],
                 messages_of(F.col("_tagged")).alias("validation_errors"),
                 tags_of(F.col("_tagged")).alias("violated"))
    doc = F.col(doc_col or DOC)
    return d.withColumn("contract_status", F.when(doc.isNull(), "unparseable")
                        .when(F.col("_bad"), "invalid").otherwise("valid"))


def join_errors(errors: Column) -> Column:
    """All violations as one reason text, joined with '; '."""
    return F.array_join(errors, "; ")


def accept_gate(df: DataFrame, raw: str = "raw_value", enforce_datetime: bool = True) -> DataFrame:
    """Boundary gate over a table/stream of request bodies.

    ``gate_status``: ``refused`` (a parsed body that is falsy: {}, [], "", 0,
    false, null - refused as "Missing JSON payload", not counted as a
    rejection), ``error`` (a body that does not parse, the empty one too),
    ``rejected`` (contract violations; ``reason`` is the joined message) or
    ``accepted``.
    """
    d = with_contract_errors(df, C.EVENT_CONTRACT, raw, enforce_datetime)
    doc = F.col(DOC)
    # Python's ``not body``: {}, [], "", 0, 0.0, false, null.  The text is
    # valid JSON here, so a pattern on the raw text decides it exactly.
    falsy = doc.isNotNull() & F.col(raw).rlike(FALSY_JSON)
    status = (F.when(falsy, "refused").when(doc.isNull(), "error")
              .when(F.col("_bad"), "rejected").otherwise("accepted"))
    return (d.withColumn("gate_status", status)
             .withColumn("reason", F.when(F.col("gate_status") == "rejected",
                                          join_errors(F.col("validation_errors"))))
             .withColumn("message",
                         F.when(F.col("gate_status") == "refused", "Missing JSON payload")
                          .when(F.col("gate_status") == "rejected",
                                F.concat(F.lit("Schema Validation Failed: "), F.col("reason")))
                          .when(F.col("gate_status") == "accepted", "Event published")))


MSG_FUTURE = "Event time too far in the future: "


def with_future_guard(df: DataFrame, max_skew: str, now: Column | None = None) -> DataFrame:
    """Optional extra rule: a valid event whose time is more than ``max_skew``
    ahead of ``now`` (processing time by default - the micro-batch time on a
    stream) is rejected, so one poisoned clock cannot push the watermark
    past all normal traffic.  Off unless asked for (original semantics)."""
    now = F.current_timestamp() if now is None else now
    ts = F.variant_get(F.col(DOC), "$.timestamp", "string")
    ahead = event_time(ts) > now + F.expr(f"INTERVAL {max_skew}")
    return df.withColumn("validation_error",
                         F.when(F.col("validation_error").isNull() & F.coalesce(ahead, F.lit(False)),
                                F.concat(F.lit(MSG_FUTURE), ts))
                          .otherwise(F.col("validation_error")))
