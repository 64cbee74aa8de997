"""DuckDB twins of the registered queries (the correctness oracle).

Written independently with DuckDB's own JSON functions over the same parquet
tables (views ``events`` etc. are registered by the checker).  SQL is built
from layered CTEs: adapter -> stream verdict -> contract verdict -> events ->
windows -> metrics -> serving.
"""

from __future__ import annotations

from clickpulse import contracts as C

# The rules in this file's own words: nothing of the engine's patterns or
# messages is imported, only the contract itself (it is the input).
DATE = "\\d\\d\\d\\d-\\d\\d-\\d\\d"
CLOCK = "\\d\\d:\\d\\d:\\d\\d"
STREAM_TIME = (f"{DATE}|{DATE}[ T]\\d\\d(:\\d\\d)?|{DATE}[ T]{CLOCK}([.,]\\d+)?|"
               f"{DATE}[ T](\\d\\d(:\\d\\d)?|{CLOCK}([.,]\\d+)?)(Z|[-+]\\d\\d|[-+]\\d\\d:\\d\\d|[-+]{CLOCK}|[-+]\\d{{4}}|[-+]\\d{{6}})")
CONTRACT_TIME = f"{DATE}[Tt]{CLOCK}([.]\\d+)?([Zz]|[-+]\\d\\d:\\d\\d)"
CONTRACT_UUID = "[[:xdigit:]]{8}(-[[:xdigit:]]{4}){3}-[[:xdigit:]]{12}"
NOT_JSON = "JSON parse error: not a single valid JSON document"

# -- adapter (FIXTURES.md section 2) ---------------------------------------
ADAPTER = r"""
a AS (SELECT *, CASE
    WHEN event_id % 101 = 1 THEN 'empty'
    WHEN event_id % 103 = 2 THEN 'truncated'
    WHEN event_id % 107 = 3 THEN 'not_object'
    WHEN event_id % 109 = 4 THEN 'missing_user'
    WHEN event_id % 113 = 5 THEN 'bad_version'
    WHEN event_id % 127 = 6 THEN 'bad_ts'
    WHEN event_id % 131 = 7 THEN 'price_text'
    WHEN event_id % 137 = 8 THEN 'extra_key'
    WHEN event_id % 139 = 9 THEN 'no_page'
    WHEN event_id % 149 = 10 THEN 'blank_page'
    WHEN event_id % 151 = 11 THEN 'bad_uuid'
    WHEN event_id % 157 = 12 THEN 'blank_user'
    WHEN event_id % 163 = 13 THEN 'list_type'
    WHEN event_id % 167 = 14 THEN 'month_ts'
    WHEN event_id % 173 = 15 THEN 'neg_price'
    WHEN event_id % 179 = 16 THEN 'trailing' ELSE 'clean' END AS cls,
  substr(md5(CAST(event_id AS VARCHAR)),1,8)
    ||'-'||substr(md5(CAST(event_id AS VARCHAR)),9,4)
    ||'-'||substr(md5(CAST(event_id AS VARCHAR)),13,4)
    ||'-'||substr(md5(CAST(event_id AS VARCHAR)),17,4)
    ||'-'||substr(md5(CAST(event_id AS VARCHAR)),21,12) AS uid,
  strftime(ts,'%Y-%m-%dT%H:%M:%S.%fZ') AS tss, strftime(ts,'%Y-%m') AS mon, strftime(ts,'%Y%m%d') AS dd,
  json_extract_string(props,'$.k') AS k,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'cart_add' WHEN 'signup' THEN 'page_exit'
    ELSE event_type END AS et FROM events),
b AS (SELECT *, CASE WHEN et IN ('cart_add','purchase') THEN true ELSE false END AS prod,
 '{"schema_version":"'||(CASE WHEN cls='bad_version' THEN '2.0' ELSE '1.0' END)||'","event_id":"'||(CASE WHEN cls='bad_uuid' THEN 'not-a-uuid' ELSE uid END)||'"'
 ||(CASE WHEN cls='missing_user' THEN '' WHEN cls='blank_user' THEN ',"user_id":""' ELSE ',"user_id":"usr_'||CAST(user_id AS VARCHAR)||'"' END)
 ||',"session_id":"ses_'||CAST(user_id AS VARCHAR)||'_'||dd||'"'
 ||',"event_type":'||(CASE WHEN cls='list_type' THEN '["'||et||'"]' ELSE '"'||et||'"' END)
 ||(CASE WHEN cls='no_page' THEN '' WHEN cls='blank_page' THEN ',"page_url":""' ELSE ',"page_url":"/page/'||k||'"' END) AS p1 FROM a),
c AS (SELECT *, p1||(CASE WHEN prod THEN ',"product_id":"prod_'||k||'","product_category":"cat_'||CAST(CAST(k AS INT)%10 AS VARCHAR)||'"' ELSE ',"product_id":null,"product_category":null' END)
 ||',"price_inr":'||(CASE WHEN cls='price_text' THEN '"not-a-number"' WHEN cls='neg_price' THEN '-1.0' WHEN prod THEN CAST(value AS VARCHAR) ELSE 'null' END)
 ||',"timestamp":"'||(CASE WHEN cls='bad_ts' THEN 'not-a-date' WHEN cls='month_ts' THEN mon ELSE tss END)||'"'||(CASE WHEN cls='extra_key' THEN ',"invalid_field":true' ELSE '' END)||'}' AS full_json FROM b),
raw AS (SELECT event_id AS src_id, cls, ts AS src_ts, 'ses_'||CAST(user_id AS VARCHAR)||'_'||dd AS msg_key,
  CASE cls WHEN 'empty' THEN NULL WHEN 'truncated' THEN substr(full_json,1,length(full_json)-5)
    WHEN 'not_object' THEN '[1,2]' WHEN 'trailing' THEN full_json||' x' ELSE full_json END AS raw_value,
  CAST(event_id % 6 AS INT) AS "partition", CAST(event_id // 6 AS BIGINT) AS "offset" FROM c)"""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _jt(path: str, raw: str = "raw_value") -> str:
    return f"json_type({raw}, {q(path)})"


def _scalar_text(expr_json: str, quote: bool) -> str:
    """Python text of a scalar JSON value held as JSON text ``expr_json``."""
    s = f"json_extract_string({expr_json}, '$')"
    sq = f"'''' || {s} || ''''" if quote else s
    return (f"CASE json_type({expr_json}) WHEN 'VARCHAR' THEN {sq} "
            f"WHEN 'BIGINT' THEN {s} WHEN 'UBIGINT' THEN {s} "
            f"WHEN 'DOUBLE' THEN CAST(CAST({s} AS DOUBLE) AS VARCHAR) "
            f"WHEN 'BOOLEAN' THEN CASE WHEN {s} = 'true' THEN 'True' ELSE 'False' END "
            f"WHEN 'NULL' THEN 'None' END")


def pytext(path: str, quote: bool, raw: str = "raw_value") -> str:
    """Python str()/repr() of the JSON value at ``path``."""
    v = f"json_extract({raw}, {q(path)})"
    items = f"json_extract({raw}, {q(path + '[*]' if path != '$' else '$[*]')})"
    lst = (f"'[' || array_to_string(list_transform({items}, lambda x: {_scalar_text('x', True)}), ', ') || ']'")
    return (f"CASE json_type({v}) WHEN 'ARRAY' THEN {lst} WHEN 'OBJECT' THEN CAST({v} AS VARCHAR) "
            f"ELSE {_scalar_text(v, quote)} END")


def _kind_is_null_or_absent(f: str) -> str:
    return f"coalesce({_jt('$.' + f)}, 'NULL') = 'NULL'"


STREAM = f"""
sv AS (SELECT *, CASE
  WHEN raw_value IS NULL OR raw_value = '' THEN 'Empty payload'
  WHEN NOT json_valid(raw_value) THEN {q(NOT_JSON)}
  WHEN json_type(raw_value) <> 'OBJECT' THEN 'Payload is not a JSON object'
  WHEN concat_ws(', ', {', '.join(f"CASE WHEN {_kind_is_null_or_absent(f)} THEN {q(f)} END" for f in C.REQUIRED_FIELDS)}) <> ''
    THEN 'Missing required fields: ' || concat_ws(', ', {', '.join(f"CASE WHEN {_kind_is_null_or_absent(f)} THEN {q(f)} END" for f in C.REQUIRED_FIELDS)})
  WHEN NOT ({_jt('$.schema_version')} = 'VARCHAR' AND json_extract_string(raw_value, '$.schema_version') = '1.0')
    THEN 'Unsupported schema_version: ' || {pytext('$.schema_version', False)}
  WHEN NOT ({_jt('$.event_type')} = 'VARCHAR' AND json_extract_string(raw_value, '$.event_type') IN ({', '.join(q(t) for t in C.EVENT_TYPES)}))
    THEN 'Invalid event_type: ' || {pytext('$.event_type', False)}
  WHEN NOT ({_jt('$.timestamp')} = 'VARCHAR'
            AND regexp_full_match(json_extract_string(raw_value, '$.timestamp'), {q(STREAM_TIME)})
            AND try_cast(json_extract_string(raw_value, '$.timestamp') AS TIMESTAMPTZ) IS NOT NULL)
    THEN 'Invalid ISO timestamp format: ' || {pytext('$.timestamp', False)}
  END AS validation_error FROM raw)"""

# Valid events, typed (event_time as naive UTC TIMESTAMP).
EVENTS = """
ev AS (SELECT src_id, cls, src_ts, msg_key, "partition", "offset", raw_value,
  json_extract_string(raw_value, '$.schema_version') AS schema_version,
  json_extract_string(raw_value, '$.event_id') AS event_id,
  json_extract_string(raw_value, '$.user_id') AS user_id,
  json_extract_string(raw_value, '$.session_id') AS session_id,
  json_extract_string(raw_value, '$.event_type') AS event_type,
  json_extract_string(raw_value, '$.page_url') AS page_url,
  json_extract_string(raw_value, '$.product_id') AS product_id,
  json_extract_string(raw_value, '$.product_category') AS product_category,
  CASE WHEN json_type(raw_value, '$.price_inr') IN ('BIGINT','UBIGINT','DOUBLE')
       THEN CAST(json_extract_string(raw_value, '$.price_inr') AS DOUBLE) END AS price_inr,
  json_extract_string(raw_value, '$.timestamp') AS "timestamp",
  CAST(timezone('UTC', CAST(json_extract_string(raw_value, '$.timestamp') AS TIMESTAMPTZ)) AS TIMESTAMP) AS event_time
  FROM sv WHERE validation_error IS NULL)"""


def contract_rules(raw: str = "raw_value", contract: dict = C.EVENT_CONTRACT) -> list[tuple[str, str]]:
    """(tag, DuckDB message expression or NULL) for a contract, in keyword
    order."""
    out = []
    obj = f"json_type({raw}) = 'OBJECT'"
    out.append(("root:type", f"CASE WHEN NOT ({obj}) THEN '[root]: ' || {pytext('$', True, raw)} || ' is not of type ''object''' END"))
    for f in contract["required"]:
        out.append(("root:required", f"CASE WHEN {obj} AND NOT json_exists({raw}, {q('$.' + f)}) THEN {q(f'[root]: {chr(39)}{f}{chr(39)} is a required property')} END"))
    for name, sub in contract["properties"].items():
        p = "$." + name
        t = f"json_type({raw}, {q(p)})"
        present = f"{obj} AND json_exists({raw}, {q(p)})"
        s = f"json_extract_string({raw}, {q(p)})"
        rep = pytext(p, True, raw)
        pre = f"'[{name}]: '"
        for kw, arg in sub.items():
            if kw == "type":
                types = arg if isinstance(arg, list) else [arg]
                ok = []
                for ty in types:
                    ok.append({"string": f"{t} = 'VARCHAR'", "null": f"{t} = 'NULL'",
                               "number": f"{t} IN ('BIGINT','UBIGINT','DOUBLE')",
                               "integer": f"({t} IN ('BIGINT','UBIGINT') OR ({t} = 'DOUBLE' AND CAST({s} AS DOUBLE) = floor(CAST({s} AS DOUBLE))))",
                               "array": f"{t} = 'ARRAY'"}[ty])
                listed = ", ".join("''" + ty + "''" for ty in types)
                out.append((f"{name}:type", f"CASE WHEN {present} AND NOT ({' OR '.join(ok)}) THEN {pre} || {rep} || ' is not of type {listed}' END"))
            elif kw == "const":
                out.append((f"{name}:const", f"CASE WHEN {present} AND NOT ({t} = 'VARCHAR' AND {s} = {q(arg)}) THEN {pre} || {q(repr(arg) + ' was expected')} END"))
            elif kw == "enum":
                lst = "[" + ", ".join(repr(x) for x in arg) + "]"
                out.append((f"{name}:enum", f"CASE WHEN {present} AND NOT ({t} = 'VARCHAR' AND {s} IN ({', '.join(q(x) for x in arg)})) THEN {pre} || {rep} || {q(' is not one of ' + lst)} END"))
            elif kw == "minLength":
                word = " should be non-empty" if arg == 1 else " is too short"
                out.append((f"{name}:minLength", f"CASE WHEN {present} AND {t} = 'VARCHAR' AND length({s}) < {arg} THEN {pre} || {rep} || {q(word)} END"))
            elif kw == "maxLength":
                out.append((f"{name}:maxLength", f"CASE WHEN {present} AND {t} = 'VARCHAR' AND length({s}) > {arg} THEN {pre} || {rep} || ' is too long' END"))
            elif kw == "minimum":
                out.append((f"{name}:minimum", f"CASE WHEN {present} AND {t} IN ('BIGINT','UBIGINT','DOUBLE') AND CAST({s} AS DOUBLE) < {arg} THEN {pre} || {rep} || {q(f' is less than the minimum of {arg!r}')} END"))
            elif kw == "format":
                pat = CONTRACT_UUID if arg == "uuid" else CONTRACT_TIME
                extra = "" if arg == "uuid" else f" AND try_cast(upper({s}) AS TIMESTAMPTZ) IS NOT NULL"
                out.append((f"{name}:format", f"CASE WHEN {present} AND {t} = 'VARCHAR' AND NOT (regexp_full_match({s}, {q(pat)}){extra}) THEN {pre} || {rep} || {q(f' is not a {arg!r}')} END"))
            elif kw == "items":
                it = arg["type"]
                bad = f"list_filter(range(0, CAST(coalesce(json_array_length({raw}, {q(p)}), 0) AS BIGINT)), lambda i: json_type({raw}, {q(p)} || '[' || i || ']') <> 'VARCHAR')"
                out.append((f"{name}:items", f"CASE WHEN {present} AND {t} = 'ARRAY' AND len({bad}) > 0 THEN 'items' END"))
    allowed = ", ".join(q(p) for p in contract["properties"])
    extra = f"list_filter(json_keys({raw}), lambda k: k NOT IN ({allowed}))"
    out.append(("root:additionalProperties",
                f"CASE WHEN {obj} AND len({extra}) > 0 THEN '[root]: Additional properties are not allowed (' || "
                f"array_to_string(list_transform({extra}, lambda k: '''' || k || ''''), ', ') || "
                f"CASE WHEN len({extra}) = 1 THEN ' was unexpected)' ELSE ' were unexpected)' END END"))
    return out


def _contract_cte() -> str:
    rules = contract_rules()
    parts = ", ".join(f"{m} AS r{i}" for i, (_, m) in enumerate(rules))
    ok = "raw_value IS NOT NULL AND raw_value <> '' AND json_valid(raw_value)"
    n = " + ".join(f"(r{i} IS NOT NULL)::INT" for i in range(len(rules)))
    reason = "concat_ws('; ', " + ", ".join(f"r{i}" for i in range(len(rules))) + ")"
    tags = []
    seen = []
    for i, (tag, _) in enumerate(rules):
        tags.append(f"CASE WHEN r{i} IS NOT NULL THEN {q(tag)} END")
    return f"""
cr0 AS (SELECT *, {parts} FROM raw WHERE {ok}),
cr AS (SELECT src_id, cls, src_ts, raw_value, {n} AS n_errors, {reason} AS reason,
  array_to_string(list_sort(list_distinct(list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL))), ',') AS tags FROM cr0),
cv AS (SELECT r.src_id, r.cls, r.src_ts, r.raw_value, r."partition",
  CASE WHEN cr.src_id IS NULL THEN 'unparseable' WHEN cr.n_errors = 0 THEN 'valid' ELSE 'invalid' END AS contract_status,
  cr.n_errors, CASE WHEN cr.n_errors > 0 THEN cr.reason END AS reason, cr.tags
  FROM raw r LEFT JOIN cr USING (src_id))"""


CONTRACT = _contract_cte()

# A parsed body that Python calls false.
FALSY = """CASE json_type(raw_value) WHEN 'NULL' THEN true WHEN 'OBJECT' THEN len(json_keys(raw_value)) = 0
  WHEN 'ARRAY' THEN json_array_length(raw_value) = 0 WHEN 'VARCHAR' THEN json_extract_string(raw_value, '$') = ''
  WHEN 'BOOLEAN' THEN json_extract_string(raw_value, '$') = 'false'
  ELSE CAST(json_extract_string(raw_value, '$') AS DOUBLE) = 0 END"""
GATE = f"""
gate AS (SELECT *, CASE
   WHEN raw_value IS NULL OR raw_value = '' OR NOT json_valid(raw_value) THEN 'error'
   WHEN {FALSY} THEN 'refused'
   WHEN contract_status = 'invalid' THEN 'rejected' ELSE 'accepted' END AS gate_status FROM cv)"""


def windows(length_s: int, slide_s: int, src: str = "ev") -> str:
    k = length_s // slide_s
    return f"""
win AS (SELECT {src}.*, CAST(time_bucket(INTERVAL '{slide_s} seconds', event_time, TIMESTAMP '1970-01-01')
          - i * INTERVAL '{slide_s} seconds' AS TIMESTAMP) AS window_start
  FROM {src}, range(0, {k}) t(i)),
winx AS (SELECT *, window_start + INTERVAL '{length_s} seconds' AS window_end,
  coalesce(nullif(page_url, ''), '/unknown') AS page_key FROM win)"""


def metrics(length_s: int, slide_s: int) -> str:
    return windows(length_s, slide_s) + """,
pm AS (SELECT window_start, window_end, page_key AS page_url,
  CAST(count(DISTINCT user_id) AS BIGINT) AS active_users,
  CAST(sum(CASE WHEN event_type = 'cart_add' THEN 1 ELSE 0 END) AS BIGINT) AS cart_additions,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
  max(event_time) AS updated_at
  FROM winx GROUP BY ALL),
m AS (SELECT *, CASE WHEN cart_additions > 0 THEN (cart_additions - purchases) / cart_additions ELSE 0.0 END
  AS cart_abandonment_rate FROM pm)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# -- stream health ----------------------------------------------------------
STEP_US = 15_000_000

GATED_EVENTS = f"""
gts AS (SELECT CAST(src_ts AS TIMESTAMP) AS ts, gate_status,
   make_timestamp(CAST(ceil(epoch_us(CAST(src_ts AS TIMESTAMP)) / {STEP_US}.0) * {STEP_US} AS BIGINT)) AS step
  FROM gate WHERE gate_status IN ('accepted', 'rejected'))"""


def steps_with(range_s: str, name: str) -> str:
    """Every step from the first event's on, and the events in (t - range, t]:
    counted as those up to t less those up to t - range."""
    return f"""
{name}_t AS (SELECT unnest(generate_series((SELECT min(step) FROM gts), (SELECT max(step) FROM gts) + INTERVAL {range_s} SECONDS,
    INTERVAL 15 SECONDS)) AS ts),
{name}_c AS (SELECT ts, count(*) FILTER (WHERE gate_status = 'accepted') AS a, count(*) FILTER (WHERE gate_status = 'rejected') AS r
  FROM gts GROUP BY ts),
{name}_s AS (SELECT ts, sum(a) OVER (ORDER BY ts) AS a, sum(r) OVER (ORDER BY ts) AS r FROM {name}_c),
{name} AS (SELECT t.ts, CAST(coalesce(hi.a, 0) - coalesce(lo.a, 0) AS BIGINT) AS accepted,
    CAST(coalesce(hi.r, 0) - coalesce(lo.r, 0) AS BIGINT) AS rejected
  FROM (SELECT ts, ts - INTERVAL {range_s} SECONDS AS back FROM {name}_t) t
  ASOF LEFT JOIN {name}_s hi ON t.ts >= hi.ts ASOF LEFT JOIN {name}_s lo ON t.back >= lo.ts)"""


def sustained_sql(src: str, keys: str, for_s: int) -> str:
    """Rows of ``src`` (keys, ts) where the condition held at every step of
    [ts - for, ts]: a RANGE-frame count over the true steps."""
    n = for_s // 15 + 1
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""(SELECT * FROM (SELECT *, count(*) OVER ({part} ORDER BY ts RANGE BETWEEN INTERVAL {for_s} SECONDS PRECEDING AND CURRENT ROW) AS c
  FROM {src}) WHERE c = {n})"""
