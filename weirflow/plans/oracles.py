"""The same results in plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

HOUR = 3_600_000
LATENESS = 12 * HOUR
PERIOD = 1_800_000
PANE_TICK = 5 * 24 * HOUR
BIG = "900000000000000000"
BIG_2 = "950000000000000000"

WHOLE = "CAST(floor(value) AS BIGINT)"
ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"
DELAY = (
    f"CASE WHEN event_id % 13 = 0 THEN {29 * HOUR} WHEN event_id % 7 = 0 THEN {3 * HOUR // 2} "
    "ELSE 0 END"
)

# Log messages

LOG_REASON = """CASE WHEN event_id % 103 = 0 THEN 'empty' WHEN event_id % 97 = 0 THEN 'malformed'
  WHEN event_id % 101 = 0 THEN 'no timestamp' WHEN event_id % 107 = 0 THEN 'bad timestamp' END"""

LOGS = f"""logs AS (
  SELECT event_id AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS severity,
    'svc-' || (user_id % 10) AS service, event_type AS message,
    user_id || '-' || (event_id % 20) AS trace_id,
    CASE WHEN event_type = 'signup' THEN 'null' ELSE
      '{{"method":"' || CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END
      || '","url":"/' || event_type || '","http_status":'
      || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END
      || ',"ip_address":"10.0.0.' || (user_id % 256) || '"}}' END AS request_details,
    {WHOLE} AS latency_ms
  FROM events WHERE ({LOG_REASON}) IS NULL)"""

LOG_LATEST = f"""WITH {LOGS}
SELECT * FROM logs QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY seq DESC) = 1"""

# CSV events

CSV = f"""csv AS (
  SELECT epoch_us(ts) // 1000 AS event_ts, CAST(user_id AS VARCHAR) AS thread_id,
    'worker-' || (user_id % 8) AS thread_name, event_id AS seq, event_type AS dim1,
    {WHOLE} AS metrics1, epoch_us(ts) // 1000 + {DELAY} AS arrival
  FROM events WHERE event_id % 89 <> 0)"""

ENRICHED = f"""{CSV}, enriched AS (
  SELECT *, event_ts + 1500 AS process_ts,
    CASE WHEN dim1 = 'click' THEN 'Not Found' ELSE 'dim-' || dim1 END AS dim1_val
  FROM csv)"""

DOCS = f"""{ENRICHED}, docs AS (
  SELECT seq, '{{"@timestamp":' || event_ts || ',"thread_id":"' || thread_id || '","thread_name":"'
    || thread_name || '","seq":' || seq || ',"dim1":"' || dim1 || '","metrics1":' || metrics1
    || ',"process_ts":' || process_ts || ',"dim1_val":"' || dim1_val || '"}}' AS doc
  FROM enriched)"""

BULK = f"""{DOCS}, numbered AS (
  SELECT seq // 5000 AS part, doc,
    (row_number() OVER (PARTITION BY seq // 5000 ORDER BY seq) - 1) // 1000 AS batch
  FROM docs), bulk AS (
  SELECT CAST(part AS VARCHAR) AS part, batch, count(*) AS docs,
    CAST(sum(3 * length(doc)) AS BIGINT) AS bytes, 1 AS attempts, 200 AS status
  FROM numbered GROUP BY part, batch)"""

WINDOW_STATS = f"""WITH {CSV}
SELECT event_ts // {HOUR} * {HOUR} AS window_start, event_ts // {HOUR} * {HOUR} + {HOUR} AS window_end,
  dim1, count(*) AS num_records, CAST(sum(metrics1) AS BIGINT) AS sum, min(metrics1) AS min,
  max(metrics1) AS max, avg(metrics1) AS avg
FROM csv GROUP BY ALL"""


def _panes(tick: str, late_count: int = 1) -> str:
    """Firings for an arrival order; ``tick`` is the micro-batch of a row.

    A micro-batch is longer than the lateness, so late rows of a window come in one.
    """
    return _tick_panes(f"dense_rank() OVER (ORDER BY {tick}) - 1", late_count)


def _tick_panes(tick: str, late_count: int = 1) -> str:
    """Firings for an arrival order; ``tick`` numbers the trigger interval of a row."""
    return f"""{CSV}, e AS (
  SELECT dim1, event_ts AS t, metrics1 AS m, {tick} AS tick FROM csv),
marks AS (
  SELECT tick, hi,
    max(hi) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm
  FROM (SELECT tick, max(t) AS hi FROM e GROUP BY tick)),
part AS (
  SELECT dim1, t // {HOUR} * {HOUR} AS window_start, t // {HOUR} * {HOUR} + {HOUR} AS window_end,
    tick, wm, count(*) AS n, sum(m) AS s, min(m) AS lo, max(m) AS hi
  FROM e JOIN marks USING (tick) GROUP BY ALL),
fired AS (
  SELECT dim1, window_start, window_end, tick, n, s, lo, hi,
    CASE WHEN wm >= window_end THEN 'LATE' ELSE 'EARLY' END AS timing
  FROM part WHERE wm IS NULL OR wm < window_end + {LATENESS}),
open_windows AS (SELECT DISTINCT dim1, window_start, window_end FROM fired WHERE timing = 'EARLY'),
passes AS (
  SELECT w.window_end, min(marks.tick) AS tick
  FROM (SELECT DISTINCT window_end FROM open_windows) w JOIN marks ON marks.hi >= w.window_end
  GROUP BY w.window_end),
closes AS (
  SELECT w.window_end, min(marks.tick) AS tick
  FROM (SELECT DISTINCT window_end FROM fired) w JOIN marks ON marks.hi >= w.window_end + {LATENESS}
  GROUP BY w.window_end),
firings AS (
  SELECT *, FALSE AS is_last FROM fired WHERE timing = 'EARLY' OR n >= {late_count}
  UNION ALL
  SELECT dim1, window_start, window_end, closes.tick, n, s, lo, hi, timing, TRUE
  FROM fired JOIN closes USING (window_end) WHERE timing = 'LATE' AND n < {late_count}
  UNION ALL
  SELECT dim1, window_start, window_end, tick, 0, NULL, NULL, NULL, 'ON_TIME', FALSE
  FROM open_windows JOIN passes USING (window_end)),
panes AS (
  SELECT dim1, window_start, window_end, tick, timing,
    row_number() OVER k - 1 AS pane_idx,
    CASE WHEN timing = 'EARLY' THEN -1 ELSE
      count(*) FILTER (WHERE timing <> 'EARLY') OVER k - 1 END AS nonspeculative_idx,
    row_number() OVER k = 1 AS is_first, is_last,
    n AS num_records, CAST(coalesce(s, 0) AS BIGINT) AS sum,
    coalesce(lo, 0) AS min, coalesce(hi, 0) AS max,
    CAST(sum(n) OVER k AS BIGINT) AS acc_num_records, CAST(sum(s) OVER k AS BIGINT) AS acc_sum,
    min(lo) OVER k AS acc_min, max(hi) OVER k AS acc_max
  FROM firings
  WINDOW k AS (PARTITION BY dim1, window_start ORDER BY tick, timing <> 'EARLY'
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


PANES = _panes(f"arrival // {PANE_TICK}", 2)
PERIOD_PANES = _tick_panes(f"arrival // {PERIOD}")

DEDUP = """WITH RECURSIVE keyed AS (
  SELECT event_id AS seq, 'u' || user_id AS uuid, epoch_us(ts) // 60000000 AS tick
  FROM events WHERE event_id % 17 <> 0),
firsts AS (SELECT uuid, tick, min(seq) AS seq FROM keyed GROUP BY uuid, tick),
nexts AS (
  SELECT a.uuid, a.tick, min(b.tick) AS next_tick, arg_min(b.seq, b.tick) AS next_seq
  FROM firsts a JOIN firsts b ON a.uuid = b.uuid AND a.tick + 1440 <= b.tick GROUP BY a.uuid, a.tick),
kept AS (
  SELECT uuid, min(tick) AS tick, arg_min(seq, tick) AS seq FROM firsts GROUP BY uuid
  UNION ALL
  SELECT k.uuid, n.next_tick, n.next_seq FROM kept k JOIN nexts n USING (uuid, tick))
SELECT seq, uuid, FALSE AS unkeyed FROM kept
UNION ALL
SELECT event_id, NULL, TRUE FROM events WHERE event_id % 17 = 0"""

# Change capture

CHANGES = f"""messages AS (
  SELECT o_orderkey AS arrival, epoch_us(o_orderdate) // 1000 AS ts,
    epoch_us(o_orderdate) // 1000 - o_orderkey % 1000 AS es,
    'SHOP.ORDERS_' || substr(o_orderpriority, 1, 1) AS destination,
    CASE WHEN o_orderkey % 199 = 0 THEN 'NONE' WHEN o_orderstatus = 'F' THEN 'DELETE'
      ELSE 'UPSERT' END AS change_type,
    CASE WHEN o_orderkey % 197 = 0 THEN 'malformed' WHEN o_orderkey % 211 = 0 THEN 'ddl'
      WHEN o_orderkey % 223 = 0 THEN 'no destination' END AS reason,
    o_custkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    o_orderkey AS order_id, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent
  FROM orders),
changes AS (
  SELECT *, 0 AS pos, CAST(o_custkey + {BIG} AS VARCHAR) AS id FROM messages WHERE reason IS NULL
  UNION ALL
  SELECT *, 1, CAST(o_custkey + {BIG_2} AS VARCHAR) FROM messages WHERE reason IS NULL AND urgent)"""

CHANGE_COLUMNS = "destination, id, status, cents, order_id, change_type"

CDC_APPLY = f"""WITH {CHANGES}, last AS (
  SELECT * FROM changes QUALIFY row_number() OVER (
    PARTITION BY destination, id ORDER BY ts DESC, es DESC, arrival DESC, pos DESC) = 1)
SELECT {CHANGE_COLUMNS} FROM last WHERE change_type <> 'DELETE'"""

# Schema drift

DRIFT = """drift AS (
  SELECT event_id AS seq, ts, least((day(ts) - 1) // 10 + 1, 3) AS batch,
    'ev-' || event_id AS id, 'Sender-' || user_id AS sender,
    CASE WHEN event_id % 19 = 0 THEN 'sender_name' ELSE 'SENDER_NAME' END AS sender_key,
    event_type, event_id % 103 = 0 AS broken
  FROM events)"""

DRIFT_FIELDS = """fields AS (
  SELECT seq, ts, batch, 'ID' AS field FROM drift WHERE NOT broken
  UNION ALL SELECT seq, ts, batch, sender_key FROM drift WHERE NOT broken
  UNION ALL SELECT seq, ts, batch, 'CHANNEL' FROM drift WHERE NOT broken AND batch >= 2
  UNION ALL SELECT seq, ts, batch, 'VISIT' FROM drift WHERE NOT broken AND batch >= 3)"""

HEALED = f"""WITH {DRIFT}
SELECT seq, id AS "ID", sender AS "SENDER_NAME",
  CASE WHEN batch >= 2 THEN 'v-' || event_type END AS "CHANNEL",
  CASE WHEN batch >= 3 THEN CAST(seq AS VARCHAR) END AS "VISIT"
FROM drift WHERE NOT broken"""


def _envelope(quote: str, inner_quote: str) -> str:
    number = f"CAST(o_orderkey + {BIG} AS VARCHAR)"
    return f"""SELECT o_orderkey AS seq,
  '{{"topic":"stock","data":"[{{\\"NO\\":{inner_quote}' || {number} || '{inner_quote},\\"rank\\":\\"'
  || o_orderpriority || '\\"}}]","big":{quote}' || {number} || '{quote},"n":' || o_custkey
  || ',"origin":"{{\\"site\\":\\"north\\",\\"shelf\\":7}}","gone":null,"sold":false}}' AS envelope
FROM orders WHERE o_orderkey % 251 <> 0"""


ORACLES: dict[str, str] = {
    "log_parse": f"WITH {LOGS} SELECT * FROM logs",
    "log_filter_sql": f"WITH {LOGS} SELECT * FROM logs WHERE severity <> 'DEBUG'",
    "log_dlq": f"""SELECT reason, count(*) AS messages FROM (SELECT {LOG_REASON} AS reason FROM events)
WHERE reason IS NOT NULL AND reason <> 'empty' GROUP BY reason""",
    "log_upsert": LOG_LATEST,
    "bigint_flatten": f"""WITH n AS (
  SELECT l_orderkey * 10 + l_linenumber + {BIG} AS id,
    '12345678' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS wide, * FROM lineitem)
SELECT CAST(id AS VARCHAR) AS id_text, CAST(id + 1 AS VARCHAR) AS id_plus_one, wide AS wide_text,
  '{{"ID":' || id || ',"name":"' || l_returnflag || '"}}' AS wrapper,
  CAST(id AS VARCHAR) AS wrapper_id, wide AS code, CAST(l_quantity AS BIGINT) AS qty,
  'none' AS old_value, 'true' AS flag FROM n""",
    "bigint_envelope": _envelope("", ""),
    "bigint_envelope_text": _envelope('"', '\\"'),
    "json_metadata_split": f"""SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name AS "SENDER_NAME",
  '{{"account":' || (c_custkey + {BIG}) || ',"profile":{{"segment":"' || c_mktsegment
  || '","nation":' || c_nationkey || '}}}}' AS "METADATA",
  CAST(c_custkey + {BIG} AS VARCHAR) AS account, c_mktsegment AS segment FROM customer""",
    "csv_typed": f"""WITH {CSV}
SELECT event_ts, thread_id, thread_name, seq, dim1, metrics1 FROM csv""",
    "csv_failures": """SELECT epoch_us(ts) // 1000 || ',' || user_id || ',worker-' || (user_id % 8) AS value,
  'missing field' AS reason FROM events WHERE event_id % 89 = 0""",
    "dim_lookup": f"WITH {ENRICHED} SELECT seq, dim1, dim1_val, process_ts FROM enriched",
    "search_docs": f"WITH {DOCS} SELECT seq, doc FROM docs",
    "table_rows": f"""WITH {ENRICHED}, w AS (
  SELECT *, make_timestamp(event_ts // {HOUR} * {HOUR} * 1000) AS s FROM enriched)
SELECT event_ts // 1000 AS event_ts, thread_id, thread_name, seq, dim1,
  metrics1, process_ts // 1000 AS process_ts, dim1_val,
  '[' || strftime(s, {ISO}) || '..' || strftime(s + INTERVAL 1 HOUR, {ISO}) || ')' AS window,
  'PaneInfo.NO_FIRING' AS pane_info, CAST(0 AS BIGINT) AS pane_idx,
  CAST(0 AS BIGINT) AS pane_nonspeculative_idx, TRUE AS is_first, TRUE AS is_last,
  'UNKNOWN' AS pane_timing, event_ts // 1000 AS pane_event_ts FROM w""",
    "basic_event_rows": """SELECT event_id AS seq, epoch_us(ts) // 1000000 AS event_ts,
  event_type AS kind, user_id AS user, CAST(3 AS BIGINT) AS fields FROM events
WHERE event_id % 113 <> 0 AND event_id % 109 <> 0""",
    "window_stats": WINDOW_STATS,
    "pane_replay": f"WITH {PANES} SELECT * FROM panes",
    "window_tall": f"""WITH {PERIOD_PANES}
SELECT dim1 || '#' || (9223372036854775807 - (tick + 1) * {PERIOD}) AS row_key,
  acc_num_records AS num_records, acc_sum AS sum, acc_max AS max, acc_min AS min,
  acc_sum / acc_num_records AS avg, pane_idx, nonspeculative_idx, is_first, is_last, timing,
  window_start AS win_start_ts, window_end AS win_end_ts FROM panes""",
    "window_wide": f"""WITH {PERIOD_PANES}, cells AS (
  SELECT dim1 || '#' || window_start || '#' || window_end AS row_key, pane_idx,
    num_records, sum, max, min FROM panes WHERE num_records > 0)
SELECT row_key, 'num_records#' || pane_idx AS "column", CAST(num_records AS VARCHAR) AS value FROM cells
UNION ALL SELECT row_key, 'sum#' || pane_idx, CAST(sum AS VARCHAR) FROM cells
UNION ALL SELECT row_key, 'max#' || pane_idx, CAST(max AS VARCHAR) FROM cells
UNION ALL SELECT row_key, 'min#' || pane_idx, CAST(min AS VARCHAR) FROM cells
UNION ALL SELECT row_key, 'avg#' || pane_idx, CAST(sum / num_records AS VARCHAR) FROM cells""",
    "late_drop": f"""WITH {CSV}, e AS (SELECT *, arrival // {PERIOD} AS tick FROM csv),
marks AS (
  SELECT tick, max(hi) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm
  FROM (SELECT tick, max(event_ts) AS hi FROM e GROUP BY tick))
SELECT seq, dim1, event_ts,
  CASE WHEN wm >= event_ts // {HOUR} * {HOUR} + {HOUR} + {LATENESS} THEN 'DROPPED'
    WHEN wm >= event_ts // {HOUR} * {HOUR} + {HOUR} THEN 'LATE' ELSE 'IN_TIME' END AS timing
FROM e JOIN marks USING (tick)""",
    "error_windows": f"""SELECT (epoch_us(ts) // 1000 + {DELAY}) // {HOUR} * {HOUR} + {HOUR} AS window_end,
  'missing field' AS reason, count(*) AS messages
FROM events WHERE event_id % 89 = 0 GROUP BY ALL""",
    "day_partition": f"""WITH {CSV}, t AS (SELECT make_timestamp(event_ts * 1000) AS moment FROM csv)
SELECT strftime(moment, '%Y-%m-%d') AS event_day,
  strftime(date_trunc('hour', moment) + INTERVAL 1 HOUR, '%Y/%m/%d/%H') AS folder, count(*) AS num_records
FROM t GROUP BY ALL""",
    "window_files": f"""WITH {CSV}
SELECT event_ts || ',' || seq || ',' || dim1 || ',' || metrics1 AS value,
  strftime(make_timestamp((event_ts // {HOUR} * {HOUR} + {HOUR}) * 1000), '%Y/%m/%d/%H') AS folder
FROM csv""",
    "window_records": f"""WITH {CSV}
SELECT event_ts, seq, dim1, metrics1,
  strftime(make_timestamp((event_ts // {HOUR} * {HOUR} + {HOUR}) * 1000), '%Y/%m/%d/%H') AS folder
FROM csv""",
    "day_table": """SELECT strftime(ts, '%Y-%m-%d') AS event_day, event_type AS kind,
  count(*) AS num_records, min(epoch_us(ts) // 1000000) AS first_ts,
  max(epoch_us(ts) // 1000000) AS last_ts, count(DISTINCT user_id) AS users
FROM events WHERE event_id % 113 <> 0 AND event_id % 109 <> 0 GROUP BY ALL""",
    "payload_rows": f"""SELECT CAST(event_id AS VARCHAR) AS message_id,
  epoch_us(ts) // 1000 || ',' || user_id || ',worker-' || (user_id % 8)
  || CASE WHEN event_id % 89 = 0 THEN '' ELSE ',' || event_id || ',' || event_type || ',' || {WHOLE}
  END AS value, epoch_us(ts) // 1000 + {DELAY} AS arrival FROM events""",
    "dedup_ttl": DEDUP,
    "batches_100": """WITH n AS (
  SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 100
    AS batch_id FROM events)
SELECT event_type, batch_id, count(*) AS size FROM n GROUP BY ALL""",
    "bulk_batches": f"WITH {BULK} SELECT * FROM bulk",
    "bulk_counters": f"""WITH {BULK}
SELECT CAST(sum(docs) AS BIGINT) AS documents, count(*) AS batches, CAST(0 AS BIGINT) AS errors
FROM bulk""",
    "bulk_commit": f"""WITH {DOCS}, ticked AS (
  SELECT seq, doc, seq // 5000 AS part,
    dense_rank() OVER (ORDER BY seq // (SELECT CAST(ceil((max(event_id) + 1) / 5) AS BIGINT) FROM events)) - 1 AS epoch
  FROM docs), numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY epoch, part ORDER BY seq) - 1) // 1000 AS batch FROM ticked)
SELECT epoch, CAST(part AS VARCHAR) AS part, batch, count(*) AS docs,
  CAST(sum(3 * length(doc)) AS BIGINT) AS bytes, 1 AS attempts, 200 AS status
FROM numbered GROUP BY epoch, part, batch""",
    "staged_paths": f"""WITH {DRIFT}
SELECT 'orders' AS table_name, batch, count(*) AS staged_rows,
  'stage/orders/window=' || batch AS path FROM drift GROUP BY batch""",
    "cdc_explode": f"WITH {CHANGES} SELECT {CHANGE_COLUMNS} FROM changes",
    "cdc_apply": CDC_APPLY,
    "cdc_route": f"""WITH {CHANGES}
SELECT destination, count(*) AS changes FROM changes GROUP BY destination""",
    "cdc_tables": f"""WITH {CHANGES}, last AS (
  SELECT * FROM changes QUALIFY row_number() OVER (
    PARTITION BY destination, id ORDER BY ts DESC, es DESC, arrival DESC, pos DESC) = 1)
SELECT destination, CAST(id AS BIGINT) AS "ID", status AS "STATUS", cents AS "CENTS",
  order_id AS "ORDER_ID" FROM last WHERE change_type <> 'DELETE'""",
    "route_tables": """SELECT o_orderkey AS order_id, o_orderstatus AS status,
  CASE WHEN o_custkey % 12 = 11 THEN -1 ELSE o_custkey % 12 END AS route FROM orders""",
    "cdc_dlq": f"""WITH {CHANGES}
SELECT reason, count(*) AS messages FROM messages WHERE reason <> 'ddl' GROUP BY reason""",
    "latest_view": """SELECT user_id, event_id, event_type, epoch_us(ts) // 1000 AS event_ms FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "drift_detect": f"""WITH {DRIFT}, {DRIFT_FIELDS}
SELECT DISTINCT batch, lower(field) AS field FROM fields
WHERE lower(field) NOT IN ('id', 'sender_name')""",
    "drift_route": f"""WITH {DRIFT}
SELECT batch, CASE WHEN batch >= 2 THEN 'DRIFTED' ELSE 'NORMAL' END AS route, count(*) AS messages
FROM drift WHERE NOT broken GROUP BY ALL""",
    "drift_route_rows": f"""WITH {DRIFT}
SELECT seq, batch, CASE WHEN batch >= 2 THEN 'DRIFTED' ELSE 'NORMAL' END AS route
FROM drift WHERE NOT broken""",
    "strict_split": f"""WITH {DRIFT}
SELECT batch, CASE WHEN broken THEN 'malformed' WHEN batch >= 3 THEN 'unknown field' ELSE 'valid' END
  AS outcome, count(*) AS messages FROM drift GROUP BY ALL""",
    "drift_heal": HEALED,
    "failed_rows_heal": HEALED,
    "ordered_dump": HEALED,
    "autodetect_load": f"""WITH {DRIFT}
SELECT id AS "ID", sender AS "SENDER_NAME",
  CASE WHEN batch >= 2 THEN 'v-' || event_type END AS "CHANNEL",
  CASE WHEN batch >= 3 THEN seq + 1 ELSE -1 END AS batch_2_plus_one
FROM drift WHERE NOT broken""",
    "schema_versions": """WITH v AS (
  SELECT *, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 1
    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 2 ELSE 3 END AS version FROM customer)
SELECT 'c' || c_custkey AS "ID", '{"nation":' || c_nationkey || '}' AS "SENDER_JSON",
  c_name AS "SENDER_NAME", c_mktsegment AS "SENDER_COMPANY",
  CASE WHEN version >= 2 THEN '+49-' || c_custkey END AS "SENDER_MOBILE_PHONE",
  CASE WHEN version >= 2 THEN c_mktsegment END AS "NEW_TOP_LEVEL_FIELD",
  CASE WHEN version = 3 THEN c_custkey ELSE -1 END AS "NEW_TOP_LEVEL_FIELD_V2" FROM v""",
    "json_column_load": """SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name AS "SENDER_NAME",
  CAST(c_nationkey AS VARCHAR) AS nation FROM customer""",
    "staged_load": HEALED,
    "schema_registry": f"""WITH {DRIFT}, {DRIFT_FIELDS}
SELECT 'orders' AS table_name, field, epoch_us(min(ts)) // 1000 AS first_seen, epoch_us(max(ts)) // 1000 AS last_seen,
  count(*) AS seen FROM fields GROUP BY field""",
    "table_compare": """SELECT o_orderkey AS key, 'status' AS field, 'different' AS status,
  o_orderstatus AS left_value, 'X' AS right_value FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT o_orderkey, 'priority', 'missing', o_orderpriority, NULL
FROM orders WHERE o_orderkey % 61 = 0
UNION ALL SELECT o_orderkey, 'note', 'extra', NULL, 'new' FROM orders WHERE o_orderkey % 67 = 0""",
    "field_counts": """SELECT 'source' AS side, count(*) AS records, 4 * count(*) AS fields FROM orders
UNION ALL SELECT 'table', count(*),
  CAST(sum(4 - CAST(o_orderkey % 61 = 0 AS INTEGER) + CAST(o_orderkey % 67 = 0 AS INTEGER)) AS BIGINT)
FROM orders""",
    "stream_log": f"WITH {LOGS} SELECT * FROM logs",
    "stream_upsert": LOG_LATEST,
    "stream_cdc": CDC_APPLY,
    "stream_cdc_batches": CDC_APPLY,
    "stream_drift_batches": HEALED,
    "stream_window": WINDOW_STATS,
    "stream_panes": f"WITH {_panes('0')} SELECT * EXCLUDE (tick) FROM panes",
    "stream_lookup": f"WITH {ENRICHED} SELECT seq, dim1, dim1_val FROM enriched",
    "lookup_hot": """WITH o AS (
  SELECT o_orderkey AS order_id, CAST(
    CASE WHEN o_orderkey % 5 < 3 THEN 1 WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS VARCHAR) AS customer
  FROM orders)
SELECT order_id, o.customer, coalesce(c_name, 'Not Found') AS name
FROM o LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = o.customer""",
    "stream_dedup": """SELECT min(event_id) AS seq, 'u' || user_id AS uuid, FALSE AS unkeyed
FROM events WHERE event_id % 17 <> 0 GROUP BY user_id
UNION ALL SELECT event_id, NULL, TRUE FROM events WHERE event_id % 17 = 0""",
    "stream_drift": HEALED,
}
ORACLES["declared_load"] = ORACLES["schema_versions"]
ORACLES["drift_route_startup"] = ORACLES["drift_route"]
ORACLES["stream_shared_dead"] = ORACLES["log_dlq"]
ORACLES["log_millis"] = f"""SELECT event_id AS seq, epoch_us(ts) // 1000 AS at_ms,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS severity
FROM events WHERE ({LOG_REASON}) IS NULL"""
ORACLES["time_forms"] = f"""WITH t AS (SELECT *, epoch_us(ts) // 1000 AS ms FROM events)
SELECT event_id AS seq, CASE WHEN event_id % 7 = 0 THEN 0 ELSE ms END AS at_ms,
  lower(to_hex(ms)) AS sequence,
  strftime(make_timestamp((ms // {HOUR} * {HOUR} + {HOUR} - 1) * 1000), '%Y-%m-%dT%H-%M-%S.%gZ') AS stamp,
  event_type || '#' || (9223372036854775807 - ms) AS key, epoch_us(ts) // 1000000 AS seconds
FROM t"""
ORACLES["typed_record"] = """SELECT event_id AS seq, event_type AS kind, user_id % 2 = 0 AS even,
  CAST(user_id AS INTEGER) AS user, epoch_us(ts) // 1000 AS at_ms,
  CAST(value AS FLOAT) AS about, value AS exactly FROM events"""
_BUNDLES = """sent AS (SELECT *, event_id % 103 = 0 AS broken,
    CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'click' THEN 'visits' WHEN 'view' THEN 'visits' END AS name,
    CASE WHEN event_id % 17 <> 0 THEN 'u' || user_id END AS uuid FROM events)"""
ORACLES["bundle_tables"] = f"""WITH {_BUNDLES}
SELECT name, coalesce(uuid, '') AS uuid, 'v' || event_id AS v FROM sent WHERE NOT broken AND name IS NOT NULL
QUALIFY uuid IS NULL OR row_number() OVER (PARTITION BY name, uuid ORDER BY event_id) = 1"""
ORACLES["bundle_registry"] = f"""WITH {_BUNDLES}, good AS (SELECT * FROM sent WHERE NOT broken AND name IS NOT NULL)
SELECT 'dead' AS kind, CASE WHEN broken THEN 'malformed' ELSE 'unknown bundle' END AS what, count(*) AS n
FROM sent WHERE broken OR name IS NULL GROUP BY ALL
UNION ALL SELECT 'field', name || '.bundle_id', count(*) FROM good GROUP BY name
UNION ALL SELECT 'field', name || '.v', count(*) FROM good GROUP BY name
UNION ALL SELECT 'field', name || '.uuid', count(uuid) FROM good GROUP BY name
UNION ALL SELECT 'field', name || '.extra', count(*) FROM good WHERE event_id % 5 = 0 GROUP BY name"""
ORACLES["poison_rows"] = """SELECT event_id AS seq,
  CASE WHEN event_id % 49999 = 5 THEN 'many' ELSE CAST(user_id AS VARCHAR) END AS amount,
  CASE WHEN event_id % 49999 = 5 THEN 'CAST_INVALID_INPUT' ELSE '' END AS reason FROM events"""
ORACLES["conflict_load"] = """WITH b AS (
  SELECT event_id, least((day(ts) - 1) // 10, 2) AS batch, event_id % 101 = 0 AS twice FROM events)
SELECT event_id AS "ID", CASE WHEN batch = 0 AND NOT twice THEN event_id END AS n,
  CASE WHEN batch = 1 AND NOT twice THEN event_id || '.50' END AS "n_V2",
  CASE WHEN batch = 2 AND NOT twice THEN 'v' || event_id END AS "n_V3",
  CASE WHEN NOT twice THEN '{"a":' || event_id || CASE WHEN batch > 0 THEN ',"b":[1,"x"]' ELSE '' END || '}' END AS o,
  CASE WHEN twice THEN 'repeated field' ELSE '' END AS reason FROM b"""
ORACLES["stream_batches"] = """WITH n AS (SELECT event_type, event_id,
    (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 100 AS batch_id FROM events)
SELECT event_type, batch_id, count(*) AS size, min(event_id) AS first_id, max(event_id) AS last_id
FROM n GROUP BY ALL HAVING count(*) = 100"""
