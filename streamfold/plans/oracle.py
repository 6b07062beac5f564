"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans, straight from the semantics, over
the driver's pre-registered views.  Epoch ms / s are computed from
``epoch_us`` with floor division, which is what Spark's ``unix_millis`` /
``unix_seconds`` do (DuckDB's ``epoch_ms`` rounds).
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
MS = "(epoch_us(ts) // 1000)"
SECS = "(epoch_us(ts) // 1000000)"

TRADES = f"""SELECT CAST(user_id AS VARCHAR) AS symbol, value AS price, CAST({K} AS DOUBLE) AS volume,
       {MS} AS timestamp, ts, event_id FROM events WHERE event_type = 'purchase'"""
QUOTES = f"""SELECT CAST(user_id AS VARCHAR) AS symbol, value AS current, value + 1.0 AS high,
       value - 1.0 AS low, value + 0.5 AS open, value AS prev_close, {SECS} AS timestamp, ts, event_id
       FROM events WHERE event_type = 'error'"""
CLICKS = f"""SELECT CAST(user_id AS VARCHAR) AS symbol, {K} AS k, {MS} AS timestamp, ts, event_id
       FROM events WHERE event_type IN ('click', 'view', 'signup')"""

# document sink, P1 alignment of the three sources
ALIGNED_DOC = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS quote_current, CAST(NULL AS DOUBLE) AS quote_prev_close,
       CAST(NULL AS BIGINT) AS clicks_k, timestamp, ts, event_id FROM ({TRADES})
UNION ALL
SELECT symbol, NULL, NULL, current, prev_close, NULL, timestamp, ts, event_id FROM ({QUOTES})
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, k, timestamp, ts, event_id FROM ({CLICKS})
"""

ALIGNED_WIDE = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS current, CAST(NULL AS DOUBLE) AS prev_close,
       CAST(NULL AS BIGINT) AS k, timestamp, ts, event_id FROM ({TRADES})
UNION ALL
SELECT symbol, NULL, NULL, current, prev_close, NULL, timestamp, ts, event_id FROM ({QUOTES})
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, k, timestamp, ts, event_id FROM ({CLICKS})
"""

_ZERO_COLS = "'' AS note, false AS active, TIMESTAMP '1970-01-01 00:00:00' AS updated"
ALIGNED_COLUMN = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS current, CAST(0 AS BIGINT) AS k, {_ZERO_COLS},
       timestamp, ts, event_id FROM ({TRADES})
UNION ALL
SELECT symbol, CAST(0 AS DOUBLE), NULL, current, 0, {_ZERO_COLS}, timestamp, ts, event_id FROM ({QUOTES})
UNION ALL
SELECT symbol, CAST(0 AS DOUBLE), NULL, NULL, k, {_ZERO_COLS}, timestamp, ts, event_id FROM ({CLICKS})
"""

DOC_VALUES = ["price", "volume", "quote_current", "quote_prev_close", "clicks_k", "timestamp"]


def _latest_nonnull(cols):
    return ", ".join(f"arg_max({c}, (ts, event_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)


SQL: dict[str, str] = {}

SQL["align_mapped"] = f"""
SELECT symbol, price, volume, quote_current, quote_prev_close, clicks_k, timestamp, event_id AS seq
FROM ({ALIGNED_DOC})"""

SQL["align_null_fill"] = f"""
SELECT symbol, price, volume, current, prev_close, k, timestamp, event_id AS seq FROM ({ALIGNED_WIDE})"""

SQL["align_default_fill"] = f"""
SELECT symbol, CAST(0 AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS current,
       k, {_ZERO_COLS}, timestamp, event_id AS seq FROM ({CLICKS})"""

SQL["single_source_insert"] = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS quote_current, CAST(NULL AS DOUBLE) AS quote_prev_close,
       CAST(NULL AS BIGINT) AS clicks_k, timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) AS rn FROM ({TRADES}))
WHERE rn = 1"""

SQL["merge_latest_nonnull"] = f"""
SELECT symbol, {_latest_nonnull(DOC_VALUES)} FROM ({ALIGNED_DOC}) GROUP BY symbol"""

SQL["upsert_last_row"] = f"""
SELECT symbol, price, volume, current, prev_close, k, timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) AS rn
      FROM ({ALIGNED_WIDE}) WHERE symbol IS NOT NULL)
WHERE rn = 1"""

SQL["append_fanin"] = f"""
SELECT symbol, price, volume, current, k, note, active, updated, timestamp, event_id AS seq
FROM ({ALIGNED_COLUMN})"""

SQL["merge_idle_ttl"] = f"""
WITH u AS ({ALIGNED_DOC}),
g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS gap FROM u),
s AS (SELECT symbol, max(ts) AS start_ts FROM g WHERE gap IS NULL OR gap > CAST(3600000000 AS BIGINT) GROUP BY symbol)
SELECT u.symbol, {", ".join(f"arg_max(u.{c}, (u.ts, u.event_id)) FILTER (WHERE u.{c} IS NOT NULL) AS {c}" for c in DOC_VALUES)}
FROM u JOIN s ON u.symbol = s.symbol AND u.ts >= s.start_ts
GROUP BY u.symbol"""

# ---------------------------------------------------------------- sources
BAD = "(event_id % 50 = 0)"
KAFKA_TS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"

SQL["src_json_decode"] = f"""
SELECT CASE WHEN {BAD} THEN NULL ELSE symbol END AS symbol,
       CASE WHEN {BAD} THEN NULL ELSE price END AS price,
       CASE WHEN {BAD} THEN NULL ELSE volume END AS volume,
       CASE WHEN {BAD} THEN NULL ELSE timestamp END AS timestamp,
       event_id AS offset, {BAD} AS is_bad
FROM ({TRADES})"""

SQL["src_meta_ts"] = f"""
SELECT CAST(user_id AS VARCHAR) AS symbol, value AS price, event_id AS offset, {KAFKA_TS} AS _kafka_ts
FROM events WHERE event_type = 'purchase'"""

SQL["src_skip_bad"] = f"""
SELECT symbol, current, high, low, open, prev_close, timestamp, event_id AS offset
FROM ({QUOTES}) WHERE NOT {BAD}"""

SQL["src_drop_count_bad"] = f"""
SELECT CASE event_type WHEN 'purchase' THEN 'trades' WHEN 'error' THEN 'quotes' ELSE 'clicks' END AS topic,
       count(*) FILTER (WHERE NOT {BAD}) AS kafka_read, count(*) FILTER (WHERE {BAD}) AS parse_errors
FROM events GROUP BY 1"""

SQL["decode_trades"] = f"""
SELECT CAST(user_id AS VARCHAR) AS symbol, value AS price,
       CASE WHEN {K} % 7 = 0 THEN 0.0 WHEN {K} % 11 = 0 THEN NULL ELSE CAST({K} AS DOUBLE) END AS volume,
       {MS} AS timestamp, event_id AS offset, 0 AS tick_idx
FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT CAST(user_id AS VARCHAR), CASE WHEN {K} % 13 = 0 THEN NULL ELSE value + 1.0 END, 0.0,
       {MS} + 1, event_id, 1
FROM events WHERE event_type = 'purchase'"""

QUOTE_RESP = f"""
SELECT CAST(user_id AS VARCHAR) AS symbol, value AS current, value + 1.0 AS high, value - 1.0 AS low,
       value + 0.5 AS open, CASE WHEN {K} % 19 = 0 THEN 0.0 ELSE value END AS prev_close,
       {SECS} AS timestamp, event_id AS offset, {KAFKA_TS} AS kts
FROM events WHERE event_type = 'error' AND {K} % 17 <> 0"""

SQL["decode_quotes"] = f"""
SELECT symbol, current, high, low, open, prev_close, timestamp, "offset" FROM ({QUOTE_RESP})"""

ROUTES = "(VALUES ('trades', 'ticks_wide'), ('quotes', 'ticks_wide'), ('trades', 'ticks_col'), " \
         "('clicks', 'clicks_col')) AS r(topic, target_table)"
TOPIC_OF = "CASE event_type WHEN 'purchase' THEN 'trades' WHEN 'error' THEN 'quotes' ELSE 'clicks' END"
ROUTED = f"""
SELECT r.target_table, e.topic, e.event_id AS offset, CAST(e.user_id AS VARCHAR) AS key
FROM (SELECT *, {TOPIC_OF} AS topic FROM events) e JOIN {ROUTES} ON e.topic = r.topic"""

SQL["route_fanout"] = ROUTED

SQL["writes_by_table"] = f"""
SELECT CASE WHEN grouping(target_table) = 1 THEN 'written' ELSE 'written:' || target_table END AS metric,
       count(*) AS n
FROM ({ROUTED}) GROUP BY ROLLUP (target_table)"""

# ---------------------------------------------------------------- enrich
SQL["enrich_asof"] = f"""
SELECT t.symbol, t.price, t.volume, t.timestamp, q.current AS quote_current, q.high AS quote_high,
       q.low AS quote_low, q.open AS quote_open, q.prev_close AS quote_prev_close,
       CASE WHEN q.prev_close IS NULL OR q.prev_close = 0 THEN NULL
            ELSE round((t.price - q.prev_close) / q.prev_close * 100, 4) END AS pct_change,
       t.event_id AS seq
FROM ({TRADES}) t ASOF JOIN ({QUOTES}) q ON t.symbol = q.symbol AND t.ts >= q.ts"""

SQL["pct_change"] = f"""
SELECT t.symbol, t.event_id AS seq, t.price, q.prev_close AS quote_prev_close,
       CASE WHEN q.prev_close IS NULL OR q.prev_close = 0 THEN NULL
            ELSE round((t.price - q.prev_close) / q.prev_close * 100, 4) END AS pct_change
FROM ({TRADES}) t ASOF JOIN ({QUOTE_RESP}) q ON t.symbol = q.symbol AND t.ts >= q.kts"""

# ---------------------------------------------------------------- runs/logs
LOGS = """SELECT event_id AS id, user_id AS run_id, event_type AS node_id, upper(event_type) AS node_label,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       CASE WHEN value >= 150 THEN '✓ ' ELSE '' END || event_type || ' #' || CAST(event_id AS VARCHAR) AS message,
       ts AS timestamp FROM events"""
RUNS = """SELECT o_orderkey AS id, o_custkey AS pipeline_id,
       CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'success' ELSE 'pending' END AS status,
       CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN 'submitted'
            ELSE 'job-' || CAST(o_orderkey AS VARCHAR) END AS job_id,
       o_orderdate AS started_at FROM orders"""
JOBS = """SELECT 'job-' || CAST(o_orderkey AS VARCHAR) AS job_id,
       CASE WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'FINISHED' END AS state
       FROM orders WHERE o_orderstatus <> 'P'"""
NODES = """(VALUES ('error', 'kafka'), ('click', 'kafka'), ('purchase', 'kafka'), ('view', 'mongodb'),
        ('signup', 'clickhouse'), ('sink', 'scylladb')) AS n(node_id, node_type)"""

SQL["filter_log_node"] = f"SELECT * FROM ({LOGS}) WHERE node_id = 'click'"

SQL["search_name"] = "SELECT c_custkey AS id, c_name AS name FROM customer WHERE lower(c_name) LIKE '%r#00000012%'"

SQL["run_summary"] = f"""
WITH l AS ({LOGS}),
a AS (SELECT run_id, node_id, count(*) AS log_count, count(*) FILTER (WHERE level = 'ERROR') AS error_count,
             bool_or(starts_with(coalesce(message, ''), '✓')) AS any_ok,
             arg_max(level, id) AS last_level, arg_max(message, id) AS last_message,
             arg_max(timestamp, id) AS last_ts
      FROM l GROUP BY run_id, node_id),
r AS (SELECT DISTINCT l.run_id, o.o_custkey AS pipeline_id FROM l JOIN orders o ON o.o_orderkey = l.run_id),
pn AS (SELECT c.c_custkey AS pipeline_id, n.node_id, n.node_type FROM customer c CROSS JOIN {NODES})
SELECT r.run_id, n.node_id, upper(n.node_id) AS node_label, n.node_type,
       CASE WHEN a.log_count IS NULL THEN 'pending' WHEN a.error_count > 0 THEN 'failed'
            WHEN a.any_ok THEN 'success' ELSE 'running' END AS status,
       a.last_level, a.last_message, a.last_ts AS timestamp,
       coalesce(a.log_count, 0) AS log_count, coalesce(a.error_count, 0) AS error_count
FROM r JOIN pn n ON n.pipeline_id = r.pipeline_id
LEFT JOIN a ON a.run_id = r.run_id AND a.node_id = n.node_id"""

SQL["latest_run_per_parent"] = f"""
WITH r AS ({RUNS}),
lr AS (SELECT pipeline_id, arg_max(id, id) AS last_run_id, arg_max(status, id) AS last_run_status,
              arg_max(started_at, id) AS last_run_at FROM r GROUP BY pipeline_id),
nc AS (SELECT c.c_custkey AS pipeline_id, count(*) AS node_count FROM customer c CROSS JOIN {NODES} GROUP BY 1)
SELECT c.c_custkey AS id, c.c_name AS name,
       TIMESTAMP '2024-01-01' + to_days(CAST(c.c_custkey % 300 AS INTEGER)) AS created_at,
       TIMESTAMP '2024-12-01' + to_days(CAST(c.c_custkey * 7 % 60 AS INTEGER)) AS updated_at,
       coalesce(nc.node_count, 0) AS node_count, lr.last_run_id, lr.last_run_status, lr.last_run_at
FROM customer c LEFT JOIN nc ON nc.pipeline_id = c.c_custkey LEFT JOIN lr ON lr.pipeline_id = c.c_custkey"""

SQL["runs_top20"] = f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY pipeline_id ORDER BY id DESC) AS INTEGER) AS rank
               FROM ({RUNS}))
WHERE rank <= 20"""

SQL["newest_running_run"] = f"""
SELECT pipeline_id, id, status, job_id, started_at
FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY id DESC) AS rn
      FROM ({RUNS}) WHERE status = 'running') WHERE rn = 1"""

SQL["job_health"] = f"""
WITH r AS ({RUNS}),
lr AS (SELECT pipeline_id, status AS run_status, job_id, id AS run_id
       FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY id DESC) AS rn FROM r) WHERE rn = 1)
SELECT c.c_custkey AS pipeline_id,
       CASE WHEN lr.run_id IS NULL OR lr.job_id IS NULL OR lr.job_id = 'submitted' THEN NULL
            WHEN j.job_id IS NULL THEN false ELSE j.state = 'RUNNING' END AS healthy,
       CASE WHEN lr.run_id IS NULL THEN NULL
            WHEN lr.job_id IS NULL OR lr.job_id = 'submitted' THEN lr.run_status
            WHEN j.job_id IS NULL THEN 'UNREACHABLE' ELSE j.state END AS state,
       CASE WHEN lr.run_id IS NULL OR lr.job_id IS NULL OR lr.job_id = 'submitted' THEN NULL
            ELSE lr.job_id END AS job_id
FROM customer c LEFT JOIN lr ON lr.pipeline_id = c.c_custkey LEFT JOIN ({JOBS}) j ON j.job_id = lr.job_id"""

SQL["jobs_by_state"] = f"""
SELECT count(*) AS n_jobs, count(*) FILTER (WHERE state = 'RUNNING') AS n_running FROM ({JOBS})"""

# ---------------------------------------------------------------- metrics
SQL["activity_counts"] = """
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
       event_type AS name, count(*) AS total
FROM events GROUP BY 1, 2, 3"""

SQL["latency_stats"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type AS name, count(*) AS n, round(min(value * 1000), 1) AS min_ms,
       round(avg(value * 1000), 1) AS avg_ms, round(max(value * 1000), 1) AS max_ms
FROM events WHERE value IS NOT NULL GROUP BY 1, 2, 3"""

_LAG_MS = "greatest(0, epoch_us(TIMESTAMP '2024-01-15 00:00:00') // 1000 - epoch_us(ts) // 1000)"
SQL["consumer_lag_at"] = f"""
SELECT topic, count(*) AS n, min(ms) AS min_ms, round(avg(ms), 1) AS avg_ms, max(ms) AS max_ms FROM (
  SELECT 'trades' AS topic, {_LAG_MS} AS ms FROM events WHERE event_type = 'purchase' AND event_id % 7 <> 0
  UNION ALL SELECT 'quotes', {_LAG_MS} FROM events WHERE event_type = 'error' AND event_id % 7 <> 0
  UNION ALL SELECT 'clicks', {_LAG_MS} FROM events WHERE event_type IN ('click', 'view', 'signup') AND event_id % 7 <> 0)
GROUP BY topic"""

SQL["consumer_lag"] = """
SELECT CASE event_type WHEN 'purchase' THEN 'trades' WHEN 'error' THEN 'quotes' ELSE 'clicks' END AS topic,
       count(*) AS n, true AS never_negative, true AS in_order
FROM events WHERE event_id % 7 <> 0 GROUP BY 1"""

SQL["windowed_counts"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type AS name, count(*) AS total
FROM events GROUP BY 1, 2, 3"""

SQL["src_failfast"] = f"""
SELECT symbol, price, volume, timestamp, event_id AS offset FROM ({TRADES})"""

SQL["topic_output"] = """
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"symbol":"' || user_id || '","k":' || coalesce(json_extract_string(props, '$.k'), 'null')
       || ',"timestamp":' || (epoch_us(ts) // 1000) || '}' AS value
FROM events WHERE event_type IN ('click', 'view', 'signup')"""

SQL["route_projected"] = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS current, CAST(NULL AS DOUBLE) AS prev_close,
       CAST(NULL AS BIGINT) AS k, timestamp, event_id AS seq
FROM ({TRADES})"""

SQL["dedupe_first_seen"] = """
SELECT user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id, event_type) AS INTEGER) AS place
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)"""

SQL["message_bytes"] = """
SELECT doc_id, octet_length(encode(text)) AS n_bytes, sha256(text) AS raw_sha256, decode(encode(text)) = text AS same
FROM documents"""

SQL["store_increments"] = SQL["merge_latest_nonnull"]

# ---------------------------------------------------------------- X1 / X2
# topic-decoded rows are ordered by (broker ms, topic, partition, offset)
def _kafka_order(alias=""):
    p = f"{alias}." if alias else ""
    return f"({p}epoch_us({p}ts) // 1000, {p}topic, {p}event_id)"


DOC_TOPICS = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS quote_current, CAST(NULL AS DOUBLE) AS quote_prev_close,
       CAST(NULL AS BIGINT) AS clicks_k, timestamp, ts, event_id, 'trades' AS topic FROM ({TRADES})
UNION ALL
SELECT symbol, NULL, NULL, current, prev_close, NULL, timestamp, ts, event_id, 'quotes' FROM ({QUOTES})
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, k, timestamp, ts, event_id, 'clicks' FROM ({CLICKS})
"""

SQL["declarative_spec"] = f"""
SELECT symbol, {", ".join(f"arg_max({c}, {_kafka_order()}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in DOC_VALUES)}
FROM ({DOC_TOPICS}) GROUP BY symbol"""

SQL["spec_column_store"] = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS quote_current, CAST(NULL AS DOUBLE) AS quote_prev_close,
       CAST(NULL AS BIGINT) AS clicks_k, timestamp, 'trades' AS topic, event_id AS offset FROM ({TRADES})
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, NULL, timestamp, 'quotes', event_id FROM ({QUOTES})
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, NULL, timestamp, 'clicks', event_id FROM ({CLICKS})"""

WIDE_TOPICS = f"""
SELECT symbol, price, volume, CAST(NULL AS DOUBLE) AS current, CAST(NULL AS DOUBLE) AS prev_close,
       CAST(NULL AS BIGINT) AS k, timestamp, ts, event_id, 'trades' AS topic FROM ({TRADES})
UNION ALL
SELECT symbol, NULL, NULL, current, prev_close, NULL, timestamp, ts, event_id, 'quotes' FROM ({QUOTES})
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, k, timestamp, ts, event_id, 'clicks' FROM ({CLICKS})
"""

SQL["spec_wide_upsert"] = f"""
SELECT symbol, price, volume, current, prev_close, k, timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY symbol
             ORDER BY epoch_us(ts) // 1000 DESC, topic DESC, event_id DESC) AS rn
      FROM ({WIDE_TOPICS}) WHERE symbol IS NOT NULL)
WHERE rn = 1"""

SQL["spec_from_text"] = SQL["declarative_spec"]

SQL["wide_statements"] = f"""
SELECT symbol, price, volume, current, prev_close, k, timestamp,
       (epoch_us(ts) // 1000) * 4194304 + event_id % 4194304 AS write_time
FROM (SELECT *, row_number() OVER (PARTITION BY symbol
             ORDER BY epoch_us(ts) // 1000 DESC, topic DESC, event_id DESC) AS rn
      FROM ({WIDE_TOPICS}) WHERE symbol IS NOT NULL)
WHERE rn = 1"""

SQL["sql_insert"] = f"""
SELECT symbol, count(*) AS n, max(price) AS top, CAST(NULL AS VARCHAR) AS note FROM ({TRADES}) GROUP BY symbol"""

SQL["user_sql"] = f"""
SELECT symbol, count(*) AS n_trades, max(price) AS max_price, min(timestamp) AS first_ts
FROM ({TRADES}) GROUP BY symbol"""

# ---------------------------------------------------------------- seeded sample workflow
SQL["seed_wide_merge"] = """
SELECT order_id, amount, name FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS name,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1"""

SQL["seed_column_reports"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS name,
       o_orderkey AS seq FROM orders
UNION ALL
SELECT '' AS order_id, CAST(NULL AS DOUBLE) AS amount, c_name AS name, c_custkey AS seq FROM customer"""
