"""DuckDB oracle SQL for the registered queries (same tables, same
arithmetic as ``larkspur.sources.records``; one statement each)."""

from __future__ import annotations

# Shared derivation of the log stand-in from ``events``.
_BASE = """
ev AS (
  SELECT event_id, user_id, event_type, props,
         epoch_us(ts) // 1000 AS ts_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
lg AS (
  SELECT event_id AS rec_id, CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new_raw,
         ts_ms, k,
         ts_ms + ((event_id * 7919) % 97) * 600000 AS arrival_ms,
         strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS day,
         event_type = 'signup' AS is_start,
         CASE WHEN event_type <> 'signup' THEN event_type END AS page_id,
         CASE WHEN event_type IN ('signup', 'view') THEN NULL
              WHEN event_type = 'click' AND k % 20 = 0 THEN ''
              ELSE 'home' END AS last_page_id,
         event_type NOT IN ('signup', 'view') AS has_last_page,
         event_type = 'view' AS uv_entry,
         event_type = 'view' OR (event_type = 'click' AND k % 20 = 0) AS bounce_entry,
         CASE WHEN event_type <> 'signup' THEN k % 4 ELSE 0 END AS n_disp
  FROM ev),
rp AS (
  SELECT *, CASE WHEN is_new_raw = '1'
                  AND row_number() OVER (PARTITION BY mid, is_new_raw ORDER BY rec_id) > 1
                 THEN '0' ELSE is_new_raw END AS is_new
  FROM lg),
pg AS (SELECT * FROM lg WHERE NOT is_start),
li AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_type = 'error' THEN 'fail' ELSE event_type END AS event_type,
         ts_ms AS "timestamp", event_id AS seq
  FROM ev)
"""


def _with(body: str) -> str:
    """Prefix the shared CTEs; ``body`` may start with more CTEs (``name AS (``)."""
    b = body.strip()
    head = b.split("(", 1)[0].split()
    more_ctes = len(head) == 2 and head[1].upper() == "AS"
    return "WITH " + _BASE.strip() + (",\n" if more_ctes else "\n") + b


_BOUNCE = """
x AS (
  SELECT *, lead(ts_ms) OVER w AS next_ts, lead(bounce_entry) OVER w AS next_entry
  FROM pg WINDOW w AS (PARTITION BY mid ORDER BY ts_ms, rec_id)),
b AS (
  SELECT mid, rec_id, ts_ms, page_id,
         CASE WHEN next_entry AND next_ts - ts_ms < 14400000 THEN 'matched' ELSE 'timeout' END AS kind,
         next_ts
  FROM x
  WHERE bounce_entry AND (next_ts IS NULL OR next_entry OR next_ts - ts_ms >= 14400000))
"""

_FAIL3 = """
x AS (
  SELECT *, lead(event_type, 1) OVER w AS e2, lead(event_type, 2) OVER w AS e3,
            lead("timestamp", 1) OVER w AS t2, lead("timestamp", 2) OVER w AS t3
  FROM li WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", seq)),
m AS (SELECT user_id, seq, "timestamp" AS t1, t2, t3 FROM x
      WHERE event_type = 'fail' AND e2 = 'fail' AND e3 = 'fail')
"""

SQL: dict[str, str] = {
    "json_dirty_split": _with("""
SELECT 'log' AS source, event_id AS rec_id,
       CASE WHEN event_id % 10 = 0 THEN 'dirty' ELSE 'main' END AS stream
FROM events
UNION ALL
SELECT 'doc', doc_id,
       CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT'
             AND try(json_extract_string(text, '$.common.mid')) IS NOT NULL
             AND try(CAST(json_extract(text, '$.ts') AS BIGINT)) IS NOT NULL
            THEN 'main' ELSE 'dirty' END
FROM documents"""),
    "json_extract_paths": _with("""
SELECT rec_id, mid, is_new_raw AS is_new, ts_ms, is_start, page_id, last_page_id, has_last_page FROM lg"""),
    "is_new_repair": _with("SELECT rec_id, mid, is_new_raw, is_new FROM rp"),
    "start_log": _with("""
SELECT rec_id, mid, is_new, ts_ms, k % 5 = 0 AS start_is_null FROM rp WHERE is_start"""),
    "page_log": _with("""
SELECT rec_id, mid, is_new, ts_ms, page_id, last_page_id, CAST(n_disp AS BIGINT) AS n_displays
FROM rp WHERE NOT is_start"""),
    "displays_explode": _with("""
SELECT page_id, CAST(rec_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS item, CAST(i AS BIGINT) AS pos,
       '{"item":"' || CAST(rec_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '","page_id":"' || page_id
         || '","pos":' || CAST(i AS VARCHAR) || '}' AS value
FROM (SELECT rec_id, page_id, unnest(range(1, n_disp + 1)) AS i FROM pg WHERE n_disp > 0)"""),
    "log_split_counts": _with("""
SELECT 'start' AS stream, count(*) AS n FROM lg WHERE is_start
UNION ALL SELECT 'page', count(*) FROM lg WHERE NOT is_start
UNION ALL SELECT 'display', CAST(sum(n_disp) AS BIGINT) FROM lg WHERE NOT is_start"""),
    "json_set_field": _with("""
SELECT rec_id,
  '{"common":{"is_new":"' || is_new || '","mid":"' || mid || '"}'
  || CASE WHEN n_disp > 0 THEN ',"displays":[' || array_to_string(list_transform(range(1, n_disp + 1),
       lambda i: '{"item":"' || CAST(rec_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '","pos":'
            || CAST(i AS VARCHAR) || '}'), ',') || ']' ELSE '' END
  || ',"page":{' || CASE WHEN last_page_id IS NOT NULL THEN '"last_page_id":"' || last_page_id || '",'
                         ELSE '' END
  || '"page_id":"' || page_id || '"},"ts":' || CAST(ts_ms AS VARCHAR) || '}' AS value
FROM rp WHERE NOT is_start"""),
    "unique_visit": _with("""
SELECT mid, day, rec_id, ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, day ORDER BY arrival_ms, rec_id) AS rn
  FROM pg WHERE uv_entry) WHERE rn = 1"""),
    "unique_visit_exact": _with("""
SELECT mid, day, rec_id, ts_ms FROM (
  SELECT *, lag(day) OVER (PARTITION BY mid ORDER BY arrival_ms, rec_id) AS prev_day
  FROM pg WHERE uv_entry) WHERE prev_day IS NULL OR prev_day <> day"""),
    "bounce_all": _with(_BOUNCE + "SELECT * FROM b"),
    "bounce_matched": _with(_BOUNCE + "SELECT * FROM b WHERE kind = 'matched'"),
    "bounce_timeout": _with(_BOUNCE + "SELECT * FROM b WHERE kind = 'timeout'"),
    "bounce_branches_union": _with(_BOUNCE + """
SELECT * FROM b WHERE kind = 'matched' UNION ALL SELECT * FROM b WHERE kind = 'timeout'"""),
    "union_overlapping": _with("""
SELECT user_id, event_type, seq FROM li WHERE event_type = 'fail'
UNION ALL
SELECT mid, CASE WHEN page_id = 'error' THEN 'fail' ELSE page_id END, rec_id FROM pg WHERE is_new_raw = '1'"""),
    "login_fail_alert": _with(_FAIL3 + """
SELECT user_id, t1, t2, t3,
       user_id || ' failed to log in 3 times in a row at: ' || CAST(t1 AS VARCHAR) || ', '
         || CAST(t2 AS VARCHAR) || ', ' || CAST(t3 AS VARCHAR) AS alert
FROM m"""),
    "strict_times_n": _with(_FAIL3 + """
SELECT user_id, seq AS first_seq, t1 AS first_ts, t3 AS last_ts,
       CAST(t1 AS VARCHAR) || ',' || CAST(t2 AS VARCHAR) || ',' || CAST(t3 AS VARCHAR) AS ts_list
FROM m"""),
    "strict_runs": _with("""
x AS (SELECT *, event_type = 'fail' AS c,
             lag(event_type = 'fail') OVER (PARTITION BY user_id ORDER BY "timestamp", seq) AS pc FROM li),
y AS (SELECT *, sum(CASE WHEN c AND NOT coalesce(pc, false) THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY "timestamp", seq
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM x)
SELECT user_id, min("timestamp") AS run_start_ts, max("timestamp") AS run_end_ts, count(*) AS run_len
FROM y WHERE c GROUP BY user_id, run"""),
    "epoch_to_day": _with("SELECT event_id, ts_ms, strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS day FROM ev"),
    "epoch_to_day_zone": _with("""
SELECT event_id, strftime(epoch_ms(ts_ms + 28800000), '%Y-%m-%d') AS day,
       strftime(epoch_ms(ts_ms + 28800000), '%Y-%m-%d %I:%M:%S') AS event_time FROM ev"""),
    "format_event_time": _with("""
SELECT event_id, strftime(epoch_ms(ts_ms), '%Y-%m-%d %I:%M:%S') || ':' || lpad(CAST(ts_ms % 1000 AS VARCHAR), 3, '0')
         AS event_time,
       strftime(epoch_ms(ts_ms), '%Y-%m-%d %I:%M:%S') AS event_time_s
FROM ev"""),
    "csv_parse": _with("""
SELECT event_id AS seq, event_type AS name, k AS score, ts_ms AS epoch_ms FROM ev"""),
}


# ------------------------------------------------------------ CDC / routing
def _sql_lit(v):
    return "NULL" if v is None else ("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v))


def _snapshot_values() -> str:
    from larkspur.sources.records import CONFIG_SNAPSHOT
    return ",\n    ".join("(" + ", ".join(_sql_lit(v) for v in row) + ")" for row in CONFIG_SNAPSHOT)


_CDC = """
cdc AS (
  SELECT 'orders' AS "table", o_orderkey * 10 AS seq,
         CASE o_orderstatus WHEN 'F' THEN 'create' WHEN 'O' THEN 'update' ELSE 'delete' END AS operation,
         'shop' AS dbname,
         CASE WHEN o_orderstatus = 'P' THEN [] ELSE [
           {'k': 'o_custkey', 'v': CAST(o_custkey AS VARCHAR), 's': CAST(o_custkey AS VARCHAR)},
           {'k': 'o_orderdate', 'v': '"' || strftime(o_orderdate, '%Y-%m-%d') || '"',
            's': strftime(o_orderdate, '%Y-%m-%d')},
           {'k': 'o_orderkey', 'v': CAST(o_orderkey AS VARCHAR), 's': CAST(o_orderkey AS VARCHAR)},
           {'k': 'o_orderpriority', 'v': '"' || o_orderpriority || '"', 's': o_orderpriority},
           {'k': 'o_orderstatus', 'v': '"' || o_orderstatus || '"', 's': o_orderstatus},
           {'k': 'o_totalprice', 'v': '"' || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) || '"',
            's': CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR)}] END AS kv,
         o_orderkey AS okey,
         CAST(NULL AS TIMESTAMP) AS l_shipdate, CAST(NULL AS INTEGER) AS l_linenumber,
         CAST(NULL AS BIGINT) AS l_partkey, CAST(NULL AS BIGINT) AS l_suppkey,
         CAST(NULL AS DOUBLE) AS l_extendedprice
  FROM orders
  UNION ALL
  SELECT 'lineitem', l_orderkey * 10 + 1, CASE WHEN l_linenumber = 1 THEN 'create' ELSE 'update' END, 'shop',
         [{'k': 'l_extendedprice', 'v': '"' || CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) || '"',
           's': CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)},
          {'k': 'l_linenumber', 'v': CAST(l_linenumber AS VARCHAR), 's': CAST(l_linenumber AS VARCHAR)},
          {'k': 'l_orderkey', 'v': CAST(l_orderkey AS VARCHAR), 's': CAST(l_orderkey AS VARCHAR)},
          {'k': 'l_partkey', 'v': CAST(l_partkey AS VARCHAR), 's': CAST(l_partkey AS VARCHAR)},
          {'k': 'l_quantity', 'v': '"' || CAST(CAST(l_quantity AS DECIMAL(16,2)) AS VARCHAR) || '"',
           's': CAST(CAST(l_quantity AS DECIMAL(16,2)) AS VARCHAR)},
          {'k': 'l_returnflag', 'v': '"' || l_returnflag || '"', 's': l_returnflag},
          {'k': 'l_shipdate', 'v': '"' || strftime(l_shipdate, '%Y-%m-%d') || '"',
           's': strftime(l_shipdate, '%Y-%m-%d')},
          {'k': 'l_suppkey', 'v': CAST(l_suppkey AS VARCHAR), 's': CAST(l_suppkey AS VARCHAR)}],
         l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem),
cfg AS (
  SELECT seq, type, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend,
         true AS accepted
  FROM (VALUES
    __SNAPSHOT__
  ) t(seq, type, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend)
  UNION ALL
  SELECT o_orderkey * 10 + 5,
         CASE WHEN o_orderkey % 500 = 400 THEN 'delete' ELSE 'update' END,
         CASE WHEN o_orderkey % 500 = 400 THEN NULL ELSE 'orders' END,
         CASE WHEN o_orderkey % 500 = 250 THEN 'update' WHEN o_orderkey % 500 = 400 THEN NULL
              WHEN o_orderkey % 2000 = 1000 THEN 'create' WHEN o_orderkey % 3000 = 1500 THEN 'delete'
              ELSE 'update' END,
         CASE WHEN o_orderkey % 500 = 400 THEN NULL
              WHEN o_orderkey % 500 <> 250 AND o_orderkey % 2000 <> 1000 AND o_orderkey % 3000 = 1500
               AND (o_orderkey // 3000) % 2 = 1 THEN 'clickhouse'
              ELSE 'kafka' END,
         CASE WHEN o_orderkey % 500 = 250 THEN 'dwd_order_update' WHEN o_orderkey % 500 = 400 THEN NULL
              WHEN o_orderkey % 2000 = 1000 THEN 'dwd_order_create'
              WHEN o_orderkey % 3000 = 1500 THEN 'dwd_order_delete' ELSE 'dwd_order_bad' END,
         CASE WHEN o_orderkey % 500 = 250 THEN
                CASE (o_orderkey // 500) % 3 WHEN 0 THEN 'o_orderkey,o_orderstatus'
                     WHEN 1 THEN 'o_orderkey,o_orderstatus,o_orderpriority' ELSE 'o_orderkey, o_orderstatus' END
              WHEN o_orderkey % 500 = 400 THEN NULL
              WHEN o_orderkey % 2000 = 1000 THEN 'o_orderkey,o_custkey'
              WHEN o_orderkey % 3000 = 1500 THEN 'o_orderkey,o_orderstatus' ELSE 'o_orderkey' END,
         CASE WHEN o_orderkey % 500 = 400 THEN NULL ELSE 'o_orderkey' END,
         CAST(NULL AS VARCHAR),
         NOT (o_orderkey % 500 = 400 OR (o_orderkey % 5000 = 4999 AND o_orderkey % 500 NOT IN (250, 400)
              AND o_orderkey % 2000 <> 1000 AND o_orderkey % 3000 <> 1500))
  FROM orders
  WHERE o_orderkey % 500 IN (250, 400) OR o_orderkey % 2000 = 1000 OR o_orderkey % 3000 = 1500
     OR o_orderkey % 5000 = 4999),
ver AS (SELECT * FROM cfg WHERE accepted),
lat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY seq DESC) AS rn
                       FROM ver) WHERE rn = 1),
rl AS (
  SELECT c.*, l.sink_type, l.sink_table, l.sink_pk, l.seq AS cfg_seq,
         list_filter(c.kv, lambda p: list_contains(string_split(l.sink_columns, ','), p.k)) AS pkv
  FROM cdc c JOIN lat l ON c."table" = l.source_table AND c.operation = l.operate_type),
ra AS (
  SELECT c.*, v.sink_type, v.sink_table, v.sink_pk, v.seq AS cfg_seq,
         list_filter(c.kv, lambda p: list_contains(string_split(v.sink_columns, ','), p.k)) AS pkv
  FROM cdc c ASOF JOIN ver v
    ON c."table" = v.source_table AND c.operation = v.operate_type AND c.seq > v.seq)
""".replace("__SNAPSHOT__", _snapshot_values())


# Orders that change while their snapshot is read in chunks (records.order_state_changes, order_snapshot_chunks).
_HAND = """
ch AS (
  SELECT CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_orderkey END AS key,
         (l_orderkey * 10 + l_linenumber + CASE WHEN l_suppkey % 4 = 0 THEN 20000 ELSE 0 END) * 1000000
           + (l_partkey * 1000 + l_suppkey) % 1000000 AS seq,
         CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op,
         'part ' || CAST(l_partkey AS VARCHAR) || ' of ' || CAST(l_suppkey AS VARCHAR) AS state
  FROM lineitem),
base AS (SELECT o_orderkey AS key, o_orderstatus AS state FROM orders),
seen AS (SELECT key, arg_max(struct_pack(op := op, state := state), (seq, state, op)) AS l FROM ch
         WHERE seq <= (key // 500 * 5000 + 2000) * 1000000 GROUP BY key),
snap AS (SELECT coalesce(b.key, s.key) AS key, coalesce(b.key, s.key) // 500 * 5000 * 1000000 AS low,
                (coalesce(b.key, s.key) // 500 * 5000 + 5000) * 1000000 AS high, coalesce(s.l.state, b.state) AS state
         FROM base b FULL JOIN seen s ON s.key = b.key WHERE s.key IS NULL OR s.l.op <> 'd')
"""


def _json_of(kv: str) -> str:
    return f"""'{{' || array_to_string(list_transform({kv}, lambda p: '"' || p.k || '":' || p.v), ',') || '}}'"""


def _keys_of(kv: str) -> str:
    return f"array_to_string(list_transform({kv}, lambda p: p.k), ',')"


def _dim_col(c: str) -> str:
    return f"list_filter(pkv, lambda p: p.k = '{c}')[1].s AS {c}"


_WITHIN = """
nx AS (
  SELECT user_id, seq, "timestamp" AS t, event_type = 'fail' AS c,
         lead("timestamp", 1) OVER w AS t2, lead(event_type = 'fail', 1) OVER w AS c2,
         lead("timestamp", 2) OVER w AS t3, lead(event_type = 'fail', 2) OVER w AS c3
  FROM li WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", seq)),
pm AS (
  SELECT user_id, seq, t, t2, t3,
         CASE WHEN t2 IS NULL OR t2 - t >= 129600000 THEN 1 WHEN NOT c2 THEN 0
              WHEN t3 IS NULL OR t3 - t >= 129600000 THEN 2 WHEN NOT c3 THEN 0 ELSE 3 END AS n
  FROM nx WHERE c)
SELECT user_id, seq AS first_seq, CAST(n AS BIGINT) AS length,
       CAST(t AS VARCHAR) || CASE WHEN n > 1 THEN ',' || CAST(t2 AS VARCHAR) ELSE '' END
         || CASE WHEN n > 2 THEN ',' || CAST(t3 AS VARCHAR) ELSE '' END AS ts_list FROM pm WHERE """
SQL.update({"strict_times_within": _with(_WITHIN + "n = 3"), "strict_times_timeout": _with(_WITHIN + "n IN (1, 2)")})

SQL.update({
    "cdc_normalize": _with(_CDC + f"""
SELECT "table", seq, operation, dbname, CAST(len(kv) AS BIGINT) AS n_keys, {_json_of('kv')} AS data_json FROM cdc"""),
    "cdc_topic_split": _with(_CDC + """
SELECT o_orderkey * 10 AS seq, 'shop_' || CAST(o_custkey % 7 AS VARCHAR) AS db, 'orders_' || lower(o_orderstatus) AS tbl FROM orders
UNION ALL
SELECT l_orderkey * 10 + 1, 'shop_' || CAST(l_suppkey % 7 AS VARCHAR), 'lineitem_' || lower(l_returnflag) FROM lineitem"""),
    "cdc_dirty_split": """
SELECT o_orderkey * 10 AS seq, CASE o_orderkey % 10 WHEN 0 THEN 'bad_text' WHEN 3 THEN 'unknown_op' WHEN 7 THEN 'no_op'
  ELSE 'main' END AS stream FROM orders""",
    "cdc_snapshot": """
SELECT 'snapshot.shop.customer' AS topic, 'read' AS operation, 'shop' AS dbname, 'customer' AS "table",
       '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name
       || '","c_nationkey":' || CAST(c_nationkey AS VARCHAR) || '}' AS data_json FROM customer""",
    "cdc_handover": _with(_HAND + """
SELECT key, seq AS pos, op, state FROM ch
UNION ALL
SELECT key, low, 'r', state FROM snap WHERE NOT EXISTS (
  SELECT 1 FROM ch WHERE ch.key = snap.key AND ch.seq > snap.low AND ch.seq <= snap.high)"""),
    # the truth that the handover must reach: the last change of all, or the order as it was
    "cdc_handover_state": _with(_HAND + """,
fin AS (SELECT key, arg_max(struct_pack(op := op, state := state), (seq, state, op)) AS l FROM ch GROUP BY key)
SELECT coalesce(b.key, fin.key) AS key, coalesce(fin.l.state, b.state) AS state
FROM base b FULL JOIN fin ON fin.key = b.key WHERE fin.key IS NULL OR fin.l.op <> 'd'"""),
    "change_feed_tables": """
SELECT l_orderkey * 10 + 1 AS seq, 'dbserver.shop.lineitem' AS topic FROM lineitem""",
    "filter_has_data": _with("""
SELECT o_orderkey AS seq,
       CASE o_orderstatus WHEN 'F' THEN 'create' WHEN 'O' THEN 'update' ELSE 'delete' END AS operation,
       o_orderstatus AS status
FROM orders WHERE o_orderkey % 50 <> 0"""),
    "src_from_timestamp": _with("""
SELECT event_id, ts_ms FROM ev WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""".replace(
        "FROM ev WHERE ts", "FROM (SELECT ev.*, e.ts FROM ev JOIN events e USING (event_id)) WHERE ts")),
    "decode_config": _with(_CDC + """
SELECT seq, type, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend, accepted
FROM cfg"""),
    "config_latest": _with(_CDC + """
SELECT source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend, seq FROM lat"""),
    "config_ddl_text": _with(_CDC + """
SELECT seq, sink_table,
       'create table if not exists DIM.' || sink_table || '(' ||
       array_to_string(list_transform(string_split(sink_columns, ','),
         lambda f: f || CASE WHEN f = coalesce(sink_pk, 'id') THEN ' varchar primary key' ELSE ' varchar' END), ',')
       || ')' || coalesce(sink_extend, '') AS ddl
FROM ver WHERE sink_type = 'hbase'
UNION ALL
SELECT c_custkey * 10 + 7, 'dim_tenant_' || CAST(c_custkey AS VARCHAR),
       'create table if not exists DIM.dim_tenant_' || CAST(c_custkey AS VARCHAR) ||
       CASE c_nationkey % 3 WHEN 0 THEN '(id varchar primary key,name varchar)'
            WHEN 1 THEN '(code varchar primary key,name varchar,segment varchar)'
            ELSE '(name varchar,id varchar primary key,balance varchar) SALT_BUCKETS = ' || CAST(c_custkey % 8 + 1 AS VARCHAR) END
FROM customer"""),
    "route_latest": _with(_CDC + f"""
SELECT "table", seq, operation, sink_type, sink_table, {_keys_of('pkv')} AS kept_keys, {_json_of('pkv')} AS data_json
FROM rl WHERE sink_type IN ('kafka', 'hbase')"""),
    "route_asof": _with(_CDC + f"""
SELECT "table", seq, operation, sink_type, sink_table, cfg_seq, {_keys_of('pkv')} AS kept_keys,
       {_json_of('pkv')} AS data_json
FROM ra WHERE sink_type IN ('kafka', 'hbase')"""),
    "route_sink_split": _with(_CDC + """
SELECT CASE WHEN sink_type = 'kafka' THEN 'main' ELSE 'side' END AS stream, sink_type, sink_table, count(*) AS n
FROM rl WHERE sink_type IN ('kafka', 'hbase') GROUP BY ALL"""),
    "route_topic_value": _with(_CDC + f"""
SELECT sink_table AS topic, {_json_of('pkv')} AS value FROM rl WHERE sink_type = 'kafka'"""),
    "dim_upsert_latest": _with(_CDC + """,
d AS (
  SELECT *, list_filter(pkv, lambda p: p.k = coalesce(sink_pk, 'id'))[1].s AS pk,
         row_number() OVER (PARTITION BY sink_table, list_filter(pkv, lambda p: p.k = coalesce(sink_pk, 'id'))[1].s
                            ORDER BY seq DESC, l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
                                     l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM rl WHERE sink_type = 'hbase' AND len(pkv) > 0)
SELECT sink_table, pk, """ + ", ".join(_dim_col(c) for c in
                                     "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_shipdate".split(","))
    + " FROM d WHERE rn = 1"),
    "map_prune_columns": _with(_CDC + """,
p AS (SELECT "table", seq, list_filter(kv, lambda p: list_contains(string_split(
        CASE okey % 3 WHEN 0 THEN 'o_orderkey,o_custkey,l_orderkey,l_partkey'
             WHEN 1 THEN 'o_orderkey, o_custkey,l_quantity, l_partkey'
             ELSE 'o_totalprice,o_orderstatus,missing,l_shipdate,l_returnflag' END, ','), p.k)) AS pkv
      FROM cdc)
SELECT "table", seq, array_to_string(list_transform(pkv, lambda p: p.k), ',') AS kept_keys, CAST(len(pkv) AS BIGINT) AS n_keys
FROM p"""),
    "json_strict_parse": _with("SELECT rec_id, mid, page_id, ts_ms FROM lg"),
    "json_round_trip": _with("""
SELECT rec_id,
  '{"common":{"ch":"web","is_new":"' || is_new_raw || '","mid":"' || mid || '"}'
  || CASE WHEN k % 4 > 0 THEN ',"displays":[' || array_to_string(list_transform(range(1, k % 4 + 1),
       lambda i: '{"item":"' || CAST(rec_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '","pos":'
            || CAST(i AS VARCHAR) || '}'), ',') || ']' ELSE '' END
  || CASE WHEN is_start THEN ',"start":' || CASE WHEN k % 5 = 0 THEN 'null'
            ELSE '{"entry":"icon","loading_time":' || CAST(k * 10 AS VARCHAR) || '}' END
     ELSE ',"page":{' || CASE WHEN last_page_id IS NOT NULL THEN '"last_page_id":"' || last_page_id || '",'
                         ELSE '' END || '"page_id":"' || page_id || '"}' END
  || ',"ts":' || CAST(ts_ms AS VARCHAR) || '}' AS value
FROM lg"""),
    "json_object_keys": _with("""
SELECT rec_id, 'common,' || CASE WHEN is_start THEN 'start' ELSE 'page' END
       || CASE WHEN k % 4 > 0 THEN ',displays' ELSE '' END || ',ts' AS keys
FROM lg"""),
})


# ------------------------------------------------------------------ windows
_SC = """
sc AS (SELECT event_id AS seq, event_type AS name, k AS score, ts_ms,
              ts_ms + ((event_id * 7919) % 97) * 600000 AS arrival_ms,
              (ts_ms // 86400000) * 86400000 AS wstart FROM ev),
cl AS (
  SELECT *, CASE WHEN wm_before IS NULL OR wstart + 86400000 - 1 > wm_before THEN 'on_time'
                 WHEN wstart + 86400000 - 1 + 21600000 <= wm_before THEN 'late' ELSE 'refire' END AS class
  FROM (SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  - 3600000 - 1 AS wm_before FROM sc)),
ot AS (SELECT name, wstart, CAST(sum(score) AS BIGINT) AS s, count(*) AS n FROM cl WHERE class = 'on_time'
       GROUP BY name, wstart)
"""


def _fmt12(ms: str) -> str:
    return f"strftime(epoch_ms({ms}), '%Y-%m-%d %I:%M:%S')"


_SUM_LAST = """,
sl AS (SELECT name, wstart AS window_start_ms, wstart + 86400000 AS window_end_ms,
              CAST(sum(score) AS BIGINT) AS score_sum, arg_max(ts_ms, (arrival_ms, seq)) AS last_ts
       FROM sc GROUP BY name, wstart)
"""

SQL.update({
    "window_tumbling_sum": _with(_SC + """
SELECT name, wstart AS window_start_ms, wstart + 86400000 AS window_end_ms,
       CAST(sum(score) AS BIGINT) AS score_sum, count(*) AS n FROM sc GROUP BY name, wstart"""),
    "window_sliding_sum": _with(_SC + """
SELECT name, s AS window_start_ms, s + 86400000 AS window_end_ms, CAST(sum(score) AS BIGINT) AS score_sum,
       count(*) AS n
FROM (SELECT name, score, (ts_ms // 21600000 - unnest(range(0, 4))) * 21600000 AS s FROM sc)
GROUP BY name, s"""),
    "window_ingest_tumbling": _with(_SC + """
SELECT name, (arrival_ms // 86400000) * 86400000 AS window_start_ms,
       (arrival_ms // 86400000) * 86400000 + 86400000 AS window_end_ms,
       CAST(sum(score) AS BIGINT) AS score_sum, count(*) AS n FROM sc GROUP BY ALL"""),
    "window_sum_last": _with(_SC + _SUM_LAST + f"""
SELECT *, {_fmt12('last_ts')} AS last_time FROM sl"""),
    "window_bounds_text": _with(_SC + _SUM_LAST + f"""
SELECT name, window_start_ms, {_fmt12('window_start_ms')} || '-' || {_fmt12('window_end_ms')} || ',' || name
       || ',' || CAST(score_sum AS VARCHAR) || ',' || {_fmt12('last_ts')} AS text FROM sl"""),
    "watermark_per_record": _with(_SC + """
SELECT seq, m - 1 AS wm_monotone, m - 3600001 AS wm_bounded FROM (
  SELECT seq, max(ts_ms) OVER (ORDER BY arrival_ms, seq ROWS UNBOUNDED PRECEDING) AS m FROM sc)"""),
    "late_classify": _with(_SC + """
SELECT seq, name, wstart AS window_start_ms, wm_before, class FROM cl"""),
    "window_refire": _with(_SC + """
SELECT name, wstart AS window_start_ms, CAST(0 AS BIGINT) AS fire_no, s AS score_sum, n AS n_rows FROM ot
UNION ALL
SELECT r.name, r.wstart, row_number() OVER w AS fire_no,
       CAST(coalesce(o.s, 0) + sum(r.score) OVER w AS BIGINT), coalesce(o.n, 0) + count(*) OVER w
FROM cl r LEFT JOIN ot o ON r.name = o.name AND r.wstart = o.wstart
WHERE r.class = 'refire'
WINDOW w AS (PARTITION BY r.name, r.wstart ORDER BY r.arrival_ms, r.seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
})

SQL.update({
    "order_time_parts": _with("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
       epoch_us(o_orderdate) // 1000 AS create_ts FROM orders"""),
    "cdc_envelope_json": _with(_CDC + f"""
SELECT "table", seq, '{{"data":' || {_json_of('kv')} || ',"operation":"' || operation || '","dbname":"' || dbname
       || '","table":"' || "table" || '"}}' AS envelope FROM cdc"""),
})
