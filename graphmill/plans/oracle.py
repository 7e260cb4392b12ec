"""DuckDB SQL giving the same rows as each query of ``catalog.py`` (tables pre-registered as views).

Written from the operator semantics, not from the Spark plans: full outer joins for upserts, anti and
semi joins for edge checks, window functions for numbering.  Queries without an entry here are checked on
row counts only (none at present).
"""

from __future__ import annotations

A1 = "TIMESTAMP '2024-01-01 00:00:00'"
A2 = "TIMESTAMP '2024-02-01 00:00:00'"

STEP = (
    "CASE event_type WHEN 'signup' THEN 'STARTED_PROCESSING_REQUEST' WHEN 'view' THEN 'FETCHING_DATA_AND_MODELS' "
    "WHEN 'click' THEN 'PUSHED_GRAPH_ELEMENTS_INTO_NEO' WHEN 'purchase' THEN 'DONE_PROCESSING_REQUEST' "
    "WHEN 'error' THEN 'ERROR' END"
)
STATUS_LIST = (
    "('STARTED_PROCESSING_REQUEST','FETCHING_DATA_AND_MODELS','FINISHED_FETCHING_DATA_AND_MODELS',"
    "'WRITING_GRAPH_ELEMENTS_INTO_REDIS','REDIS_IS_READY_FOR_CONSUMPTION','DELETING_REDIS_KEYS',"
    "'DONE_PROCESSING_REQUEST','ERROR')"
)


def _pev(where: str = "TRUE") -> str:
    return (
        f"SELECT ts AS timestamp, event_id AS seq, 'req-' || CAST(user_id AS VARCHAR) AS request_id, {STEP} AS event_type, "
        f"props AS message FROM events WHERE {where}"
    )


def _since_start(where: str = "TRUE") -> str:
    return f"""
ev AS ({_pev(where)}),
st AS (SELECT request_id, timestamp AS s_ts, seq AS s_seq FROM (
        SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY timestamp DESC, seq DESC) AS rn
        FROM ev WHERE event_type = 'STARTED_PROCESSING_REQUEST') WHERE rn = 1),
f AS (SELECT ev.*, st.s_ts FROM ev JOIN st USING (request_id)
      WHERE ev.timestamp > st.s_ts OR (ev.timestamp = st.s_ts AND ev.seq >= st.s_seq))"""


def _request_state(where: str = "TRUE") -> str:
    return f"""
WITH {_since_start(where)},
last_status AS (SELECT request_id, event_type AS status FROM (
        SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY timestamp DESC, seq DESC) AS rn
        FROM f WHERE event_type IN {STATUS_LIST}) WHERE rn = 1),
agg AS (SELECT request_id, max(s_ts) AS s_ts,
               max(CASE WHEN event_type = 'DONE_PROCESSING_REQUEST' THEN timestamp END) AS e_ts,
               count(*) AS n_events, count(*) FILTER (WHERE event_type = 'ERROR') AS n_errors
        FROM f GROUP BY request_id)
SELECT agg.request_id, last_status.status,
       strftime(s_ts, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(e_ts, '%Y-%m-%d %H:%M:%S') AS end_time,
       CAST(floor(epoch(s_ts)) AS BIGINT) AS start_time_unix, CAST(floor(epoch(e_ts)) AS BIGINT) AS end_time_unix,
       n_events, n_errors
FROM agg LEFT JOIN last_status USING (request_id)"""


CUSTOMER_NODES = "SELECT c_custkey AS _uid, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer"

_CUSTOMER_KEYS = """
WITH k AS (
  SELECT CASE WHEN c_nationkey = 1 THEN '' ELSE c_name END || ':' ||
         CASE c_mktsegment WHEN 'BUILDING' THEN 'edges_ingest' WHEN 'AUTOMOBILE' THEN 'drop_ingest' ELSE 'nodes_ingest' END || ':' ||
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'IN_NATION,Customer,Nation' ELSE 'Customer' END ||
         CASE WHEN c_nationkey = 0 THEN ':extra' ELSE '' END AS key
  FROM customer),
p AS (SELECT key, string_split(key, ':') AS parts FROM k),
parsed AS (
  SELECT key,
         CASE WHEN len(parts) = 3 THEN parts[1] END AS job_name,
         CASE WHEN len(parts) = 3 THEN parts[2] END AS operation,
         CASE WHEN len(parts) = 3 THEN string_split(parts[3], ',') END AS args,
         CASE WHEN len(parts) <> 3 THEN 'Expected 3 parts in ' || key || ' but got ' || CAST(len(parts) AS VARCHAR)
              WHEN parts[1] = '' THEN 'Job name must not be empty ! [' || key || ']'
              WHEN parts[2] NOT IN ('nodes_ingest', 'edges_ingest') THEN 'Operation ' || parts[2] || ' is not supported.' END AS error
  FROM p)"""

_COUNTERS = f"""
WITH lo AS (SELECT * FROM customer WHERE c_acctbal < 5000),
hi AS (SELECT * FROM customer WHERE c_acctbal >= 2000),
nat AS (SELECT * FROM nation),
rows AS (
  SELECT 1 AS batch, 'NODES' AS element_type, 'Customer' AS element_properties, 'nodes_created' AS counter, (SELECT count(*) FROM lo) AS value
  UNION ALL SELECT 1, 'NODES', 'Customer', 'labels_added', (SELECT count(*) FROM lo)
  UNION ALL SELECT 1, 'NODES', 'Customer', 'properties_set', (SELECT CAST(coalesce(sum(5), 0) AS BIGINT) FROM lo)
  UNION ALL SELECT 2, 'NODES', 'Customer', 'nodes_created', (SELECT count(*) FROM hi WHERE c_custkey NOT IN (SELECT c_custkey FROM lo))
  UNION ALL SELECT 2, 'NODES', 'Customer', 'labels_added', (SELECT count(*) FROM hi WHERE c_custkey NOT IN (SELECT c_custkey FROM lo))
  UNION ALL SELECT 2, 'NODES', 'Customer', 'properties_set', (SELECT CAST(coalesce(sum(5), 0) AS BIGINT) FROM hi)
  UNION ALL SELECT 3, 'NODES', 'Nation', 'nodes_created', (SELECT count(*) FROM nat)
  UNION ALL SELECT 3, 'NODES', 'Nation', 'labels_added', (SELECT count(*) FROM nat)
  UNION ALL SELECT 3, 'NODES', 'Nation', 'properties_set', (SELECT CAST(coalesce(sum(3), 0) AS BIGINT) FROM nat)
  UNION ALL SELECT 4, 'EDGES', 'IN_NATION_Customer_Nation', 'relationships_created',
         (SELECT count(*) FROM (SELECT DISTINCT c_custkey, c_nationkey FROM lo WHERE c_nationkey IN (SELECT n_nationkey FROM nat)))
  UNION ALL SELECT 5, 'EDGES', 'IN_NATION_Customer_Nation', 'relationships_created',
         (SELECT count(*) FROM (SELECT DISTINCT c_custkey, c_nationkey FROM customer
                                WHERE c_nationkey IN (SELECT n_nationkey FROM nat) AND c_acctbal >= 5000))
)"""

_MODEL_GRAPH = """
WITH nat AS (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)"""

_STAGED_CUSTOMERS = """
WITH sc AS (SELECT 'custjob' AS job_name, 'nodes_ingest' AS operation, 'Customer_' || n_name AS arguments,
                   c_custkey AS _uid, c_name AS name, n_regionkey
            FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_REQUESTS = """
WITH r AS (
  SELECT event_id,
    CASE event_type
      WHEN 'error' THEN '{"request_id":"e' || CAST(event_id AS VARCHAR) || '"}'
      WHEN 'view' THEN '{"request_type":"nothing","request_id":"e' || CAST(event_id AS VARCHAR) || '"}'
      WHEN 'click' THEN '{"request_type":"white_list","request_id":"e' || CAST(event_id AS VARCHAR) || '"}'
      WHEN 'purchase' THEN '{"request_type":"white_list","request_id":"e' || CAST(event_id AS VARCHAR) || '","file_path":' || json_extract_string(props, '$.k') || '}'
      ELSE '{"request_type":"white_list","request_id":"e' || CAST(event_id AS VARCHAR) || '","file_path":"/lists/' || json_extract_string(props, '$.k') || '.txt"}'
    END AS request
  FROM events),
c AS (
  SELECT event_id,
    json_extract(request, '$.request_type') IS NULL AS no_type,
    json_extract(request, '$.request_id') IS NULL AS no_id,
    json_extract_string(request, '$.request_type') AS rtype,
    json_extract(request, '$.file_path') IS NULL AS no_path,
    json_type(request, '$.file_path') AS path_type
  FROM r),
pr AS (
  SELECT event_id,
    CASE WHEN no_type OR no_id THEN
           concat_ws('; ', CASE WHEN no_type THEN 'Field request_type is mandatory.' END,
                           CASE WHEN no_id THEN 'Field request_id is mandatory.' END)
         ELSE concat_ws('; ',
           CASE WHEN rtype NOT IN ('white_list') THEN 'Unsupported request type: ' || rtype || '.' END,
           CASE WHEN rtype = 'white_list' AND no_path THEN 'Field file_path is missing.' END,
           CASE WHEN rtype = 'white_list' AND NOT no_path AND path_type <> 'VARCHAR' THEN 'Field file_path must be of type str.' END)
    END AS problems
  FROM c)"""

_STREAM_WINNERS = f"""
SELECT user_id AS _uid, event_id, ts, event_type, value, {A2} AS _created,
       CASE WHEN n > 1 THEN {A2} END AS _last_updated
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
             count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE rn = 1"""


ORACLE: dict[str, str] = {
    "translate_nodes": f"""
SELECT 'req_customers:nodes_ingest:Customer' AS key, 'Customer' AS element_properties,
       c_custkey AS _uid, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer""",
    "translate_edges": """
SELECT 'req_orders:edges_ingest:PLACED,Customer,Order' AS key, 'PLACED_Customer_Order' AS element_properties,
       o_custkey AS _fromUid, o_orderkey AS _toUid, 'PLACED' AS _edgeType FROM orders""",
    "merge_nodes_create": f"""
SELECT c_custkey AS _uid, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal, c_mktsegment AS segment,
       {A1} AS _created, CAST(NULL AS TIMESTAMP) AS _last_updated FROM customer""",
    "merge_nodes_update": f"""
WITH e AS (SELECT c_custkey AS _uid, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal, c_mktsegment AS segment
           FROM customer WHERE c_acctbal < 6000),
i AS (SELECT c_custkey AS _uid, CASE WHEN c_nationkey = 0 THEN NULL ELSE c_name || '*' END AS name,
             c_acctbal + 1 AS acctbal, lower(c_mktsegment) AS tier FROM customer WHERE c_acctbal > 3000)
SELECT coalesce(i._uid, e._uid) AS _uid,
       CASE WHEN i._uid IS NOT NULL THEN i.name ELSE e.name END AS name,
       e.nation AS nation,
       CASE WHEN i._uid IS NOT NULL THEN i.acctbal ELSE e.acctbal END AS acctbal,
       e.segment AS segment, i.tier AS tier,
       CASE WHEN e._uid IS NOT NULL THEN {A1} ELSE {A2} END AS _created,
       CASE WHEN e._uid IS NOT NULL AND i._uid IS NOT NULL THEN {A2} END AS _last_updated
FROM e FULL OUTER JOIN i ON e._uid = i._uid""",
    "merge_nodes_duplicate_uid": _STREAM_WINNERS,
    "merge_edges": """
SELECT DISTINCT o_custkey AS _fromUid, o_orderkey AS _toUid, 'PLACED' AS _edgeType,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'kept' ELSE 'created' END AS action
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')""",
    "merge_edges_dedup": """
SELECT DISTINCT l_partkey AS _fromUid, l_suppkey AS _toUid, 'SUPPLIED_BY' AS _edgeType FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
    "dangling_edges": """
SELECT o.o_custkey AS _fromUid, o.o_orderkey AS _toUid, c.c_custkey IS NULL AS missing_from, o2.o_orderkey IS NULL AS missing_to
FROM orders o
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') o2 ON o.o_orderkey = o2.o_orderkey
WHERE c.c_custkey IS NULL OR o2.o_orderkey IS NULL""",
    "detach_delete_nodes": """
SELECT c_custkey AS _uid, c_name AS name, c_mktsegment AS segment FROM customer WHERE NOT coalesce(c_mktsegment = 'MACHINERY', false)""",
    "detach_delete_edges": """
SELECT 'PLACED' AS _edgeType, o_custkey AS _fromUid, o_orderkey AS _toUid FROM
  (SELECT DISTINCT o_custkey, o_orderkey FROM orders) WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
UNION ALL
SELECT 'IN_NATION', c_custkey, CAST(c_nationkey AS BIGINT) FROM customer
WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey IN (SELECT n_nationkey FROM nation)""",
    "delete_summary": """
WITH gone AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY')
SELECT 'Customer' AS label, (SELECT count(*) FROM gone) AS total,
       CAST(ceil((SELECT count(*) FROM gone) / 1000.0) AS BIGINT) AS batches,
       (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders) WHERE o_custkey IN (SELECT c_custkey FROM gone))
       + (SELECT count(*) FROM gone WHERE c_nationkey IN (SELECT n_nationkey FROM nation)) AS edges_deleted""",
    "merge_counters": _COUNTERS + "\nSELECT batch, element_type, element_properties, counter, CAST(value AS BIGINT) AS value FROM rows",
    "counter_rollup": _COUNTERS + """
SELECT 'req-counters' AS request_id, element_type || '_' || element_properties AS key, counter, CAST(sum(value) AS BIGINT) AS value
FROM rows GROUP BY ALL""",
    "count_nodes_by_label": """
SELECT 'Customer' AS label, count(*) AS n FROM customer
UNION ALL SELECT 'Nation', count(*) FROM nation WHERE n_regionkey <> 4
UNION ALL SELECT 'Order', count(*) FROM orders
UNION ALL SELECT 'Supplier', count(*) FROM supplier""",
    "count_edges_by_type": _MODEL_GRAPH + """
SELECT 'PLACED' AS edge_type, count(*) AS n FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
UNION ALL
SELECT 'IN_NATION', (SELECT count(*) FROM (SELECT DISTINCT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT * FROM nat)))
                  + (SELECT count(*) FROM (SELECT DISTINCT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT * FROM nat)))""",
    "stage_set_add": """
SELECT 'evjob' AS job_name, 'nodes_ingest' AS operation, event_type AS arguments, user_id AS _uid, event_id FROM events""",
    "publish_check": """
SELECT 'pjob' AS job_name, 'nodes_ingest' AS operation, p_brand AS arguments,
       count(*) + count(*) FILTER (WHERE p_size = 1) AS n_items, count(*) AS n_distinct,
       count(*) FILTER (WHERE p_size > 25) AS n_new,
       (count(*) FILTER (WHERE p_size > 25) = count(*) + count(*) FILTER (WHERE p_size = 1))
         OR count(*) FILTER (WHERE p_size > 25) = 0 AS ok
FROM part GROUP BY p_brand""",
    "stage_cardinality": """
SELECT 'evjob' AS job_name, 'nodes_ingest' AS operation, event_type AS arguments, count(*) AS cardinality FROM events GROUP BY event_type""",
    "parse_keys": _CUSTOMER_KEYS + """
SELECT key, job_name, operation, array_to_string(args, '|') AS arguments, CAST(len(args) AS BIGINT) AS n_arguments, error FROM parsed""",
    "order_jobs": _CUSTOMER_KEYS + """
, valid AS (SELECT job_name || ':' || operation || ':' || array_to_string(args, ',') AS key, operation FROM parsed WHERE error IS NULL)
SELECT key, row_number() OVER (ORDER BY operation <> 'nodes_ingest', lower(key), key) AS job_order FROM valid""",
    "keys_by_pattern": _CUSTOMER_KEYS + """
, valid AS (SELECT DISTINCT job_name || ':' || operation || ':' || array_to_string(args, ',') AS key FROM parsed WHERE error IS NULL)
SELECT key FROM valid WHERE key GLOB 'Customer#0000001[0-4]?:*_ingest:*'""",
    "batch_numbers": """
SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS batch_no FROM orders""",
    "key_sample": """
WITH s AS (SELECT event_type, event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"user_id":' || CAST(user_id AS VARCHAR) || '}' AS payload FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY payload) AS sample_no, count(*) OVER (PARTITION BY event_type) AS size FROM s)
SELECT 'evjob:nodes_ingest:' || event_type AS key, 'Nodes' AS type, size, sample_no, payload, event_id FROM r WHERE sample_no <= 3""",
    "row_to_json_roundtrip": """
SELECT p_partkey, p_name, p_brand, CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS p_type, p_size, p_retailprice,
       true AS roundtrip_ok, p_size > 45 AS has_null_field FROM part""",
    "multi_get": """
SELECT o_orderkey AS pos, 'Customer-' || CAST(o_custkey AS VARCHAR) AS key, c.c_name AS value
FROM orders LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) c ON o_custkey = c.c_custkey""",
    "multi_get_hash": """
WITH store AS (
  SELECT 'Part-' || CAST(p_partkey AS VARCHAR) AS key, 'name' AS field, p_name AS value FROM part WHERE p_size <= 40
  UNION ALL SELECT 'Part-' || CAST(p_partkey AS VARCHAR), 'brand', p_brand FROM part WHERE p_size <= 40
  UNION ALL SELECT 'Part-' || CAST(p_partkey AS VARCHAR), 'type', p_type FROM part WHERE p_size <= 40)
SELECT l_orderkey * 8 + l_linenumber AS pos, 'Part-' || CAST(l_partkey AS VARCHAR) AS key, store.field, store.value
FROM lineitem LEFT JOIN store ON 'Part-' || CAST(l_partkey AS VARCHAR) = store.key""",
    "keyed_overwrite": """
SELECT user_id AS _uid, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "keyed_sink": """
SELECT user_id AS _uid, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "staged_keys": """
SELECT job_name, arguments, event_id, ts FROM (
  SELECT ['01', '1', '20240201'][user_id % 3 + 1] AS job_name, CASE event_type WHEN 'view' THEN '' ELSE event_type END AS arguments, event_id, ts FROM events)
WHERE NOT (job_name = '1' AND arguments = '') AND NOT (job_name = '01' AND arguments = 'click')""",
    "fan_out_outcomes": """
SELECT 'orders' AS request_id, writer, writer <> 'broken' AS ok,
       CASE writer WHEN 'counted' THEN CAST((SELECT count(*) FROM orders) AS VARCHAR) END AS result,
       CASE writer WHEN 'broken' THEN 'LookupError' END AS error_type, CASE writer WHEN 'broken' THEN 'unavailable' END AS error
FROM (VALUES ('counted'), ('broken'), ('silent')) AS w(writer)""",
    "fan_out": """
SELECT CAST(3 AS BIGINT) AS total, CAST(2 AS BIGINT) AS succeeded, CAST(1 AS BIGINT) AS failed, false AS all_ok, 'FAILED_WRITERS' AS verdict, 2 * count(*) AS rows_written FROM orders""",
    "translate_identity": "SELECT 'job:nodes_ingest:Supplier' AS key, s_suppkey, s_name FROM supplier",
    "request_state": _request_state(),
    "status_times": f"""
WITH {_since_start()}
SELECT request_id, event_type AS status, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS at
FROM f WHERE event_type IN {STATUS_LIST} GROUP BY request_id, event_type""",
    "request_errors": f"""
WITH {_since_start()}
SELECT request_id, timestamp, seq, message, row_number() OVER (PARTITION BY request_id ORDER BY timestamp, seq) AS error_no
FROM f WHERE event_type = 'ERROR'""",
    "progress_percent": """
SELECT 'req-' || CAST(user_id AS VARCHAR) AS request_id, event_type AS key, count(*) AS cardinality,
       count(*) FILTER (WHERE value >= 30) AS processed,
       round_even(100.0 * count(*) FILTER (WHERE value >= 30) / nullif(count(*), 0), 0) AS percent
FROM events GROUP BY ALL""",
    "missing_keys": """
SELECT 'req-' || CAST(user_id AS VARCHAR) AS request_id, event_type AS key FROM events GROUP BY ALL HAVING min(value) < 10""",
    "outcome_summary": """
SELECT 'req-' || CAST(user_id AS VARCHAR) AS request_id, count(*) AS total,
       count(*) FILTER (WHERE event_type <> 'error') AS succeeded, count(*) FILTER (WHERE event_type = 'error') AS failed,
       bool_and(event_type <> 'error') AS all_ok,
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'FAILED_WRITERS'
            WHEN count(*) FILTER (WHERE event_type <> 'error') = 0 THEN 'NOTHING_WRITTEN' ELSE 'ALL_OK' END AS verdict
FROM events GROUP BY ALL""",
    "undirected_graph": """
WITH e AS (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS a, 'S' || CAST(l_suppkey AS VARCHAR) AS b, 'SUPPLIED_BY,Part,Supplier' AS t FROM lineitem
           UNION ALL SELECT 'S' || CAST(l_suppkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR), 'SUPPLIES,Supplier,Part' FROM lineitem WHERE l_returnflag = 'R')
SELECT least(a, b) AS u, greatest(a, b) AS v, max(t) AS type FROM e GROUP BY ALL""",
    "undirected_vertices": """
WITH ends AS (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS id FROM lineitem UNION ALL SELECT 'S' || CAST(l_suppkey AS VARCHAR) FROM lineitem),
n AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_size <= 40)
SELECT id, bool_or(node) AS has_node FROM (SELECT id, true AS node FROM n UNION ALL SELECT id, false FROM ends) GROUP BY id""",
    "undirected_attributes": """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id, 'brand' AS attribute, p_brand AS value FROM part WHERE p_brand IS NOT NULL
UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), 'type', p_type FROM part WHERE p_type IS NOT NULL
UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), 'name', s_name FROM supplier WHERE s_name IS NOT NULL""",
    "validate_requests": _REQUESTS + """
SELECT event_id, problems = '' AS valid, problems FROM pr""",
    "uid_duplicates": "SELECT user_id AS _uid, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1",
    "uid_nulls": """
SELECT 'Message' AS label, count(*) FILTER (WHERE role = 'system') AS n_null, count(*) AS n_rows FROM conversations""",
    "events_of_request": f"SELECT request_id, seq, event_type FROM ({_pev()}) WHERE contains(request_id, 'req-12')",
    "stream_read": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_merge": _STREAM_WINNERS,
    "indexed_set_add": """
WITH m AS (SELECT DISTINCT event_type, event_id, user_id FROM events)
SELECT event_type AS arguments, count(*) AS cardinality,
       (SELECT count(*) FROM m WHERE event_type <> 'click') AS added_0, (SELECT count(*) FROM m WHERE event_type = 'click') AS added_1,
       CAST(0 AS BIGINT) AS added_2
FROM m GROUP BY event_type""",
    "listeners": """
SELECT l.listener, TRUE AS ok, CAST(CASE l.listener WHEN 'flaky' THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       count(*) AS n_events, count(DISTINCT event_id) AS n_distinct
FROM events CROSS JOIN (VALUES ('steady'), ('flaky')) AS l(listener) GROUP BY l.listener""",
    "get_stored": """
SELECT o_orderkey AS pos, 'Customer-' || CAST(o_custkey AS VARCHAR) AS key, c_name AS value
FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'""",
    "get_stored_hash": """
SELECT CAST(n_nationkey AS BIGINT) AS pos, 'Nation-' || CAST(n_nationkey AS VARCHAR) AS key, s_name AS field, CAST(s_acctbal AS DOUBLE) AS value
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_nationkey <> 7""",
    "stream_rows": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_merge_rows": _STREAM_WINNERS,
    "live_runs": f"""
WITH {_since_start()},
g AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w > INTERVAL 3 DAY THEN 1 ELSE 0 END AS brk
      FROM f WINDOW w AS (PARTITION BY request_id ORDER BY timestamp, seq)),
k AS (SELECT *, sum(brk) OVER (PARTITION BY request_id ORDER BY timestamp, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cut FROM g),
run AS (SELECT * FROM k WHERE cut = 0),
ls AS (SELECT request_id, event_type AS status FROM (
       SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY timestamp DESC, seq DESC) AS rn FROM run
       WHERE event_type IN {STATUS_LIST}) WHERE rn = 1)
SELECT run.request_id, ls.status, min(s_ts) AS start_at,
       max(CASE WHEN event_type = 'DONE_PROCESSING_REQUEST' THEN timestamp END) AS end_at,
       count(*) AS n_events, count(*) FILTER (WHERE event_type = 'ERROR') AS n_errors
FROM run LEFT JOIN ls USING (request_id) GROUP BY run.request_id, ls.status""",
    "live_state": f"""
WITH ev AS ({_pev()}),
ls AS (SELECT request_id, event_type AS status FROM (
       SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY timestamp DESC, seq DESC) AS rn FROM ev
       WHERE event_type IN {STATUS_LIST}) WHERE rn = 1)
SELECT request_id, ls.status, min(timestamp) AS first_at,
       max(CASE WHEN event_type = 'DONE_PROCESSING_REQUEST' THEN timestamp END) AS end_at,
       count(*) AS n_events, count(*) FILTER (WHERE event_type = 'ERROR') AS n_errors
FROM ev LEFT JOIN ls USING (request_id) GROUP BY request_id, ls.status""",
    "closed_sessions": """
WITH ev AS (SELECT 'req-' || CAST(user_id AS VARCHAR) AS request_id, ts FROM events),
g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 1 HOUR THEN 1 ELSE 0 END AS brk
      FROM ev WINDOW w AS (PARTITION BY request_id ORDER BY ts)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY request_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g),
sess AS (SELECT request_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS n_events FROM s GROUP BY request_id, sid)
SELECT * FROM sess WHERE session_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "event_sequence": """
SELECT from_type, event_type AS to_type, count(*) AS n FROM (
  SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_type FROM events)
WHERE from_type IS NOT NULL GROUP BY ALL""",
    "ingest_two_sources": """
WITH nat AS (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)
SELECT 'NODES' AS element_type, 'Customer' AS name, count(*) AS n FROM customer
UNION ALL SELECT 'NODES', 'Nation', count(*) FROM nat
UNION ALL SELECT 'NODES', 'Supplier', count(*) FROM supplier
UNION ALL SELECT 'EDGES', 'IN_NATION_Customer_Nation', count(*) FROM customer WHERE c_nationkey IN (SELECT * FROM nat)
UNION ALL SELECT 'EDGES', 'IN_NATION_Supplier_Nation', count(*) FROM supplier WHERE s_nationkey IN (SELECT * FROM nat)""",
    "load_staged": """
SELECT 'NODES' AS element_type, 'Customer' AS name, count(*) AS n FROM customer
UNION ALL SELECT 'NODES', 'Order', count(*) FROM orders
UNION ALL SELECT 'EDGES', 'PLACED_Customer_Order', count(*) FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'NODES', 'Customer.vip', count(*) FROM customer WHERE c_acctbal > 9000""",
    "admin_log_named": """
SELECT ts AS timestamp, n_name AS job_name, 'job-' || CAST(user_id % 25 AS VARCHAR) AS job_id, event_type AS category,
       CAST(floor(value) AS BIGINT) AS int_value, props AS string_value
FROM events LEFT JOIN nation ON 'job-' || CAST(user_id % 25 AS VARCHAR) = 'job-' || CAST(n_nationkey AS VARCHAR)""",
    "fixture_nodes": """
SELECT c_custkey AS _uid, 'Person' || CAST(c_custkey AS VARCHAR) AS name, c_custkey AS age,
       'Person' || CAST(c_custkey AS VARCHAR) || '@gmail.com' AS email FROM customer""",
    "fixture_edges": """
SELECT DISTINCT o_orderkey AS _fromUid, 2 * o_orderkey AS _toUid, 'EDGE_TYPE' AS _edgeType FROM orders
WHERE 2 * o_orderkey IN (SELECT o_orderkey FROM orders)""",
    "two_sources": """
SELECT s AS source, s || '-' || CAST(c_custkey AS VARCHAR) AS _uid, CAST(c_custkey AS VARCHAR) || '-' || s AS name, c_custkey AS age,
       CAST(c_custkey AS VARCHAR) || '-Oranges,' || CAST(c_custkey AS VARCHAR) || '-Apples' AS likes,
       CAST(c_custkey AS VARCHAR) || '-' || s || '@gmail.com' AS email
FROM customer, (VALUES ('source-1'), ('source-2')) v(s)""",
    "index_scan": """
SELECT c_custkey AS pid, 'Name_' || CAST(c_custkey AS VARCHAR) AS name, c_custkey AS age, 'Org_' || CAST(c_custkey AS VARCHAR) AS org_name,
       'location_' || CAST(c_custkey AS VARCHAR) AS org_location,
       CASE WHEN c_custkey % 2 = 0 THEN 'a' || CAST(c_custkey AS VARCHAR) || '|b' || CAST(c_custkey AS VARCHAR) ELSE 't' || CAST(c_custkey AS VARCHAR) END AS long_text,
       CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS n_long_text
FROM customer""",
    "select_sources": """
SELECT s_suppkey, s_name FROM supplier
WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA'))""",
    "staged_scan": "SELECT c_custkey AS _uid, c_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'",
    "delete_keys": _STAGED_CUSTOMERS + "\nSELECT job_name, operation, arguments, _uid FROM sc WHERE n_regionkey <> 0",
    "delete_prefix": _STAGED_CUSTOMERS + """
SELECT 'custjob:nodes_ingest:Customer_NATION_1' AS prefix,
       (SELECT count(DISTINCT arguments) FROM sc WHERE starts_with(job_name || ':' || operation || ':' || arguments, 'custjob:nodes_ingest:Customer_NATION_1')) AS keys_deleted,
       (SELECT count(*) FROM sc WHERE NOT starts_with(job_name || ':' || operation || ':' || arguments, 'custjob:nodes_ingest:Customer_NATION_1')) AS rows_remaining""",
    "ingest_progress": """
SELECT 'nodes_ingest:Customer' AS key, count(*) AS cardinality, count(*) AS processed, CAST(100.0 AS DOUBLE) AS percent, true AS complete FROM customer
UNION ALL
SELECT 'edges_ingest:IN_NATION,Customer,Nation', count(*), count(*), 100.0, true FROM customer
UNION ALL
SELECT 'nodes_ingest:Nation', count(*), count(*), 100.0, true FROM nation""",
    "purge": _STAGED_CUSTOMERS + "\nSELECT count(*) AS rows_staged, count(DISTINCT arguments) AS keys_staged, count(DISTINCT arguments) AS keys_purged, CAST(0 AS BIGINT) AS rows_left FROM sc",
    "key_columns": """
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority,
         'req_' || strftime(o_orderdate, '%Y_%-m_%-d_%-H_%-M_%-S') || '_orders' AS job,
         CASE WHEN o_orderstatus = 'F' THEN 'nodes_ingest' ELSE 'edges_ingest' END AS op FROM orders),
j AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN job || ':p' ELSE job END AS job_name,
             CASE WHEN op = 'nodes_ingest' THEN 'Order' ELSE 'PLACED,Customer,Order' END AS args FROM o)
SELECT o_orderkey, job_name, job_name || ':' || op || ':' || args AS key, NOT contains(job_name, ':') AS job_ok,
       CASE WHEN op = 'nodes_ingest' THEN 'Nodes' ELSE 'Edges' END AS kind,
       CASE WHEN op = 'nodes_ingest' THEN 'Order' ELSE 'PLACED_Customer_Order' END AS element_properties,
       o_orderpriority AS edge_type, 'PLACED' AS edge_type_given FROM j""",
    "scalar_forms": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, CAST(floor(epoch(ts)) AS BIGINT) AS ts_unix,
       to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})::VARCHAR AS json,
       'event_id=' || CAST(event_id AS VARCHAR) || ';user_id=' || CAST(user_id AS VARCHAR) || ';event_type=' || event_type AS attributes,
       event_type || '|' || props AS flat
FROM events""",
    "progress_lookup": f"""
WITH live AS ({_request_state("ts < TIMESTAMP '2024-01-15 00:00:00'")}),
full_state AS ({_request_state()})
SELECT request_id, status, n_events, 'memory' AS source FROM live
UNION ALL
SELECT request_id, status, n_events, 'dump' FROM full_state WHERE request_id NOT IN (SELECT request_id FROM live)""",
    "source_maps": """
SELECT DISTINCT 'req-' || CAST(n_regionkey AS VARCHAR) AS request_id, s_name AS source_name, 'model-' || n_name AS graph_model
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "source_keys": """
SELECT s_name AS source_name, k AS key FROM supplier, (VALUES ('job:nodes_ingest:Supplier'), ('job:edges_ingest:IN_NATION,Supplier,Nation')) v(k)""",
    "union_frames": """
SELECT c_custkey AS _uid, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
    "sequence_check": f"""
WITH ev AS ({_pev()}),
n AS (SELECT request_id, event_type, row_number() OVER (PARTITION BY request_id ORDER BY timestamp, seq) AS pos FROM ev),
e AS (SELECT * FROM (VALUES (1, 'STARTED_PROCESSING_REQUEST'), (2, 'FETCHING_DATA_AND_MODELS'), (3, 'PUSHED_GRAPH_ELEMENTS_INTO_NEO')) v(pos, expected)),
j AS (SELECT n.*, e.expected, n.event_type IS NOT DISTINCT FROM e.expected AS hit FROM n LEFT JOIN e USING (pos))
SELECT request_id, count(*) AS n_events, count(*) FILTER (WHERE hit) AS n_matching, min(pos) FILTER (WHERE NOT hit) AS first_mismatch,
       count(*) = 3 AND count(*) FILTER (WHERE hit) = 3 AS matches
FROM j GROUP BY request_id""",
    "typed_edges": """
SELECT DISTINCT CASE WHEN l_returnflag = 'R' THEN 'RETURNED' ELSE 'SUPPLIED_BY' END AS _edgeType, l_partkey AS _fromUid, l_suppkey AS _toUid
FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
    "store_delete": """
WITH gone AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
keep AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment <> 'MACHINERY'),
d AS (SELECT (SELECT count(*) FROM gone) AS deleted_nodes,
             (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT * FROM gone))
             + (SELECT count(*) FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey IN (SELECT n_nationkey FROM nation)) AS deleted_edges)
SELECT element_type, name, n, deleted_nodes, deleted_edges FROM (
  SELECT 'NODES' AS element_type, 'Customer' AS name, (SELECT count(*) FROM keep) AS n
  UNION ALL SELECT 'NODES', 'Nation', (SELECT count(*) FROM nation)
  UNION ALL SELECT 'NODES', 'Order', (SELECT count(*) FROM orders)
  UNION ALL SELECT 'EDGES', 'IN_NATION_Customer_Nation', (SELECT count(*) FROM keep WHERE c_nationkey IN (SELECT n_nationkey FROM nation))
  UNION ALL SELECT 'EDGES', 'PLACED_Customer_Order', (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM keep))
), d""",
    "graph_sql": """
SELECT c_mktsegment AS segment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
}
ORACLE["partitioned_upsert"] = ORACLE["merge_nodes_update"]  # same merges, other storage
