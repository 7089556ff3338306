"""The expected result of each query as plain SQL over the same tables."""

from __future__ import annotations

# Views of the stand-in topics, written once and put in front of each statement.
_VIEWS = """
WITH en AS (SELECT COUNT(*) AS n FROM events),
L AS (
  SELECT e.*, CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
         ts AS kafka_timestamp, event_id - event_id % 1000 AS offset_bucket,
         epoch_us(ts) // 1000 AS ms, n, 1000 * ((n + 31999) // 32000) AS width
  FROM events e, en),
hot AS (SELECT * FROM L WHERE event_id * 10 >= n * 6),
cold AS (SELECT * FROM L WHERE event_id * 10 < n * 7),
stops AS (SELECT user_id AS "routeId", ms AS timestamp, event_type AS state,
                 value AS x, value AS y, kafka_offset
          FROM L WHERE event_type IN ('purchase', 'error')),
positions AS (SELECT user_id AS "routeId", ms AS timestamp, value AS x, value AS y, kafka_offset
              FROM L),
ord AS (SELECT o.*, (SELECT COUNT(*) FROM orders) AS n FROM orders o),
changes AS (
  SELECT 'c' AS op, o_orderkey AS "OrderID", o_custkey AS "CustomerID",
         o_orderstatus AS "Status", o_totalprice AS "Amount", o_orderkey AS kafka_offset, n
  FROM ord
  UNION ALL
  SELECT 'u', o_orderkey, o_custkey, 'SHIPPED', o_totalprice, n + o_orderkey, n
  FROM ord WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT 'd', o_orderkey, o_custkey, o_orderstatus, o_totalprice, 2 * n + o_orderkey, n
  FROM ord WHERE o_orderpriority = '5-LOW'),
O AS (SELECT *, CAST("OrderID" % 4 AS INTEGER) AS kafka_partition FROM changes),
newest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY "OrderID" ORDER BY kafka_offset DESC) AS rn
    FROM O WHERE kafka_offset * 3 >= n) t
  WHERE rn = 1),
live AS (SELECT * FROM newest WHERE op <> 'd'),
tombs AS (SELECT * FROM newest WHERE op = 'd'),
coldo AS (SELECT * FROM O WHERE op = 'c' AND kafka_offset * 3 < n),
mergedo AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY "OrderID" ORDER BY kafka_offset DESC) AS rn
    FROM O) t
  WHERE rn = 1 AND op <> 'd'),
cn AS (SELECT COUNT(*) AS n FROM customer),
C AS (SELECT c.*, 0 AS kafka_partition, c_custkey AS kafka_offset, n FROM customer c, cn)
"""

_EV = "event_id, user_id, event_type, value, kafka_partition, kafka_offset"
_OR = '"OrderID", "CustomerID", "Status", "Amount", kafka_partition, kafka_offset'
_CU = "c_custkey, c_name, c_acctbal, c_mktsegment, kafka_offset"
_HOUR = "strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:00')"
_AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"
_LAST = """
SELECT user_id AS "routeId", MAX(CASE WHEN event_type = 'purchase' THEN ms END) AS end_ts
FROM L WHERE event_type IN ('signup', 'purchase')
GROUP BY user_id HAVING MAX(CASE WHEN event_type = 'purchase' THEN ms END) IS NOT NULL
ORDER BY end_ts DESC, "routeId" LIMIT 1
"""
_CELLS = """
SELECT user_id AS "routeId", kafka_partition, kafka_offset, kafka_timestamp,
       CAST(FLOOR(value / 20) AS BIGINT) AS x, CAST(FLOOR(value / 40) AS BIGINT) AS y FROM L
"""
_PREFIX_INDEX = """
SELECT DISTINCT SUBSTRING(c_name, 1, 15) AS value, kafka_partition,
       kafka_offset - kafka_offset % 100 AS granule FROM C
"""
_ERRORS = """
SELECT ROW_NUMBER() OVER (ORDER BY ts, kafka_partition, kafka_offset) - 1 AS replay_offset, *
FROM L WHERE event_type = 'error'
"""
_RATE = """
ROUND(CAST(100.0 * SUM(CASE WHEN state = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE)
      / NULLIF(COUNT(*), 0), 2) AS purchase_pct
"""

_BODIES: dict[str, str] = {
    # scans
    "hot_scan": f"SELECT {_EV}, kafka_timestamp, offset_bucket FROM hot",
    "cold_scan": f"SELECT {_EV}, kafka_timestamp FROM cold",
    "cold_logical_scan": f"""
        SELECT {_OR} FROM coldo WHERE "OrderID" NOT IN (SELECT "OrderID" FROM tombs)""",
    "merged_scan": f"SELECT {_EV}, kafka_timestamp, offset_bucket FROM L",
    "merged_stored": f"SELECT {_EV} FROM L",
    "cdc_deletes": """
        SELECT "OrderID", kafka_partition, kafka_offset AS delete_kafka_offset FROM tombs""",
    "wide_scan": "SELECT doc_id, text, n_chars FROM documents",
    "limit_n": """
        SELECT least(COUNT(*), 10) AS n, least(COUNT(DISTINCT doc_id), 10) AS different
        FROM documents""",
    "decode_payload": """
        SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM L""",
    "merged_evolved": """
        SELECT event_id, event_type, value,
               CASE WHEN event_id * 10 >= n * 9 THEN value / 10 END AS risk FROM L""",
    "merged_one_sided": """
        SELECT 'supplier' AS topic, s_suppkey AS id, s_name AS name FROM supplier
        UNION ALL
        SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation""",
    # catalog
    "show_namespaces": """
        SELECT 'cold' AS namespace, CAST(2 AS BIGINT) AS tables,
               (SELECT COUNT(*) FROM cold)
               + (SELECT COUNT(*) FROM C WHERE c_custkey * 10 < n * 9) AS row_count
        UNION ALL SELECT 'deletes', 0, 0
        UNION ALL SELECT 'hot', 2, (SELECT COUNT(*) FROM hot)
               + (SELECT COUNT(*) FROM C WHERE c_custkey * 10 >= n * 8)
        UNION ALL SELECT 'merged', 2, (SELECT COUNT(*) FROM L) + (SELECT COUNT(*) FROM C)
        UNION ALL SELECT 'today', 0, 0""",
    "show_tables_merged": """
        SELECT 'merged' AS namespace, 'customers' AS table_name, COUNT(*) AS row_count
        FROM C
        UNION ALL SELECT 'merged', 'events', COUNT(*) FROM L""",
    "describe_hot": """
        SELECT 'OrderID' AS col_name, 'bigint' AS data_type, COUNT("OrderID") AS non_null FROM live
        UNION ALL SELECT 'CustomerID', 'bigint', COUNT("CustomerID") FROM live
        UNION ALL SELECT 'Status', 'string', COUNT("Status") FROM live
        UNION ALL SELECT 'Amount', 'double', COUNT("Amount") FROM live
        UNION ALL SELECT 'kafka_partition', 'int', COUNT(kafka_partition) FROM live
        UNION ALL SELECT 'kafka_offset', 'bigint', COUNT(kafka_offset) FROM live
        UNION ALL SELECT 'kafka_timestamp', 'timestamp_ntz', COUNT(o_orderdate)
          FROM live JOIN orders ON "OrderID" = o_orderkey""",
    "query_in_set": """
        SELECT 'hot' AS tier, event_type, COUNT(*) AS n, MIN(kafka_offset) AS first_offset
        FROM hot GROUP BY event_type
        UNION ALL
        SELECT 'cold', event_type, COUNT(*), MIN(kafka_offset) FROM cold GROUP BY event_type
        UNION ALL
        SELECT 'merged', event_type, COUNT(*), MIN(kafka_offset) FROM L GROUP BY event_type""",
    "query_in_set_indexed": """
        SELECT c_custkey, c_name, c_acctbal FROM C
        WHERE UPPER(TRIM(c_name)) = 'CUSTOMER#000000042'""",
    "query_indexed_report": """
        SELECT c_mktsegment AS segment, n_regionkey, COUNT(*) AS customers, SUM(c_acctbal) AS balance
        FROM C JOIN nation ON n_nationkey = c_nationkey
        WHERE UPPER(TRIM(c_name)) IN ('CUSTOMER#000000007', 'CUSTOMER#000000042', 'CUSTOMER#000000099')
        GROUP BY 1, 2""",
    # projections and filters
    "project_rename": 'SELECT "OrderID", "Status" AS hotset_status FROM live',
    "filter_eq": f"""SELECT {_OR} FROM live WHERE "Status" = 'SHIPPED'""",
    "filter_range": f'SELECT {_OR} FROM mergedo WHERE "OrderID" > 0',
    "filter_transformed": f"SELECT {_CU} FROM C WHERE UPPER(TRIM(c_mktsegment)) = 'BUILDING'",
    "filter_as_of": f"""
        SELECT 'hot' AS source, COUNT(*) AS row_count FROM hot WHERE ts < {_AS_OF}
        UNION SELECT 'cold', COUNT(*) FROM cold WHERE ts < {_AS_OF}
        UNION SELECT 'merged', COUNT(*) FROM L WHERE ts < {_AS_OF}""",
    "filter_now": """
        SELECT 'hot' AS source, COUNT(*) AS row_count FROM hot
        UNION SELECT 'cold', COUNT(*) FROM cold
        UNION SELECT 'merged', COUNT(*) FROM L""",
    "drop_consecutive_dups": f"""
        SELECT "routeId", kafka_partition, kafka_offset, x, y FROM (
          SELECT *,
            LAG(kafka_offset) OVER w IS NOT NULL
            AND LAG(x) OVER w IS NOT DISTINCT FROM x
            AND LAG(y) OVER w IS NOT DISTINCT FROM y AS same
          FROM ({_CELLS}) c
          WINDOW w AS (PARTITION BY "routeId" ORDER BY kafka_timestamp, kafka_partition, kafka_offset)) t
        WHERE NOT same""",
    # joins
    "cold_hot_join": """
        SELECT o."OrderID", o."Status" AS coldset_status
        FROM coldo o JOIN live h ON o."OrderID" = h."OrderID" WHERE h."Status" = 'SHIPPED'""",
    "route_population": """
        SELECT s."routeId", COUNT(*) AS pair_count,
               ROUND(AVG(CASE WHEN s.state = 'purchase' THEN 1.0 ELSE 0.0 END), 3)
                 AS delivered_share,
               ROUND(STDDEV_SAMP(g.x) + STDDEV_SAMP(g.y), 6) AS spread
        FROM stops s JOIN positions g ON s."routeId" = g."routeId" GROUP BY s."routeId" """,
    "route_population_preagg": """
        SELECT s."routeId", n_stops, n_delivered, n_positions, dev_x, dev_y
        FROM (SELECT "routeId", COUNT(*) AS n_stops,
                     CAST(SUM(CASE WHEN state = 'purchase' THEN 1 ELSE 0 END) AS BIGINT)
                       AS n_delivered
              FROM stops GROUP BY 1) s
        JOIN (SELECT "routeId", COUNT(*) AS n_positions, ROUND(STDDEV_POP(x), 6) AS dev_x,
                     ROUND(STDDEV_POP(y), 6) AS dev_y FROM positions GROUP BY 1) p
        ON s."routeId" = p."routeId" """,
    # aggregates
    "count_all": "SELECT COUNT(*) AS n FROM events",
    "active_sessions": "SELECT COUNT(DISTINCT user_id) AS active_sessions FROM L",
    "no_duplicates": """
        SELECT COUNT(*) AS total, COUNT(DISTINCT "OrderID") AS distinct_keys,
               COUNT(*) = COUNT(DISTINCT "OrderID") AS no_duplicates FROM mergedo""",
    "coord_envelope": """
        SELECT MIN(x) AS x_min, MAX(x) AS x_max, MIN(y) AS y_min, MAX(y) AS y_max
        FROM positions""",
    "event_counts": "SELECT event_type, COUNT(*) AS events FROM L GROUP BY 1 ORDER BY 1",
    "outcome_counts": """
        SELECT state, COUNT(*) AS stop_count,
               CASE WHEN state = 'error' THEN 'bad' ELSE 'good' END AS label
        FROM stops GROUP BY state ORDER BY stop_count DESC""",
    "hit_rate": f"SELECT {_RATE} FROM stops",
    "hit_rate_by_hour": f"""
        SELECT {_HOUR} AS hour_bucket, {_RATE} FROM stops GROUP BY 1 ORDER BY 1""",
    "stops_by_hour": f"""
        SELECT {_HOUR} AS hour_bucket, COUNT(DISTINCT "routeId") AS route_count, COUNT(*) AS stop_count
        FROM stops GROUP BY 1 ORDER BY 1""",
    "latest_completed": _LAST,
    "leaderboard": """
        SELECT name, score FROM (
          SELECT user_id, MAX(CAST(user_id AS VARCHAR)) AS name,
                 MAX(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS score
          FROM L WHERE event_type = 'view' GROUP BY user_id) t
        WHERE name IS NOT NULL AND score IS NOT NULL ORDER BY score DESC, name""",
    "sum_by_group": """
        SELECT event_type, ROUND(SUM(value), 2) AS total FROM L GROUP BY 1 ORDER BY 2 DESC""",
    "status_counts": 'SELECT "Status", COUNT(*) AS n FROM mergedo GROUP BY 1 ORDER BY 1',
    "tier_counts": """
        SELECT 'hot' AS source, COUNT(*) AS order_count FROM live
        UNION ALL SELECT 'cold_physical', COUNT(*) FROM coldo
        UNION ALL SELECT 'merged', COUNT(*) FROM mergedo""",
    "tier_counts_distinct": """
        SELECT 'hot' AS source, COUNT(*) AS row_count FROM hot
        UNION SELECT 'cold', COUNT(*) FROM cold
        UNION SELECT 'merged', COUNT(*) FROM L""",
    "tier_distribution": """
        SELECT p.peg AS offset_peg, hot_count, hot_earliest, hot_latest, cold_count,
               cold_earliest, cold_latest, merged_count,
               CAST(ROUND(100.0 * hot_count / GREATEST(merged_count, 1)) AS BIGINT) AS hot_pct,
               CAST(ROUND(100.0 * cold_count / GREATEST(merged_count, 1)) AS BIGINT) AS cold_pct
        FROM (SELECT MAX(kafka_offset) AS peg FROM L) p,
             (SELECT COUNT(*) AS hot_count, MIN(kafka_offset) AS hot_earliest,
                     MAX(kafka_offset) AS hot_latest FROM hot) h,
             (SELECT COUNT(*) AS cold_count, MIN(kafka_offset) AS cold_earliest,
                     MAX(kafka_offset) AS cold_latest FROM cold) c,
             (SELECT COUNT(*) AS merged_count FROM L) m""",
    "tier_distribution_stored": """
        SELECT p.peg AS offset_peg, hot_count, hot_earliest, hot_latest, cold_count,
               cold_earliest, cold_latest, merged_count,
               CAST(ROUND(100.0 * hot_count / GREATEST(merged_count, 1)) AS BIGINT) AS hot_pct,
               CAST(ROUND(100.0 * cold_count / GREATEST(merged_count, 1)) AS BIGINT) AS cold_pct
        FROM (SELECT MAX(kafka_offset) AS peg FROM L) p,
             (SELECT COUNT(*) AS hot_count, MIN(kafka_offset) AS hot_earliest,
                     MAX(kafka_offset) AS hot_latest FROM hot) h,
             (SELECT COUNT(*) AS cold_count, MIN(kafka_offset) AS cold_earliest,
                     MAX(kafka_offset) AS cold_latest FROM cold) c,
             (SELECT COUNT(*) AS merged_count FROM L) m""",
    "freshness": """
        SELECT age AS age_ms, ROUND(age / 3600000, 3) AS age_hours,
               ROUND(age / 86400000, 3) AS age_days
        FROM (SELECT epoch_ms(TIMESTAMP '2024-02-01 00:00:00') - MAX(ms) AS age FROM L) t""",
    "latency_percentiles": """
        SELECT event_type, COUNT(*) AS n,
               MAX(CASE WHEN r = c // 2 THEN value END) AS p50,
               MAX(CASE WHEN r = LEAST(c - 1, (95 * c + 99) // 100 - 1) THEN value END) AS p95
        FROM (SELECT event_type, value,
                     ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r,
                     COUNT(*) OVER (PARTITION BY event_type) AS c
              FROM L WHERE value IS NOT NULL) t
        GROUP BY event_type""",
    "speed_ratio": """
        SELECT h.kafka_partition, candidate, base,
               ROUND(CASE WHEN base > 0 THEN candidate / base ELSE 0 END, 6) AS ratio,
               ROUND(CASE WHEN base > 0 THEN (candidate - base) * 100.0 / base ELSE 0 END, 4)
                 AS change_pct
        FROM (SELECT kafka_partition, COUNT(*) AS candidate FROM hot GROUP BY 1) h
        JOIN (SELECT kafka_partition, COUNT(*) AS base FROM cold GROUP BY 1) c
        ON h.kafka_partition = c.kafka_partition""",
    # sorts and top-k
    "newest_n": f"SELECT {_EV} FROM L ORDER BY kafka_offset DESC LIMIT 50",
    "oldest_n": f"SELECT {_EV} FROM L ORDER BY kafka_offset LIMIT 5",
    "topk_key": f'SELECT {_OR} FROM mergedo ORDER BY "OrderID" LIMIT 10',
    "trajectory": f"""
        SELECT p.* FROM positions p
        WHERE "routeId" = (SELECT "routeId" FROM ({_LAST}) r) ORDER BY timestamp""",
    "route_stops": f"""
        SELECT s.*, CASE WHEN state = 'purchase' THEN 'delivered' ELSE 'undelivered' END AS outcome
        FROM stops s WHERE "routeId" = (SELECT "routeId" FROM ({_LAST}) r)""",
    # scalar functions
    "scalar_strings": """
        SELECT c_custkey, UPPER(c_name) AS upper_name, UPPER(TRIM(c_name)) AS upper_trimmed,
               SUBSTRING(c_name, 1, 15) AS prefix FROM C""",
    "json_extract": """
        SELECT event_id, json_extract_string(props, '$.k') AS k_text,
               TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM L""",
    "epoch_convert": """
        SELECT event_id, ms, ms // 1000 AS event_time,
               strftime(make_timestamp((ms // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS event_text,
               strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:00') AS hour_bucket FROM L""",
    "offset_bucket": """
        SELECT kafka_partition, offset_bucket AS block, COUNT(*) AS n FROM L GROUP BY 1, 2""",
    # change log
    "cdc_unwrap": f"SELECT op, {_OR} FROM O",
    "cdc_current": f"SELECT {_OR} FROM live",
    "cdc_merged": f"SELECT {_OR} FROM mergedo",
    "cdc_roll": f"SELECT {_OR} FROM mergedo",
    "cdc_roll_null_key": f"""
        SELECT * FROM (WITH event AS (
            SELECT * REPLACE (CASE WHEN op = 'd' OR "OrderID" % 7 <> 0 THEN "OrderID" END AS "OrderID")
            FROM O WHERE kafka_offset * 3 >= n
        ), last AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY "OrderID" ORDER BY kafka_offset DESC) AS rn FROM event
        )
        SELECT {_OR} FROM last WHERE rn = 1 AND op <> 'd'
        UNION ALL
        SELECT {_OR} FROM coldo c WHERE NOT EXISTS (SELECT 1 FROM event e WHERE e."OrderID" = c."OrderID")) t""",
    "cdc_merged_evolved": f"""
        SELECT {_OR}, CASE WHEN kafka_offset * 3 >= n THEN "Amount" / 10 END AS "Risk" FROM mergedo""",
    "cdc_roll_evolved": f"""
        SELECT {_OR}, CASE WHEN kafka_offset * 3 >= n THEN "Amount" / 10 END AS "Risk" FROM mergedo""",
    "cdc_roll_invariant": f"SELECT {_OR} FROM mergedo",
    # archive jobs
    "archive_ctas": f"""
        SELECT {_EV}, kafka_offset - kafka_offset % width AS offset_bucket FROM hot""",
    "archive_ordered": f"SELECT {_EV}, kafka_timestamp FROM hot",
    "archive_append": f"SELECT {_EV} FROM L",
    "derived_table": """
        SELECT user_id AS "routeId", event_type AS state, ms AS timestamp
        FROM cold WHERE event_type = 'purchase'""",
    "trim_hot": f"""
        SELECT {_EV} FROM hot h
        WHERE kafka_offset > (SELECT MAX(c.kafka_offset) FROM cold c
                              WHERE c.kafka_partition = h.kafka_partition)""",
    "trim_hot_late": f"""
        SELECT {_EV}, CASE WHEN event_id * 10 < n * 7 AND NOT (event_id * 10 >= n * 3 AND event_id * 10 < n * 5)
                           THEN 'cold' ELSE 'hot' END AS tier
        FROM L""",
    "merged_late": f"SELECT {_EV} FROM L",
    "bloom_archive": """
        SELECT 'Customer#000000042' AS name, COUNT(*) AS n FROM C WHERE c_name = 'Customer#000000042'
        UNION ALL SELECT 'Customer#000000042x', 0""",
    "housekeeping": "SELECT COUNT(*) AS row_count, 0 AS crowded_folders FROM L",
    "latest_data": """
        SELECT COUNT(*) AS n, 'before' AS moment FROM L WHERE event_id * 10 < n * 9
        UNION ALL SELECT COUNT(*), 'after' FROM L""",
    "evolve_cold": """
        SELECT event_id, event_type, value,
               CASE WHEN event_id * 10 >= n * 9 THEN value / 10 END AS risk, kafka_offset FROM L""",
    # index
    "index_build": """
        SELECT DISTINCT c_name AS value, kafka_partition,
               kafka_offset - kafka_offset % 100 AS granule FROM C WHERE c_custkey * 10 < n * 9""",
    "index_build_transformed": f"{_PREFIX_INDEX} WHERE c_custkey * 10 < n * 9",
    "index_lookup": f"SELECT {_CU} FROM C WHERE UPPER(TRIM(c_name)) = 'CUSTOMER#000000042'",
    "index_lookup_multi": f"""
        SELECT {_CU} FROM C WHERE SUBSTRING(c_name, 1, 15) = 'Customer#000000'""",
    "index_lookup_tail": f"SELECT {_CU} FROM C WHERE c_custkey = n - 1",
    "index_superset": f"SELECT {_CU} FROM C WHERE c_name = 'Customer#000000042'",
    "index_parity": """
        SELECT COUNT(*) AS matches, CAST(0 AS BIGINT) AS differences
        FROM C WHERE SUBSTRING(c_name, 1, 15) = 'Customer#000000'""",
    "index_lookup_late": f"""
        SELECT way, {_EV} FROM L, (VALUES ('indexed'), ('plain'), ('refreshed')) w(way)
        WHERE event_type = 'error'""",
    "index_explain": f"""
        SELECT kafka_partition, granule AS low, granule + 100 AS high
        FROM ({_PREFIX_INDEX} WHERE c_custkey * 10 < n * 9) i WHERE value = 'Customer#000000'
        UNION ALL
        SELECT 0, MAX(kafka_offset), CAST(NULL AS BIGINT) FROM C WHERE c_custkey * 10 < n * 9""",
    "index_refresh": _PREFIX_INDEX,
    "index_hot_values": """
        SELECT value, COUNT(*) AS blocks FROM (
          SELECT DISTINCT UPPER(event_type) AS value, kafka_partition, offset_bucket FROM L) t
        GROUP BY value""",
    # replay
    "replay": f"SELECT {_EV} FROM L ORDER BY kafka_partition, kafka_offset",
    "replay_stored": f"SELECT {_EV} FROM L",
    "replay_page_stored": f"""
        SELECT {_EV} FROM L WHERE kafka_partition = 1 AND kafka_offset >= (n * 7 + 9) // 10 - 50
        ORDER BY kafka_offset LIMIT 200""",
    "replay_hot_start": """
        SELECT kafka_partition, MIN(kafka_offset) AS start_offset FROM hot GROUP BY 1""",
    "replay_page": f"""
        SELECT {_EV} FROM L WHERE kafka_partition = 1 AND kafka_offset >= (n * 7 + 9) // 10 - 50
        ORDER BY kafka_offset LIMIT 200""",
    "replay_resume": f"""
        SELECT CAST((r - 1) // 150 AS INTEGER) AS page, {_EV}
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY kafka_offset) AS r
              FROM L WHERE kafka_partition = 0) t WHERE r <= 300""",
    "virtual_topic": f"SELECT {_CU} FROM C WHERE c_mktsegment = 'BUILDING'",
    "virtual_topic_kept": f"SELECT {_EV} FROM L WHERE event_type = 'error' AND user_id % 10 = 3",
    "virtual_topic_late": f"SELECT {_EV} FROM L WHERE event_type = 'error'",
    "reordered_replay": f"SELECT replay_offset, {_EV} FROM ({_ERRORS}) t",
    "reordered_resume": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY late, value DESC, kafka_partition, kafka_offset) - 1
                 AS replay_offset, {_EV}
        FROM (SELECT *, event_id * 10 >= n * 7 AS late FROM L WHERE event_type = 'error') t""",
    "reordered_late": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY late, value DESC, kafka_partition, kafka_offset) - 1
                 AS replay_offset, {_EV}
        FROM (SELECT *, event_id * 10 >= n * 7 OR event_id * 10 >= n * 3 AND event_id * 10 < n * 5 AS late
              FROM L WHERE event_type = 'error') t""",
    "replay_rule": f"""
        SELECT 'audit' AS group_id,
               ROW_NUMBER() OVER (ORDER BY ts DESC, kafka_partition, kafka_offset) - 1
                 AS replay_offset, {_EV}
        FROM cold WHERE event_type = 'error'
        UNION ALL
        SELECT 'plain', kafka_offset, {_EV} FROM L""",
    "offset_gaps": """
        SELECT kafka_partition, prev + 1 AS gap_start, kafka_offset - 1 AS gap_end,
               kafka_offset - prev - 1 AS missing
        FROM (SELECT kafka_partition, kafka_offset,
                     LAG(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset)
                       AS prev FROM L) t
        WHERE kafka_offset > prev + 1""",
    "offset_gaps_stored": """
        SELECT kafka_partition, prev + 1 AS gap_start, kafka_offset - 1 AS gap_end,
               kafka_offset - prev - 1 AS missing
        FROM (SELECT kafka_partition, kafka_offset,
                     LAG(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset)
                       AS prev FROM L) t
        WHERE kafka_offset > prev + 1""",
    "contiguity": """
        SELECT kafka_partition, MIN(kafka_offset) AS first_offset,
               MAX(kafka_offset) AS last_offset, COUNT(*) AS records,
               MAX(kafka_offset) - MIN(kafka_offset) + 1 - COUNT(*) AS missing
        FROM L GROUP BY 1""",
    "contiguity_stored": """
        SELECT kafka_partition, MIN(kafka_offset) AS first_offset,
               MAX(kafka_offset) AS last_offset, COUNT(*) AS records,
               MAX(kafka_offset) - MIN(kafka_offset) + 1 - COUNT(*) AS missing
        FROM L GROUP BY 1""",
    "batch_statistics": f"""
        SELECT replay_offset // 500 AS batch, COUNT(*) AS records,
               MIN(replay_offset) AS first_offset, MAX(replay_offset) AS last_offset
        FROM ({_ERRORS}) t GROUP BY 1""",
    # streaming: the batch result of the same rows
    "stream_ingest": f"SELECT {_EV} FROM hot",
    "stream_archive": f"SELECT {_EV} FROM L",
    "stream_cdc": f"SELECT {_OR} FROM mergedo",
    "stream_cdc_seeded": f"SELECT {_OR} FROM mergedo",
    "stream_cdc_state": f"SELECT {_OR} FROM mergedo",
    "stream_replay": f"SELECT {_EV} FROM L",
}


def statements() -> dict[str, str]:
    return {name: _VIEWS + body for name, body in _BODIES.items()}
