"""DuckDB SQL for each registered query: the same results computed from ``events``
columns by the fault rules, without bytes (so the Spark side, which classifies real
bytes, is checked independently)."""

from __future__ import annotations

WIRE_CTE = """
wire AS (
  SELECT *, CAST(event_id * 3 // (SELECT max(event_id) + 1 FROM events) AS BIGINT) AS batch, 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS part,
         CAST(row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS BIGINT) AS off,
         CASE WHEN event_id % 97 = 0 THEN 'null_value' WHEN event_id % 89 = 0 THEN 'bad_magic'
              WHEN event_id % 83 = 0 THEN 'too_short' ELSE 'ok' END AS verdict,
         CAST(CASE WHEN user_id % 5 = 0 THEN 8 ELSE 7 END AS INTEGER) AS sid,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value > 50 END AS flag
  FROM events),
ok AS (SELECT *, CAST(row_number() OVER (ORDER BY batch, part, off) AS BIGINT) AS lsn FROM wire WHERE verdict = 'ok'),
commits AS (SELECT part, max(off) // 2 AS upto FROM wire GROUP BY part),
covered AS (SELECT o.* FROM ok o JOIN commits c ON o.part = c.part AND o.off <= c.upto),
batches AS (SELECT CAST(event_id % 3 AS INTEGER) AS task_id, event_id // 500 AS batch_id, count(*) AS rows, max(lsn) AS max_lsn
            FROM ok GROUP BY 1, 2),
stats AS (SELECT task_id, batch_id, rows,
         CAST(sum(rows) OVER (PARTITION BY task_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_completed,
         max(max_lsn) OVER (PARTITION BY task_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_lsn
         FROM batches),
days AS (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM ok GROUP BY 1),
probes AS (SELECT day + INTERVAL 1 DAY AS probe_ts,
           CAST(sum(n) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_completed FROM days)
"""


def _q(body: str) -> str:
    return "WITH " + WIRE_CTE.strip() + "\n" + body.strip()


TABLE_COLS = """event_type, CAST(event_id AS INTEGER) AS event_id, flag, topic AS _topic, part AS _partition,
  off AS _offset, sid AS _schema_id, lsn AS _lsn, batch AS batch_id"""

ORACLES = {
    "wire_verdicts": _q("SELECT verdict, count(*) AS n FROM wire GROUP BY verdict"),
    "wire_roundtrip": _q(
        'SELECT topic, part AS "partition", off AS "offset", sid AS schema_id, event_type, '
        "CAST(event_id AS INTEGER) AS event_id, flag FROM wire WHERE verdict = 'ok'"
    ),
    "generated_rows": """
SELECT event_id + 1 AS seq, repeat('A', 200) AS string_column,
       CAST(least(greatest(event_id + 1, -2147483648), 2147483647) AS INTEGER) AS numeric_column,
       (((((event_id + 1 + 2) % 2147483647) * 48271) % 2147483647) // 16) % 2 = 1 AS boolean_column
FROM events""",
    "lsn_assign": _q(
        'SELECT part AS "partition", off AS "offset", CAST(row_number() OVER (ORDER BY part, off) AS BIGINT) AS lsn FROM ok'
    ),
    "flush_point_by_partition": _q(
        'SELECT topic, part AS "partition", count(*) AS entries_considered, max(lsn) AS max_lsn FROM covered GROUP BY topic, part'
    ),
    "flush_point": _q("SELECT max(lsn) AS flush_lsn, count(*) AS entries_considered FROM covered"),
    "index_remaining": _q(
        'SELECT topic, part AS "partition", off AS "offset", lsn FROM ok '
        "WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.part = ok.part AND c.off = ok.off "
        "AND c.lsn <= (SELECT max(lsn) FROM covered))"
    ),
    "index_pruned": _q("SELECT count(*) AS pruned FROM covered WHERE lsn <= (SELECT max(lsn) FROM covered)"),
    "batch_stats": _q("SELECT task_id, batch_id, rows, total_completed, last_lsn FROM stats"),
    "log_metrics": _q(
        "SELECT CAST(task_id AS VARCHAR) AS task_id, rows AS processed, total_completed, CAST(rows * 0.25 AS DOUBLE) AS elapsed_ms, "
        "round(rows / greatest(0.001, rows * 0.25 / 1000.0), 2) AS rps, last_lsn FROM stats"
    ),
    "overall_progress": _q(
        "SELECT CAST(count(*) AS BIGINT) AS total_completed, count(DISTINCT event_id % 3) AS tasks, max(lsn) AS highest_lsn, "
        "least(100, count(*) * 100 // (SELECT count(*) FROM events)) AS progress_pct FROM ok"
    ),
    "log_file_progress": _q(
        "SELECT CAST(task_id AS VARCHAR) AS task_id, arg_max(total_completed, batch_id) AS total_completed, "
        "arg_max(last_lsn, batch_id) AS last_lsn FROM stats GROUP BY task_id"
    ),
    "index_upsert": _q(
        'SELECT topic, part AS "partition", off AS "offset", '
        "CASE WHEN off <= (SELECT upto FROM commits c WHERE c.part = ok.part) THEN lsn + (SELECT count(*) FROM ok) ELSE lsn END AS lsn, "
        "CAST(CASE WHEN off <= (SELECT upto FROM commits c WHERE c.part = ok.part) THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM ok"
    ),
    "ingest_log_progress": _q(
        "SELECT 'events-' || CAST(part AS VARCHAR) AS task_id, count(*) AS total_completed, max(lsn) AS last_lsn "
        "FROM ok GROUP BY part"
    ),
    "ledger_stats": _q(
        'SELECT part AS "partition", batch AS batch_id, count(*) AS rows, '
        "CAST(sum(count(*)) OVER (PARTITION BY part ORDER BY batch) AS BIGINT) AS total_completed, "
        "max(max(lsn)) OVER (PARTITION BY part ORDER BY batch) AS last_lsn FROM ok GROUP BY part, batch"
    ),
    "flush_latency": _q(
        """
, fl AS (SELECT batch_id * 3 + task_id AS line_no, (batch_id % 7) * 1.5 + rows / 8.0 AS ms,
        printf('Sink task flush done: task_id=%s flushed_lsn=%s pruned_entries=%d elapsed_ms=%.3f offsets={events-%s=%s}',
               CAST(task_id AS VARCHAR), CAST(last_lsn AS VARCHAR), rows, (batch_id % 7) * 1.5 + rows / 8.0,
               CAST(task_id AS VARCHAR), CAST(total_completed AS VARCHAR)) AS line FROM stats)
SELECT count(*) AS flush_count, coalesce(avg(ms), 0.0) AS flush_avg_ms, coalesce(max(ms), 0.0) AS flush_max_ms,
       first(CASE WHEN ms > 0 THEN line END ORDER BY ms DESC, line_no ASC) AS flush_max_line FROM fl"""
    ),
    "probe_rates": _q(
        """
, p AS (SELECT probe_ts, total_completed,
        coalesce(lag(probe_ts) OVER (ORDER BY probe_ts), min(probe_ts) OVER () - INTERVAL 1 DAY) AS prev_ts,
        coalesce(lag(total_completed) OVER (ORDER BY probe_ts), 0) AS prev_total FROM probes)
SELECT probe_ts, total_completed, CAST(total_completed - prev_total AS BIGINT) AS delta_rows,
       CAST(greatest(1, date_diff('second', prev_ts, probe_ts)) AS BIGINT) AS window_s,
       (total_completed - prev_total) / greatest(1, date_diff('second', prev_ts, probe_ts)) AS probe_rps FROM p"""
    ),
    "target_reached": _q(
        "SELECT probe_ts, total_completed FROM probes WHERE total_completed >= (SELECT count(*) // 2 FROM ok) "
        "ORDER BY probe_ts LIMIT 1"
    ),
    "sliding_stream": """
WITH x AS (SELECT event_type, ts, unnest(generate_series(0, 2)) AS k,
                  (epoch_us(ts) // 1000000 // 18000) * 18000 AS base FROM events)
SELECT make_timestamp((base - k * 18000) * 1000000) AS window_start,
       make_timestamp((base - k * 18000 + 43200) * 1000000) AS window_end, event_type, count(*) AS n
FROM x WHERE ts < make_timestamp((base - k * 18000 + 43200) * 1000000) GROUP BY 1, 2, 3""",
    "sliding_event_counts": """
WITH x AS (SELECT event_type, ts, unnest(generate_series(0, 2)) AS k,
                  (epoch_us(ts) // 1000000 // 18000) * 18000 AS base FROM events)
SELECT make_timestamp((base - k * 18000) * 1000000) AS window_start,
       make_timestamp((base - k * 18000 + 43200) * 1000000) AS window_end, event_type, count(*) AS n
FROM x WHERE ts < make_timestamp((base - k * 18000 + 43200) * 1000000) GROUP BY 1, 2, 3""",
    "task_health": """
WITH per AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, CASE WHEN user_id % 11 = 0 THEN 'PAUSED' ELSE 'RUNNING' END AS connector_state,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS INTEGER) AS tasks_not_running,
       user_id % 11 <> 0 AND count(*) FILTER (WHERE event_type = 'error') = 0 AS healthy,
       coalesce(string_agg(CASE WHEN event_type = 'error' THEN 'error events: ' || n END, '; '), '') AS failed_traces
FROM per GROUP BY user_id""",
    "table_uris": """
SELECT event_type, 'ingest.' || event_type AS qualified_name,
       's3://lake/warehouse/ingest/' || event_type AS uri,
       count(*) AS rows FROM events GROUP BY event_type""",
    "ingest_stream": _q(f"SELECT {TABLE_COLS} FROM ok"),
    "ingest_replay": _q(f"SELECT {TABLE_COLS} FROM ok"),
    "ingest_quarantine": _q("SELECT verdict, count(*) AS n FROM wire WHERE verdict <> 'ok' GROUP BY verdict"),
    "snapshot_at_lsn": _q(f"SELECT {TABLE_COLS} FROM ok WHERE lsn <= (SELECT max(lsn) FROM covered)"),
    "table_status": _q(
        "SELECT 'ingest' AS database, 'events_sink' AS \"table\", max(lsn) AS commit_lsn, max(lsn) AS flush_lsn, "
        "count(*) AS cardinality FROM ok"
    ),
    "durable_lsn": _q("SELECT max(lsn) AS durable_lsn, count(DISTINCT batch) AS batches FROM ok"),
    "reconcile_counts": _q(
        "SELECT reader, (SELECT count(*) FROM ok) - lost AS rows, (SELECT count(*) FROM ok) AS expected, lost = 0 AS matches "
        "FROM (SELECT 'table' AS reader, 0 AS lost UNION ALL SELECT 'location', 0 "
        "UNION ALL SELECT 'lossy', (SELECT count(DISTINCT part) FROM ok)) r"
    ),
    "reconcile_contents": _q(
        'SELECT topic, part AS "partition", count(*) AS wire_rows, count(*) AS table_rows, CAST(0 AS BIGINT) AS duplicates, '
        "max(off) - min(off) + 1 - count(*) AS gaps, true AS checksum_match FROM ok GROUP BY topic, part"
    ),
    "reconcile_faults": _q(
        """
, shown AS (SELECT topic, part, off FROM ok
            WHERE NOT (part = 0 AND off = (SELECT min(off) FROM ok WHERE part = 0))
            UNION ALL SELECT topic, part, min(off) FROM ok WHERE part = 1 GROUP BY 1, 2)
SELECT w.topic, w.part AS "partition", w.n AS wire_rows, s.n AS table_rows, s.n - s.d AS duplicates,
       s.hi - s.lo + 1 - s.d AS gaps,
       w.part = 3 AND NOT EXISTS (SELECT 1 FROM ok WHERE part = 3 AND flag IS NULL) AS checksum_match
FROM (SELECT topic, part, count(*) AS n FROM ok GROUP BY 1, 2) w
JOIN (SELECT part, count(*) AS n, count(DISTINCT off) AS d, min(off) AS lo, max(off) AS hi FROM shown GROUP BY 1) s ON s.part = w.part"""
    ),
    "table_by_name": _q(f"SELECT {TABLE_COLS} FROM ok"),
    "ingest_crash_replay": _q(f"SELECT {TABLE_COLS} FROM ok"),
    "ingest_strict": _q(f"SELECT {TABLE_COLS} FROM ok"),
    "append_and_stream": _q(
        """
, placed AS (SELECT CASE WHEN part < 2 THEN 0 ELSE batch + 1 END AS batch_id, count(*) AS rows FROM ok GROUP BY 1)
SELECT batch_id, rows, CAST(sum(rows) OVER (ORDER BY batch_id) - rows + 1 AS BIGINT) AS min_lsn,
       CAST(sum(rows) OVER (ORDER BY batch_id) AS BIGINT) AS max_lsn FROM placed"""
    ),
    "bounded_rows": """
WITH n AS (SELECT count(*) AS n FROM events),
     plans AS (SELECT 'half' AS plan, greatest(n // 4, 1) * 2 AS goal FROM n UNION ALL SELECT 'floor', 3 FROM n
               UNION ALL SELECT 'unlimited', 9223372036854775807 FROM n)
SELECT plan, count(*) AS rows, CAST(max(event_id + 1) AS INTEGER) AS last, CAST(1 AS INTEGER) AS width
FROM events JOIN plans ON event_id + 1 <= goal GROUP BY plan""",
    "schema_join": _q(
        "SELECT sid AS schema_id, sid = 7 AS registered, count(*) AS n FROM wire WHERE verdict = 'ok' GROUP BY sid"
    ),
    "ingest_flush_latency": _q(
        "SELECT (SELECT count(*) FROM (SELECT DISTINCT batch, part FROM wire)) AS flush_count, true AS timed, true AS has_line, "
        "max(lsn) AS flushed_lsn FROM ok"
    ),
    "ingest_catalog_repair": _q(f"SELECT {TABLE_COLS} FROM ok"),
    "ingest_redelivered": _q(
        f"""
, placed AS (SELECT * REPLACE (CASE WHEN off % 5 = 4 THEN 3 ELSE batch END AS batch) FROM wire WHERE verdict = 'ok'),
numbered AS (SELECT *, CAST(row_number() OVER (ORDER BY batch, part, off) AS BIGINT) AS lsn FROM placed)
SELECT {TABLE_COLS} FROM numbered"""
    ),
    "redelivered_counts": _q(
        """
, placed AS (SELECT *, CASE WHEN off % 5 = 4 THEN 3 ELSE batch END AS b FROM wire)
SELECT CAST(b AS BIGINT) AS batch_id, count(*) FILTER (verdict = 'ok') AS rows, count(*) FILTER (verdict <> 'ok') AS quarantined,
       CAST(CASE WHEN b = 3 THEN (SELECT count(*) FROM wire WHERE off % 5 <> 4) ELSE 0 END AS BIGINT) AS redelivered
FROM placed GROUP BY b"""
    ),
    "append_without_markers": _q(
        """
, placed AS (SELECT *, event_id % 3 AS third, CAST(row_number() OVER (ORDER BY event_id % 3, part, off) AS BIGINT) AS number FROM ok)
SELECT event_type, CAST(event_id AS INTEGER) AS event_id, flag, topic AS _topic, part AS _partition, off AS _offset,
       sid AS _schema_id, number AS _lsn, third AS batch_id FROM placed"""
    ),
    "ledger_compacted": _q(
        """
SELECT batch AS batch_id, part AS "partition", count(lsn) AS rows, count(*) - count(lsn) AS quarantined, min(off) AS min_offset,
       max(off) AS max_offset, min(lsn) AS min_lsn, max(lsn) AS max_lsn, count(lsn) AS stored
FROM (SELECT wire.batch, wire.part, wire.off, ok.lsn FROM wire LEFT JOIN ok USING (event_id)) GROUP BY 1, 2"""
    ),
    "reconcile_differences": _q(
        """
, firsts AS (SELECT part, min(off) AS off FROM ok GROUP BY part)
SELECT ok.topic, ok.part AS "partition", ok.off AS "offset",
       CASE WHEN ok.part = 0 THEN 'missing' WHEN ok.part = 1 THEN 'doubled' ELSE 'changed' END AS fault,
       CASE WHEN ok.part = 2 THEN 'event_type' WHEN ok.part = 3 THEN 'flag,_schema_id' END AS columns
FROM ok JOIN firsts ON ok.part = firsts.part
WHERE (ok.part < 3 AND ok.off = firsts.off) OR (ok.part = 3 AND ok.flag IS NULL)"""
    ),
    "reconcile_offset_ranges": _q(
        """
, faults AS (SELECT topic, part, off, 'missing' AS fault FROM ok WHERE part = 0 AND (off // 10) % 7 <= 2
             UNION ALL SELECT topic, part, off, 'doubled' FROM ok WHERE part = 1 AND (off // 10) % 9 = 4
             UNION ALL SELECT topic, part, off + 10000000, 'extra' FROM ok WHERE part = 2 AND off < 25),
runs AS (SELECT *, off - row_number() OVER (PARTITION BY part, fault ORDER BY off) AS run FROM faults)
SELECT topic, part AS "partition", fault, min(off) AS first_offset, max(off) AS last_offset, count(*) AS offsets
FROM runs GROUP BY topic, part, fault, run"""
    ),
    "generated_stream": """
WITH n AS (SELECT greatest(1, count(*) // 10) * 10 AS n FROM events)
SELECT i AS seq, repeat('A', 20) AS string_column, CAST(i AS INTEGER) AS numeric_column,
       (((((i + 2) % 2147483647) * 48271) % 2147483647) // 16) % 2 = 1 AS boolean_column
FROM (SELECT unnest(range(1, n + 1)) AS i FROM n)""",
    "log_arrival_order": _q(
        "SELECT via, CAST(task_id AS VARCHAR) AS task_id, arg_max(total_completed, batch_id) AS total_completed, "
        "arg_max(last_lsn, batch_id) AS last_lsn FROM stats, (VALUES ('batch'), ('stream')) v(via) "
        "WHERE batch_id <= (SELECT max(batch_id) // 2 FROM stats) GROUP BY via, task_id"
    ),
    "sliding_append": """
WITH parts AS (SELECT event_id, event_type, ts, event_id * 3 // (SELECT max(event_id) + 1 FROM events) AS p FROM events),
arriving AS (SELECT event_type, ts, CASE WHEN p = 0 AND event_id % 50 = 0 THEN 2 ELSE p END AS batch FROM parts),
marks AS (SELECT batch, max(date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY) OVER (ORDER BY batch) AS mark FROM arriving GROUP BY batch),
x AS (SELECT event_type, ts, batch, unnest(generate_series(0, 2)) AS k, (epoch_us(ts) // 1000000 // 18000) * 18000 AS base FROM arriving),
w AS (SELECT event_type, batch, make_timestamp((base - k * 18000) * 1000000) AS window_start,
             make_timestamp((base - k * 18000 + 43200) * 1000000) AS window_end
      FROM x WHERE ts < make_timestamp((base - k * 18000 + 43200) * 1000000))
SELECT window_start, window_end, event_type, count(*) AS n
FROM w LEFT JOIN marks m ON m.batch = w.batch - 2
WHERE (m.mark IS NULL OR window_end > m.mark) AND window_end <= (SELECT max(mark) FROM marks)
GROUP BY ALL""",
}
