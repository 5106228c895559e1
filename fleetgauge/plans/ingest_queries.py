"""Ingest queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from fleetgauge.functions.semantics import month_of
from fleetgauge.operators import blocking, calendar, ingest, waits
from fleetgauge.plans.checking import G, month, stamp
from fleetgauge.plans.deadlock_queries import delta_sql
from fleetgauge.plans.disk_queries import _using
from fleetgauge.plans.wait_queries import _B, _SQL
from fleetgauge.sources.bindings import with_bindings

_RUN_AT = datetime(2001, 8, 1, 0, 0, 40, 250000)
_SLICE = (date(1997, 3, 1), date(1997, 4, 1))


def _capacity(restarts, schedulers):
    return ingest.server_capacity(restarts, schedulers, stamp(_RUN_AT))


def _new_wait_rollups(wait_boundaries, lock_wait_boundaries):
    rolled_up = blocking.blocking_net(lock_wait_boundaries)
    return ingest.append_missing_rollups(
        waits.category_pivot(wait_boundaries), rolled_up, ["server_name", "rollup_month"]
    )


def _new_minutes(strict: bool):
    def query(raw, history):
        return ingest.append_new_minutes(ingest.ingest_scheduler_records(raw, history), None, strict=strict)

    return query


def _closed_deltas(samples, restarts):
    """Sums of differences by month, which have to be the nets of the boundary snapshots."""
    deltas = ingest.counter_delta(samples, "value", bucket="month", restarts=restarts)
    sums = deltas.groupBy("server_name", month_of("event_time_utc").alias("rollup_month")).agg(F.sum("delta").alias("value"))
    closed = ingest.closed_months(ingest.boundary_marks(samples, restarts)).select("server_name", "rollup_month").distinct()
    return sums.join(closed, ["server_name", "rollup_month"], "left_semi")


QUERIES = {
    "in1_month_slice": _using("cumulative_samples")(lambda df: calendar.month_slice(df, *_SLICE)),
    "in2_scheduler_records": _using("raw_scheduler_records")(ingest.ingest_scheduler_records),
    "in3_append_new_minutes": _using("raw_scheduler_records", "cpu_samples")(_new_minutes(False)),
    "in3_append_new_minutes_strict": _using("raw_scheduler_records", "cpu_samples")(_new_minutes(True)),
    "in4_ratio_counter": _using("raw_counters")(
        lambda raw: ingest.ratio_counter(raw, "Buffer cache hit ratio", "Buffer cache hit ratio base")
    ),
    "in5_select_counters": _using("raw_counters")(ingest.select_counters),
    "in5_memory_counter_samples": _using("raw_counters")(ingest.memory_counter_samples),
    "in6_file_latency": _using("file_io_stats", "files")(
        lambda io, files: ingest.file_latency(io, files.drop("is_percent_growth").distinct())
    ),
    "in7_normalize_volumes": _using("raw_volumes")(ingest.normalize_volumes),
    "in8_classify_waits": _using("raw_waits", "restarts", "schedulers")(
        lambda raw, r, s: ingest.classify_waits(raw, _capacity(r, s))
    ),
    "in9_server_capacity": _using("restarts", "schedulers")(_capacity),
    "in10_blocked_sessions": _using("requests", "databases")(ingest.blocked_sessions),
    "in11_lock_waits_by_database": _using("index_stats", "databases", "restarts", "schedulers")(
        lambda i, d, r, s: ingest.lock_waits_by_database(i, d, _capacity(r, s))
    ),
    "in12_register_restarts": _using("observed_restarts", "restart_registry")(
        lambda seen, registry: ingest.register_restarts(seen, registry, stamp(_RUN_AT))
    ),
    "in13_counter_delta": _using("counter_resets")(
        lambda df: ingest.counter_delta(df, order=["event_time_utc", "sample_id"])
    ),
    "in13_counter_delta_history": _using("cumulative_samples")(
        lambda df: ingest.counter_delta(df, "value", bucket="month")
    ),
    "in13_counter_delta_restarts": _using("cumulative_samples", "restarts")(
        lambda df, r: ingest.counter_delta(df, "value", bucket="month", restarts=r)
    ),
    "in13_monthly_delta_sum": _using("cumulative_samples", "restarts")(_closed_deltas),
    "in14_boundary_snapshots": _using("cumulative_samples", "restarts")(ingest.boundary_snapshots),
    "in14_monthly_net": _using("cumulative_samples", "restarts")(
        lambda c, r: waits.boundary_net(ingest.closed_months(ingest.boundary_snapshots(c, r)), ["server_name", "rollup_month"], ["value"])
    ),
    "in15_append_missing_rollups": _using("wait_boundaries", "lock_wait_boundaries")(_new_wait_rollups),
}


def _minute(ts: str) -> str:
    return f"date_trunc('minute', {ts} + INTERVAL 30 SECONDS)"


_RECORDS = """records AS (
  SELECT server_name, sampled_at_utc - to_milliseconds(now_tick_ms - tick_ms) AS event_time_utc,
         sampled_at_local - to_milliseconds(now_tick_ms - tick_ms) AS event_time_local, sql_service, idle_process,
         100 - idle_process - sql_service AS non_sql_process
  FROM (SELECT *, cast(nullif(regexp_extract(record, '<ProcessUtilization>([0-9]+)<', 1), '') AS int) AS sql_service,
               cast(nullif(regexp_extract(record, '<SystemIdle>([0-9]+)<', 1), '') AS int) AS idle_process
        FROM raw_scheduler_records WHERE ring_buffer_type = 'RING_BUFFER_SCHEDULER_MONITOR') AS r)"""
_FRESH = f"""fresh AS (
  SELECT *, row_number() OVER (PARTITION BY server_name, {_minute("event_time_utc")} ORDER BY event_time_utc) AS rn
  FROM records AS r
  WHERE NOT EXISTS (SELECT 1 FROM cpu_samples AS h WHERE h.server_name = r.server_name
                    AND {_minute("h.event_time_utc")} = {_minute("r.event_time_utc")}))"""
_COUNTER = """c.server_name, c.sample_time_utc AS event_time_utc, c.object_name, c.counter_name, c.instance_name"""
_RATIO = f"""SELECT {_COUNTER}, CASE WHEN b.cntr_value = 0 THEN NULL ELSE c.cntr_value * 100 // b.cntr_value END AS counter_value,
       c.cntr_type AS counter_type
FROM raw_counters AS c JOIN raw_counters AS b ON b.server_name = c.server_name AND b.sample_time_utc = c.sample_time_utc
     AND b.object_name = c.object_name AND b.counter_name = 'Buffer cache hit ratio base'
WHERE c.counter_name = 'Buffer cache hit ratio' AND c.object_name LIKE '%Buffer Manager%'"""
_SELECTED = f"""SELECT {_COUNTER}, c.cntr_value AS counter_value, c.cntr_type AS counter_type
FROM raw_counters AS c
WHERE c.object_name LIKE '%Buffer Manager%' AND c.counter_name = 'Page life expectancy'
   OR c.object_name LIKE '%Memory Manager%' AND c.counter_name IN ('Memory Grants Pending', 'Memory Grants Outstanding',
      'Target Server Memory (KB)', 'Total Server Memory (KB)', 'Free Memory (KB)', 'Stolen Server Memory (KB)')"""


def _even(num: str, den: str) -> str:
    """Integer quotient, halves to even."""
    return (
        f"(({num}) // ({den}) + CASE WHEN 2 * (({num}) % ({den})) > ({den}) OR (2 * (({num}) % ({den})) = ({den})"
        f" AND (({num}) // ({den})) % 2 = 1) THEN 1 ELSE 0 END)"
    )


_VOLUMES = f"""SELECT event_time_utc, server_name, rtrim(name, chr(92)) AS mount_path, label,
       CASE drive_type WHEN 2 THEN 'Removable Disk' WHEN 3 THEN 'Local Disk' WHEN 4 THEN 'Network Drive' WHEN 5 THEN 'CD-ROM'
            ELSE 'RAM Disk' END AS drive_type,
       coalesce(drive_letter, '') = '' AS is_mount_point, size_kb, free_kb, size_kb - free_kb AS used_kb, percent_free,
       cast(100 - percent_free AS decimal(5,2)) AS percent_used, block_size AS cluster_size_bytes
FROM (SELECT *, CASE WHEN size_kb = 0 THEN cast(0 AS decimal(5,2))
                     ELSE cast(cast({_even("free_kb * 10000", "size_kb")} AS decimal(7,0)) / 100 AS decimal(5,2)) END AS percent_free
      FROM (SELECT *, {_even("capacity_bytes", "1024")} AS size_kb, {_even("free_bytes", "1024")} AS free_kb
            FROM raw_volumes) AS s) AS p
WHERE drive_type BETWEEN 2 AND 6 AND file_system IS NOT NULL AND lower(coalesce(label, '')) <> 'recovery'
  AND (coalesce(drive_letter, '') <> '' OR (substr(name, 2, 1) = ':' AND substr(name, 3, 1) = chr(92)))"""

_CAPACITY = f"""capacity AS (
  SELECT s.server_name, uptime_seconds, processor_count, cast(uptime_seconds * processor_count AS double) AS total_server_time_seconds
  FROM (SELECT server_name, cast(count(*) FILTER (WHERE status = 'VISIBLE ONLINE') AS int) AS processor_count
        FROM schedulers GROUP BY server_name) AS s
  LEFT JOIN (SELECT server_name, greatest(1, date_diff('second', max(restart_ts), TIMESTAMP '{_RUN_AT}')) AS uptime_seconds
             FROM restarts GROUP BY server_name) AS r USING (server_name))"""


def _names(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _category_case() -> str:
    lines = []
    for category, rule in ingest.WAIT_CATEGORIES:
        tests = [f"wait_type LIKE '{p}'" for p in rule.get("like", [])]
        if "names" in rule:
            tests.append(f"wait_type IN {_names(rule['names'])}")
        lines.append(f"WHEN {' OR '.join(tests)} THEN '{category}'")
    return f"CASE {' '.join(lines)} ELSE 'Other' END"


def _rounded(ms: str) -> str:
    return f"cast(cast(({ms} + 5) // 10 AS double) / 100 AS decimal(14,2))"


_CLASSIFIED = f"""SELECT server_name, total_server_time_seconds, wait_type, {_category_case()} AS category,
       {_rounded("wait_time_ms")} AS wait_seconds, {_rounded("wait_time_ms - signal_wait_time_ms")} AS resource_seconds,
       {_rounded("signal_wait_time_ms")} AS signal_seconds,
       cast(round(cast(wait_time_ms AS double) / 1000 / total_server_time_seconds * 100, 2) AS decimal(18,2)) AS total_wait_pct,
       waiting_tasks_count
FROM raw_waits JOIN capacity USING (server_name)
WHERE waiting_tasks_count > 0 AND wait_type NOT IN {_names(ingest.BENIGN_WAITS)}"""

_UPTIME = """uptime AS (
  SELECT c.*, (SELECT max(r.restart_ts) FROM restarts AS r
               WHERE r.server_name = c.server_name AND r.restart_ts <= c.event_time_utc) AS u
  FROM cumulative_samples AS c)"""
BOUNDARIES = f"""{_UPTIME},
stepped AS (
  SELECT *, {month("event_time_utc")} AS own, lead({month("event_time_utc")}) OVER w AS opens, lead(u) OVER w AS next_u
  FROM uptime WINDOW w AS (PARTITION BY server_name ORDER BY event_time_utc)),
marked AS (
  SELECT *, 'EndOfMonth' AS snapshot_type, own AS rollup_month FROM stepped WHERE opens <> own
  UNION ALL
  SELECT *, 'StartOfMonth', opens FROM stepped WHERE opens <> own AND next_u IS NOT DISTINCT FROM u
  UNION ALL
  SELECT *, 'PreRestart', own FROM stepped WHERE opens = own AND next_u IS DISTINCT FROM u),
boundaries AS (
  SELECT server_name, event_time_utc AS snapshot_date_utc, snapshot_type, rollup_month, epoch_id, value FROM marked)"""

_NET = f"""WITH {BOUNDARIES}
SELECT {G}, cast(sum(CASE WHEN snapshot_type = 'StartOfMonth' THEN -abs(value) ELSE value END) AS bigint) AS value
FROM boundaries GROUP BY {G} HAVING count(CASE WHEN snapshot_type = 'EndOfMonth' THEN 1 END) > 0"""

ORACLE = {
    "in1_month_slice": with_bindings(
        f"""SELECT * FROM cumulative_samples
WHERE event_time_utc >= TIMESTAMP '{_SLICE[0]} 00:00:00' AND event_time_utc < TIMESTAMP '{_SLICE[1]} 00:00:00'"""
    ),
    "in2_scheduler_records": with_bindings(f"WITH {_RECORDS} SELECT * FROM records"),
    "in3_append_new_minutes": with_bindings(f"WITH {_RECORDS}, {_FRESH} SELECT * EXCLUDE (rn) FROM fresh"),
    "in3_append_new_minutes_strict": with_bindings(
        f"WITH {_RECORDS}, {_FRESH} SELECT * EXCLUDE (rn) FROM fresh WHERE rn = 1"
    ),
    "in4_ratio_counter": with_bindings(_RATIO),
    "in5_select_counters": with_bindings(_SELECTED),
    "in5_memory_counter_samples": with_bindings(f"{_RATIO} UNION ALL {_SELECTED}"),
    "in6_file_latency": with_bindings(
        """SELECT server_name, database_name, physical_name, left(physical_name, 2) AS drive,
       CASE WHEN num_of_reads = 0 THEN 0 ELSE io_stall_read_ms // num_of_reads END AS read_latency,
       CASE WHEN num_of_writes = 0 THEN 0 ELSE io_stall_write_ms // num_of_writes END AS write_latency,
       CASE WHEN num_of_reads + num_of_writes = 0 THEN 0 ELSE io_stall // (num_of_reads + num_of_writes) END AS avg_latency,
       CASE WHEN num_of_reads + num_of_writes = 0 THEN 0
            ELSE (num_of_bytes_read + num_of_bytes_written) // (num_of_reads + num_of_writes) // 1024 END AS avg_kb_per_transfer
FROM file_io_stats JOIN (SELECT DISTINCT server_name, database_id, file_id, database_name, physical_name FROM files) AS f
     USING (server_name, database_id, file_id)"""
    ),
    "in7_normalize_volumes": with_bindings(_VOLUMES),
    "in8_classify_waits": with_bindings(f"WITH {_CAPACITY} {_CLASSIFIED}"),
    "in9_server_capacity": with_bindings(f"WITH {_CAPACITY} SELECT * FROM capacity"),
    "in10_blocked_sessions": with_bindings(
        """SELECT r.server_name, r.session_id AS blocked_session_id, r.blocking_session_id, r.wait_type, r.wait_time_ms,
       r.database_id, d.database_name, r.command AS blocked_command, b.command AS blocking_command
FROM requests AS r JOIN databases AS d ON d.server_name = r.server_name AND d.database_id = r.database_id
LEFT JOIN requests AS b ON b.server_name = r.server_name AND b.session_id = r.blocking_session_id
WHERE r.blocking_session_id <> 0"""
    ),
    "in11_lock_waits_by_database": with_bindings(
        f"""WITH {_CAPACITY}
SELECT server_name, database_id, database_name, row_lock_wait_ms, page_lock_wait_ms,
       row_lock_wait_ms + page_lock_wait_ms AS total_blocking_wait_ms, uptime_seconds, processor_count,
       cast(total_server_time_seconds AS bigint) AS total_processor_time_seconds
FROM (SELECT server_name, database_id, cast(sum(row_lock_wait_in_ms) AS bigint) AS row_lock_wait_ms,
             cast(sum(page_lock_wait_in_ms) AS bigint) AS page_lock_wait_ms
      FROM index_stats GROUP BY server_name, database_id) AS s
LEFT JOIN databases USING (server_name, database_id) LEFT JOIN capacity USING (server_name)"""
    ),
    "in12_register_restarts": with_bindings(
        f"""SELECT DISTINCT server_name, {_minute("start_time_utc")} AS restart_ts,
       {_minute(f"TIMESTAMP '{_RUN_AT}'")} AS run_ts
FROM observed_restarts AS o
WHERE NOT EXISTS (SELECT 1 FROM restart_registry AS g WHERE g.server_name = o.server_name
                  AND g.restart_ts = {_minute("o.start_time_utc")})"""
    ),
    "in13_counter_delta": with_bindings(
        f"SELECT * EXCLUDE (before) FROM ({delta_sql('raw_counter_value', 'event_time_utc, sample_id', 'counter_resets')}) AS d"
    ),
    "in13_counter_delta_history": with_bindings(
        f"SELECT * EXCLUDE (before) FROM ({delta_sql('value', 'event_time_utc', 'cumulative_samples')}) AS d"
    ),
    "in14_boundary_snapshots": with_bindings(f"WITH {BOUNDARIES} SELECT * FROM boundaries"),
    "in13_counter_delta_restarts": with_bindings(
        f"""WITH {_UPTIME}
SELECT server_name, event_time_utc, epoch_id, value,
       CASE WHEN u IS NOT NULL AND (last_time IS NULL OR last_time < u) THEN value WHEN last_time IS NULL THEN 0
            WHEN value < last_value THEN value ELSE value - last_value END AS delta
FROM (SELECT *, lag(value) OVER w AS last_value, lag(event_time_utc) OVER w AS last_time
      FROM uptime WINDOW w AS (PARTITION BY server_name ORDER BY event_time_utc)) AS x"""
    ),
    "in13_monthly_delta_sum": with_bindings(_NET),
    "in14_monthly_net": with_bindings(_NET),
    "in15_append_missing_rollups": with_bindings(
        f"""WITH {_B} SELECT * FROM ({_SQL["wa4_category_pivot"]}) AS n
WHERE NOT EXISTS (SELECT 1 FROM lock_wait_boundaries AS x
                  WHERE x.server_name = n.server_name AND x.rollup_month = n.rollup_month AND x.database_name <> 'tempdb')"""
    ),
}
