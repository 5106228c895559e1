"""Telemetry tables derived from the test tables.

One text per table, run unchanged by Spark and by the checking engine, so both see the same
rows. ``chr(92)`` is the backslash.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampType

BINDINGS: dict[str, str] = {}

BINDINGS["cpu_samples"] = """
SELECT concat('srv-', cast(user_id % 5 AS string)) AS server_name,
       ts AS event_time_utc, ts - INTERVAL 5 HOURS AS event_time_local,
       cast(least(60, floor(value)) AS int) AS sql_service,
       cast(event_id % 41 AS int) AS idle_process,
       100 - cast(event_id % 41 AS int) - cast(least(60, floor(value)) AS int) AS non_sql_process
FROM events
"""

BINDINGS["raw_scheduler_records"] = """
SELECT concat('srv-', cast(user_id % 5 AS string)) AS server_name,
       CASE WHEN event_id % 10 = 9 THEN 'OTHER' ELSE 'RING_BUFFER_SCHEDULER_MONITOR' END AS ring_buffer_type,
       event_id * 60000 AS tick_ms, cast(100000000 AS bigint) AS now_tick_ms, ts AS sampled_at_utc,
       ts - INTERVAL 5 HOURS AS sampled_at_local,
       concat('<Record id="', cast(event_id AS string), '"><SchedulerMonitorEvent><SystemHealth><ProcessUtilization>',
              cast(cast(least(60, floor(value)) AS int) AS string), '</ProcessUtilization>',
              CASE WHEN event_id % 13 = 0 THEN '' ELSE
                   concat('<SystemIdle>', cast(event_id % 41 AS string), '</SystemIdle>') END,
              '</SystemHealth></SchedulerMonitorEvent></Record>') AS record
FROM events
"""

BINDINGS["landed_scheduler_records"] = f"""
SELECT server_name, ring_buffer_type, tick_ms, now_tick_ms, sampled_at_utc, sampled_at_local,
       CASE WHEN tick_ms % 1020000 = 0 THEN substring(record, 1, length(record) - 20)
            WHEN tick_ms % 1140000 = 0 THEN cast(NULL AS string)
            WHEN tick_ms % 1380000 = 0 THEN replace(record, '</ProcessUtilization>', 'x</ProcessUtilization>')
            ELSE record END AS record
FROM ({BINDINGS["raw_scheduler_records"]}) AS r
"""

BINDINGS["counter_samples"] = """
SELECT concat('srv-', cast(user_id % 2 AS string)) AS server_name,
       date_trunc('hour', ts) AS event_time_utc,
       CASE event_id % 8 WHEN 0 THEN 'Page life expectancy' WHEN 1 THEN 'Buffer cache hit ratio'
            WHEN 2 THEN 'Target Server Memory (KB)' WHEN 3 THEN 'Total Server Memory (KB)'
            WHEN 4 THEN 'Memory Grants Pending' WHEN 5 THEN 'Memory Grants Outstanding'
            WHEN 6 THEN 'Free Memory (KB)' ELSE 'Stolen Server Memory (KB)' END AS counter_name,
       cast(CASE event_id % 8 WHEN 0 THEN floor(value * 20) WHEN 1 THEN 100 - user_id % 9
            WHEN 2 THEN 1000 + user_id % 7 WHEN 3 THEN 850 + least(150, floor(value))
            WHEN 4 THEN user_id % 3 ELSE floor(value * 50) END AS bigint) AS counter_value
FROM events
"""

BINDINGS["raw_counters"] = """
SELECT concat('srv-', cast(user_id % 2 AS string)) AS server_name, ts AS sample_time_utc,
       CASE WHEN event_id % 9 < 3 THEN concat('INST', cast(user_id % 4 AS string), ':Buffer Manager')
            WHEN event_id % 9 < 8 THEN concat('INST', cast(user_id % 4 AS string), ':Memory Manager')
            ELSE 'General Statistics' END AS object_name,
       CASE event_id % 9 WHEN 0 THEN 'Page life expectancy' WHEN 1 THEN 'Buffer cache hit ratio'
            WHEN 2 THEN 'Lazy writes/sec' WHEN 3 THEN 'Total Server Memory (KB)'
            WHEN 4 THEN 'Memory Grants Pending' WHEN 5 THEN 'Memory Grants Outstanding'
            WHEN 6 THEN 'Free Memory (KB)' WHEN 7 THEN 'Lock Memory (KB)'
            ELSE 'Page life expectancy' END AS counter_name,
       '' AS instance_name, cast(floor(value * 50) AS bigint) AS cntr_value, 65792 AS cntr_type
FROM events
UNION ALL
SELECT concat('srv-', cast(user_id % 2 AS string)), ts, concat('INST', cast(user_id % 4 AS string), ':Buffer Manager'),
       'Buffer cache hit ratio base', '', cast(user_id % 11 * 250 AS bigint), 1073939712
FROM events
"""

BINDINGS["volume_samples"] = """
SELECT concat('srv-', cast(cast(floor(user_id / 5.0) AS bigint) % 3 AS string)) AS server_name,
       ts AS event_time_utc,
       CASE user_id % 5 WHEN 0 THEN 'C:' WHEN 1 THEN 'D:' WHEN 2 THEN concat('D:', chr(92), 'Data')
            WHEN 3 THEN 'L:' ELSE 'E:' END AS mount_path,
       CASE WHEN user_id % 5 = 4 THEN 'CD-ROM' ELSE 'Local Disk' END AS drive_type,
       concat('vol', cast(user_id % 5 AS string)) AS label,
       user_id % 5 = 2 AS is_mount_point,
       cast(1000000 AS bigint) AS size_kb,
       cast(least(990000, floor(value * 8000)) AS bigint) AS used_kb,
       1000000 - cast(least(990000, floor(value * 8000)) AS bigint) AS free_kb,
       cast((1000000 - cast(least(990000, floor(value * 8000)) AS bigint)) / 10000 AS decimal(5,2)) AS percent_free,
       cast(100 - cast((1000000 - cast(least(990000, floor(value * 8000)) AS bigint)) / 10000 AS decimal(5,2))
            AS decimal(5,2)) AS percent_used
FROM events
"""

BINDINGS["raw_volumes"] = """
SELECT concat('srv-', cast(cast(floor(user_id / 5.0) AS bigint) % 3 AS string)) AS server_name,
       ts AS event_time_utc,
       CASE user_id % 6 WHEN 0 THEN concat('C:', chr(92)) WHEN 1 THEN concat('D:', chr(92))
            WHEN 2 THEN concat('D:', chr(92), 'Data', chr(92)) WHEN 3 THEN concat('L:', chr(92))
            WHEN 4 THEN concat(chr(92), chr(92), '?', chr(92), 'Volume', chr(92)) ELSE concat('E:', chr(92)) END AS name,
       CASE user_id % 7 WHEN 0 THEN 'Recovery' WHEN 1 THEN 'RECOVERY' WHEN 2 THEN cast(NULL AS string)
            ELSE concat('vol', cast(user_id % 7 AS string)) END AS label,
       CASE user_id % 6 WHEN 0 THEN 'C:' WHEN 1 THEN 'D:' WHEN 3 THEN 'L:' WHEN 5 THEN '' ELSE cast(NULL AS string) END AS drive_letter,
       CASE WHEN user_id % 10 = 9 THEN cast(NULL AS string) ELSE 'NTFS' END AS file_system,
       cast(user_id % 8 AS int) AS drive_type,
       CASE WHEN user_id % 11 = 10 THEN cast(0 AS bigint) ELSE cast(1000000 * 1024 + (event_id % 3) * 512 AS bigint) END AS capacity_bytes,
       CASE WHEN user_id % 11 = 10 THEN cast(0 AS bigint)
            ELSE cast((1000000 - cast(least(990000, floor(value * 8000)) AS bigint)) * 1024 + (event_id % 4) * 512 AS bigint) END AS free_bytes,
       cast(4096 AS bigint) AS block_size
FROM events
"""

BINDINGS["file_latency_samples"] = """
SELECT concat('srv-', cast(cast(floor(user_id / 5.0) AS bigint) % 3 AS string)) AS server_name,
       ts AS event_time_utc, concat('db', cast(event_id % 6 AS string)) AS database_name,
       concat(CASE event_id % 5 WHEN 0 THEN 'C:' WHEN 1 THEN 'D:' WHEN 2 THEN concat('D:', chr(92), 'Data')
                   WHEN 3 THEN concat('D:', chr(92), 'Data2') ELSE 'Z:' END,
              chr(92), 'db', cast(event_id % 6 AS string), '.mdf') AS physical_name,
       cast(floor(value) AS int) AS read_latency, cast(floor(value * 2) AS int) AS write_latency,
       cast(floor(value * 1.5) AS int) AS avg_latency
FROM events
"""

BINDINGS["file_io_stats"] = """
SELECT concat('srv-', cast(l_suppkey % 3 AS string)) AS server_name,
       cast(l_suppkey % 10 AS int) AS database_id, l_linenumber AS file_id,
       cast(sum(CASE WHEN l_linenumber = 5 THEN 0 ELSE cast(floor(l_quantity) AS bigint) - 1 END) AS bigint) AS num_of_reads,
       cast(sum(CASE WHEN l_linenumber = 5 THEN 0 ELSE cast(floor(l_quantity) AS bigint) END) AS bigint) AS num_of_writes,
       cast(sum(cast(floor(l_extendedprice) AS bigint)) AS bigint) AS io_stall_read_ms,
       cast(sum(cast(floor(l_extendedprice * l_discount) AS bigint)) AS bigint) AS io_stall_write_ms,
       cast(sum(cast(floor(l_extendedprice * 2) AS bigint)) AS bigint) AS io_stall,
       cast(sum(cast(floor(l_extendedprice * 4096) AS bigint)) AS bigint) AS num_of_bytes_read,
       cast(sum(cast(floor(l_extendedprice * 1024) AS bigint)) AS bigint) AS num_of_bytes_written
FROM lineitem GROUP BY l_suppkey % 3, l_suppkey % 10, l_linenumber
"""

BINDINGS["files"] = """
SELECT server_name, database_id, file_id, concat('db', cast(database_id AS string)) AS database_name,
       CASE WHEN file_id = 2 THEN concat('D:', chr(92), 'Data', chr(92), 'db', cast(database_id AS string), '.mdf')
            ELSE concat(CASE WHEN file_id = 1 THEN 'C:' ELSE 'D:' END, chr(92), 'f', cast(file_id AS string)) END
            AS physical_name,
       CASE WHEN file_id = 7 THEN 'LOG' ELSE 'ROWS' END AS type_desc,
       cast(file_id * 1000 AS bigint) AS size_pages, cast(file_id * 10 AS bigint) AS growth_pages, is_percent_growth
FROM (SELECT concat('srv-', cast(l_suppkey % 3 AS string)) AS server_name, cast(l_suppkey % 10 AS int) AS database_id,
             l_linenumber AS file_id, bool_or(l_suppkey % 4 = 0) AS is_percent_growth
      FROM lineitem
      GROUP BY concat('srv-', cast(l_suppkey % 3 AS string)), cast(l_suppkey % 10 AS int), l_linenumber) AS f
"""

BINDINGS["file_collections"] = f"""
SELECT f.*, TIMESTAMP '2001-07-01 02:00:00' AS collected_utc FROM ({BINDINGS["files"]}) AS f WHERE file_id < 5
UNION ALL
SELECT f.*, CASE WHEN server_name = 'srv-0' THEN TIMESTAMP '2001-07-29 02:00:00' ELSE TIMESTAMP '2001-07-31 02:00:00' END
FROM ({BINDINGS["files"]}) AS f
UNION ALL
SELECT f.*, TIMESTAMP '2001-08-02 02:00:00' FROM ({BINDINGS["files"]}) AS f WHERE file_id < 3
"""

BINDINGS["log_segments"] = """
SELECT concat('srv-', cast(l_suppkey % 3 AS string)) AS server_name,
       concat('db', cast(cast(floor(sqrt(l_partkey % 900)) AS bigint) AS string)) AS database_name
FROM lineitem
"""

BINDINGS["raw_waits"] = """
SELECT concat('srv-', cast(l_suppkey % 3 AS string)) AS server_name,
       CASE l_partkey % 12 WHEN 0 THEN 'SOS_SCHEDULER_YIELD' WHEN 1 THEN 'CXPACKET' WHEN 2 THEN 'RESOURCE_SEMAPHORE'
            WHEN 3 THEN 'PAGEIOLATCH_SH' WHEN 4 THEN 'WRITELOG' WHEN 5 THEN 'LCK_M_X' WHEN 6 THEN 'LCK_M_S'
            WHEN 7 THEN 'LATCH_EX' WHEN 8 THEN 'ASYNC_NETWORK_IO' WHEN 9 THEN 'SLEEP_TASK'
            WHEN 10 THEN 'HADR_SYNC_COMMIT' ELSE 'OLEDB' END AS wait_type,
       cast(floor(l_quantity) AS bigint) - 1 AS waiting_tasks_count,
       cast(floor(l_extendedprice) AS bigint) AS wait_time_ms,
       cast(floor(l_extendedprice * l_discount) AS bigint) AS signal_wait_time_ms
FROM lineitem
"""

BINDINGS["wait_boundaries"] = """
SELECT server_name, rollup_month, snapshot_date_local, snapshot_type, wait_type, category,
       total_server_time_seconds, wait_seconds,
       cast(wait_seconds - signal_seconds AS decimal(14,2)) AS resource_seconds, signal_seconds
FROM (
SELECT concat('srv-', cast(l_suppkey % 3 AS string)) AS server_name,
       cast(date_trunc('month', l_shipdate) AS date) AS rollup_month,
       CASE l_partkey % 3 WHEN 0 THEN l_shipdate + INTERVAL 7 HOURS WHEN 1 THEN l_shipdate + INTERVAL 11 HOURS
            ELSE l_shipdate + INTERVAL 20 HOURS END AS snapshot_date_local,
       CASE WHEN l_linenumber = 7 THEN 'StartOfMonth' WHEN l_linestatus = 'F' THEN 'PreRestart' ELSE 'EndOfMonth' END AS snapshot_type,
       CASE l_partkey % 9 WHEN 0 THEN 'SOS_SCHEDULER_YIELD' WHEN 1 THEN 'CXPACKET' WHEN 2 THEN 'RESOURCE_SEMAPHORE'
            WHEN 3 THEN 'PAGEIOLATCH_SH' WHEN 4 THEN 'WRITELOG' WHEN 5 THEN 'LCK_M_X' WHEN 6 THEN 'LCK_M_S'
            WHEN 7 THEN 'LATCH_EX' ELSE 'OLEDB' END AS wait_type,
       CASE l_partkey % 9 WHEN 0 THEN 'CPU' WHEN 1 THEN 'Parallelism' WHEN 2 THEN 'Memory' WHEN 3 THEN 'Disk'
            WHEN 4 THEN 'Disk' WHEN 5 THEN 'Blocking' WHEN 6 THEN 'Blocking' WHEN 7 THEN 'Latches' ELSE 'Other' END AS category,
       cast(3600 AS double) AS total_server_time_seconds,
       cast(floor(CASE WHEN l_linenumber = 7 THEN l_extendedprice / 100 ELSE l_extendedprice END) / 100 AS decimal(14,2)) AS wait_seconds,
       cast(floor(CASE WHEN l_linenumber = 7 THEN l_extendedprice / 1000 ELSE l_extendedprice / 10 END) / 100 AS decimal(14,2)) AS signal_seconds
FROM lineitem) AS b
"""

BINDINGS["lock_wait_boundaries"] = """
SELECT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name,
       cast(date_trunc('month', o_orderdate) AS date) AS rollup_month,
       CASE WHEN o_orderkey % 10 = 0 THEN 'StartOfMonth' WHEN o_orderstatus = 'P' THEN 'PreRestart' ELSE 'EndOfMonth' END AS snapshot_type,
       cast(o_custkey % 4 AS int) AS database_id,
       CASE WHEN o_custkey % 4 = 0 THEN 'tempdb' ELSE concat('db', cast(o_custkey % 4 AS string)) END AS database_name,
       cast(floor(CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice / 1000 ELSE o_totalprice END) AS bigint) AS row_lock_wait_ms,
       cast(floor(CASE WHEN o_orderkey % 10 = 0 THEN 0 WHEN o_orderstatus = 'F' THEN o_totalprice * 3 ELSE o_totalprice / 2 END) AS bigint) AS page_lock_wait_ms,
       cast(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 1000 END AS bigint) AS total_processor_time_seconds
FROM orders
"""

BINDINGS["index_stats"] = """
SELECT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name, cast(o_custkey % 4 AS int) AS database_id,
       cast(floor(o_totalprice) AS bigint) AS row_lock_wait_in_ms,
       cast(floor(o_totalprice / 2) AS bigint) AS page_lock_wait_in_ms
FROM orders
"""

BINDINGS["counter_resets"] = """
SELECT concat('srv-', cast(user_id % 5 AS string)) AS server_name, event_id AS sample_id,
       ts AS event_time_utc, ts - INTERVAL 5 HOURS AS event_time_local,
       event_id % 500 AS raw_counter_value
FROM events
"""

BINDINGS["cumulative_samples"] = """
WITH daily AS (
  SELECT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name, o_orderdate AS event_time_utc,
         cast(floor((year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate)) / 45.0) AS bigint) AS epoch_id,
         count(*) AS n
  FROM orders
  GROUP BY concat('srv-', cast(o_custkey % 3 AS string)), o_orderdate,
           cast(floor((year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate)) / 45.0) AS bigint))
SELECT server_name, event_time_utc, epoch_id,
       cast(sum(n) OVER (PARTITION BY server_name, epoch_id ORDER BY event_time_utc
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS value
FROM daily
"""

BINDINGS["restarts"] = f"""
SELECT server_name, min(event_time_utc) - INTERVAL 1 MINUTE AS restart_ts
FROM ({BINDINGS["cumulative_samples"]}) AS c
GROUP BY server_name, epoch_id
"""

BINDINGS["observed_restarts"] = """
SELECT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name,
       o_orderdate + CASE o_orderkey % 4 WHEN 0 THEN INTERVAL 29 SECONDS WHEN 1 THEN INTERVAL 30 SECONDS
                          WHEN 2 THEN INTERVAL 95 SECONDS ELSE INTERVAL 86370 SECONDS END AS start_time_utc
FROM orders
"""

BINDINGS["restart_registry"] = """
SELECT DISTINCT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name, o_orderdate AS restart_ts
FROM orders WHERE o_orderstatus = 'F'
"""

BINDINGS["properties"] = """
SELECT concat('srv-', cast(c_custkey % 50 AS string)) AS server_name,
       CASE cast(floor(c_custkey / 50.0) AS bigint) % 9 WHEN 0 THEN 'ProductMajorVersion' WHEN 1 THEN 'Edition'
            WHEN 2 THEN 'ServerName' WHEN 3 THEN 'InternalSQLName' WHEN 4 THEN 'IsClustered'
            WHEN 5 THEN 'VersionBanner' WHEN 6 THEN 'LockedPagesKB' WHEN 7 THEN 'VirtualMachineType'
            ELSE 'HostDistribution' END AS property_name,
       max(CASE cast(floor(c_custkey / 50.0) AS bigint) % 9 WHEN 0 THEN cast(11 + c_custkey % 6 AS string) WHEN 1 THEN c_mktsegment
            WHEN 2 THEN concat('host', cast(c_custkey % 50 AS string)) WHEN 3 THEN concat('host', cast(c_custkey % 25 AS string))
            WHEN 4 THEN cast(c_custkey % 2 AS string)
            WHEN 5 THEN concat('Server ', cast(2011 + c_custkey % 6 AS string), chr(10), CASE WHEN c_custkey % 5 = 0 THEN ' RTM' ELSE ' (RTM) - 11.0' END)
            WHEN 6 THEN cast(c_custkey % 3 * 1024 AS string) WHEN 7 THEN CASE WHEN c_custkey % 2 = 0 THEN 'NONE' ELSE 'HYPERVISOR' END
            ELSE concat('dist', cast(c_custkey % 4 AS string)) END) AS property_value
FROM customer
GROUP BY concat('srv-', cast(c_custkey % 50 AS string)),
       CASE cast(floor(c_custkey / 50.0) AS bigint) % 9 WHEN 0 THEN 'ProductMajorVersion' WHEN 1 THEN 'Edition'
            WHEN 2 THEN 'ServerName' WHEN 3 THEN 'InternalSQLName' WHEN 4 THEN 'IsClustered'
            WHEN 5 THEN 'VersionBanner' WHEN 6 THEN 'LockedPagesKB' WHEN 7 THEN 'VirtualMachineType'
            ELSE 'HostDistribution' END
"""

BINDINGS["configs"] = """
SELECT DISTINCT concat('srv-', cast(c_custkey % 50 AS string)) AS server_name,
       CASE c_nationkey % 7 WHEN 0 THEN 'optimize for ad hoc workloads' WHEN 1 THEN 'backup compression default'
            WHEN 2 THEN 'cost threshold for parallelism' WHEN 3 THEN 'max degree of parallelism'
            WHEN 4 THEN 'min server memory (MB)' WHEN 5 THEN 'max server memory (MB)' ELSE 'fill factor (%)' END AS name,
       CASE WHEN c_nationkey % 7 < 2 THEN cast(c_custkey % 2 AS int) ELSE cast(c_custkey % 16 * 1024 AS int) END AS value
FROM customer
"""

BINDINGS["availability_groups"] = """
SELECT concat('srv-', cast(c_custkey % 50 AS string)) AS server_name, concat('ag', cast(c_nationkey AS string)) AS group_name
FROM customer WHERE c_nationkey = 3 AND c_mktsegment = 'BUILDING'
"""

BINDINGS["schedulers"] = """
SELECT concat('srv-', cast(s_suppkey % 3 AS string)) AS server_name,
       CASE WHEN s_nationkey % 5 = 4 THEN 64 ELSE s_nationkey % 5 END AS parent_node_id,
       CASE s_suppkey % 4 WHEN 0 THEN 'VISIBLE OFFLINE' WHEN 1 THEN 'HIDDEN ONLINE' ELSE 'VISIBLE ONLINE' END AS status
FROM supplier
"""

BINDINGS["database_settings"] = """
SELECT concat('srv-', cast(s_suppkey % 3 AS string)) AS server_name, cast(s_suppkey AS int) AS database_id,
       CASE WHEN s_suppkey = 2 THEN 'tempdb' ELSE concat('db', cast(s_suppkey AS string)) END AS database_name,
       CASE s_nationkey % 3 WHEN 0 THEN 'SIMPLE' WHEN 1 THEN 'FULL' ELSE 'BULK_LOGGED' END AS recovery_model,
       CASE WHEN s_nationkey % 4 = 0 THEN 'NONE' ELSE 'CHECKSUM' END AS page_verify,
       s_nationkey % 5 = 0 AS is_auto_shrink_on, s_nationkey % 7 = 0 AS is_auto_close_on
FROM supplier
"""

BINDINGS["backups"] = """
SELECT concat('srv-', cast(o_custkey % 120 % 3 AS string)) AS server_name,
       concat('db', cast(o_custkey % 120 AS string)) AS database_name,
       CASE WHEN o_orderstatus = 'F' THEN 'D' WHEN o_orderstatus = 'O' THEN 'L' ELSE 'I' END AS backup_type,
       o_orderdate AS backup_finish_ts
FROM orders
"""

BINDINGS["integrity_checks"] = """
SELECT concat('srv-', cast(s_suppkey % 3 AS string)) AS server_name, concat('db', cast(s_suppkey AS string)) AS database_name,
       CASE s_suppkey % 5 WHEN 0 THEN '1900-01-01 00:00:00.000' WHEN 1 THEN 'unreadable'
            ELSE concat('2001-07-', CASE WHEN s_nationkey < 9 THEN '0' ELSE '' END, cast(s_nationkey + 1 AS string), ' 03:15:00.000') END
            AS last_known_good
FROM supplier
"""

BINDINGS["requests"] = """
SELECT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name, o_orderkey AS session_id,
       CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + 3 ELSE 0 END AS blocking_session_id,
       cast(o_custkey % 4 AS int) AS database_id, 'LCK_M_X' AS wait_type,
       cast(floor(o_totalprice) AS bigint) AS wait_time_ms, o_orderpriority AS command
FROM orders
"""

BINDINGS["databases"] = """
SELECT DISTINCT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name,
       CASE WHEN o_custkey % 4 = 3 THEN 30 ELSE cast(o_custkey % 4 AS int) END AS database_id,
       concat('db', cast(o_custkey % 4 AS string)) AS database_name
FROM orders
"""

BINDINGS["collection_times"] = """
SELECT concat('srv-', cast(o_custkey % 3 AS string)) AS server_name,
       max(o_orderdate) + INTERVAL 2 HOURS AS collected_utc
FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-06-01 00:00:00' AND (month(o_orderdate) + o_custkey % 3) % 4 <> 0
GROUP BY concat('srv-', cast(o_custkey % 3 AS string)), year(o_orderdate), month(o_orderdate), day(o_orderdate) >= 16
"""

BINDINGS["log_segment_collections"] = f"""
SELECT s.server_name, t.collected_utc, s.database_name
FROM (SELECT concat('srv-', cast(l_suppkey % 3 AS string)) AS server_name,
             concat('db', cast(cast(floor(sqrt(l_partkey % 900)) AS bigint) AS string)) AS database_name,
             l_orderkey % 1500 AS segment, min(l_shipdate) AS since
      FROM lineitem
      GROUP BY concat('srv-', cast(l_suppkey % 3 AS string)),
               concat('db', cast(cast(floor(sqrt(l_partkey % 900)) AS bigint) AS string)), l_orderkey % 1500) AS s
JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = s.server_name
WHERE s.since <= t.collected_utc AND (s.segment + month(t.collected_utc)) % 11 <> 0
"""

BINDINGS["file_history"] = f"""
SELECT f.server_name, f.database_id, f.file_id, f.database_name, f.physical_name, f.type_desc,
       CASE WHEN f.file_id % 2 = 0 THEN f.size_pages + month(t.collected_utc) * 10 ELSE f.size_pages END AS size_pages,
       f.growth_pages, f.is_percent_growth AND month(t.collected_utc) < 9 AS is_percent_growth, t.collected_utc
FROM ({BINDINGS["files"]}) AS f JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = f.server_name
WHERE (f.database_id + month(t.collected_utc)) % 7 <> 0
"""

BINDINGS["property_collections"] = f"""
SELECT p.server_name, t.collected_utc, p.property_name,
       CASE WHEN p.property_name = 'Edition' AND month(t.collected_utc) > 6 THEN 'Enterprise'
            WHEN p.property_name = 'ProductMajorVersion' AND year(t.collected_utc) = 2001 THEN '15' ELSE p.property_value END AS property_value
FROM ({BINDINGS["properties"]}) AS p JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = p.server_name
WHERE (length(p.property_name) + month(t.collected_utc)) % 6 <> 0
"""

BINDINGS["config_collections"] = f"""
SELECT c.server_name, t.collected_utc, c.name, CASE WHEN month(t.collected_utc) % 3 = 0 THEN c.value + 1 ELSE c.value END AS value
FROM ({BINDINGS["configs"]}) AS c JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = c.server_name
"""

BINDINGS["scheduler_collections"] = f"""
SELECT s.server_name, t.collected_utc, s.parent_node_id,
       CASE WHEN month(t.collected_utc) % 5 = 0 AND s.status = 'VISIBLE OFFLINE' THEN 'VISIBLE ONLINE' ELSE s.status END AS status
FROM ({BINDINGS["schedulers"]}) AS s JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = s.server_name
WHERE s.parent_node_id < 4 OR month(t.collected_utc) > 3
"""

BINDINGS["database_collections"] = f"""
SELECT d.server_name, t.collected_utc, d.database_id, d.database_name,
       CASE WHEN month(t.collected_utc) > 8 THEN 'FULL' ELSE d.recovery_model END AS recovery_model, d.page_verify,
       d.is_auto_shrink_on, d.is_auto_close_on
FROM ({BINDINGS["database_settings"]}) AS d JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = d.server_name
WHERE (d.database_id + month(t.collected_utc)) % 9 <> 0
"""

BINDINGS["integrity_collections"] = f"""
SELECT i.server_name, t.collected_utc, i.database_name, i.last_known_good
FROM ({BINDINGS["integrity_checks"]}) AS i JOIN ({BINDINGS["collection_times"]}) AS t ON t.server_name = i.server_name
WHERE month(t.collected_utc) % 2 = 1
"""

BINDINGS["raw_wait_history"] = f"""
SELECT c.server_name, c.event_time_utc, c.event_time_utc - INTERVAL 5 HOURS AS event_time_local, w.wait_type,
       c.value AS waiting_tasks_count, c.value * (w.k * 700 + 1300) AS wait_time_ms, c.value * (w.k * 50 + 20) AS signal_wait_time_ms
FROM ({BINDINGS["cumulative_samples"]}) AS c
JOIN (SELECT server_name, wait_type, min(signal_wait_time_ms) % 13 AS k FROM ({BINDINGS["raw_waits"]}) AS r
      GROUP BY server_name, wait_type) AS w ON w.server_name = c.server_name
"""

BINDINGS["index_stats_history"] = f"""
SELECT c.server_name, c.event_time_utc, d.database_id, c.value * (d.database_id * 300 + 900) AS row_lock_wait_in_ms,
       c.value * (d.n % 7 * 100 + 250) AS page_lock_wait_in_ms
FROM ({BINDINGS["cumulative_samples"]}) AS c
JOIN (SELECT server_name, database_id, count(*) AS n FROM ({BINDINGS["index_stats"]}) AS i GROUP BY server_name, database_id) AS d
  ON d.server_name = c.server_name
"""

_TABLES = ["customer", "events", "lineitem", "orders", "supplier"]
_FROM = re.compile(r"\bFROM (" + "|".join(_TABLES) + r")\b")


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named telemetry table over the Parquet tables in ``sf_dir``."""
    text = BINDINGS[name]
    used = set(_FROM.findall(text))
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    table = spark.sql(_FROM.sub(r"FROM {\1}", text), **frames)
    zoned = [f.name for f in table.schema if isinstance(f.dataType, TimestampType)]
    return table.withColumns({c: table[c].cast("timestamp_ntz") for c in zoned}) if zoned else table


def bound_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table as a stream over the landed Parquet files of its source table."""
    text = BINDINGS[name]
    frames = {}
    for t in set(_FROM.findall(text)):
        schema = spark.read.parquet(f"{sf_dir}/{t}.parquet").schema
        frames[t] = spark.readStream.schema(schema).option("pathGlobFilter", f"{t}.parquet").parquet(sf_dir)
    return spark.sql(_FROM.sub(r"FROM {\1}", text), **frames)


def binder(spark: SparkSession, sf_dir: str):
    return partial(bound, spark, sf_dir)


def with_bindings(sql: str) -> str:
    """Prefix a checking query with the bindings it mentions, as common table expressions."""
    wanted = [n for n in BINDINGS if re.search(rf"\b{n}\b", sql)]
    heads = ", ".join(f"{n} AS ({BINDINGS[n].strip()})" for n in wanted)
    if not heads:
        return sql.strip()
    body = sql.strip()
    joiner = ", " if body[:5].upper() == "WITH " else " "
    return f"WITH {heads}{joiner}{body[5:] if joiner == ', ' else body}"
