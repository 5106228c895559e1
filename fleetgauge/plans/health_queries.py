"""General health queries and the report period."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.operators import calendar, health
from fleetgauge.plans.checking import AS_OF, days, stamp
from fleetgauge.plans.disk_queries import _using
from fleetgauge.sources.bindings import with_bindings



def _flags(properties, groups):
    return health.derive_system_flags(health.pivot_properties(properties), groups)


QUERIES = {
    "ge1_pivot_properties": _using("properties")(health.pivot_properties),
    "ge2_pivot_settings": _using("configs")(health.pivot_settings),
    "ge3_derive_system_flags": _using("properties", "availability_groups")(_flags),
    "ge5_scheduler_topology": _using("schedulers")(health.scheduler_topology),
    "ge7_system_health": _using("properties", "configs", "schedulers", "availability_groups")(
        lambda p, c, s, a: health.system_health(p, c, s, F.lit("2001-07-01").cast("date"), a)
    ),
    "ge8_file_flags": _using("files")(health.file_flags),
    "ge9_latest_backups": _using("backups")(health.latest_backups),
    "ge10_backup_staleness": _using("database_settings", "backups")(
        lambda d, b: health.backup_staleness(d, b, stamp(AS_OF))
    ),
    "ge11_high_segment_flag": _using("log_segments")(health.high_segment_flag),
    "ge12_last_good_check": _using("integrity_checks")(health.last_good_check),
    "ge13_database_health": _using("database_settings", "files", "log_segments", "backups", "integrity_checks")(
        lambda d, f, s, b, i: health.database_health(d, f, s, b, i, F.lit("2001-07-01").cast("date"), stamp(AS_OF))
    ),
    "dt1_report_period": _using("cumulative_samples")(lambda c: calendar.month_spine(c, stamp(AS_OF))),
}


def _property(name: str, column: str, to: str) -> str:
    value = f"max(CASE WHEN property_name = '{name}' THEN property_value END)"
    return f"{value} AS {column}" if to == "string" else f"try_cast({value} AS {to}) AS {column}"


_PIVOT = f"""props AS (SELECT server_name, {", ".join(_property(n, c, t) for n, (c, t) in health.PROPERTY_SPEC.items())}
  FROM properties GROUP BY server_name)"""
_SETTINGS = f"""settings AS (SELECT server_name, {", ".join(
    f"max(CASE WHEN name = '{n}' THEN value END) AS {c}" for n, c in health.SETTING_COLUMNS.items())}
  FROM configs WHERE name <> 'fill factor (%)' GROUP BY server_name)"""
_FLAGS = """flags AS (SELECT props.* REPLACE (
         coalesce(instance_name, 'MSSQLSERVER (Default Instance)') AS instance_name,
         is_ag_enabled = 1 AS is_ag_enabled, is_clustered = 1 AS is_clustered),
         coalesce(host_name = internal_name, false) AS is_name_matching,
         virtual_machine_type <> 'NONE' AS is_virtual_machine,
         coalesce(locked_pages_kb > 0, false) AS lock_pages_in_memory,
         server_name IN (SELECT server_name FROM availability_groups) AS is_ag_present
  FROM props)"""
_TOPOLOGY = """topology AS (SELECT server_name, cast(count(DISTINCT parent_node_id) AS int) AS numa_nodes,
         cast(count(*) FILTER (WHERE status = 'VISIBLE ONLINE') AS bigint) AS online_cpu_count,
         cast(count(*) FILTER (WHERE status = 'VISIBLE OFFLINE') AS bigint) AS offline_cpu_count,
         cast(count(*) FILTER (WHERE status IN ('VISIBLE ONLINE', 'VISIBLE OFFLINE')) AS bigint) AS allocated_cpu_count
  FROM schedulers WHERE parent_node_id < 64 GROUP BY server_name)"""
_BANNER = "replace(replace(version_banner, chr(10), ' '), chr(13), ' ')"
_SYSTEM = f"""SELECT DATE '2001-07-01' AS rollup_month, server_name, cpu_cores, host_name, host_power_plan,
       cast(physical_memory_kb // 1024 AS int) AS host_ram_mb, is_virtual_machine, numa_nodes, instance_collation, instance_name,
       is_name_matching, edition,
       CASE WHEN strpos({_BANNER}, '-') > 0 THEN left({_BANNER}, strpos({_BANNER}, '-') - 1) END AS friendly_version,
       product_version, ad_hoc_enabled <> 0 AS ad_hoc_enabled, backup_compression <> 0 AS backup_compression, cost_threshold,
       is_ag_enabled, is_ag_present, is_clustered, lock_pages_in_memory, max_dop, max_memory_mb, min_memory_mb,
       CASE WHEN coalesce(major_version, 11) >= 14 THEN coalesce(instant_file_initialization = 1, false) END AS instant_file_initialization,
       CASE WHEN coalesce(major_version, 11) >= 14 THEN host_distribution END AS host_distribution,
       CASE WHEN coalesce(major_version, 11) >= 14 THEN host_operating_system END AS host_operating_system
FROM flags LEFT JOIN settings USING (server_name) LEFT JOIN topology USING (server_name)"""
_FILE_FLAGS = """file_facts AS (SELECT server_name, database_id,
         bool_or(type_desc = 'ROWS' AND is_percent_growth) AS has_percent_autogrowth,
         bool_or(starts_with(physical_name, concat('C:', chr(92)))) AS has_files_on_c_disk
  FROM files GROUP BY server_name, database_id)"""
_LATEST = """latest AS (SELECT server_name, database_name, max(CASE WHEN backup_type = 'D' THEN backup_finish_ts END) AS last_full_backup,
         max(CASE WHEN backup_type = 'L' THEN backup_finish_ts END) AS last_log_backup
  FROM backups GROUP BY server_name, database_name)"""
_STALE = f"""stale AS (SELECT d.*, last_full_backup, last_log_backup,
         database_name <> 'tempdb' AND (last_full_backup IS NULL OR last_full_backup < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS)
           AS is_backup_overdue,
         database_name <> 'tempdb' AND recovery_model <> 'SIMPLE'
           AND (last_log_backup IS NULL OR last_log_backup < TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS) AS is_log_backup_overdue
  FROM database_settings AS d LEFT JOIN latest USING (server_name, database_name))"""
_SEGMENTS = """segments AS (SELECT server_name, database_name, cast(count(*) AS bigint) AS log_segment_count,
         count(*) > 99 AS has_high_segment_count
  FROM log_segments WHERE database_name <> 'tempdb' GROUP BY server_name, database_name)"""
_CHECKS = """checks AS (SELECT server_name, database_name,
         max(try_cast(nullif(last_known_good, '1900-01-01 00:00:00.000') AS timestamp)) AS last_good_check
  FROM integrity_checks GROUP BY server_name, database_name)"""
_DATABASE = f"""SELECT DATE '2001-07-01' AS rollup_month, server_name, database_name, recovery_model,
       page_verify <> 'CHECKSUM' AS is_page_verification_not_checksum,
       coalesce(has_high_segment_count, false) AS has_high_segment_count,
       cast(coalesce(log_segment_count, 0) AS bigint) AS log_segment_count,
       coalesce(has_percent_autogrowth, false) AS has_percent_autogrowth, is_backup_overdue, last_full_backup,
       is_log_backup_overdue, last_log_backup,
       database_id > 4 AND coalesce(has_files_on_c_disk, false) AS has_files_on_c_disk,
       is_auto_shrink_on, is_auto_close_on, last_good_check
FROM stale LEFT JOIN file_facts USING (server_name, database_id) LEFT JOIN segments USING (server_name, database_name)
LEFT JOIN checks USING (server_name, database_name)
WHERE database_name <> 'tempdb'"""

ORACLE = {
    "ge1_pivot_properties": with_bindings(f"WITH {_PIVOT} SELECT * FROM props"),
    "ge2_pivot_settings": with_bindings(f"WITH {_SETTINGS} SELECT * FROM settings"),
    "ge3_derive_system_flags": with_bindings(f"WITH {_PIVOT}, {_FLAGS} SELECT * FROM flags"),
    "ge5_scheduler_topology": with_bindings(f"WITH {_TOPOLOGY} SELECT * FROM topology"),
    "ge7_system_health": with_bindings(f"WITH {_PIVOT}, {_FLAGS}, {_SETTINGS}, {_TOPOLOGY} {_SYSTEM}"),
    "ge8_file_flags": with_bindings(f"WITH {_FILE_FLAGS} SELECT * FROM file_facts"),
    "ge9_latest_backups": with_bindings(f"WITH {_LATEST} SELECT * FROM latest"),
    "ge10_backup_staleness": with_bindings(f"WITH {_LATEST}, {_STALE} SELECT * FROM stale"),
    "ge11_high_segment_flag": with_bindings(f"WITH {_SEGMENTS} SELECT * FROM segments"),
    "ge12_last_good_check": with_bindings(f"WITH {_CHECKS} SELECT * FROM checks"),
    "ge13_database_health": with_bindings(
        f"WITH {_LATEST}, {_STALE}, {_FILE_FLAGS}, {_SEGMENTS}, {_CHECKS} {_DATABASE}"
    ),
    "dt1_report_period": with_bindings(
        f"""SELECT rollup_month, cast(last_day(rollup_month) AS date) AS end_of_month,
       cast({days("rollup_month")} * 1440 AS int) AS total_minutes
FROM (SELECT cast(unnest(generate_series(date_trunc('month', min(event_time_utc)),
                                         date_trunc('month', TIMESTAMP '{AS_OF}') - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS date) AS rollup_month
      FROM cumulative_samples) AS m"""
    ),
}
