"""Column layouts of the stored tables.

Times are UTC wall-clock (or local, with the suffix ``_local``). ``conform`` casts a
DataFrame to one of these layouts just before it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_SECONDS = "decimal(18,2)"
_PCT = "decimal(18,2)"


def _columns(kind: str, names: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names.split())


_STAMPS = "generated_utc timestamp_ntz, generated_local timestamp_ntz"
_SAMPLE = "server_name string, event_time_utc timestamp_ntz, event_time_local timestamp_ntz"
_ROLLUP = "server_name string, rollup_month date"

SCHEMAS: dict[str, str] = {
    "restart_epochs": "server_name string, restart_ts timestamp_ntz, run_ts timestamp_ntz",
    "cpu_samples": f"{_SAMPLE}, {_columns('int', 'sql_service idle_process non_sql_process')}",
    "counter_samples": (
        f"{_SAMPLE}, {_columns('string', 'object_name counter_name instance_name')}, counter_value bigint, counter_type int"
    ),
    "file_latency_samples": (
        f"{_SAMPLE}, {_columns('string', 'database_name physical_name drive')}, "
        f"{_columns('bigint', 'read_latency write_latency avg_latency avg_kb_per_transfer')}"
    ),
    "volume_samples": (
        f"{_SAMPLE}, {_columns('string', 'mount_path label drive_type')}, is_mount_point boolean, "
        f"{_columns('bigint', 'size_kb free_kb used_kb')}, {_columns('decimal(5,2)', 'percent_free percent_used')}, "
        "cluster_size_bytes bigint"
    ),
    "wait_samples": (
        f"{_SAMPLE}, total_server_time_seconds double, wait_type string, category string, "
        f"{_columns('decimal(14,2)', 'wait_seconds resource_seconds signal_seconds')}, "
        f"total_wait_pct {_PCT}, waiting_tasks_count bigint"
    ),
    "wait_boundaries": (
        f"{_ROLLUP}, snapshot_date_utc timestamp_ntz, snapshot_date_local timestamp_ntz, snapshot_type string, "
        "total_server_time_seconds double, wait_type string, category string, "
        f"{_columns('decimal(14,2)', 'wait_seconds resource_seconds signal_seconds')}, "
        f"total_wait_pct {_PCT}, waiting_tasks_count bigint"
    ),
    "lock_wait_samples": (
        f"{_SAMPLE}, database_id int, database_name string, {_columns('bigint', 'row_lock_wait_ms page_lock_wait_ms')}, "
        f"{_columns('bigint', 'total_blocking_wait_ms uptime_seconds')}, processor_count int, "
        "total_processor_time_seconds bigint"
    ),
    "blocked_sessions": (
        f"{_SAMPLE}, {_columns('bigint', 'blocked_session_id blocking_session_id')}, wait_type string, "
        "wait_time_ms bigint, database_id int, database_name string, sql_handle binary, "
        f"{_columns('string', 'blocked_command blocking_command')}"
    ),
    "lock_wait_boundaries": (
        f"{_ROLLUP}, snapshot_date_utc timestamp_ntz, snapshot_date_local timestamp_ntz, snapshot_type string, "
        f"database_id int, database_name string, {_columns('bigint', 'row_lock_wait_ms page_lock_wait_ms')}, "
        f"{_columns('bigint', 'total_blocking_wait_ms uptime_seconds')}, processor_count int, "
        "total_processor_time_seconds bigint"
    ),
    "counter_deltas": f"{_SAMPLE}, sample_id bigint, raw_counter_value bigint, delta bigint",
    "cpu_monthly": (
        f"{_ROLLUP}, expected_points int, collected_points bigint, accuracy_percent {_PCT}, "
        + _columns(
            "decimal(5,2)",
            "avg_total_cpu peak_total_cpu p90_total_cpu median_service_cpu median_non_service_cpu median_total_cpu "
            "load_above_median_service load_above_median_non_service load_above_median_total p90_service_cpu "
            "p90_non_service_cpu",
        )
        + ", pct_in_top10_total decimal(7,2), saturation_hours int, worst_hour_start timestamp_ntz, "
        f"{_columns(_PCT, 'service_percent_of_total non_service_percent_of_total')}, {_STAMPS}, "
        "report_generation_time_method int"
    ),
    "memory_monthly": (
        f"{_ROLLUP}, expected_points int, collected_points bigint, accuracy_percent {_PCT}, "
        f"{_columns('decimal(10,4)', 'avg_steady_state_ratio min_steady_state_ratio')}, "
        f"{_columns(_PCT, 'pct_below_90pct_steady pct_with_grants_pending')}, max_grants_pending bigint, "
        f"{_columns('bigint', 'median_ple ple_5th_percentile')}, {_columns(_PCT, 'pct_ple_below_600 pct_ple_below_300')}, "
        f"avg_bchr decimal(10,4), min_bchr bigint, pct_bchr_below_95 {_PCT}, {_STAMPS}"
    ),
    "deadlock_monthly": (
        f"{_ROLLUP}, total_events bigint, {_columns(_PCT, 'avg_per_day avg_per_week')}, busiest_day date, "
        "busiest_day_count bigint, month_over_month_delta bigint, zero_event_days int, peak_hour_local int, "
        f"peak_hour_label string, peak_hour_count bigint, {_STAMPS}"
    ),
    "blocking_monthly": (
        f"{_ROLLUP}, database_id int, database_name string, "
        f"{_columns(_SECONDS, 'row_lock_wait_seconds page_lock_wait_seconds total_blocking_wait_seconds')}, "
        f"top_blocking_type string, {_columns(_PCT, 'top_blocking_type_pct pct_of_instance_blocking')}, "
        f"rank_within_instance int, pct_of_total_processor_time {_PCT}, "
        f"{_columns(_PCT, 'mom_blocking_change_pct mom_row_lock_change_pct mom_page_lock_change_pct')}, "
        "created_at_utc timestamp_ntz"
    ),
    "wait_monthly": (
        f"{_ROLLUP}, {_columns(_SECONDS, 'total_resource_seconds total_signal_seconds')}, "
        "signal_to_resource_ratio decimal(18,4), "
        + _columns(
            _SECONDS,
            "total_wait_seconds cpu_wait_seconds memory_wait_seconds disk_wait_seconds blocking_wait_seconds "
            "other_wait_seconds cpu_wait_pct memory_wait_pct disk_wait_pct blocking_wait_pct other_wait_pct",
        )
        + ", "
        + ", ".join(
            f"top_wait_type_{i} string, top_wait_type_{i}_seconds {_SECONDS}, top_wait_type_{i}_pct {_PCT}"
            for i in (1, 2, 3)
        )
        + ", peak_blocking_hour_local int, top_blocking_wait_type string, "
        + _columns(
            _PCT,
            "mom_total_wait_change_pct mom_cpu_wait_change_pct mom_memory_wait_change_pct mom_disk_wait_change_pct "
            "mom_blocking_wait_change_pct",
        )
        + ", created_at_utc timestamp_ntz"
    ),
    "disk_monthly": (
        f"{_ROLLUP}, {_columns('string', 'rollup_type mount_path drive_label drive_type')}, "
        f"{_columns('boolean', 'is_mount_point is_sql_disk')}, "
        f"{_columns('bigint', 'total_size_kb free_space_kb used_space_kb')}, "
        f"{_columns('decimal(5,2)', 'percent_free percent_used')}, rollup_free_space_kb bigint, "
        "rollup_percent_free decimal(5,2), absolute_growth_kb bigint, percent_growth decimal(18,4), "
        f"{_columns('bigint', 'samples_critical_free days_critical_free max_used_space_kb min_free_space_kb')}, "
        f"{_columns('int', 'avg_read_latency_ms avg_write_latency_ms avg_overall_latency_ms worst_observed_latency_ms')}, "
        f"{_STAMPS}, {_columns('string', 'database_name physical_name file_type file_drive')}, "
        f"{_columns('bigint', 'file_size_kb file_growth_kb log_segment_count')}, log_segment_severity string, "
        f"{_columns('bigint', 'data_file_count log_file_count total_database_size_kb total_database_growth_kb')}"
    ),
    "system_health": (
        f"{_ROLLUP}, cpu_cores int, {_columns('string', 'host_name host_power_plan')}, host_ram_mb int, "
        "is_virtual_machine boolean, numa_nodes int, instance_collation string, instance_name string, "
        f"is_name_matching boolean, {_columns('string', 'edition friendly_version product_version')}, "
        f"{_columns('boolean', 'ad_hoc_enabled backup_compression')}, cost_threshold int, "
        f"{_columns('boolean', 'is_ag_enabled is_ag_present is_clustered lock_pages_in_memory')}, "
        f"{_columns('int', 'max_dop max_memory_mb min_memory_mb')}, instant_file_initialization boolean, "
        f"{_columns('string', 'host_distribution host_operating_system')}"
    ),
    "database_health": (
        f"{_ROLLUP}, {_columns('string', 'database_name recovery_model')}, "
        f"{_columns('boolean', 'is_page_verification_not_checksum has_high_segment_count')}, log_segment_count bigint, "
        f"{_columns('boolean', 'has_percent_autogrowth is_backup_overdue')}, last_full_backup timestamp_ntz, "
        "is_log_backup_overdue boolean, last_log_backup timestamp_ntz, "
        f"{_columns('boolean', 'has_files_on_c_disk is_auto_shrink_on is_auto_close_on')}, "
        "last_good_check timestamp_ntz"
    ),
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast to the stored layout. Columns the input lacks become NULL, but for local times of
    boundary tables, without which peak hours would vanish unnoticed; strings lose the trailing
    blanks of fixed-width sources, so that equal names compare equal."""
    if "snapshot_date_local" in schema(name).names and "snapshot_date_local" not in df.columns:
        raise ValueError(f"{name} needs snapshot_date_local")
    out = []
    for field in schema(name):
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        c = c.cast(field.dataType)
        out.append((F.rtrim(c) if isinstance(field.dataType, StringType) else c).alias(field.name))
    return df.select(*out)
