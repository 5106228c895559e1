"""Disk queries."""

from __future__ import annotations

from fleetgauge.operators import disk
from fleetgauge.operators.calendar import latest_collection
from fleetgauge.plans.checking import AS_OF, STAMPS, G, month, stamp, stamps
from fleetgauge.sources.bindings import binder, with_bindings


def _using(*names: str):
    """Pass the named tables to an operator."""

    def wrap(fn):
        def query(spark, sf_dir):
            table = binder(spark, sf_dir)
            return fn(*[table(n) for n in names])

        return query

    return wrap


def _disk_monthly(volumes, latency, files, log_segments):
    drives = disk.drive_monthly(volumes, latency, **stamps())
    return disk.disk_monthly(drives, disk.file_monthly(latency, volumes, files, log_segments, **stamps()))


_LATENCY = ("file_latency_samples", "volume_samples")

QUERIES = {
    "dk1_first_last_used": _using("volume_samples")(disk.first_last_used),
    "dk2_drive_stats": _using("volume_samples")(disk.drive_stats),
    "dk4_longest_prefix_join": _using(*_LATENCY)(disk.longest_prefix_join),
    "dk4_longest_prefix_join_compat": _using(*_LATENCY)(lambda f, v: disk.longest_prefix_join(f, v, compat=True)),
    "dk5_mount_latency": _using(*_LATENCY)(disk.mount_latency),
    "dk6_last_sample": _using("volume_samples")(disk.last_sample),
    "dk7_drive_monthly": _using("volume_samples", "file_latency_samples")(
        lambda v, l: disk.drive_monthly(v, l, **stamps())
    ),
    "dk8_file_latency_monthly": _using(*_LATENCY)(disk.file_latency_monthly),
    "dk10_database_footprint": _using("files")(disk.database_footprint),
    "dk10_database_footprint_collected": _using("file_collections")(
        lambda f: disk.database_footprint(latest_collection(f, stamp(AS_OF)))
    ),
    "dk11_log_segment_severity": _using("log_segments")(disk.log_segment_severity),
    "dk12_file_monthly": _using("file_latency_samples", "volume_samples", "files", "log_segments")(
        lambda l, v, f, s: disk.file_monthly(l, v, f, s, **stamps())
    ),
    "dk12_disk_monthly": _using("volume_samples", "file_latency_samples", "files", "log_segments")(_disk_monthly),
}

_V = f"v AS (SELECT *, {month('event_time_utc')} AS rollup_month FROM volume_samples)"
_DRIVE = f"{G}, mount_path"
_FIRST_LAST = f"""first_last AS (
  SELECT {_DRIVE}, max(CASE WHEN a = 1 THEN used_kb END) AS first_used_kb, max(CASE WHEN z = 1 THEN used_kb END) AS last_used_kb
  FROM (SELECT *, row_number() OVER (PARTITION BY {_DRIVE} ORDER BY event_time_utc, used_kb) AS a,
               row_number() OVER (PARTITION BY {_DRIVE} ORDER BY event_time_utc DESC, used_kb DESC) AS z
        FROM v WHERE drive_type <> 'CD-ROM') AS r
  GROUP BY {_DRIVE})"""
_STATS = f"""stats AS (
  SELECT {_DRIVE}, drive_type, label AS drive_label, is_mount_point,
         cast(sum(size_kb) // count(size_kb) AS bigint) AS total_size_kb,
         cast(sum(free_kb) // count(free_kb) AS bigint) AS free_space_kb,
         cast(sum(used_kb) // count(used_kb) AS bigint) AS used_space_kb,
         cast(round(cast(sum(percent_free) AS double) / count(percent_free), 2) AS decimal(5,2)) AS percent_free,
         cast(round(cast(sum(percent_used) AS double) / count(percent_used), 2) AS decimal(5,2)) AS percent_used,
         max(used_kb) AS max_used_space_kb, min(free_kb) AS min_free_space_kb,
         cast(count(*) FILTER (WHERE percent_free < 10) AS bigint) AS samples_critical_free,
         cast(count(DISTINCT CASE WHEN percent_free < 10 THEN cast(event_time_utc AS date) END) AS bigint) AS days_critical_free
  FROM v WHERE drive_type <> 'CD-ROM'
  GROUP BY {_DRIVE}, drive_type, label, is_mount_point)"""


def _resolved(rule: str) -> str:
    return f"""resolved AS (
  SELECT server_name, physical_name, mount_path
  FROM (SELECT f.server_name, f.physical_name, m.mount_path,
               row_number() OVER (PARTITION BY f.server_name, f.physical_name ORDER BY length(m.mount_path) DESC) AS rn
        FROM (SELECT DISTINCT server_name, physical_name FROM file_latency_samples) AS f
        JOIN (SELECT DISTINCT server_name, mount_path FROM volume_samples) AS m
          ON m.server_name = f.server_name AND {rule}) AS r
  WHERE rn = 1)"""


_RESOLVED = _resolved(
    "(f.physical_name = m.mount_path OR starts_with(f.physical_name, concat(m.mount_path, chr(92))))"
)
_AVERAGES = """cast(sum(read_latency) // count(read_latency) AS int) AS avg_read_latency_ms,
         cast(sum(write_latency) // count(write_latency) AS int) AS avg_write_latency_ms,
         cast(sum(avg_latency) // count(avg_latency) AS int) AS avg_overall_latency_ms,
         max(avg_latency) AS worst_observed_latency_ms"""


def _latency(name: str, keys: str) -> str:
    return f"""{name} AS (
  SELECT {keys}, {_AVERAGES}
  FROM (SELECT l.*, r.mount_path, {month("l.event_time_utc")} AS rollup_month
        FROM file_latency_samples AS l JOIN resolved AS r USING (server_name, physical_name)) AS x
  GROUP BY {keys})"""


_MOUNT = _latency("mount_speed", _DRIVE)
_FILE = _latency("file_speed", f"{_DRIVE}, database_name, physical_name")
_LAST = f"""last_rows AS (
  SELECT {_DRIVE}, free_kb AS rollup_free_space_kb, percent_free AS rollup_percent_free
  FROM (SELECT *, max(event_time_utc) OVER (PARTITION BY {_DRIVE}) AS top FROM v) AS t WHERE event_time_utc = top)"""
_DRIVES = f"""drives AS (
  SELECT {G}, 'Drive' AS rollup_type, s.* EXCLUDE (server_name, rollup_month), m.server_name IS NOT NULL AS is_sql_disk,
         rollup_free_space_kb, rollup_percent_free, last_used_kb - first_used_kb AS absolute_growth_kb,
         CASE WHEN first_used_kb > 0
              THEN cast(round(cast(last_used_kb - first_used_kb AS double) / first_used_kb, 4) AS decimal(18,4)) END AS percent_growth,
         avg_read_latency_ms, avg_write_latency_ms, avg_overall_latency_ms, worst_observed_latency_ms, {STAMPS}
  FROM stats AS s JOIN first_last USING ({_DRIVE}) LEFT JOIN mount_speed AS m USING ({_DRIVE}) LEFT JOIN last_rows USING ({_DRIVE}))"""
_FOOTPRINT = """footprint AS (
  SELECT server_name, database_id, database_name, cast(count(*) FILTER (WHERE type_desc = 'ROWS') AS bigint) AS data_file_count,
         cast(count(*) FILTER (WHERE type_desc = 'LOG') AS bigint) AS log_file_count,
         cast(sum(size_pages) * 8 AS bigint) AS total_database_size_kb
  FROM files GROUP BY server_name, database_id, database_name)"""
_COLLECTED = f"""current_files AS (
  SELECT * FROM file_collections JOIN (
    SELECT server_name, max(collected_utc) AS collected_utc FROM file_collections
    WHERE collected_utc <= TIMESTAMP '{AS_OF}' GROUP BY server_name) AS newest USING (server_name, collected_utc))"""
_SEVERITY = """severity AS (
  SELECT server_name, database_name, cast(count(*) AS bigint) AS log_segment_count,
         CASE WHEN count(*) < 100 THEN 'Normal' WHEN count(*) < 500 THEN 'Warning' WHEN count(*) < 1000 THEN 'Severe'
              ELSE 'Critical' END AS log_segment_severity
  FROM log_segments GROUP BY server_name, database_name)"""
_FILES = f"""file_rows AS (
  SELECT {G}, 'DatabaseFile' AS rollup_type, mount_path, true AS is_sql_disk, database_name, physical_name,
         type_desc AS file_type, CASE WHEN type_desc IS NOT NULL THEN left(physical_name, 2) END AS file_drive,
         size_pages * 8 AS file_size_kb, growth_pages * 8 AS file_growth_kb,
         avg_read_latency_ms, avg_write_latency_ms, avg_overall_latency_ms, worst_observed_latency_ms,
         log_segment_count, log_segment_severity, data_file_count, log_file_count, total_database_size_kb,
         cast(NULL AS bigint) AS total_database_growth_kb, {STAMPS}
  FROM file_speed
  LEFT JOIN (SELECT server_name, database_name, physical_name, type_desc, size_pages, growth_pages FROM files) AS i
    USING (server_name, database_name, physical_name)
  LEFT JOIN footprint USING (server_name, database_name)
  LEFT JOIN severity USING (server_name, database_name))"""
_ALL_DRIVES = f"{_V}, {_FIRST_LAST}, {_STATS}, {_RESOLVED}, {_MOUNT}, {_LAST}, {_DRIVES}"
_ALL_FILES = f"{_FILE}, {_FOOTPRINT}, {_SEVERITY}, {_FILES}"

ORACLE = {
    "dk1_first_last_used": with_bindings(f"WITH {_V}, {_FIRST_LAST} SELECT * FROM first_last"),
    "dk2_drive_stats": with_bindings(f"WITH {_V}, {_STATS} SELECT * FROM stats"),
    "dk4_longest_prefix_join": with_bindings(f"WITH {_RESOLVED} SELECT * FROM resolved"),
    "dk4_longest_prefix_join_compat": with_bindings(
        f"WITH {_resolved('starts_with(f.physical_name, m.mount_path)')} SELECT * FROM resolved"
    ),
    "dk5_mount_latency": with_bindings(f"WITH {_RESOLVED}, {_MOUNT} SELECT * FROM mount_speed"),
    "dk6_last_sample": with_bindings(f"WITH {_V}, {_LAST} SELECT * FROM last_rows"),
    "dk7_drive_monthly": with_bindings(f"WITH {_ALL_DRIVES} SELECT * FROM drives"),
    "dk8_file_latency_monthly": with_bindings(f"WITH {_RESOLVED}, {_FILE} SELECT * FROM file_speed"),
    "dk10_database_footprint": with_bindings(f"WITH {_FOOTPRINT} SELECT * FROM footprint"),
    "dk10_database_footprint_collected": with_bindings(
        f"WITH {_COLLECTED}, {_FOOTPRINT.replace('FROM files', 'FROM current_files')} SELECT * FROM footprint"
    ),
    "dk11_log_segment_severity": with_bindings(f"WITH {_SEVERITY} SELECT * FROM severity"),
    "dk12_file_monthly": with_bindings(f"WITH {_RESOLVED}, {_ALL_FILES} SELECT * FROM file_rows"),
    "dk12_disk_monthly": with_bindings(
        f"WITH {_ALL_DRIVES}, {_ALL_FILES} SELECT * FROM drives UNION ALL BY NAME SELECT * FROM file_rows"
    ),
}
