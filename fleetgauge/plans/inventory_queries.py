"""Inventories over time: twelve months in one call, each with the state it ended with."""

from __future__ import annotations

import re
from datetime import date

from fleetgauge.operators import disk, health, inventory
from fleetgauge.plans import health_queries as now
from fleetgauge.plans.checking import AS_OF, stamps
from fleetgauge.plans.disk_queries import _FOOTPRINT, _SEVERITY, _using
from fleetgauge.plans.disk_queries import ORACLE as DISK
from fleetgauge.sources.bindings import BINDINGS, with_bindings

START, END = date(2000, 8, 1), date(2001, 8, 1)
#: The latency samples lie in one later month.
LATE = (date(2023, 10, 1), date(2024, 2, 1))


def _months(*inventories):
    return [inventory.by_month(i, START, END) for i in inventories]


def _system(properties, configs, schedulers, groups):
    p, c, s = _months(properties, configs, schedulers)
    return health.system_health(p, c, s, availability_groups=groups)


def _databases(databases, files, segments, backups, checks):
    d, f, s, i = _months(databases, files, segments, checks)
    return health.database_health(d, f, s, backups, i)


def _files(latency, volumes, files, segments):
    f, s = (inventory.by_month(i, *LATE) for i in (files, segments))
    return disk.file_monthly(latency, volumes, f, s, **stamps())


QUERIES = {
    "dk11_inventory_intervals": _using("log_segment_collections")(inventory.validity_intervals),
    "dk10_database_footprint_by_month": _using("file_history")(lambda f: disk.database_footprint(*_months(f))),
    "dk11_log_segment_severity_by_month": _using("log_segment_collections")(lambda s: disk.log_segment_severity(*_months(s))),
    "dk12_file_monthly_by_month": _using("file_latency_samples", "volume_samples", "file_history", "log_segment_collections")(_files),
    "ge5_scheduler_topology_by_month": _using("scheduler_collections")(lambda s: health.scheduler_topology(*_months(s))),
    "ge7_system_health_by_month": _using("property_collections", "config_collections", "scheduler_collections", "availability_groups")(_system),
    "ge11_high_segment_flag_by_month": _using("log_segment_collections")(lambda s: health.high_segment_flag(*_months(s))),
    "ge13_database_health_by_month": _using(
        "database_collections", "file_history", "log_segment_collections", "backups", "integrity_collections"
    )(_databases),
}

# The checking SQL looks up each month's newest collection, calls "server|month" a server and runs the SQL of one state.
_STATES = {
    "log_segments": "log_segment_collections",
    "files": "file_history",
    "properties": "property_collections",
    "configs": "config_collections",
    "schedulers": "scheduler_collections",
    "database_settings": "database_collections",
    "integrity_checks": "integrity_collections",
}
_SERVER, _MONTH = "split_part(server_name, '|', 1)", "cast(split_part(server_name, '|', 2) AS date)"


def _by_month(body: str, extra: str = "", start: date = START, end: date = END) -> str:
    """``body``, SQL over one state, as SQL over the states of all months."""
    used = [n for n in _STATES if re.search(rf"\bFROM {n}\b", body + extra)]
    parts = [
        f"""months AS (SELECT cast(unnest(generate_series(DATE '{start}', DATE '{end}' - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS date) AS rollup_month)"""
    ]
    for name in used:
        source = _STATES[name]
        parts.append(
            f"""{name}_newest AS (SELECT server_name, rollup_month, max(collected_utc) AS collected_utc FROM {source} AS t, months
  WHERE collected_utc < rollup_month + INTERVAL 1 MONTH GROUP BY server_name, rollup_month),
{name}_m AS (SELECT t.* EXCLUDE (collected_utc) REPLACE (concat(t.server_name, '|', cast(n.rollup_month AS string)) AS server_name)
  FROM {source} AS t JOIN {name}_newest AS n ON n.server_name = t.server_name AND n.collected_utc = t.collected_utc)"""
        )
        body, extra = (re.sub(rf"\bFROM {name}\b", f"FROM {name}_m", text) for text in (body, extra))
    if extra:
        parts.append(extra)
    return with_bindings(f"WITH {', '.join(parts)} SELECT * REPLACE ({_SERVER} AS server_name), {_MONTH} AS rollup_month FROM ({body}) AS found")


def _dated(sql: str) -> str:
    """The row has its month already."""
    return sql.replace("DATE '2001-07-01' AS rollup_month, ", "")


_FLAGS = now._FLAGS.replace("server_name IN (SELECT", f"{_SERVER} IN (SELECT")
_LATEST = f"""latest AS (SELECT d.server_name, d.database_name, max(CASE WHEN backup_type = 'D' THEN backup_finish_ts END) AS last_full_backup,
         max(CASE WHEN backup_type = 'L' THEN backup_finish_ts END) AS last_log_backup
  FROM backups AS b JOIN (SELECT DISTINCT server_name, database_name FROM database_settings) AS d
    ON b.server_name = {_SERVER.replace("server_name", "d.server_name")} AND b.database_name = d.database_name
   AND b.backup_finish_ts < {_MONTH.replace("server_name", "d.server_name")} + INTERVAL 1 MONTH
  GROUP BY d.server_name, d.database_name)"""
_STALE = now._STALE.replace(f"TIMESTAMP '{AS_OF}'", f"({_MONTH.replace('server_name', 'd.server_name')} + INTERVAL 1 MONTH)")

ORACLE = {
    "dk11_inventory_intervals": with_bindings(
        """WITH calendar AS (SELECT *, row_number() OVER w AS n, lead(collected_utc) OVER w AS following
  FROM (SELECT DISTINCT server_name, collected_utc FROM log_segment_collections) AS c WINDOW w AS (PARTITION BY server_name ORDER BY collected_utc)),
counted AS (SELECT server_name, database_name, collected_utc, count(*) AS row_count FROM log_segment_collections GROUP BY ALL),
flagged AS (SELECT *, CASE WHEN lag(n) OVER w IS DISTINCT FROM n - 1 OR lag(row_count) OVER w IS DISTINCT FROM row_count THEN 1 ELSE 0 END AS opens
  FROM counted JOIN calendar USING (server_name, collected_utc) WINDOW w AS (PARTITION BY server_name, database_name ORDER BY n)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY server_name, database_name ORDER BY n) AS stretch FROM flagged)
SELECT server_name, database_name, cast(any_value(row_count) AS bigint) AS row_count, min(collected_utc) AS valid_from_utc,
       arg_max_null(following, n) AS valid_to_utc, max(collected_utc) AS last_seen_utc
FROM numbered GROUP BY server_name, database_name, stretch"""
    ),
    "dk10_database_footprint_by_month": _by_month("SELECT * FROM footprint", _FOOTPRINT),
    "dk11_log_segment_severity_by_month": _by_month("SELECT * FROM severity", _SEVERITY),
    "ge5_scheduler_topology_by_month": _by_month("SELECT * FROM topology", now._TOPOLOGY),
    "ge7_system_health_by_month": _by_month(_dated(now._SYSTEM), f"{now._PIVOT}, {_FLAGS}, {now._SETTINGS}, {now._TOPOLOGY}"),
    "ge11_high_segment_flag_by_month": _by_month("SELECT * FROM segments", now._SEGMENTS),
    "ge13_database_health_by_month": _by_month(
        _dated(now._DATABASE), f"{_LATEST}, {_STALE}, {now._FILE_FLAGS}, {now._SEGMENTS}, {now._CHECKS}"
    ),
}


def _newest(name: str) -> str:
    """The last collection of each server, which is the state of all later months."""
    return f"""(SELECT t.* EXCLUDE (collected_utc) FROM ({BINDINGS[name]}) AS t
  JOIN (SELECT server_name, max(collected_utc) AS collected_utc FROM ({BINDINGS[name]}) AS n GROUP BY server_name) AS m
    ON m.server_name = t.server_name AND m.collected_utc = t.collected_utc)"""


_LATE_FILES = DISK["dk12_file_monthly"]
for _name in ("files", "log_segments"):
    _LATE_FILES = _LATE_FILES.replace(f"{_name} AS ({BINDINGS[_name].strip()})", f"{_name} AS {_newest(_STATES[_name])}")
ORACLE["dk12_file_monthly_by_month"] = _LATE_FILES
