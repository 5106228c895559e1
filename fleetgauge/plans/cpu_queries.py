"""CPU queries."""

from __future__ import annotations

from fleetgauge.operators import cpu
from fleetgauge.plans.checking import STAMPS, G, days, month, pct, pct0, stamps
from fleetgauge.sources.bindings import bound, with_bindings

_ON = {
    "cp1_completeness": cpu.completeness,
    "cp2_cpu_load": cpu.cpu_load,
    "cp3_cpu_medians": cpu.cpu_medians,
    "cp4_load_above_median": cpu.load_above_median,
    "cp5_cpu_p90": cpu.cpu_p90,
    "cp6_pct_at_or_above_p90": cpu.pct_at_or_above_p90,
    "cp7_saturation_hours": lambda df: cpu.saturation_hours(df, 65),
    "cp8_cpu_share": cpu.cpu_share,
    "cp9_cpu_monthly": lambda df: cpu.cpu_monthly(df, **stamps(), threshold=65),
}

QUERIES = {
    name: (lambda fn: lambda spark, sf_dir: fn(bound(spark, sf_dir, "cpu_samples")))(fn) for name, fn in _ON.items()
}

_CPU = f"""cpu AS (
  SELECT server_name, {month("event_time_utc")} AS rollup_month, date_trunc('hour', event_time_utc) AS hour_start,
         sql_service AS service, non_sql_process AS non_service, 100 - idle_process AS total
  FROM cpu_samples)"""

_EXPECTED = f"cast({days('rollup_month')} * 1440 AS int)"

_SQL = {}
_SQL["cp1_completeness"] = f"""SELECT {G}, {_EXPECTED} AS expected_points, cast(count(*) AS bigint) AS collected_points,
       {pct0("count(*)", _EXPECTED)} AS accuracy_percent
FROM cpu GROUP BY {G}"""
_SQL["cp2_cpu_load"] = f"""SELECT {G}, cast(round(cast(sum(total) AS double) / count(total), 2) AS decimal(5,2)) AS avg_total_cpu,
       cast(max(total) AS decimal(5,2)) AS peak_total_cpu,
       cast(quantile_cont(total, 0.9) AS decimal(5,2)) AS p90_total_cpu
FROM cpu GROUP BY {G}"""
_SQL["cp3_cpu_medians"] = f"""SELECT {G}, cast(quantile_cont(service, 0.5) AS decimal(5,2)) AS median_service_cpu,
       cast(quantile_cont(non_service, 0.5) AS decimal(5,2)) AS median_non_service_cpu,
       cast(quantile_cont(total, 0.5) AS decimal(5,2)) AS median_total_cpu
FROM cpu GROUP BY {G}"""


def _above(c: str) -> str:
    return (
        f"cast(sum({c}) FILTER (WHERE {c} > m_{c}) // count(*) FILTER (WHERE {c} > m_{c}) AS decimal(5,2))"
        f" AS load_above_median_{c}"
    )


_SQL["cp4_load_above_median"] = f"""SELECT {G}, {_above("service")}, {_above("non_service")}, {_above("total")}
FROM cpu JOIN (SELECT {G}, quantile_cont(service, 0.5) AS m_service, quantile_cont(non_service, 0.5) AS m_non_service,
                      quantile_cont(total, 0.5) AS m_total FROM cpu GROUP BY {G}) AS m USING ({G})
GROUP BY {G}"""
_SQL["cp5_cpu_p90"] = f"""SELECT {G}, cast(quantile_cont(service, 0.9) AS decimal(5,2)) AS p90_service_cpu,
       cast(quantile_cont(non_service, 0.9) AS decimal(5,2)) AS p90_non_service_cpu
FROM cpu GROUP BY {G}"""
_SQL["cp6_pct_at_or_above_p90"] = f"""SELECT {G}, {pct("count(*) FILTER (WHERE total >= p90)", "count(*)", "decimal(7,2)")} AS pct_in_top10_total
FROM cpu JOIN (SELECT {G}, quantile_cont(total, 0.9) AS p90 FROM cpu GROUP BY {G}) AS p USING ({G})
GROUP BY {G}"""
_SQL["cp7_saturation_hours"] = f"""SELECT {G}, cast(count(*) FILTER (WHERE avg_cpu > 65) AS int) AS saturation_hours,
       min(hour_start) FILTER (WHERE avg_cpu > 65 AND avg_cpu = top_cpu) AS worst_hour_start
FROM (SELECT *, max(avg_cpu) OVER (PARTITION BY {G}) AS top_cpu
      FROM (SELECT {G}, hour_start, sum(total) // count(total) AS avg_cpu FROM cpu GROUP BY {G}, hour_start) AS h) AS t
GROUP BY {G}"""
_SQL["cp8_cpu_share"] = f"""SELECT {G}, {pct0("sum(service)", "sum(service + non_service)")} AS service_percent_of_total,
       {pct0("sum(non_service)", "sum(service + non_service)")} AS non_service_percent_of_total
FROM cpu GROUP BY {G}"""

_PARTS = [f"cp{i}" for i in range(1, 9)]
_JOINED = " ".join(f"JOIN {p} USING ({G})" for p in _PARTS[1:])
_CTES = ", ".join(f"{name.split('_')[0]} AS ({sql})" for name, sql in _SQL.items())

ORACLE = {name: with_bindings(f"WITH {_CPU} {sql}") for name, sql in _SQL.items()}
ORACLE["cp9_cpu_monthly"] = with_bindings(
    f"WITH {_CPU}, {_CTES} SELECT *, {STAMPS}, 1 AS report_generation_time_method FROM cp1 {_JOINED}"
)
