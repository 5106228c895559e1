"""Memory queries."""

from __future__ import annotations

from fleetgauge.operators import memory
from fleetgauge.plans.checking import STAMPS, G, days, month, pct, pct0, stamps
from fleetgauge.sources.bindings import bound, with_bindings


def _on_pivot(fn):
    return lambda spark, sf_dir: fn(memory.pivot_counters(bound(spark, sf_dir, "counter_samples")))


QUERIES = {
    "mm1_pivot_counters": _on_pivot(lambda df: df),
    "mm3_completeness": _on_pivot(memory.completeness),
    "mm4_steady_stats": _on_pivot(memory.steady_stats),
    "mm5_grant_stats": _on_pivot(memory.grant_stats),
    "mm6_page_life_stats": _on_pivot(memory.page_life_stats),
    "mm7_hit_ratio_stats": _on_pivot(memory.hit_ratio_stats),
    "mm8_memory_monthly": lambda spark, sf_dir: memory.memory_monthly(
        bound(spark, sf_dir, "counter_samples"), **stamps()
    ),
}

_COLUMNS = ", ".join(
    f"max(CASE WHEN counter_name = '{n}' THEN counter_value END) AS {c}" for n, c in memory.COUNTER_COLUMNS.items()
)
_PIVOT = f"SELECT server_name, event_time_utc, {_COLUMNS} FROM counter_samples GROUP BY server_name, event_time_utc"
_POINTS = f"""points AS (
  SELECT *, {month("event_time_utc")} AS rollup_month,
         CASE WHEN target_server_memory_kb > 0 THEN cast(total_server_memory_kb AS double) / target_server_memory_kb END AS ratio
  FROM ({_PIVOT}) AS p)"""
_EXPECTED = f"cast(({days('rollup_month')} * 1440) // 5 AS int)"

_SQL = {}
_SQL["mm3_completeness"] = f"""SELECT {G}, {_EXPECTED} AS expected_points, cast(count(*) AS bigint) AS collected_points,
       {pct0("count(*)", _EXPECTED)} AS accuracy_percent
FROM points GROUP BY {G}"""
_SQL["mm4_steady_stats"] = f"""SELECT {G}, cast(round(avg(ratio), 4) AS decimal(10,4)) AS avg_steady_state_ratio,
       cast(round(min(ratio), 4) AS decimal(10,4)) AS min_steady_state_ratio,
       {pct("count(*) FILTER (WHERE total_server_memory_kb * 10 < target_server_memory_kb * 9)", "count(*)")} AS pct_below_90pct_steady
FROM points GROUP BY {G}"""
_SQL["mm5_grant_stats"] = f"""SELECT {G}, {pct("count(*) FILTER (WHERE memory_grants_pending > 0)", "count(*)")} AS pct_with_grants_pending,
       max(memory_grants_pending) AS max_grants_pending
FROM points GROUP BY {G}"""
_SQL["mm6_page_life_stats"] = f"""SELECT {G}, {pct("count(*) FILTER (WHERE ple <= 600)", "count(ple)")} AS pct_ple_below_600,
       {pct("count(*) FILTER (WHERE ple <= 300)", "count(ple)")} AS pct_ple_below_300,
       cast(trunc(round(quantile_cont(ple, 0.5), 6)) AS bigint) AS median_ple,
       cast(trunc(round(quantile_cont(ple, 0.05), 6)) AS bigint) AS ple_5th_percentile
FROM points GROUP BY {G}"""
_SQL["mm7_hit_ratio_stats"] = f"""SELECT {G}, cast(round(avg(bchr), 4) AS decimal(10,4)) AS avg_bchr, min(bchr) AS min_bchr,
       {pct("count(*) FILTER (WHERE bchr < 95)", "count(bchr)")} AS pct_bchr_below_95
FROM points GROUP BY {G}"""

ORACLE = {name: with_bindings(f"WITH {_POINTS} {sql}") for name, sql in _SQL.items()}
ORACLE["mm1_pivot_counters"] = with_bindings(_PIVOT)
_CTES = ", ".join(f"{name.split('_')[0]} AS ({sql})" for name, sql in _SQL.items())
_ZERO = {
    "avg_steady_state_ratio": "decimal(10,4)",
    "min_steady_state_ratio": "decimal(10,4)",
    "pct_below_90pct_steady": "decimal(18,2)",
    "pct_with_grants_pending": "decimal(18,2)",
}
ORACLE["mm8_memory_monthly"] = with_bindings(
    f"""WITH {_POINTS}, {_CTES}
SELECT * REPLACE ({", ".join(f"coalesce({c}, cast(0 AS {t})) AS {c}" for c, t in _ZERO.items())}), {STAMPS}
FROM mm3 JOIN mm4 USING ({G}) JOIN mm5 USING ({G}) JOIN mm6 USING ({G}) JOIN mm7 USING ({G})"""
)
