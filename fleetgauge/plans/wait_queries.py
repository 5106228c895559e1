"""Wait queries."""

from __future__ import annotations

from fleetgauge.operators import waits
from fleetgauge.plans.checking import GENERATED_UTC, G, pct, pct0, stamp
from fleetgauge.sources.bindings import bound, with_bindings

_MOM_INPUT = ["total_wait_seconds", "disk_wait_seconds"]

_ON = {
    "wa1_signed_boundary_net": waits.net_by_type,
    "wa2_category_report": waits.category_report,
    "wa3_category_totals": waits.category_totals,
    "wa4_category_pivot": waits.category_pivot,
    "wa6_top_k_wide": waits.top_k_wide,
    "wa7_peak_hour": waits.peak_hour,
    "wa8_top_type": waits.top_type,
    "wa9_mom_pct": lambda df: waits.mom_pct(
        waits.category_pivot(df).select("server_name", "rollup_month", *waits.TRENDS), waits.trend_columns()
    ),
    "wa10_wait_monthly": lambda df: waits.wait_monthly(df, stamp(GENERATED_UTC)),
}

QUERIES = {
    name: (lambda fn: lambda spark, sf_dir: fn(bound(spark, sf_dir, "wait_boundaries")))(fn)
    for name, fn in _ON.items()
}


def _signed(c: str) -> str:
    return f"CASE WHEN snapshot_type = 'StartOfMonth' THEN -abs({c}) ELSE {c} END AS {c}"


_MEASURES = ["wait_seconds", "resource_seconds", "signal_seconds"]
_B = f"""b AS (
  SELECT {G}, snapshot_date_local, wait_type, category, {_signed("total_server_time_seconds")},
         {", ".join(_signed(c) for c in _MEASURES)}
  FROM wait_boundaries)"""


def _sums(p: int, prefix: str = "") -> str:
    return ", ".join(f"cast(sum({c}) AS decimal({p},2)) AS {prefix}{c}" for c in _MEASURES)


def _of(category: str) -> str:
    return f"sum(CASE WHEN category = '{category}' THEN wait_seconds ELSE 0 END)"


_SQL = {}
_SQL["wa1_signed_boundary_net"] = f"SELECT {G}, wait_type, category, {_sums(24)} FROM b GROUP BY {G}, wait_type, category"
_SQL["wa2_category_report"] = f"""SELECT {G}, category, avg(t) AS total_server_time_seconds, {_sums(18, "monthly_")},
       CASE WHEN sum(wait_seconds) = 0 THEN 0 ELSE round(cast(sum(wait_seconds) AS double) / nullif(avg(t), 0), 2) END AS total_wait_pct
FROM (SELECT {G}, wait_type, category, sum(total_server_time_seconds) AS t, {_sums(24)} FROM b GROUP BY {G}, wait_type, category) AS x
GROUP BY {G}, category"""
_SQL["wa3_category_totals"] = f"""SELECT {G}, category, {_sums(18, "total_")}, any_value(g) AS grand_total_wait_seconds
FROM b JOIN (SELECT {G}, cast(sum(wait_seconds) AS decimal(18,2)) AS g FROM b GROUP BY {G}) AS t USING ({G})
GROUP BY {G}, category"""
_SQL["wa4_category_pivot"] = f"""SELECT {G}, cast(sum(wait_seconds) AS decimal(18,2)) AS total_wait_seconds,
       {", ".join(f"cast({_of(c)} AS decimal(18,2)) AS {c.lower()}_wait_seconds" for c in waits.REPORTED)},
       {", ".join(f"{pct0(_of(c), 'sum(wait_seconds)')} AS {c.lower()}_wait_pct" for c in waits.REPORTED)}
FROM b GROUP BY {G}"""


def _top(i: int) -> str:
    s = f"max(CASE WHEN rn = {i} THEN w END)"
    return (
        f"max(CASE WHEN rn = {i} THEN wait_type END) AS top_wait_type_{i}, {s} AS top_wait_type_{i}_seconds, "
        f"{pct0(s, 'sum(w)')} AS top_wait_type_{i}_pct"
    )


_SQL["wa6_top_k_wide"] = f"""SELECT {G}, {_top(1)}, {_top(2)}, {_top(3)}
FROM (SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY w DESC, wait_type) AS rn
      FROM (SELECT {G}, wait_type, cast(sum(wait_seconds) AS decimal(18,2)) AS w FROM b GROUP BY {G}, wait_type) AS x) AS r
GROUP BY {G}"""
_SQL["wa7_peak_hour"] = f"""SELECT {G}, h AS peak_blocking_hour_local
FROM (SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY w DESC, h) AS rn
      FROM (SELECT {G}, cast(hour(snapshot_date_local) AS int) AS h, sum(wait_seconds) AS w FROM b WHERE category = 'Blocking'
            GROUP BY {G}, cast(hour(snapshot_date_local) AS int)) AS x) AS r
WHERE rn = 1"""
_SQL["wa8_top_type"] = f"""SELECT {G}, wait_type AS top_blocking_wait_type
FROM (SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY w DESC, wait_type) AS rn
      FROM (SELECT {G}, wait_type, sum(wait_seconds) AS w FROM b WHERE category = 'Blocking' GROUP BY {G}, wait_type) AS x) AS r
WHERE rn = 1"""


def _mom(source: str) -> str:
    changes = ", ".join(
        f"{pct(f'c.{col} - p.{col}', f'p.{col}')} AS {out}" for col, out in waits.trend_columns().items()
    )
    return f"""SELECT c.*, {changes} FROM {source} AS c LEFT JOIN {source} AS p
    ON p.server_name = c.server_name AND p.rollup_month = cast(c.rollup_month - INTERVAL 1 MONTH AS date)"""


_PIVOTED = f"pivoted AS ({_SQL['wa4_category_pivot']})"
ORACLE = {name: with_bindings(f"WITH {_B} {sql}") for name, sql in _SQL.items()}
ORACLE["wa9_mom_pct"] = with_bindings(
    f"""WITH {_B}, {_PIVOTED}, trends AS (SELECT {G}, {", ".join(waits.TRENDS)} FROM pivoted) {_mom("trends")}"""
)
MONTHLY = f"""{_PIVOTED}, top3 AS ({_SQL["wa6_top_k_wide"]}), peak AS ({_SQL["wa7_peak_hour"]}),
lead AS ({_SQL["wa8_top_type"]}),
plain AS (SELECT {G}, cast(sum(resource_seconds) AS decimal(18,2)) AS total_resource_seconds,
                 cast(sum(signal_seconds) AS decimal(18,2)) AS total_signal_seconds,
                 CASE WHEN sum(resource_seconds) = 0 THEN NULL
                      ELSE cast(round(cast(sum(signal_seconds) AS double) / cast(sum(resource_seconds) AS double), 4) AS decimal(18,4))
                 END AS signal_to_resource_ratio FROM b GROUP BY {G}),
rollup_rows AS (SELECT * FROM plain JOIN pivoted USING ({G}) JOIN top3 USING ({G})
                LEFT JOIN peak USING ({G}) LEFT JOIN lead USING ({G})),
full_rows AS ({_mom("rollup_rows")})
SELECT *, TIMESTAMP '{GENERATED_UTC}' AS created_at_utc FROM full_rows"""
ORACLE["wa10_wait_monthly"] = with_bindings(f"WITH {_B}, {MONTHLY}")

