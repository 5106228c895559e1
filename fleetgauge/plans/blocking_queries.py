"""Lock-blocking queries."""

from __future__ import annotations

from fleetgauge.operators import blocking
from fleetgauge.plans.checking import GENERATED_UTC, G, pct, stamp
from fleetgauge.sources.bindings import bound, with_bindings

_ON = {
    "bk1_blocking_net": blocking.blocking_net,
    "bk2_instance_totals": lambda df: blocking.instance_totals(blocking.blocking_net(df)),
    "bk3_rank_within_instance": lambda df: blocking.rank_within_instance(blocking.blocking_net(df)),
    "bk5_blocking_shares": lambda df: blocking.blocking_shares(
        blocking.instance_totals(blocking.blocking_net(df))
    ),
    "bk6_blocking_mom": lambda df: blocking.blocking_mom(blocking.blocking_net(df)),
    "bk7_blocking_monthly": lambda df: blocking.blocking_monthly(df, stamp(GENERATED_UTC)),
}

QUERIES = {
    name: (lambda fn: lambda spark, sf_dir: fn(bound(spark, sf_dir, "lock_wait_boundaries")))(fn)
    for name, fn in _ON.items()
}


def _net(c: str) -> str:
    return f"sum(CASE WHEN snapshot_type = 'StartOfMonth' THEN -abs({c}) ELSE {c} END)"


def _seconds(c: str) -> str:
    return f"cast(cast({c} AS decimal(20,3)) / 1000 AS decimal(20,3))"


_NET = f"""net AS (
  SELECT {G}, database_id, database_name, {_seconds("r")} AS row_lock_wait_seconds, {_seconds("p")} AS page_lock_wait_seconds,
         {_seconds("r + p")} AS total_blocking_wait_seconds, t AS total_processor_time_seconds
  FROM (SELECT {G}, database_id, database_name, cast({_net("row_lock_wait_ms")} AS bigint) AS r,
               cast({_net("page_lock_wait_ms")} AS bigint) AS p, cast({_net("total_processor_time_seconds")} AS bigint) AS t
        FROM lock_wait_boundaries GROUP BY {G}, database_id, database_name) AS x
  WHERE database_name <> 'tempdb')"""
_TOTALS = f"""totals AS (
  SELECT *, cast(sum(total_blocking_wait_seconds) OVER (PARTITION BY {G}) AS decimal(20,3)) AS instance_blocking_seconds,
         cast(sum(total_processor_time_seconds) OVER (PARTITION BY {G}) AS bigint) AS instance_processor_seconds
  FROM net)"""
_RANKED = f"""ranked AS (
  SELECT *, cast(row_number() OVER (PARTITION BY {G} ORDER BY total_blocking_wait_seconds DESC, database_id) AS int)
            AS rank_within_instance FROM net)"""
_SHARES = f"""shares AS (
  SELECT *, {pct("total_blocking_wait_seconds", "instance_blocking_seconds")} AS pct_of_instance_blocking,
         {pct("total_processor_time_seconds", "instance_processor_seconds")} AS pct_of_total_processor_time
  FROM totals)"""


def _change(c: str, prev: str, out: str) -> str:
    return f"{pct(f'c.{c} - {prev}', prev)} AS {out}"


_ROW, _PAGE = "cast(p.row_lock_wait_seconds AS decimal(18,2))", "cast(p.page_lock_wait_seconds AS decimal(18,2))"
_MOM = f"""mom AS (
  SELECT c.*, {_change("total_blocking_wait_seconds", f"({_ROW} + {_PAGE})", "mom_blocking_change_pct")},
         {_change("row_lock_wait_seconds", _ROW, "mom_row_lock_change_pct")},
         {_change("page_lock_wait_seconds", _PAGE, "mom_page_lock_change_pct")}
  FROM net AS c LEFT JOIN net AS p ON p.server_name = c.server_name AND p.database_id = c.database_id
       AND p.rollup_month = cast(c.rollup_month - INTERVAL 1 MONTH AS date))"""

_DB = f"{G}, database_id, database_name"
MONTHLY = f"""{_TOTALS}, {_RANKED}, {_SHARES}, {_MOM}
SELECT {_DB}, cast(s.row_lock_wait_seconds AS decimal(18,2)) AS row_lock_wait_seconds,
       cast(s.page_lock_wait_seconds AS decimal(18,2)) AS page_lock_wait_seconds,
       cast(cast(s.row_lock_wait_seconds AS decimal(18,2)) + cast(s.page_lock_wait_seconds AS decimal(18,2)) AS decimal(18,2))
         AS total_blocking_wait_seconds,
       CASE WHEN s.total_blocking_wait_seconds = 0 THEN NULL WHEN s.row_lock_wait_seconds >= s.page_lock_wait_seconds
            THEN 'ROW' ELSE 'PAGE' END AS top_blocking_type,
       {pct("greatest(s.row_lock_wait_seconds, s.page_lock_wait_seconds)", "s.total_blocking_wait_seconds")} AS top_blocking_type_pct,
       pct_of_instance_blocking, rank_within_instance, pct_of_total_processor_time,
       mom_blocking_change_pct, mom_row_lock_change_pct, mom_page_lock_change_pct,
       TIMESTAMP '{GENERATED_UTC}' AS created_at_utc
FROM shares AS s JOIN ranked USING ({_DB}) JOIN mom USING ({_DB})"""
ORACLE = {
    "bk1_blocking_net": with_bindings(f"WITH {_NET} SELECT * FROM net"),
    "bk2_instance_totals": with_bindings(f"WITH {_NET}, {_TOTALS} SELECT * FROM totals"),
    "bk3_rank_within_instance": with_bindings(f"WITH {_NET}, {_RANKED} SELECT * FROM ranked"),
    "bk5_blocking_shares": with_bindings(f"WITH {_NET}, {_TOTALS}, {_SHARES} SELECT * FROM shares"),
    "bk6_blocking_mom": with_bindings(f"WITH {_NET}, {_MOM} SELECT * FROM mom"),
    "bk7_blocking_monthly": with_bindings(f"WITH {_NET}, {MONTHLY}"),
}
