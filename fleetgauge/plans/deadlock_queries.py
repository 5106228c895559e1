"""Queries over reset-able event counters.

``counter_resets`` has many samples in one month, ``cumulative_samples`` few in each of many.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.operators import deadlocks
from fleetgauge.operators.ingest import counter_delta
from fleetgauge.plans.checking import STAMPS, G, days, month, stamps
from fleetgauge.sources.bindings import bound, with_bindings


def one_month(spark, sf_dir):
    return counter_delta(bound(spark, sf_dir, "counter_resets"), order=["event_time_utc", "sample_id"])


def many_months(spark, sf_dir):
    samples = bound(spark, sf_dir, "cumulative_samples").withColumn("event_time_local", F.col("event_time_utc"))
    return counter_delta(samples, "value", bucket="month")


def _over(source, fn):
    return lambda spark, sf_dir: fn(source(spark, sf_dir))


QUERIES = {
    "dd1_daily_counts": _over(one_month, deadlocks.daily_counts),
    "dd2_total_and_zero_days": _over(many_months, deadlocks.total_and_zero_days),
    "dd3_busiest_day": _over(many_months, deadlocks.busiest_day),
    "dd4_peak_hour_label": _over(one_month, deadlocks.peak_hour_label),
    "dd5_avg_rates": _over(many_months, deadlocks.avg_rates),
    "dd6_mom_delta": _over(
        many_months,
        lambda d: deadlocks.mom_delta(deadlocks.total_and_zero_days(d).select("server_name", "rollup_month", "total_events")),
    ),
    "dd7_deadlock_monthly": _over(one_month, lambda d: deadlocks.deadlock_monthly(d, **stamps())),
    "dd7_deadlock_monthly_history": _over(many_months, lambda d: deadlocks.deadlock_monthly(d, **stamps())),
}


def delta_sql(value: str, order: str, source: str) -> str:
    """Increase since the previous sample with reset, over a whole server history."""
    return f"""SELECT *, cast(CASE WHEN before IS NULL THEN 0 WHEN {value} < before THEN {value} ELSE {value} - before END AS bigint) AS delta
FROM (SELECT *, lag({value}) OVER (PARTITION BY server_name ORDER BY {order}) AS before FROM {source}) AS w"""


_ONE = f"d AS ({delta_sql('raw_counter_value', 'event_time_utc, sample_id', 'counter_resets')})"
_MANY = f"""d AS (SELECT *, event_time_utc AS event_time_local
  FROM ({delta_sql('value', 'event_time_utc', 'cumulative_samples')}) AS x)"""
_DAILY = f"""daily AS (
  SELECT server_name, {month("event_time_local")} AS rollup_month, cast(event_time_local AS date) AS event_date,
         cast(sum(delta) AS bigint) AS daily_count
  FROM d GROUP BY server_name, {month("event_time_local")}, cast(event_time_local AS date))"""
_HOURLY = f"""hourly AS (
  SELECT server_name, {month("event_time_local")} AS rollup_month, cast(hour(event_time_local) AS int) AS h,
         cast(sum(delta) AS bigint) AS n
  FROM d GROUP BY server_name, {month("event_time_local")}, cast(hour(event_time_local) AS int))"""
_TOTALS = f"""totals AS (
  SELECT {G}, cast(sum(daily_count) AS bigint) AS total_events,
         cast({days("rollup_month")} - count(*) FILTER (WHERE daily_count > 0) AS int) AS zero_event_days
  FROM daily GROUP BY {G})"""
_BUSY = f"""busy AS (
  SELECT {G}, event_date AS busiest_day, daily_count AS busiest_day_count
  FROM (SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY daily_count DESC, event_date) AS rn FROM daily) AS r
  WHERE rn = 1)"""
_PEAK = f"""peak AS (
  SELECT {G}, h AS peak_hour_local, n AS peak_hour_count,
         CASE WHEN h = 0 THEN '12 AM' WHEN h < 12 THEN concat(cast(h AS string), ' AM') WHEN h = 12 THEN '12 PM'
              ELSE concat(cast(h - 12 AS string), ' PM') END AS peak_hour_label
  FROM (SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY n DESC, h) AS rn FROM hourly) AS r
  WHERE rn = 1)"""
_RATES = f"""rates AS (
  SELECT {G}, cast(round(cast(total_events AS double) / {days("rollup_month")}, 2) AS decimal(18,2)) AS avg_per_day,
         cast(round(total_events * 7.0 / {days("rollup_month")}, 2) AS decimal(18,2)) AS avg_per_week
  FROM totals)"""
_MOM = """mom AS (
  SELECT c.server_name, c.rollup_month, c.total_events,
         c.total_events - coalesce(p.total_events, 0) AS month_over_month_delta
  FROM totals AS c LEFT JOIN totals AS p ON p.server_name = c.server_name
       AND p.rollup_month = cast(c.rollup_month - INTERVAL 1 MONTH AS date))"""


def _full(source: str) -> str:
    return with_bindings(f"""WITH {source}, {_DAILY}, {_HOURLY}, {_TOTALS}, {_BUSY}, {_PEAK}, {_RATES}, {_MOM}
SELECT *, {STAMPS} FROM totals JOIN rates USING ({G}) JOIN busy USING ({G}) JOIN peak USING ({G})
JOIN (SELECT {G}, month_over_month_delta FROM mom) AS m USING ({G})""")


ORACLE = {
    "dd1_daily_counts": with_bindings(f"WITH {_ONE}, {_DAILY} SELECT * FROM daily"),
    "dd2_total_and_zero_days": with_bindings(f"WITH {_MANY}, {_DAILY}, {_TOTALS} SELECT * FROM totals"),
    "dd3_busiest_day": with_bindings(f"WITH {_MANY}, {_DAILY}, {_BUSY} SELECT * FROM busy"),
    "dd4_peak_hour_label": with_bindings(f"WITH {_ONE}, {_HOURLY}, {_PEAK} SELECT * FROM peak"),
    "dd5_avg_rates": with_bindings(f"WITH {_MANY}, {_DAILY}, {_TOTALS}, {_RATES} SELECT * FROM rates"),
    "dd6_mom_delta": with_bindings(f"WITH {_MANY}, {_DAILY}, {_TOTALS}, {_MOM} SELECT * FROM mom"),
    "dd7_deadlock_monthly": _full(_ONE),
    "dd7_deadlock_monthly_history": _full(_MANY),
}
