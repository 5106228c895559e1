"""Months from daily sketches, and scheduler records with the damaged ones beside the good."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import GROUP, month_of
from fleetgauge.functions.sketches import rank_error
from fleetgauge.operators import daily, ingest
from fleetgauge.plans.checking import month
from fleetgauge.plans.disk_queries import _using
from fleetgauge.plans.jobs import sketch_days
from fleetgauge.sources.bindings import bound, with_bindings
from fleetgauge.sources.commits import PublishedTable
from fleetgauge.sources.session import checkpoint_root

#: The samples of one month are sketched by two runs, the later one with its last day.
RUNS = [date(2024, 1, 12), date(2024, 2, 1)]
#: One sketch in a hundred may be off by more than the rank error, none by this many times as much.
TIMES = 3


def rank_checks(values: DataFrame, months: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """How many values each quantile was taken from, and whether its rank is within the stated error.

    One pass over the values counts those below and up to each quantile; the quantiles are a few small rows.
    """
    rows = values.withColumn("rollup_month", month_of("event_time_utc")).join(months.drop("n"), GROUP)
    counts = []
    for name, (column, _) in wanted.items():
        value = F.col(column)
        counts += [F.count(value).alias(f"{name}_n"), F.count_if(value < F.col(name)).alias(f"{name}_below"), F.count_if(value <= F.col(name)).alias(f"{name}_upto")]
    counted = rows.groupBy(*GROUP).agg(*counts)
    checks = []
    for name, (_, fraction) in wanted.items():
        n, room = F.col(f"{name}_n"), F.lit(TIMES * rank_error()) * F.col(f"{name}_n") + 1
        rank = F.lit(fraction) * n
        within = (F.col(f"{name}_below") <= rank + room) & (F.col(f"{name}_upto") >= rank - room)
        checks.append(F.struct(F.lit(name).alias("name"), n.alias("n"), within.alias("within_error")))
    return counted.select(*GROUP, F.inline(F.array(*checks)))


def _sketched(source: str, values_of, wanted: dict[str, tuple[str, float]]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{checkpoint_root(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
        values = values_of(bound(spark, sf_dir, source))
        for until in RUNS:
            sketch_days(spark, values, sorted({c for c, _ in wanted.values()}), path, until)
        return rank_checks(values, daily.monthly_quantiles(PublishedTable(spark, path).read(), wanted), wanted)

    return query


QUERIES = {
    "cp3_cpu_quantiles_sketched": _sketched("cpu_samples", daily.cpu_values, daily.CPU_QUANTILES),
    "mm6_page_life_sketched": _sketched("counter_samples", daily.page_life_values, daily.PAGE_LIFE_QUANTILES),
    "in2_judged_records": _using("landed_scheduler_records")(ingest.judge_scheduler_records),
}


def _counted(source: str, wanted: dict[str, tuple[str, float]], columns: dict[str, str], where: str = "true") -> str:
    each = " UNION ALL ".join(
        f"SELECT server_name, {month('event_time_utc')} AS rollup_month, '{name}' AS name, {columns[c]} AS v FROM {source} WHERE {where}"
        for name, (c, _) in wanted.items()
    )
    return with_bindings(
        f"SELECT server_name, rollup_month, name, cast(count(v) AS bigint) AS n, true AS within_error FROM ({each}) AS e GROUP BY server_name, rollup_month, name"
    )


_TEXT = "nullif(regexp_extract(record, '<{0}>([^<]*)<', 1), '')"
_DAMAGE = f"""CASE WHEN record IS NULL OR trim(record) = '' THEN 'no record' WHEN NOT record LIKE '%</Record>' THEN 'not well-formed'
            WHEN ({_TEXT.format("ProcessUtilization")} IS NOT NULL AND try_cast({_TEXT.format("ProcessUtilization")} AS int) IS NULL)
              OR ({_TEXT.format("SystemIdle")} IS NOT NULL AND try_cast({_TEXT.format("SystemIdle")} AS int) IS NULL) THEN 'not a number' END"""

ORACLE = {
    "cp3_cpu_quantiles_sketched": _counted(
        "cpu_samples", daily.CPU_QUANTILES, {"service": "sql_service", "non_service": "non_sql_process", "total": "100 - idle_process"}
    ),
    "mm6_page_life_sketched": _counted(
        "counter_samples", daily.PAGE_LIFE_QUANTILES, {"ple": "counter_value"}, "counter_name = 'Page life expectancy'"
    ),
    "in2_judged_records": with_bindings(
        f"""SELECT server_name, sampled_at_utc - to_milliseconds(now_tick_ms - tick_ms) AS event_time_utc,
       sampled_at_local - to_milliseconds(now_tick_ms - tick_ms) AS event_time_local,
       CASE WHEN damage IS NULL THEN service END AS sql_service, CASE WHEN damage IS NULL THEN idle END AS idle_process,
       CASE WHEN damage IS NULL THEN 100 - idle - service END AS non_sql_process, damage, CASE WHEN damage IS NOT NULL THEN record END AS record
FROM (SELECT *, try_cast({_TEXT.format("ProcessUtilization")} AS int) AS service, try_cast({_TEXT.format("SystemIdle")} AS int) AS idle, {_DAMAGE} AS damage
      FROM landed_scheduler_records WHERE ring_buffer_type = 'RING_BUFFER_SCHEDULER_MONITOR') AS r"""
    ),
}
