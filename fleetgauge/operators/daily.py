"""Daily summaries that months are made of, so that no sample of a closed day is read again.

Sketches are the approximate, opt-in form of the medians and percentiles of the CPU and memory rollups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import GROUP, MONTH, SERVER, month_of
from fleetgauge.functions.sketches import SIZE, merged, quantile, sketched

DAY = "event_day"

#: Quantiles of the CPU rollup and of page life: name, value and fraction.
CPU_QUANTILES = {
    "median_service_cpu": ("service", 0.5),
    "median_non_service_cpu": ("non_service", 0.5),
    "median_total_cpu": ("total", 0.5),
    "p90_service_cpu": ("service", 0.9),
    "p90_non_service_cpu": ("non_service", 0.9),
    "p90_total_cpu": ("total", 0.9),
}
PAGE_LIFE_QUANTILES = {"median_ple": ("ple", 0.5), "ple_5th_percentile": ("ple", 0.05)}


def cpu_values(samples: DataFrame) -> DataFrame:
    total = (F.lit(100) - F.col("idle_process")).alias("total")
    return samples.select(SERVER, "event_time_utc", F.col("sql_service").alias("service"), F.col("non_sql_process").alias("non_service"), total)


def page_life_values(samples: DataFrame) -> DataFrame:
    """Page-life readings of the long counter table; the filter reaches the scan."""
    return samples.filter(F.col("counter_name") == "Page life expectancy").select(SERVER, "event_time_utc", F.col("counter_value").alias("ple"))


def daily_sketches(values: DataFrame, columns: list[str], ts: str = "event_time_utc", size: int = SIZE) -> DataFrame:
    """One row per server and day: the number of samples and a sketch of each column.

    The sketches of tasks are merged, so a server with most of the samples is many tasks, and a row has a bounded size.
    """
    day = F.to_date(ts).alias(DAY)
    return values.groupBy(SERVER, day).agg(
        F.count(F.lit(1)).alias("n"), *[sketched(F.col(c).cast("bigint"), size).alias(f"{c}_sketch") for c in columns]
    )


def monthly_quantiles(daily: DataFrame, wanted: dict[str, tuple[str, float]], size: int = SIZE) -> DataFrame:
    """Quantiles per server and month from daily sketches: about thirty small rows for each group."""
    columns = sorted({c for c, _ in wanted.values()})
    months = daily.groupBy(SERVER, month_of(DAY).alias(MONTH)).agg(
        F.sum("n").alias("n"), *[merged(f"{c}_sketch", size).alias(f"{c}_sketch") for c in columns]
    )
    return months.select(*GROUP, "n", *[quantile(f"{c}_sketch", p).alias(name) for name, (c, p) in wanted.items()])
