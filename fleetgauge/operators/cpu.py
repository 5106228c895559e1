"""CPU rollups per server and month.

Everything but the hourly part is a function of how often each load triple occurred. Loads
are percentages, so that frequency table has a bounded number of rows per group however
many samples a server sent, and it is built with a map-side combined count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import (
    GROUP,
    MONTH,
    PERCENT,
    SERVER,
    hour_start,
    int_avg,
    int_div,
    minutes_in_month,
    month_of,
    percent,
    percent_or_zero,
)

SATURATION_THRESHOLD = 85

_LOADS = ["service", "non_service", "total"]
_RATE = "decimal(5,2)"


def _load(df: DataFrame) -> DataFrame:
    return df.select(
        SERVER,
        month_of("event_time_utc").alias(MONTH),
        hour_start("event_time_utc").alias("hour_start"),
        F.col("sql_service").alias("service"),
        F.col("non_sql_process").alias("non_service"),
        (F.lit(100) - F.col("idle_process")).alias("total"),
    )


def load_profile(df: DataFrame) -> DataFrame:
    """How many samples of each (service, non-service, total) load a server had per month."""
    return _load(df).groupBy(*GROUP, *_LOADS).agg(F.count(F.lit(1)).alias("n"))


def _weighted(load: str) -> Column:
    return F.sum(F.col(load) * F.col("n"))


def _share(numerator: Column, to: str = PERCENT) -> Column:
    return percent_or_zero(numerator, _weighted("service") + _weighted("non_service"), to)


def _completeness(points: Column, every_minutes: int) -> list[Column]:
    expected = F.floor(minutes_in_month(F.col(MONTH)) / every_minutes).cast("int")
    return [
        expected.alias("expected_points"),
        points.alias("collected_points"),
        percent_or_zero(points, expected).alias("accuracy_percent"),
    ]


def completeness(df: DataFrame, every_minutes: int = 1) -> DataFrame:
    """Expected and collected samples per server and month, and their ratio in percent."""
    return (
        df.groupBy(SERVER, month_of("event_time_utc").alias(MONTH))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*GROUP, *_completeness(F.col("n"), every_minutes))
    )


def _percentile(load: str, p: float) -> Column:
    return F.percentile(load, p, F.col("n"))


def cpu_load(df: DataFrame) -> DataFrame:
    """Average, peak and 90th percentile of total load."""
    return load_profile(df).groupBy(*GROUP).agg(*_load_stats())


def _load_stats() -> list[Column]:
    average = _weighted("total").cast("decimal(20,0)") / F.sum(F.when(F.col("total").isNotNull(), F.col("n")))
    return [
        average.cast(_RATE).alias("avg_total_cpu"),
        F.max("total").cast(_RATE).alias("peak_total_cpu"),
        _percentile("total", 0.9).cast(_RATE).alias("p90_total_cpu"),
    ]


def cpu_medians(df: DataFrame) -> DataFrame:
    """Interpolated medians of the three loads."""
    return load_profile(df).groupBy(*GROUP).agg(
        *[_percentile(c, 0.5).cast(_RATE).alias(f"median_{c}_cpu") for c in _LOADS]
    )


def cpu_p90(df: DataFrame) -> DataFrame:
    """90th percentile of service and non-service load."""
    return load_profile(df).groupBy(*GROUP).agg(
        *[_percentile(c, 0.9).cast(_RATE).alias(f"p90_{c}_cpu") for c in _LOADS[:2]]
    )


def _against_group(profile: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Attach group percentiles to the rows of the (bounded) frequency table."""
    w = Window.partitionBy(*GROUP)
    return profile.select("*", *[_percentile(c, p).over(w).alias(name) for name, (c, p) in wanted.items()])


def _above_median(load: str) -> Column:
    over = F.col(load) > F.col(f"__median_{load}")
    total = F.sum(F.when(over, F.col(load) * F.col("n")))
    return int_div(total, F.sum(F.when(over, F.col("n")))).cast(_RATE).alias(f"load_above_median_{load}")


def _medians() -> dict[str, tuple[str, float]]:
    return {f"__median_{c}": (c, 0.5) for c in _LOADS}


def load_above_median(df: DataFrame) -> DataFrame:
    """Whole-number average of the samples strictly above the group's own median."""
    return _against_group(load_profile(df), _medians()).groupBy(*GROUP).agg(*[_above_median(c) for c in _LOADS])


def _at_or_above_p90() -> Column:
    hits = F.sum(F.when(F.col("total") >= F.col("__p90_total"), F.col("n")).otherwise(F.lit(0)))
    return percent(hits, F.sum("n"), "decimal(7,2)").alias("pct_in_top10_total")


def pct_at_or_above_p90(df: DataFrame) -> DataFrame:
    """Percent of samples whose total load reaches the group's 90th percentile."""
    return (
        _against_group(load_profile(df), {"__p90_total": ("total", 0.9)}).groupBy(*GROUP).agg(_at_or_above_p90())
    )


def _saturation(hour_average: Column, threshold: int) -> list[Column]:
    saturated = hour_average > threshold
    worst = F.min_by("hour_start", F.when(saturated, F.struct((-hour_average).alias("a"), F.col("hour_start").alias("h"))))
    return [
        F.count_if(saturated).cast("int").alias("saturation_hours"),
        worst.alias("worst_hour_start"),
    ]


def saturation_hours(df: DataFrame, threshold: int = SATURATION_THRESHOLD) -> DataFrame:
    """Hours whose whole-number average load exceeds the threshold, and the worst of them.

    Two aggregation levels, both combined map-side: hours first, then months. The earliest
    hour wins among equals.
    """
    return (
        _load(df)
        .groupBy(*GROUP, "hour_start")
        .agg(int_avg(F.col("total")).alias("avg_cpu"))
        .groupBy(*GROUP)
        .agg(*_saturation(F.col("avg_cpu"), threshold))
    )


def cpu_share(df: DataFrame) -> DataFrame:
    """Service and non-service share of the summed load, 0 when there was none."""
    return load_profile(df).groupBy(*GROUP).agg(*_shares())


def _shares() -> list[Column]:
    return [
        _share(_weighted("service")).alias("service_percent_of_total"),
        _share(_weighted("non_service")).alias("non_service_percent_of_total"),
    ]


def cpu_monthly(
    df: DataFrame,
    generated_utc: Column,
    generated_local: Column,
    threshold: int = SATURATION_THRESHOLD,
    time_method: int = 1,
) -> DataFrame:
    """The full CPU row per server and month.

    One pass builds the load profile, on which a window per group finds the percentiles that
    other metrics compare with; a second, narrower pass averages the hours. Measured against
    one pass that feeds both through grouping sets, this sorts far fewer rows. Both results
    arrive partitioned by (server, month), so joining them moves nothing.
    """
    profiled = (
        _against_group(load_profile(df), _medians() | {"__p90_total": ("total", 0.9)})
        .groupBy(*GROUP)
        .agg(
            F.sum("n").alias("__points"),
            *_load_stats(),
            *[F.first(f"__median_{c}").cast(_RATE).alias(f"median_{c}_cpu") for c in _LOADS],
            *[_above_median(c) for c in _LOADS],
            *[_percentile(c, 0.9).cast(_RATE).alias(f"p90_{c}_cpu") for c in _LOADS[:2]],
            _at_or_above_p90(),
            *_shares(),
        )
    )
    return (
        profiled.join(saturation_hours(df, threshold), GROUP)
        .select(
            *GROUP,
            *_completeness(F.col("__points"), 1),
            *["avg_total_cpu", "peak_total_cpu", "p90_total_cpu"],
            *[f"median_{c}_cpu" for c in _LOADS],
            *[f"load_above_median_{c}" for c in _LOADS],
            *["p90_service_cpu", "p90_non_service_cpu", "pct_in_top10_total"],
            *["saturation_hours", "worst_hour_start"],
            *["service_percent_of_total", "non_service_percent_of_total"],
            generated_utc.alias("generated_utc"),
            generated_local.alias("generated_local"),
            F.lit(time_method).alias("report_generation_time_method"),
        )
    )
