"""Rollups of a reset-able event counter per server and local month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.ordered import with_previous_month
from fleetgauge.functions.semantics import GROUP, MONTH, SERVER, choose, days_in_month, lead_by, month_of


def _events(deltas: DataFrame) -> DataFrame:
    return deltas.select(
        SERVER,
        month_of("event_time_local").alias(MONTH),
        F.to_date("event_time_local").alias("event_date"),
        F.hour("event_time_local").alias("hour"),
        "delta",
    )


def daily_counts(deltas: DataFrame) -> DataFrame:
    """Events per server and local date."""
    return _events(deltas).groupBy(*GROUP, "event_date").agg(F.sum("delta").alias("daily_count"))


def _total() -> Column:
    return F.coalesce(F.sum("daily_count"), F.lit(0))


def _zero_days() -> Column:
    return days_in_month(F.col(MONTH)) - F.count_if(F.col("daily_count") > 0).cast("int")


def _busiest() -> list[Column]:
    day, n = F.col("event_date"), F.col("daily_count")
    return [lead_by(day, n, day).alias("busiest_day"), F.max(n).alias("busiest_day_count")]


def _rates(total: Column) -> list[Column]:
    days = days_in_month(F.col(MONTH))
    exact = total.cast("decimal(20,2)")
    return [
        (exact / days).cast("decimal(18,2)").alias("avg_per_day"),
        (exact * 7 / days).cast("decimal(18,2)").alias("avg_per_week"),
    ]


def _hour_label(hour: Column) -> Column:
    text = F.when(hour < 12, F.concat(hour.cast("string"), F.lit(" AM"))).otherwise(
        F.concat((hour - 12).cast("string"), F.lit(" PM"))
    )
    return F.when(hour.isNotNull(), F.coalesce(choose([(hour == 0, "12 AM"), (hour == 12, "12 PM")]), text))


def total_and_zero_days(deltas: DataFrame) -> DataFrame:
    """Events in the month and days without any; days without samples count as zero days."""
    return (
        daily_counts(deltas)
        .groupBy(*GROUP)
        .agg(_total().alias("total_events"), _zero_days().alias("zero_event_days"))
    )


def busiest_day(deltas: DataFrame) -> DataFrame:
    """Day with the most events (earliest among equals) and its count."""
    return daily_counts(deltas).groupBy(*GROUP).agg(*_busiest())


def _peak(hourly: Column) -> list[Column]:
    hour = F.col("hour")
    return [lead_by(hour, hourly, hour).alias("peak_hour_local"), F.max(hourly).alias("peak_hour_count")]


def peak_hour_label(deltas: DataFrame) -> DataFrame:
    """Local hour of day with the most events over the month, with a 12-hour label."""
    return (
        _events(deltas)
        .groupBy(*GROUP, "hour")
        .agg(F.sum("delta").alias("hourly_count"))
        .groupBy(*GROUP)
        .agg(*_peak(F.col("hourly_count")))
        .withColumn("peak_hour_label", _hour_label(F.col("peak_hour_local")))
    )


def avg_rates(deltas: DataFrame) -> DataFrame:
    """Average events per day and per week of the calendar month."""
    totals = daily_counts(deltas).groupBy(*GROUP).agg(_total().alias("total_events"))
    return totals.select(*GROUP, *_rates(F.col("total_events")))


def mom_delta(
    rollup: DataFrame,
    value: str = "total_events",
    out: str = "month_over_month_delta",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Difference to the previous calendar month; a missing month counts as 0."""
    with_before = with_previous_month(rollup, MONTH, [SERVER], {"__before": F.col(value)}, earlier)
    return with_before.withColumn(out, F.col(value) - F.coalesce("__before", F.lit(0))).drop("__before")


def deadlock_monthly(
    deltas: DataFrame, generated_utc: Column, generated_local: Column, earlier: DataFrame | None = None
) -> DataFrame:
    """The full row per server and local month from a single scan.

    Grouping sets count by day and by hour of day in one pass; both are at most 31 rows per
    group, so the final aggregate is small whatever the number of samples.
    """
    days, hours = [*GROUP, "event_date"], [*GROUP, "hour"]
    counted = (
        _events(deltas)
        .groupingSets([days, hours], *GROUP, "event_date", "hour")
        .agg(F.sum("delta").alias("n"), F.grouping("hour").alias("by_day"))
    )
    shaped = counted.select(
        *GROUP,
        "event_date",
        "hour",
        F.when(F.col("by_day") == 1, F.col("n")).alias("daily_count"),
        F.when(F.col("by_day") == 0, F.col("n")).alias("hourly_count"),
    )
    rollup = (
        shaped.groupBy(*GROUP)
        .agg(
            _total().alias("total_events"),
            *_busiest(),
            _zero_days().alias("zero_event_days"),
            *_peak(F.col("hourly_count")),
        )
    )
    return mom_delta(rollup, earlier=earlier).select(
        *GROUP,
        "total_events",
        *_rates(F.col("total_events")),
        *["busiest_day", "busiest_day_count", "month_over_month_delta", "zero_event_days", "peak_hour_local"],
        _hour_label(F.col("peak_hour_local")).alias("peak_hour_label"),
        "peak_hour_count",
        generated_utc.alias("generated_utc"),
        generated_local.alias("generated_local"),
    )
