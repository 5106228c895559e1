"""Memory rollups per server and month over the long counter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.quantiles import wide_percentiles
from fleetgauge.functions.semantics import GROUP, MONTH, PERCENT, SERVER, month_of, percent
from fleetgauge.operators.cpu import _completeness

# Counter names and the columns they become.
COUNTER_COLUMNS = {
    "Page life expectancy": "ple",
    "Buffer cache hit ratio": "bchr",
    "Target Server Memory (KB)": "target_server_memory_kb",
    "Total Server Memory (KB)": "total_server_memory_kb",
    "Memory Grants Pending": "memory_grants_pending",
    "Memory Grants Outstanding": "memory_grants_outstanding",
    "Free Memory (KB)": "free_memory_kb",
    "Stolen Server Memory (KB)": "stolen_memory_kb",
}

SAMPLE_MINUTES = 5
_RATIO = "decimal(10,4)"


def pivot_counters(samples: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """One row per server and sample time, one column per counter (largest value on ties).

    The counter list is fixed, so this is one conditional aggregate: no pass to find the
    distinct names and no second shuffle.
    """
    names = COUNTER_COLUMNS if names is None else names
    times = [c for c in ("event_time_utc", "event_time_local") if c in samples.columns]
    return samples.groupBy(SERVER, *times).agg(
        *[F.max(F.when(F.col("counter_name") == n, F.col("counter_value"))).alias(c) for n, c in names.items()]
    )


def steady_ratio() -> Column:
    """Total over target memory; NULL when the target is missing or not positive."""
    total, target = (F.col(c).cast("decimal(19,4)") for c in ("total_server_memory_kb", "target_server_memory_kb"))
    return F.when(target > 0, F.try_divide(total, target))


def _monthly(pivoted: DataFrame) -> DataFrame:
    return pivoted.withColumn(MONTH, month_of("event_time_utc")).withColumn("ratio", steady_ratio())


def completeness(pivoted: DataFrame, every_minutes: int = SAMPLE_MINUTES) -> DataFrame:
    return (
        _monthly(pivoted)
        .groupBy(*GROUP)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*GROUP, *_completeness(F.col("n"), every_minutes))
    )


def _per_point(hits: Column, compat: bool) -> Column:
    """Percent of all collected points; the executed form had no denominator."""
    return F.lit(None).cast(PERCENT) if compat else percent(hits, F.count(F.lit(1)))


def _steady(compat: bool) -> list[Column]:
    low = F.count_if(F.col("ratio") < F.lit("0.90").cast("decimal(3,2)"))
    return [
        F.avg("ratio").cast(_RATIO).alias("avg_steady_state_ratio"),
        F.min("ratio").cast(_RATIO).alias("min_steady_state_ratio"),
        _per_point(low, compat).alias("pct_below_90pct_steady"),
    ]


def _grants(compat: bool) -> list[Column]:
    pending = F.col("memory_grants_pending")
    return [
        _per_point(F.count_if(pending > 0), compat).alias("pct_with_grants_pending"),
        F.max(pending).alias("max_grants_pending"),
    ]


def _page_life_bands(compat: bool) -> list[Column]:
    ple, factor = F.col("ple"), 100 if compat else 1
    return [
        percent(F.count_if(ple <= limit) * factor, F.count(ple)).alias(f"pct_ple_below_{limit}")
        for limit in (600, 300)
    ]


def _page_life_percentiles(pivoted: DataFrame, compat: bool) -> DataFrame:
    tail = 95 if compat else 5
    return wide_percentiles(_monthly(pivoted), GROUP, "ple", {"median_ple": 50, "ple_5th_percentile": tail})


def _hit_ratio() -> list[Column]:
    hit = F.col("bchr")
    return [
        F.avg(hit.cast("decimal(19,4)")).cast(_RATIO).alias("avg_bchr"),
        F.min(hit).alias("min_bchr"),
        percent(F.count_if(hit < 95), F.count(hit)).alias("pct_bchr_below_95"),
    ]


def steady_stats(pivoted: DataFrame, compat: bool = False) -> DataFrame:
    """Average and minimum total/target ratio, percent of points below 0.90."""
    return _monthly(pivoted).groupBy(*GROUP).agg(*_steady(compat))


def grant_stats(pivoted: DataFrame, compat: bool = False) -> DataFrame:
    """Percent of points with pending grants and the largest queue."""
    return _monthly(pivoted).groupBy(*GROUP).agg(*_grants(compat))


def page_life_stats(pivoted: DataFrame, compat: bool = False) -> DataFrame:
    """Median, low tail and share of low values of page life expectancy."""
    bands = _monthly(pivoted).groupBy(*GROUP).agg(*_page_life_bands(compat))
    return bands.join(_page_life_percentiles(pivoted, compat), GROUP, "left")


def hit_ratio_stats(pivoted: DataFrame) -> DataFrame:
    """Average and minimum cache hit ratio, percent of values below 95."""
    return _monthly(pivoted).groupBy(*GROUP).agg(*_hit_ratio())


def memory_monthly(
    samples: DataFrame, generated_utc: Column, generated_local: Column, compat: bool = False
) -> DataFrame:
    """The full memory row per server and month.

    All plain metrics come from one aggregate over the pivot. The page-life percentiles need
    only one counter, so their branch filters the long table first (the filter reaches the
    scan) instead of pivoting everything twice.
    """
    page_life = {n: c for n, c in COUNTER_COLUMNS.items() if c == "ple"}
    only_page_life = pivot_counters(samples.filter(F.col("counter_name").isin(list(page_life))), page_life)
    tail = 95 if compat else 5
    percentiles = wide_percentiles(
        only_page_life.withColumn(MONTH, month_of("event_time_utc")),
        GROUP,
        "ple",
        {"median_ple": 50, "ple_5th_percentile": tail},
    )
    plain = (
        _monthly(pivot_counters(samples))
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("__points"),
            *_steady(compat),
            *_grants(compat),
            *_page_life_bands(compat),
            *_hit_ratio(),
        )
    )

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(plain.schema[name].dataType).alias(name)

    return plain.join(percentiles, GROUP, "left").select(
        *GROUP,
        *_completeness(F.col("__points"), SAMPLE_MINUTES),
        or_zero("avg_steady_state_ratio"),
        or_zero("min_steady_state_ratio"),
        or_zero("pct_below_90pct_steady"),
        or_zero("pct_with_grants_pending"),
        "max_grants_pending",
        *["median_ple", "ple_5th_percentile", "pct_ple_below_600", "pct_ple_below_300"],
        *["avg_bchr", "min_bchr", "pct_bchr_below_95"],
        generated_utc.alias("generated_utc"),
        generated_local.alias("generated_local"),
    )
