"""Wait rollups per server and month over boundary snapshots of cumulative wait counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.ordered import with_previous_month
from fleetgauge.functions.semantics import GROUP, MONTH, SERVER, lead_by, percent, percent_or_zero, sum_where
from fleetgauge.operators.ingest import START_OF_MONTH

REPORTED = ["CPU", "Memory", "Disk", "Blocking", "Other"]
BLOCKING = "Blocking"
MEASURES = ["wait_seconds", "resource_seconds", "signal_seconds"]
TRENDS = ["total_wait_seconds"] + [f"{c.lower()}_wait_seconds" for c in REPORTED[:4]]

_SECONDS = "decimal(18,2)"


def signed_boundaries(boundaries: DataFrame, cols: list[str]) -> DataFrame:
    """Opening snapshots negated, so that a plain sum is the activity inside the month."""
    opening = F.col("snapshot_type") == START_OF_MONTH
    return boundaries.withColumns(
        {c: F.when(opening, -F.abs(F.col(c))).otherwise(F.col(c)).cast(boundaries.schema[c].dataType) for c in cols}
    )


def boundary_net(boundaries: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Signed sums of ``cols`` per ``keys``: activity inside the month across restarts."""
    return signed_boundaries(boundaries, cols).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def net_by_type(boundaries: DataFrame) -> DataFrame:
    return boundary_net(boundaries, [*GROUP, "wait_type", "category"], MEASURES)


def category_report(boundaries: DataFrame) -> DataFrame:
    """Per category: average server time of its wait types, summed waits, and their ratio."""
    cols = ["total_server_time_seconds", *MEASURES]
    waited, server_time = F.sum("wait_seconds"), F.avg("total_server_time_seconds")
    ratio = F.round(F.try_divide(waited.cast("double"), server_time), 2)
    return (
        boundary_net(boundaries, [*GROUP, "wait_type", "category"], cols)
        .groupBy(*GROUP, "category")
        .agg(
            server_time.alias("total_server_time_seconds"),
            *[F.sum(c).cast(_SECONDS).alias(f"monthly_{c}") for c in MEASURES],
            F.when(waited == 0, F.lit(0.0)).otherwise(ratio).alias("total_wait_pct"),
        )
    )


def category_totals(boundaries: DataFrame) -> DataFrame:
    """Summed waits per category, with the group's grand total on every row.

    The window runs over a handful of categories per group, after aggregation.
    """
    per_category = boundary_net(boundaries, [*GROUP, "category"], MEASURES)
    grand = F.sum("wait_seconds").over(Window.partitionBy(*GROUP))
    return per_category.select(
        *GROUP,
        "category",
        *[F.col(c).cast(_SECONDS).alias(f"total_{c}") for c in MEASURES],
        grand.cast(_SECONDS).alias("grand_total_wait_seconds"),
    )


def _category_columns() -> list[Column]:
    total = F.sum("wait_seconds")
    seconds = {c: sum_where(F.col("category") == c, F.col("wait_seconds")) for c in REPORTED}
    return [
        total.cast(_SECONDS).alias("total_wait_seconds"),
        *[s.cast(_SECONDS).alias(f"{c.lower()}_wait_seconds") for c, s in seconds.items()],
        *[percent_or_zero(s, total).alias(f"{c.lower()}_wait_pct") for c, s in seconds.items()],
    ]


def category_pivot(boundaries: DataFrame) -> DataFrame:
    """Seconds and percent columns for the reported categories.

    Other categories count in the total only, so the percents need not add up to 100.
    """
    return boundary_net(boundaries, [*GROUP, "category"], ["wait_seconds"]).groupBy(*GROUP).agg(*_category_columns())


def signal_ratio() -> Column:
    """Signal over resource seconds, 4 decimals, NULL when there are no resource seconds."""
    return F.try_divide(F.sum("signal_seconds"), F.sum("resource_seconds")).cast("decimal(18,4)")


def _ranked_types(net: DataFrame) -> DataFrame:
    w = Window.partitionBy(*GROUP).orderBy(F.desc("type_seconds"), "wait_type")
    return net.withColumn("rank", F.dense_rank().over(w))


def _top_columns(k: int, total: Column) -> list[Column]:
    cols = []
    for i in range(1, k + 1):
        seconds = F.max(F.when(F.col("rank") == i, F.col("type_seconds")))
        pct = F.when(total == 0, F.lit(0).cast(_SECONDS)).otherwise(percent(seconds, total))
        cols += [
            F.max(F.when(F.col("rank") == i, F.col("wait_type"))).alias(f"top_wait_type_{i}"),
            seconds.cast(_SECONDS).alias(f"top_wait_type_{i}_seconds"),
            pct.alias(f"top_wait_type_{i}_pct"),
        ]
    return cols


def top_k_wide(boundaries: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` largest wait types laid out as columns; equal waits rank by name.

    Ranks are taken over wait types after aggregation: a catalogue of fixed size per group.
    """
    net = boundary_net(boundaries, [*GROUP, "wait_type"], ["wait_seconds"])
    return (
        _ranked_types(net.withColumn("type_seconds", F.col("wait_seconds")))
        .groupBy(*GROUP)
        .agg(*_top_columns(k, F.sum("wait_seconds")))
    )


def peak_hour(boundaries: DataFrame, category: str = BLOCKING) -> DataFrame:
    """Local hour of day with the most waiting in a category; the earliest among equals."""
    return (
        boundary_net(
            boundaries.filter(F.col("category") == category).withColumn("hour", F.hour("snapshot_date_local")),
            [*GROUP, "hour"],
            ["wait_seconds"],
        )
        .groupBy(*GROUP)
        .agg(lead_by(F.col("hour"), F.col("wait_seconds"), F.col("hour")).alias("peak_blocking_hour_local"))
    )


def top_type(boundaries: DataFrame, category: str = BLOCKING) -> DataFrame:
    """Largest wait type of a category; the first by name among equals."""
    name = F.col("wait_type")
    return (
        boundary_net(boundaries.filter(F.col("category") == category), [*GROUP, "wait_type"], ["wait_seconds"])
        .groupBy(*GROUP)
        .agg(lead_by(name, F.col("wait_seconds"), name).alias("top_blocking_wait_type"))
    )


def mom_pct(
    rollup: DataFrame, cols: dict[str, str], keys: list[str] | None = None, earlier: DataFrame | None = None
) -> DataFrame:
    """Percent change against the previous calendar month, one column per entry of ``cols``.

    NULL when that month is missing or its value is 0. ``earlier`` are stored rollup rows
    that new months may follow.
    """
    before = {f"__before_{c}": F.col(c) for c in cols}
    with_before = with_previous_month(rollup, MONTH, keys or [SERVER], before, earlier)
    changes = {out: percent(F.col(c) - F.col(f"__before_{c}"), F.col(f"__before_{c}")) for c, out in cols.items()}
    return with_before.withColumns(changes).drop(*before)


def trend_columns() -> dict[str, str]:
    return {c: f"mom_{c.removesuffix('_seconds')}_change_pct" for c in TRENDS}


def wait_monthly(boundaries: DataFrame, created_at: Column, earlier: DataFrame | None = None) -> DataFrame:
    """The full wait row per server and month.

    Snapshots are netted once per (type, category, hour). That result is small per group and
    is brought together by (server, month) once; type totals, hour totals, ranks and the
    final row all reuse that exchange.
    """
    net = boundary_net(
        boundaries.withColumn("hour", F.hour("snapshot_date_local")),
        [*GROUP, "wait_type", "category", "hour"],
        MEASURES,
    ).repartition(*GROUP)
    by_type, by_hour = Window.partitionBy(*GROUP, "wait_type"), Window.partitionBy(*GROUP, "hour")
    blocking = F.when(F.col("category") == BLOCKING, F.col("wait_seconds"))
    name, hour = F.col("wait_type"), F.col("hour")
    is_blocking = F.col("category") == BLOCKING
    shaped = net.withColumns(
        {
            "type_seconds": F.sum("wait_seconds").over(by_type),
            "blocking_type_seconds": F.when(is_blocking, F.sum(blocking).over(by_type)),
            "blocking_hour_seconds": F.when(is_blocking, F.sum(blocking).over(by_hour)),
        }
    )
    rollup = (
        _ranked_types(shaped)
        .groupBy(*GROUP)
        .agg(
            F.sum("resource_seconds").cast(_SECONDS).alias("total_resource_seconds"),
            F.sum("signal_seconds").cast(_SECONDS).alias("total_signal_seconds"),
            signal_ratio().alias("signal_to_resource_ratio"),
            *_category_columns(),
            *_top_columns(3, F.sum("wait_seconds")),
            lead_by(hour, F.col("blocking_hour_seconds"), hour).alias("peak_blocking_hour_local"),
            lead_by(name, F.col("blocking_type_seconds"), name).alias("top_blocking_wait_type"),
        )
    )
    return mom_pct(rollup, trend_columns(), earlier=earlier).withColumn("created_at_utc", created_at)
