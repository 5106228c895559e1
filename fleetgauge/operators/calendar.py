"""Month slices and report periods. Clocks are always parameters."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import MONTH, SERVER, minutes_in_month, month_of


def month_slice(
    df: DataFrame,
    start: date | datetime,
    end: date | datetime,
    ts: str = "event_time_utc",
    partition_column: str | None = None,
) -> DataFrame:
    """Rows with ``start <= ts < end``.

    Both bounds are literals, so they reach the Parquet reader as pushed filters. When the
    history is stored by month, name that column to prune whole partitions too.
    """
    lo, hi = (F.lit(x.isoformat(sep=" ") if isinstance(x, datetime) else x.isoformat()) for x in (start, end))
    kept = df.filter((F.col(ts) >= lo.cast("timestamp_ntz")) & (F.col(ts) < hi.cast("timestamp_ntz")))
    if partition_column:
        kept = kept.filter(
            (F.col(partition_column) >= F.trunc(lo.cast("date"), "MM")) & (F.col(partition_column) <= hi.cast("date"))
        )
    return kept


def latest_collection(inventory: DataFrame, as_of: Column, ts: str = "collected_utc") -> DataFrame:
    """The rows of each server's newest collection at or before ``as_of``.

    Inventories (files, log segments, settings) are landed as a whole, again and again; a report counts one of them.
    Servers may be collected at different times. A server without a collection by then has no rows. The newest times are
    a map-side combined aggregate with one row per server; the inventory is not sorted.
    """
    known = inventory.filter(F.col(ts) <= as_of)
    newest = known.groupBy(SERVER).agg(F.max(ts).alias(ts))
    return known.join(newest, [SERVER, ts], "left_semi")


def report_period(as_of: Column) -> dict[str, Column]:
    """The calendar month before ``as_of``: first day, last day, minutes."""
    start = F.add_months(month_of(as_of), -1)
    return {
        "start_of_month": start,
        "end_of_month": F.last_day(start),
        "total_minutes": minutes_in_month(start),
    }


def month_spine(df: DataFrame, as_of: Column, ts: str = "event_time_utc") -> DataFrame:
    """Every report month from the first sample up to the month before ``as_of``.

    One row per month: its bounds and its length in minutes. Only the smallest event time
    leaves the samples (a one-row aggregate); months without samples are listed too.
    """
    last = report_period(as_of)["start_of_month"]
    first = month_of("__first")
    return (
        df.agg(F.min(ts).alias("__first"))
        .filter(first <= last)
        .select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias(MONTH))
        .select(MONTH, F.last_day(MONTH).alias("end_of_month"), minutes_in_month(F.col(MONTH)).alias("total_minutes"))
    )
