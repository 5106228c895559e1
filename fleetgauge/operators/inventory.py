"""Inventories over time: repeated collections become validity intervals, intervals one inventory per month.

An inventory (files, log segments, schedulers, settings) is landed as a whole at every collection. Most rows do not change
from one collection to the next, so what is kept is one row per unchanged stretch. A report of any month then reads the
state its month ended with, and a backfill of many months is one job.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import MONTH, SERVER, month_of

FROM, TO, SEEN, ROWS = "valid_from_utc", "valid_to_utc", "last_seen_utc", "row_count"


def _calendar(times: DataFrame, ts: str) -> DataFrame:
    """Collections of a server, numbered, each with the one after it. One row per server and collection."""
    own = Window.partitionBy(SERVER).orderBy(ts)
    return times.select(SERVER, ts).distinct().withColumns({"__n": F.row_number().over(own), "__next": F.lead(ts).over(own)})


def _stretches(seen: DataFrame, facts: list[str], ts: str) -> DataFrame:
    """Rows of collections that follow each other, as one row. ``seen`` has ``__n``, ``__next`` and the count of equal rows.

    A row that is missing from a collection, or occurs another number of times in it, ends there.
    """
    same = [*facts, ROWS]
    place = F.row_number().over(Window.partitionBy(*same).orderBy("__n"))
    return (
        seen.withColumn("__run", F.col("__n") - place)
        .groupBy(*same, "__run")
        .agg(F.min("__from").alias(FROM), F.max_by("__next", "__n").alias(TO), F.max(ts).alias(SEEN))
        .select(*facts, ROWS, FROM, TO, SEEN)
    )


def validity_intervals(inventory: DataFrame, ts: str = "collected_utc", collections: DataFrame | None = None) -> DataFrame:
    """Intervals ``[valid_from_utc, valid_to_utc)`` in which each inventory row was there, from all its collections.

    A row is valid from the collection that shows it first to the server's next collection that does not show it;
    ``valid_to_utc`` is NULL while the newest collection has it. ``row_count`` says how many equal rows there are
    (inventories such as log segments are bags); a change of it starts a new interval. ``last_seen_utc`` is the last
    collection with the row. Servers are collected at times of their own. A collection that found nothing leaves no rows:
    list all runs in ``collections`` (server and time) where that can happen.

    Equal rows are counted map-side, and stretches are found within one row's collections, so a server with most of
    the rows is many groups; only its collection times are ordered together.
    """
    facts = [c for c in inventory.columns if c != ts]
    counted = inventory.groupBy(*facts, ts).agg(F.count(F.lit(1)).alias(ROWS))
    calendar = _calendar(inventory if collections is None else collections, ts)
    return _stretches(counted.join(calendar, [SERVER, ts]).withColumn("__from", F.col(ts)), facts, ts)


def apply_collections(
    stored: DataFrame, batch: DataFrame, ts: str = "collected_utc", last_run: DataFrame | None = None, collections: DataFrame | None = None
) -> DataFrame:
    """Stored open intervals and newly landed collections: the intervals that are closed by them and those open after them.

    ``stored`` needs the open rows only (``valid_to_utc`` is NULL); closed ones never change. What is returned replaces
    them. A server's collections at or before its last known one were applied already and are left out, so applying a
    batch again changes nothing. ``last_run`` (server and ``last_seen_utc``) tells the last collection of servers that may
    have no open row; by default it is what the open rows say.
    """
    facts = [c for c in batch.columns if c != ts]
    known = stored.filter(F.col(TO).isNull())
    last = F.broadcast((known if last_run is None else last_run).groupBy(SERVER).agg(F.max(SEEN).alias("__last")))
    fresh = batch.join(last, SERVER, "left").filter(F.col("__last").isNull() | (F.col(ts) > F.col("__last")))
    counted = fresh.groupBy(*facts, ts).agg(F.count(F.lit(1)).alias(ROWS)).withColumn("__from", F.col(ts))
    runs = (batch if collections is None else collections).select(SERVER, ts)
    runs = runs.join(last, SERVER, "left").filter(F.col("__last").isNull() | (F.col(ts) > F.col("__last"))).select(SERVER, ts)
    calendar = _calendar(runs.unionByName(last.select(SERVER, F.col("__last").alias(ts))), ts)
    carried = known.join(last, SERVER).select(*facts, F.col("__last").alias(ts), ROWS, F.col(FROM).alias("__from"))
    return _stretches(counted.unionByName(carried).join(calendar, [SERVER, ts]), facts, ts)


def monthly_inventory(intervals: DataFrame, start: date, end: date) -> DataFrame:
    """The state each month in ``[start, end)`` ended with: inventory rows with ``rollup_month`` and ``row_count``.

    An interval knows the months whose end it covers, so it unfolds into them; no pair of an interval and a month that do
    not belong together is ever formed. A server has no rows in months that ended before its first collection.
    """
    first = F.greatest(month_of(FROM), F.lit(start))
    # a month's end lies inside if the row is still there at the first instant of the next month, or is never gone
    last = F.least(F.add_months(month_of(TO), -1), F.lit(end) - F.expr("INTERVAL 1 MONTH")).cast("date")
    months = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    return intervals.withColumn(MONTH, F.explode(months)).drop(FROM, TO, SEEN)


def by_month(inventory: DataFrame, start: date, end: date, ts: str = "collected_utc", collections: DataFrame | None = None) -> DataFrame:
    """Collections of an inventory to the state at the end of each month."""
    return monthly_inventory(validity_intervals(inventory, ts, collections), start, end)
