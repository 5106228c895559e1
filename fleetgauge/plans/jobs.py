"""Collection and rollup jobs over stored tables.

Every job may run again at any time: what is stored already is left out before the heavy
work and once more before the append.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import MONTH, SERVER, month_of
from fleetgauge.operators.calendar import month_slice
from fleetgauge.operators.daily import daily_sketches
from fleetgauge.operators.ingest import (
    DAMAGE,
    advance_boundaries,
    append_missing_rollups,
    append_new_minutes,
    judge_scheduler_records,
)
from fleetgauge.operators.inventory import FROM, ROWS, SEEN, TO, apply_collections, validity_intervals
from fleetgauge.sources.commits import PublishedTable
from fleetgauge.sources.tables import append_rollup, append_samples, stored_rollups

Rollup = Callable[[DataFrame, DataFrame | None], DataFrame]


def collect_minutes(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    name: str,
    ts: str = "event_time_utc",
    strict: bool = False,
    keys: list[str] | None = None,
) -> None:
    """Append the batch's new minutes to a sample history.

    ``keys`` (by default the server) tell whose minutes are compared, see ``append_new_minutes``.

    Only history between the first and the last minute of the batch can hold a duplicate, so
    the batch's time range (a one-row aggregate) bounds the scan of the history. A minute on
    either side allows for rounding.
    """
    history = stored_rollups(spark, path)
    if history is not None:
        minute = F.expr("INTERVAL 1 MINUTE")
        lo, hi = batch.agg(F.min(ts) - minute, F.max(ts) + minute).first()
        if lo is None:
            return
        history = month_slice(history, lo, hi, ts, "event_month").select(*(keys or [SERVER]), ts)
    append_samples(append_new_minutes(batch, history, keys, ts, strict), path, name, ts)


def roll_up(
    spark: SparkSession,
    source: DataFrame,
    build: Rollup,
    path: str,
    start: date,
    end: date,
    keys: list[str] | None = None,
    ts: str | None = "event_time_utc",
    partition_column: str | None = None,
    kind: str | None = None,
    as_of: date | None = None,
) -> None:
    """Roll up the months in ``[start, end)`` that are not stored yet and append them.

    With ``as_of``, months that were not over on that day are left out; a stored month is never computed again, so an
    open one must not be stored.

    ``build`` gets the pending source rows and the stored rollups from one month before
    ``start`` (None at first). ``ts`` is the time that decides the month; None means that the
    source has ``rollup_month`` itself. ``kind`` is the rollup type where one table holds
    several: rows of another type then do not count as done.
    """
    keys = keys or [SERVER, MONTH]
    if as_of is not None:
        end = min(end, as_of.replace(day=1))
    if ts is None:
        pending = source.filter((F.col(MONTH) >= F.lit(start)) & (F.col(MONTH) < F.lit(end)))
    else:
        pending = month_slice(source, start, end, ts, partition_column)
    stored = stored_rollups(spark, path)
    if stored is None:
        append_rollup(build(pending, None), path)
        return
    if kind is not None:
        stored = stored.filter(F.col("rollup_type") == kind)
    month = F.col(MONTH) if ts is None else month_of(ts)
    stored = stored.filter((F.col(MONTH) >= F.add_months(F.lit(start), -1)) & (F.col(MONTH) < F.lit(end)))
    done = stored.filter(F.col(MONTH) >= F.lit(start))
    groups = done.select(SERVER, F.col(MONTH).alias("__month")).distinct()
    pending = (
        pending.withColumn("__month", month).join(groups, [SERVER, "__month"], "left_anti").select(*source.columns)
    )
    append_rollup(append_missing_rollups(build(pending, stored), done, keys), path)


def publish_months(
    spark: SparkSession,
    source: DataFrame,
    build: Rollup,
    path: str,
    start: date,
    end: date,
    keys: list[str] | None = None,
    ts: str = "event_time_utc",
    partition_column: str | None = None,
    as_of: date | None = None,
    run: str | None = None,
) -> bool:
    """``roll_up`` for tables that several runs may write at once (``PublishedTable``).

    Months that are published already are left out before the heavy work, by the keys of the log; what another run
    publishes meanwhile is left out at the commit. A run that dies leaves nothing behind. False if ``run`` was published.
    """
    table = PublishedTable(spark, path)
    if as_of is not None:
        end = min(end, as_of.replace(day=1))
    pending = month_slice(source, start, end, ts, partition_column)
    known, earlier = table.keys(), table.read()
    if known is not None:
        done = known.select(SERVER, F.col(MONTH).alias("__month")).distinct()
        marked = pending.withColumn("__month", month_of(ts))
        pending = marked.join(done, [SERVER, "__month"], "left_anti").select(*source.columns)
        earlier = earlier.filter((F.col(MONTH) >= F.add_months(F.lit(start), -1)) & (F.col(MONTH) < F.lit(end)))
    return table.publish(build(pending, earlier), keys or [SERVER, MONTH], run)


def snapshot_boundaries(
    spark: SparkSession, batch: DataFrame, restarts: DataFrame, path: str, run: str | None = None, ts: str = "event_time_utc"
) -> bool:
    """Publish the month and restart boundaries that a batch of new samples decides (see ``advance_boundaries``).

    Boundaries and the carried last rows are committed together. A run of the same name is not made twice, and a batch
    that was applied under another name adds nothing.
    """
    return PublishedTable(spark, path).advance(lambda carried: advance_boundaries(batch, carried, restarts, ts), run)


def record_collection(spark: SparkSession, batch: DataFrame, path: str, run: str | None = None, ts: str = "collected_utc") -> bool:
    """Apply newly landed collections of an inventory to its stored validity intervals.

    Closed intervals are published once and never read again; the open ones are the carried state. Servers that have no
    open row keep one with the time of their last collection alone, so that an older one is not applied later.
    """

    def step(carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        facts = [c for c in batch.columns if c != ts]
        if carried is None:
            changed = validity_intervals(batch, ts)
        else:
            changed = apply_collections(carried.filter(F.col(FROM).isNotNull()), batch, ts, last_run=carried)
        seen = batch.select(SERVER, F.col(ts).alias(SEEN))
        if carried is not None:
            seen = seen.unionByName(carried.select(SERVER, SEEN))
        runs = seen.groupBy(SERVER).agg(F.max(SEEN).alias(SEEN))
        changed = changed.persist()
        empty = changed.limit(0).select(*facts, ROWS, FROM, TO, SEEN)
        still_open = changed.filter(F.col(TO).isNull())
        return changed.filter(F.col(TO).isNotNull()), still_open.unionByName(empty.unionByName(runs, allowMissingColumns=True))

    return PublishedTable(spark, path).advance(step, run)


def stored_intervals(spark: SparkSession, path: str) -> DataFrame | None:
    """All validity intervals recorded so far, closed and open ones."""
    table = PublishedTable(spark, path)
    closed, (carried, _) = table.read(), table.state()
    return None if closed is None else closed.unionByName(carried.filter(F.col(FROM).isNotNull()))


def sketch_days(spark: SparkSession, values: DataFrame, columns: list[str], path: str, until: date, ts: str = "event_time_utc") -> bool:
    """Store the sketches of all days before ``until`` that are not stored yet (see ``daily_sketches``).

    The day the last run ended with is the carried state, so a run reads the samples of new closed days alone. A sample
    that comes after its day was closed is not counted.
    """

    def step(carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        since = carried.first()["until"] if carried is not None else date(1, 1, 1)
        fresh = month_slice(values, since, max(since, until), ts)
        return daily_sketches(fresh, columns, ts), spark.createDataFrame([(max(since, until),)], "until date")

    return PublishedTable(spark, path).advance(step)


def collect_scheduler_records(spark: SparkSession, raw: DataFrame, path: str, run: str) -> dict[str, int]:
    """Publish the parsed records of a landing, damaged ones beside the good (see ``judge_scheduler_records``).

    Returns how many records there were and how many were damaged, by reason; both are counted while the records are
    written. A landing that is published already is not counted again (an empty result).
    """
    counts = Observation()
    reasons = {reason: F.count_if(F.col("damage") == reason).alias(reason) for reason in DAMAGE}
    judged = judge_scheduler_records(raw).observe(counts, F.count(F.lit(1)).alias("records"), *reasons.values())
    return counts.get if PublishedTable(spark, path).put(judged, run) else {}
