"""Collection to monthly rollup as one job of stages, each published by its commit log.

A stage reads what the stage before it published under the run's name and publishes its own under the same name. A run
that is started again skips the stages that are published and goes on with the first that is not, so no stage is made
twice and none sees half of its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import GROUP, MONTH, SERVER
from fleetgauge.operators import blocking, ingest, waits
from fleetgauge.plans.jobs import snapshot_boundaries
from fleetgauge.sources.commits import PublishedTable

Stage = tuple[str, Callable[[], bool]]


def run_stages(stages: list[Stage], tables: dict[str, PublishedTable], run: str) -> list[str]:
    """Makes the stages that are not published under ``run`` yet, in their order; returns their names."""
    made = []
    for name, make in stages:
        if run not in tables[name].log.runs() and make():
            made.append(name)
    return made


def progress(spark: SparkSession, root: str, names: list[str]) -> dict[str, list[str]]:
    """Runs that each stage has completed, oldest first."""
    return {name: PublishedTable(spark, f"{root}/{name}").log.runs() for name in names}


def _pending(boundaries: DataFrame, published: DataFrame | None) -> DataFrame:
    """Boundary rows of closed months that have no published rollup."""
    closed = ingest.closed_months(boundaries)
    return closed if published is None else closed.join(published.select(*GROUP).distinct(), GROUP, "left_anti")


def _collect(
    spark: SparkSession,
    root: str,
    run: str,
    names: list[str],
    samples: Callable[[], DataFrame],
    restarts: DataFrame,
    rollup: Callable[[DataFrame, DataFrame | None], DataFrame],
    keys: list[str],
) -> list[str]:
    tables = {name: PublishedTable(spark, f"{root}/{name}") for name in names}
    sampled, bounded, rolled = names

    def roll_up() -> bool:
        published = tables[rolled].read()
        return tables[rolled].publish(rollup(_pending(tables[bounded].read(), published), published), keys, run)

    stages = [
        (sampled, lambda: tables[sampled].put(samples(), run)),
        (bounded, lambda: snapshot_boundaries(spark, tables[sampled].rows_of(run), restarts, tables[bounded].path, run)),
        (rolled, roll_up),
    ]
    return run_stages(stages, tables, run)


WAIT_STAGES = ["wait_samples", "wait_boundaries", "wait_monthly"]
LOCK_STAGES = ["lock_wait_samples", "lock_wait_boundaries", "blocking_monthly"]


def collect_waits(
    spark: SparkSession, root: str, run: str, raw: DataFrame, capacity: DataFrame, restarts: DataFrame, created_at: Column
) -> list[str]:
    """Landed raw waits to classified samples, month boundaries and the wait rollup of every month closed by them.

    ``run`` names the landing: give a landing the same name when it is collected again. Returns the stages made.
    """
    return _collect(
        spark, root, run, WAIT_STAGES, lambda: ingest.classify_waits(raw, capacity), restarts,
        lambda pending, earlier: waits.wait_monthly(pending, created_at, earlier), GROUP,
    )


def collect_lock_waits(
    spark: SparkSession, root: str, run: str, index_stats: DataFrame, databases: DataFrame, capacity: DataFrame,
    restarts: DataFrame, created_at: Column,
) -> list[str]:
    """Landed index statistics to lock waits by database, month boundaries and the blocking rollup of closed months."""
    return _collect(
        spark, root, run, LOCK_STAGES, lambda: ingest.lock_waits_by_database(index_stats, databases, capacity), restarts,
        lambda pending, earlier: blocking.blocking_monthly(pending, created_at, earlier), [*GROUP, "database_id", "database_name"],
    )


def landings(df: DataFrame, cuts: list, ts: str = "event_time_utc") -> list[DataFrame]:
    """A history as landings in order of time, cut at the given instants."""
    edges = [None, *cuts, None]
    at = F.col(ts)
    return [
        df.filter((F.lit(True) if lo is None else at >= F.lit(str(lo)).cast("timestamp_ntz")) & (F.lit(True) if hi is None else at < F.lit(str(hi)).cast("timestamp_ntz")))
        for lo, hi in zip(edges, edges[1:])
    ]
