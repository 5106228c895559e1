"""Jobs that run in several landings, read back and checked against the SQL of the whole chain."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.operators import ingest
from fleetgauge.plans import chains, jobs
from fleetgauge.plans.blocking_queries import MONTHLY as BLOCKING_MONTHLY
from fleetgauge.plans.blocking_queries import _NET
from fleetgauge.plans.checking import GENERATED_UTC, stamp
from fleetgauge.plans.ingest_queries import _CAPACITY, _CLASSIFIED, _RUN_AT, BOUNDARIES
from fleetgauge.plans.ingest_queries import ORACLE as INGEST
from fleetgauge.plans.inventory_queries import ORACLE as INVENTORY
from fleetgauge.plans.wait_queries import _B
from fleetgauge.plans.wait_queries import MONTHLY as WAIT_MONTHLY
from fleetgauge.sources.bindings import binder, with_bindings
from fleetgauge.sources.commits import PublishedTable
from fleetgauge.sources.session import checkpoint_root

#: Landings end inside a month, and at a month's end.
CUTS = [datetime(1996, 5, 1), datetime(1998, 7, 12)]
COLLECTION_CUTS = [datetime(2000, 11, 3), datetime(2001, 4, 1)]


def _root(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def boundary_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries from three runs, each over its own samples only; the last landing arrives twice."""
    table, root = binder(spark, sf_dir), _root(spark, "boundaries")
    slices = chains.landings(table("cumulative_samples"), CUTS)
    for number, batch in enumerate([*slices, slices[-1]]):
        jobs.snapshot_boundaries(spark, batch, table("restarts"), root, f"landing-{number}")
    return PublishedTable(spark, root).read()


def recorded_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity intervals kept up to date by three landings of collections."""
    table, root = binder(spark, sf_dir), _root(spark, "intervals")
    for number, batch in enumerate(chains.landings(table("log_segment_collections"), COLLECTION_CUTS, "collected_utc")):
        jobs.record_collection(spark, batch, root, f"landing-{number}")
    return jobs.stored_intervals(spark, root)


def _capacity(table) -> DataFrame:
    return ingest.server_capacity(table("restarts"), table("schedulers"), stamp(_RUN_AT))


def wait_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, root = binder(spark, sf_dir), _root(spark, "waits")
    for number, raw in enumerate(chains.landings(table("raw_wait_history"), CUTS)):
        chains.collect_waits(spark, root, f"landing-{number}", raw, _capacity(table), table("restarts"), stamp(GENERATED_UTC))
    return PublishedTable(spark, f"{root}/wait_monthly").read()


def lock_wait_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, root = binder(spark, sf_dir), _root(spark, "locks")
    for number, raw in enumerate(chains.landings(table("index_stats_history"), CUTS)):
        chains.collect_lock_waits(
            spark, root, f"landing-{number}", raw, table("databases"), _capacity(table), table("restarts"), stamp(GENERATED_UTC)
        )
    return PublishedTable(spark, f"{root}/blocking_monthly").read()


QUERIES = {
    "in14_boundary_increments": boundary_increments,
    "dk11_inventory_recorded": recorded_intervals,
    "wa10_wait_chain": wait_chain,
    "bk7_blocking_chain": lock_wait_chain,
}

_CLOSED = """closed AS (SELECT DISTINCT server_name, rollup_month FROM marked WHERE snapshot_type = 'EndOfMonth')"""
_WAITS = f"""classified AS ({_CLASSIFIED.replace("SELECT server_name,", "SELECT event_time_utc, event_time_local, server_name,", 1).replace("FROM raw_waits", "FROM raw_wait_history")}),
wait_rows AS (SELECT s.*, s.event_time_local AS snapshot_date_local, m.snapshot_type, m.rollup_month
  FROM classified AS s JOIN marked AS m ON m.server_name = s.server_name AND m.event_time_utc = s.event_time_utc
  JOIN closed AS c ON c.server_name = m.server_name AND c.rollup_month = m.rollup_month)"""
_LOCKS = """summed AS (SELECT event_time_utc, server_name, database_id, cast(sum(row_lock_wait_in_ms) AS bigint) AS row_lock_wait_ms,
         cast(sum(page_lock_wait_in_ms) AS bigint) AS page_lock_wait_ms
  FROM index_stats_history GROUP BY event_time_utc, server_name, database_id),
lock_rows AS (SELECT s.server_name, m.rollup_month, m.snapshot_type, s.database_id, d.database_name, row_lock_wait_ms, page_lock_wait_ms,
         cast(p.total_server_time_seconds AS bigint) AS total_processor_time_seconds
  FROM summed AS s JOIN marked AS m ON m.server_name = s.server_name AND m.event_time_utc = s.event_time_utc
  JOIN closed AS c ON c.server_name = m.server_name AND c.rollup_month = m.rollup_month
  LEFT JOIN databases AS d ON d.server_name = s.server_name AND d.database_id = s.database_id
  LEFT JOIN capacity AS p ON p.server_name = s.server_name)"""

ORACLE = {
    "in14_boundary_increments": INGEST["in14_boundary_snapshots"],
    "dk11_inventory_recorded": INVENTORY["dk11_inventory_intervals"],
    "wa10_wait_chain": with_bindings(
        f"WITH {_CAPACITY}, {BOUNDARIES}, {_CLOSED}, {_WAITS}, {_B.replace('FROM wait_boundaries', 'FROM wait_rows')}, {WAIT_MONTHLY}"
    ),
    "bk7_blocking_chain": with_bindings(
        f"WITH {_CAPACITY}, {BOUNDARIES}, {_CLOSED}, {_LOCKS}, {_NET.replace('FROM lock_wait_boundaries', 'FROM lock_rows')}, {BLOCKING_MONTHLY}"
    ),
}
