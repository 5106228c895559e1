"""Lock-blocking rollups per server, month and database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.ordered import with_previous_month
from fleetgauge.functions.semantics import GROUP, MONTH, SERVER, int_div, percent
from fleetgauge.operators.waits import boundary_net

DATABASE = [*GROUP, "database_id", "database_name"]
SCRATCH_DATABASE = "tempdb"

_LOCKS = ["row_lock_wait_ms", "page_lock_wait_ms"]
_STORED = "decimal(18,2)"


def blocking_net(boundaries: DataFrame) -> DataFrame:
    """Net row, page and total lock waits in seconds per database; tempdb left out."""
    cols = [*_LOCKS, "total_blocking_wait_ms", "total_processor_time_seconds"]
    total = F.col("row_lock_wait_ms") + F.col("page_lock_wait_ms")

    def seconds(c: str) -> Column:
        return (F.col(c).cast("decimal(20,0)") / 1000).cast("decimal(20,3)")

    return (
        boundary_net(boundaries.withColumn("total_blocking_wait_ms", total), DATABASE, cols)
        .filter(F.col("database_name") != SCRATCH_DATABASE)
        .select(
            *DATABASE,
            seconds("row_lock_wait_ms").alias("row_lock_wait_seconds"),
            seconds("page_lock_wait_ms").alias("page_lock_wait_seconds"),
            seconds("total_blocking_wait_ms").alias("total_blocking_wait_seconds"),
            "total_processor_time_seconds",
        )
    )


def instance_totals(net: DataFrame) -> DataFrame:
    """Each database with its instance's blocking and processor seconds.

    Runs on one row per database: the window holds the databases of one instance and month.
    """
    w = Window.partitionBy(*GROUP)
    return net.withColumns(
        {
            "instance_blocking_seconds": F.sum("total_blocking_wait_seconds").over(w).cast("decimal(20,3)"),
            "instance_processor_seconds": F.sum("total_processor_time_seconds").over(w),
        }
    )


def rank_within_instance(net: DataFrame) -> DataFrame:
    """Rank of the databases of an instance by blocking; the lower id first among equals."""
    w = Window.partitionBy(*GROUP).orderBy(F.desc("total_blocking_wait_seconds"), "database_id")
    return net.withColumn("rank_within_instance", F.row_number().over(w))


def dominant_lock() -> dict[str, Column]:
    """ROW or PAGE, whichever waited longer (ROW when equal), and its share in percent."""
    row, page = F.col("row_lock_wait_seconds"), F.col("page_lock_wait_seconds")
    total = F.col("total_blocking_wait_seconds")
    return {
        "top_blocking_type": F.when(total == 0, F.lit(None)).when(row >= page, "ROW").otherwise("PAGE"),
        "top_blocking_type_pct": percent(F.greatest(row, page), total),
    }


def blocking_shares(totals: DataFrame, compat: bool = False) -> DataFrame:
    """Percent of the instance's blocking and processor time; NULL when the instance has none.

    ``compat`` divides processor seconds as integers, which leaves only whole multiples of 100.
    """
    cpu, all_cpu = F.col("total_processor_time_seconds"), F.col("instance_processor_seconds")
    processor = (int_div(cpu, all_cpu) * 100).cast(_STORED) if compat else percent(cpu, all_cpu)
    return totals.withColumns(
        {
            "pct_of_instance_blocking": percent(
                F.col("total_blocking_wait_seconds"), F.col("instance_blocking_seconds")
            ),
            "pct_of_total_processor_time": processor,
        }
    )


_TRENDS = {
    "total_blocking_wait_seconds": "mom_blocking_change_pct",
    "row_lock_wait_seconds": "mom_row_lock_change_pct",
    "page_lock_wait_seconds": "mom_page_lock_change_pct",
}


def blocking_mom(net: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Change against the stored (2-decimal) figures of the previous month, per database."""
    row, page = (F.col(c).cast(_STORED) for c in ("row_lock_wait_seconds", "page_lock_wait_seconds"))
    before = {
        "__before_total_blocking_wait_seconds": row + page,
        "__before_row_lock_wait_seconds": row,
        "__before_page_lock_wait_seconds": page,
    }
    joined = with_previous_month(net, MONTH, [SERVER, "database_id"], before, earlier)
    changes = {out: percent(F.col(c) - F.col(f"__before_{c}"), F.col(f"__before_{c}")) for c, out in _TRENDS.items()}
    return joined.withColumns(changes).drop(*before)


def blocking_monthly(
    boundaries: DataFrame, created_at: Column, earlier: DataFrame | None = None, compat: bool = False
) -> DataFrame:
    """The full blocking row for every database of every server and month."""
    ranked = rank_within_instance(instance_totals(blocking_net(boundaries)))
    row, page = (F.col(c).cast(_STORED) for c in ("row_lock_wait_seconds", "page_lock_wait_seconds"))
    return blocking_mom(blocking_shares(ranked, compat).withColumns(dominant_lock()), earlier).select(
        *DATABASE,
        row.alias("row_lock_wait_seconds"),
        page.alias("page_lock_wait_seconds"),
        (row + page).cast(_STORED).alias("total_blocking_wait_seconds"),
        *["top_blocking_type", "top_blocking_type_pct", "pct_of_instance_blocking"],
        *["rank_within_instance", "pct_of_total_processor_time"],
        *_TRENDS.values(),
        created_at.alias("created_at_utc"),
    )
