"""Landed files in, stored tables out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import MONTH, month_of
from fleetgauge.schemas import conform, schema


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files of a known table with their declared layout; nothing is inferred.

    ``fmt`` is any built-in file format (parquet, orc, csv, json).
    """
    return spark.read.format(fmt).schema(schema(name)).options(**options).load(path)


def stored_rollups(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored rollup table, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_rollup(df: DataFrame, path: str) -> None:
    """Append rollup rows, partitioned by month.

    The rebalance hint gives every month few, evenly sized files: adaptive execution merges
    small months into one task and splits a large one.
    """
    df.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(path)


def append_samples(df: DataFrame, path: str, name: str, ts: str = "event_time_utc") -> None:
    """Append sample history in its declared layout, partitioned by ``event_month``.

    Rows are sorted by server and time inside a file, which keeps the Parquet min/max
    statistics of both narrow.
    """
    stored = conform(df, name).withColumn("event_month", month_of(ts))
    (
        stored.hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", "server_name", F.col(ts))
        .write.mode("append")
        .partitionBy("event_month")
        .parquet(path)
    )
