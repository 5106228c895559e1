"""Streaming queries, run to completion over the tables as they lie and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.operators import cpu
from fleetgauge.plans.deadlock_queries import delta_sql
from fleetgauge.plans.ingest_queries import BOUNDARIES, _minute
from fleetgauge.plans.ingest_queries import ORACLE as INGEST
from fleetgauge.plans.cpu_queries import ORACLE as CPU
from fleetgauge.sources.bindings import bound, bound_stream, with_bindings
from fleetgauge.sources.commits import PublishedTable
from fleetgauge.sources.session import checkpoint_root
from fleetgauge.streaming import jobs, stateful

_THRESHOLD = 65


def _fresh_root(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def _run(stream: DataFrame, root: str) -> DataFrame:
    """Append a stream's rows to Parquet until its input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/rows")


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = jobs.dedupe_minutes(bound_stream(spark, sf_dir, "cpu_samples"))
    return _run(stream.select("server_name", "minute"), _fresh_root(spark, "minutes"))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = jobs.saturation_alerts(bound_stream(spark, sf_dir, "cpu_samples"), _THRESHOLD)
    return _run(stream, _fresh_root(spark, "alerts"))


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _fresh_root(spark, "deltas")
    for stream in _landed_by_time(spark, bound(spark, sf_dir, "counter_resets"), root, "event_time_utc"):
        query, out = jobs.counter_delta_stream(stream, root, order=["event_time_utc", "sample_id"])
        query.awaitTermination()
    return out.read()


def _landed(spark: SparkSession, df: DataFrame, root: str) -> DataFrame:
    """Write a derived table as several landed files and open them as a stream of one file at a time."""
    df.repartition(3).write.parquet(f"{root}/landed")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")


def _landed_by_time(spark: SparkSession, df: DataFrame, root: str, ts: str, slices: int = 3) -> Iterator[DataFrame]:
    """The rows in order of time, one landing after the other: the stream over them, after each landing.

    The table is derived and written once, in parallel, and dealt over the landings by time; a landing arrives as a whole
    by a rename. The stream is a new query on the same checkpoint each time, as after a restart.
    """
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet
    df.write.parquet(f"{root}/derived")
    derived = spark.read.schema(df.schema).parquet(f"{root}/derived")
    lo, hi = derived.agg(F.min(ts), F.max(ts)).first()
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{root}/landed"))
    if lo is not None:
        edges = [lo + i * (hi - lo) / slices for i in range(1, slices)]
        place = sum((F.when(F.col(ts) >= F.lit(edge), 1).otherwise(0) for edge in edges), F.lit(0))
        derived.withColumn("__landing", place).write.partitionBy("__landing").parquet(f"{root}/staged")
    for i in range(slices):
        if files.exists(path(f"{root}/staged/__landing={i}")):
            files.rename(path(f"{root}/staged/__landing={i}"), path(f"{root}/landed/{i}"))
        yield stream(f"{root}/landed")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _fresh_root(spark, "snapshots")
    bound(spark, sf_dir, "restarts").write.parquet(f"{root}/restarts")
    for stream in _landed_by_time(spark, bound(spark, sf_dir, "cumulative_samples"), root, "event_time_utc"):
        query, out = jobs.boundary_snapshot_stream(stream, lambda: spark.read.parquet(f"{root}/restarts"), root)
        query.awaitTermination()
    return out.read()


def _settled(stream: DataFrame, root: str) -> None:
    """Everything the state lets go of for the rows landed so far; the next call goes on from its checkpoint."""
    with stateful.state_store(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{root}/settled")
            .option("checkpointLocation", f"{root}/state-checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def state_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _fresh_root(spark, "state-deltas")
    for stream in _landed_by_time(spark, bound(spark, sf_dir, "counter_resets"), root, "event_time_utc"):
        found = stateful.counter_delta_state(stream, order=["event_time_utc", "sample_id"])
        _settled(found, root)
    return spark.read.schema(found.schema).parquet(f"{root}/settled")


def state_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restart marks land with the samples of their time; all at once they would move the watermark past later samples."""
    root = _fresh_root(spark, "state-snapshots")
    marks = bound(spark, sf_dir, "restarts").select("server_name", F.col("restart_ts").alias("event_time_utc"))
    rows = bound(spark, sf_dir, "cumulative_samples").unionByName(marks, allowMissingColumns=True)
    for stream in _landed_by_time(spark, rows, root, "event_time_utc"):
        restarts = stream.filter("value IS NULL").select("server_name", F.col("event_time_utc").alias("restart_ts"))
        found = stateful.boundary_snapshot_state(stream.filter("value IS NOT NULL"), restarts, ["epoch_id", "value"])
        _settled(found, root)
    return spark.read.schema(found.schema).parquet(f"{root}/settled")


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishes the same rollup twice, as a job that is run again would."""
    root = _fresh_root(spark, "published")
    rollup = cpu.completeness(bound(spark, sf_dir, "cpu_samples"))
    stream = _landed(spark, rollup.unionByName(rollup), root)
    keys = ["server_name", "rollup_month"]
    jobs.publish_rollups(stream, f"{root}/table", f"{root}/checkpoint", keys).awaitTermination()
    return PublishedTable(spark, f"{root}/table").read()


QUERIES = {
    "st1_dedupe_minutes": minutes,
    "st2_saturation_alerts": alerts,
    "st3_counter_delta": deltas,
    "st4_boundary_snapshots": snapshots,
    "st3_counter_delta_state": state_deltas,
    "st4_boundary_snapshots_state": state_snapshots,
    "st5_publish_rollups": published,
}

ORACLE = {
    "st1_dedupe_minutes": with_bindings(
        f"SELECT DISTINCT server_name, {_minute('event_time_utc')} AS minute FROM cpu_samples"
    ),
    "st2_saturation_alerts": with_bindings(
        f"""SELECT server_name, hour_start, cast(avg_cpu AS bigint) AS avg_cpu
FROM (SELECT server_name, date_trunc('hour', event_time_utc) AS hour_start,
             sum(100 - idle_process) // count(*) AS avg_cpu
      FROM cpu_samples GROUP BY server_name, date_trunc('hour', event_time_utc)) AS h
WHERE avg_cpu > {_THRESHOLD}
  AND hour_start + INTERVAL 1 HOUR <= (SELECT max(event_time_utc) FROM cpu_samples) - INTERVAL 4 HOURS"""
    ),
    "st3_counter_delta": INGEST["in13_counter_delta"],
    "st4_boundary_snapshots": INGEST["in14_boundary_snapshots"],
    "st3_counter_delta_state": with_bindings(
        f"""SELECT server_name, event_time_utc, sample_id, raw_counter_value, delta
FROM ({delta_sql('raw_counter_value', 'event_time_utc, sample_id', 'counter_resets')}) AS d
WHERE event_time_utc < (SELECT max(event_time_utc) FROM counter_resets) - INTERVAL 4 HOURS"""
    ),
    "st4_boundary_snapshots_state": with_bindings(
        f"""WITH {BOUNDARIES.replace("lead(u) OVER w AS next_u", "lead(u) OVER w AS next_u, lead(event_time_utc) OVER w AS follower")}
SELECT server_name, event_time_utc AS snapshot_date_utc, snapshot_type, rollup_month, epoch_id, value FROM marked
WHERE follower < (SELECT max(event_time_utc) FROM cumulative_samples) - INTERVAL 4 HOURS"""
    ),
    "st5_publish_rollups": CPU["cp1_completeness"],
}
