"""Streams over landed samples.

De-duplication and hourly alerts are plain streaming operators. Differencing and boundary
detection need earlier readings of every key. They run as ``foreachBatch`` around the
batch operators, with the readings of a look-back kept as a small table: rows that arrive out
of order within it are re-ordered, later ones are put aside and counted. The rows of one chatty
server in a micro-batch are split like in batch, instead of all landing in one stateful task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from fleetgauge.functions.semantics import SERVER, int_avg, minute_round
from fleetgauge.operators.cpu import SATURATION_THRESHOLD
from fleetgauge.operators.ingest import boundary_snapshots, counter_delta
from fleetgauge.sources.commits import PublishedTable

LOOK_BACK = "4 hours"


def _with_watermark(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; ``ts`` is UTC and so is the session."""
    return stream.withColumn("__event_time", F.col(ts).cast("timestamp")).withWatermark("__event_time", delay)


def dedupe_minutes(
    stream: DataFrame, keys: list[str] | None = None, ts: str = "event_time_utc", delay: str = LOOK_BACK
) -> DataFrame:
    """First row seen of each (server, rounded minute); rows later than ``delay`` drop.

    State is one entry per key and minute, removed once the watermark has passed it.
    """
    keys = keys or [SERVER]
    return (
        _with_watermark(stream.withColumn("minute", minute_round(ts)), ts, delay)
        .dropDuplicatesWithinWatermark([*keys, "minute"])
        .drop("__event_time")
    )


def saturation_alerts(stream: DataFrame, threshold: int = SATURATION_THRESHOLD, delay: str = LOOK_BACK) -> DataFrame:
    """Hours whose whole-number average CPU load exceeds the threshold, once they are final."""
    return (
        _with_watermark(stream, "event_time_utc", delay)
        .groupBy(F.window("__event_time", "1 hour"), SERVER)
        .agg(int_avg(F.lit(100) - F.col("idle_process")).alias("avg_cpu"))
        .filter(F.col("avg_cpu") > threshold)
        .select(SERVER, F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "avg_cpu")
    )


KIND = "__kind"


class VersionedTable:
    """A table with one version per micro-batch, ``batch=<number>`` below its path, with rows of several kinds.

    Micro-batches are numbered from 0 without gaps and one ends before the next begins. Each
    reads only older versions and writes its own with overwrite, so a micro-batch that is run
    again after a failure gives the same result. All kinds of a version are one write.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _open(self, path: str) -> DataFrame:
        stored = StructType([*self.schema.fields, StructField(KIND, StringType()), StructField("batch", LongType())])
        return self.spark.read.schema(stored).option("basePath", self.path).parquet(path)

    def previous(self, batch_id: int, kind: str) -> DataFrame | None:
        return self._open(f"{self.path}/batch={batch_id - 1}").filter(F.col(KIND) == kind).drop(KIND, "batch") if batch_id else None

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").partitionBy(KIND).parquet(f"{self.path}/batch={batch_id}")

    def read(self, kind: str) -> DataFrame:
        """Rows of a kind from all versions; none before the first micro-batch."""
        if self.newest() is None:
            return self.spark.createDataFrame([], self.schema)
        return self._open(self.path).filter(F.col(KIND) == kind).drop(KIND, "batch")

    def _folder(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def newest(self) -> int | None:
        """Number of the newest version."""
        files, path = self._folder()
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        return max((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), default=None)

    def forget(self, batch_id: int, kind: str) -> None:
        """Drops what no micro-batch reads any more: one that is run again needs only the version before it."""
        files, path = self._folder()
        files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path, f"batch={batch_id - 2}/{KIND}={kind}"), True)


class Results:
    """Results of a re-ordering stream: settled ones by micro-batch, and those that later rows may still change.

    Beside them the samples: those carried to the next micro-batch, and the late ones, which came after the look-back.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, results: StructType, samples: StructType):
        self.results = VersionedTable(spark, f"{root}/{name}", results)
        self.samples = VersionedTable(spark, f"{root}/samples", StructType([*samples.fields, StructField("__carried", BooleanType())]))

    def read(self) -> DataFrame:
        """Everything known so far: the settled results and the open ones of the newest micro-batch."""
        newest = self.results.newest()
        settled = self.results.read("settled")
        return settled if newest is None else settled.unionByName(self.results.previous(newest + 1, "open"))

    def late(self) -> DataFrame:
        return self.samples.read("late").drop("__carried")

    def carried(self, batch_id: int) -> DataFrame | None:
        return self.samples.previous(batch_id, "carried")

    def write(self, found: DataFrame, settled: Column, carried: DataFrame, late: DataFrame, batch_id: int) -> None:
        """One write of results, one of samples."""
        self.results.write(found.withColumn(KIND, F.when(settled, "settled").otherwise("open")).select(*self.results.schema.names, KIND), batch_id)
        columns = self.samples.schema.names
        late = late.withColumn("__carried", F.lit(False)).select(*columns, F.lit("late").alias(KIND))
        self.samples.write(carried.select(*columns, F.lit("carried").alias(KIND)).unionByName(late), batch_id)
        self.results.forget(batch_id, "open")
        self.samples.forget(batch_id, "carried")


def _per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, to be met by raw rows. One per server is sent to them, so that no server's rows end in one task."""
    return F.broadcast(df) if keys == [SERVER] else df


def _reordered(batch: DataFrame, state: DataFrame | None, keys: list[str], order: list[str], delay: str) -> DataFrame:
    """Open rows of the state and the batch in one table, with the rows that came too late marked by ``__late``.

    ``__cut``: the newest time of the key less ``delay``; ``__carried``: settled before, kept as a predecessor. A row is too
    late if it is before the last settled row of its key in the full ``order``; a row of the same place is not.
    """
    fresh = batch.withColumns({"__carried": F.lit(False), "__late": F.lit(False)})
    if state is not None:
        place = F.struct(*order)
        settled = state.filter("__carried").groupBy(*keys).agg(F.max(place).alias("__settled"))
        behind = F.coalesce(place < F.col("__settled"), F.lit(False))
        fresh = fresh.join(_per_key(settled, keys), keys, "left").withColumn("__late", behind).drop("__settled")
        fresh = fresh.unionByName(state.withColumn("__late", F.lit(False)))
    newest = F.max(F.when(~F.col("__late"), F.col(order[0])))
    cut = fresh.groupBy(*keys).agg((newest - F.expr(f"INTERVAL {delay}")).alias("__cut"))
    return fresh.join(_per_key(cut, keys), keys)


def _start(stream: DataFrame, root: str, step: Callable[[DataFrame, int], None], trigger: dict | None = None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def counter_delta_stream(
    stream: DataFrame,
    root: str,
    value: str = "raw_counter_value",
    keys: list[str] | None = None,
    order: list[str] | None = None,
    bucket: str = "hour",
    delay: str = LOOK_BACK,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, Results]:
    """Counter increases as samples arrive; results are written below ``root``.

    Rows may come in any order within ``delay`` of the newest row of their key: they are put in order before their
    increases settle. Later ones go to ``late``. The carried table has the open rows and one settled row per key.
    """
    keys, order = keys or [SERVER], order or ["event_time_utc"]
    spark, samples = stream.sparkSession, stream.schema
    empty = spark.createDataFrame([], samples)
    out = Results(spark, root, "deltas", counter_delta(empty, value, keys, order).schema, samples)

    def step(batch: DataFrame, batch_id: int) -> None:
        judged = _reordered(batch, out.carried(batch_id), keys, order, delay).persist()
        rows = judged.filter(~F.col("__late"))
        settled = F.col(order[0]) <= F.col("__cut")
        deltas = counter_delta(rows, value, keys, order, bucket=bucket).filter(~F.col("__carried"))
        rest = [c for c in batch.columns if c not in keys]
        newest = rows.filter(settled).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        last = newest.select(*keys, "__row.*").withColumn("__carried", F.lit(True))
        carried = rows.filter(~settled).select(*batch.columns, "__carried").unionByName(last)
        out.write(deltas, settled, carried, judged.filter("__late"), batch_id)
        judged.unpersist()

    return _start(stream, root, step, trigger), out


def boundary_snapshot_stream(
    stream: DataFrame,
    restarts: Callable[[], DataFrame],
    root: str,
    ts: str = "event_time_utc",
    delay: str = LOOK_BACK,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, Results]:
    """Month and restart boundaries as samples arrive; results are written below ``root``.

    ``restarts`` is called per micro-batch and returns the restart registry of that moment. A boundary settles once its
    follower is older than ``delay``. The carried table has the open rows and all rows of each server's last settled
    instant; rows of that instant may still come.
    """
    spark, samples = stream.sparkSession, stream.schema
    found_schema = boundary_snapshots(spark.createDataFrame([], samples), restarts(), ts).schema
    out = Results(spark, root, "snapshots", found_schema, samples)

    def step(batch: DataFrame, batch_id: int) -> None:
        judged = _reordered(batch, out.carried(batch_id), [SERVER], [ts], delay).persist()
        rows = judged.filter(~F.col("__late"))
        last = _per_key(rows.filter(F.col(ts) <= F.col("__cut")).groupBy(SERVER).agg(F.max(ts).alias("__last")), [SERVER])
        found = boundary_snapshots(rows.select(*batch.columns), restarts(), ts).join(last, SERVER, "left")
        settled = F.coalesce(F.col("snapshot_date_utc") < F.col("__last"), F.lit(False))
        kept = rows.join(last, SERVER, "left").filter(F.col("__last").isNull() | (F.col(ts) >= F.col("__last")))
        carried = kept.withColumn("__carried", F.coalesce(F.col(ts) == F.col("__last"), F.lit(False)))
        out.write(found, settled, carried, judged.filter("__late"), batch_id)
        judged.unpersist()

    return _start(stream, root, step, trigger), out


def publish_rollups(
    stream: DataFrame, target: str, checkpoint: str, keys: list[str], trigger: dict | None = None
) -> StreamingQuery:
    """Publish rollup rows to a stored table (``PublishedTable``), each key once and never again.

    Duplicates inside one micro-batch collapse with a map-side combined minimum. The check reads the keys of the months
    in the micro-batch, not the rows published earlier. A micro-batch is a run of the commit log, named by the checkpoint
    and its number: one that is run again after its commit adds nothing, one that died before it leaves nothing, and
    several queries may publish to one table.
    """
    rest = [c for c in stream.columns if c not in keys]
    table = PublishedTable(stream.sparkSession, target)
    name = hashlib.md5(checkpoint.encode()).hexdigest()

    def step(batch: DataFrame, batch_id: int) -> None:
        once = batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*")
        table.publish(once, keys, f"{name}-{batch_id}")

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
