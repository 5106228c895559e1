"""Streams over several micro-batches and jobs that run more than once."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from fleetgauge.operators import cpu, ingest, waits
from fleetgauge.plans import jobs as plans
from fleetgauge.schemas import SCHEMAS, conform, schema
from fleetgauge.sources.commits import PublishedTable
from fleetgauge.sources.session import checkpoint_root
from fleetgauge.sources.tables import append_samples, read_table
from fleetgauge.streaming import jobs

T0 = datetime(2024, 1, 30)


def land(spark, tmp_path, parts, ddl):
    """One file per part, so that every part can be its own micro-batch."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/part=*")
    return stream, spark.read.schema(ddl).parquet(f"{tmp_path}/in/part=*")


def readings(seed=7):
    rng = random.Random(seed)
    rows, value = {"a": [], "b": []}, {"a": 5, "b": 50}
    for i in range(120):
        for s in rows:
            value[s] = rng.randrange(0, 4) if rng.random() < 0.1 else value[s] + rng.randrange(0, 9)
            rows[s].append((s, T0 + timedelta(minutes=50 * i), value[s]))
    ordered = sorted(rows["a"] + rows["b"], key=lambda r: r[1])
    return [ordered[i : i + 60] for i in range(0, len(ordered), 60)]


def bag(df):
    return sorted(tuple(r) for r in df.collect())


READING = "server_name string, event_time_utc timestamp_ntz, raw_counter_value bigint"


def test_delta_stream_equals_batch(spark, tmp_path):
    stream, whole = land(spark, tmp_path, readings(), READING)
    query, out = jobs.counter_delta_stream(stream, f"{tmp_path}/run")
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 3
    assert bag(out.read()) == bag(ingest.counter_delta(whole))


def test_late_readings_do_not_disturb_the_stream(spark, tmp_path):
    parts = readings()
    late = [("a", T0 - timedelta(hours=1), 3)]
    stream, _ = land(spark, tmp_path, parts + [late], READING)
    query, out = jobs.counter_delta_stream(stream, f"{tmp_path}/run")
    query.awaitTermination()
    clean = spark.createDataFrame([r for p in parts for r in p], READING)
    assert bag(out.read()) == bag(ingest.counter_delta(clean))


def test_snapshot_stream_equals_batch(spark, tmp_path):
    stream, whole = land(spark, tmp_path, readings(), READING)
    marks = spark.createDataFrame(
        [("a", T0 + timedelta(minutes=m)) for m in (500, 2890, 2900, 5010)] + [("b", T0 + timedelta(minutes=3000))],
        "server_name string, restart_ts timestamp_ntz",
    )
    query, out = jobs.boundary_snapshot_stream(stream, lambda: marks, f"{tmp_path}/run")
    query.awaitTermination()
    expected = bag(ingest.boundary_snapshots(whole, marks))
    assert len(expected) > 5 and bag(out.read()) == expected


def test_a_micro_batch_can_be_run_again(spark, tmp_path):
    table = jobs.VersionedTable(spark, f"{tmp_path}/t", spark.range(1).schema)
    rows = lambda n, kind: spark.range(n).withColumn(jobs.KIND, F.lit(kind))
    assert table.previous(0, "x") is None and table.read("x").count() == 0
    table.write(rows(3, "x"), 0)
    table.write(rows(5, "x"), 1)
    table.write(rows(7, "x").union(rows(2, "y")), 1)
    assert (table.previous(1, "x").count(), table.read("x").count(), table.read("y").count()) == (3, 10, 2)
    assert (table.previous(1, "y").count(), table.newest()) == (0, 1)
    table.forget(2, "x")
    assert table.read("x").count() == 7


def test_stream_of_minutes_drops_what_is_too_late(spark, tmp_path):
    ddl = "server_name string, event_time_utc timestamp_ntz"
    base = datetime(2024, 1, 1, 12)
    parts = [
        [("a", base), ("a", base + timedelta(seconds=20)), ("b", base)],
        [("a", base + timedelta(seconds=10)), ("a", base + timedelta(hours=9))],
        [("a", base + timedelta(hours=9, seconds=5))],  # lateness is judged by the watermark of one batch before
        [("a", base + timedelta(hours=1)), ("a", base + timedelta(hours=6))],
        [("a", base + timedelta(hours=10))],
    ]
    stream, _ = land(spark, tmp_path, parts, ddl)
    query = (
        jobs.dedupe_minutes(stream).writeStream.format("parquet").option("path", f"{tmp_path}/rows")
        .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = sorted((r.server_name, (r.minute - base).total_seconds() / 3600) for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    assert got == [("a", 0.0), ("a", 6.0), ("a", 9.0), ("a", 10.0), ("b", 0.0)]


def test_rollups_are_published_once(spark, tmp_path):
    ddl = "server_name string, rollup_month date, v int"
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    parts = [[("a", jan, 1), ("a", jan, 1)], [("a", jan, 9), ("a", feb, 2)], [("b", jan, 3), ("a", feb, 2)]]
    stream, _ = land(spark, tmp_path, parts, ddl)
    jobs.publish_rollups(stream, f"{tmp_path}/t", f"{tmp_path}/cp", ["server_name", "rollup_month"]).awaitTermination()
    assert bag(PublishedTable(spark, f"{tmp_path}/t").read()) == [("a", jan, 1), ("a", feb, 2), ("b", jan, 3)]


CPU = "server_name string, event_time_utc timestamp_ntz, event_time_local timestamp_ntz, sql_service int, idle_process int, non_sql_process int"


def cpu_rows(minutes, start=datetime(2024, 1, 31, 22)):
    return [("a", start + timedelta(minutes=m), start, 10, 50, 40) for m in minutes]


def test_collection_and_rollup_run_twice(spark, tmp_path):
    history, rollups = f"{tmp_path}/cpu", f"{tmp_path}/cpu_monthly"
    first, second = (spark.createDataFrame(cpu_rows(r), CPU) for r in (range(100), range(50, 180)))
    for batch in (first, first, second, second):
        plans.collect_minutes(spark, batch, history, "cpu_samples")
    stored = read_table(spark, history, "cpu_samples")
    assert stored.count() == 180
    t = F.lit("2024-03-01").cast("timestamp_ntz")

    def build(df, earlier):
        return cpu.cpu_monthly(df, t, t)

    source = spark.read.parquet(history)
    for end in (date(2024, 2, 1), date(2024, 3, 1), date(2024, 3, 1)):
        plans.roll_up(spark, source, build, rollups, date(2024, 1, 1), end, partition_column="event_month")
    got = sorted((str(r.rollup_month), r.collected_points) for r in spark.read.parquet(rollups).collect())
    assert got == [("2024-01-01", 120), ("2024-02-01", 60)]
    plan = plans.month_slice(source, date(2024, 1, 1), date(2024, 2, 1), partition_column="event_month")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in text and "GreaterThanOrEqual(event_time_utc" in text


def test_monthly_change_follows_the_stored_month(spark, tmp_path):
    ddl = (
        "server_name string, rollup_month date, snapshot_date_local timestamp_ntz, snapshot_type string, wait_type string, "
        "category string, total_server_time_seconds double, wait_seconds decimal(14,2), resource_seconds decimal(14,2), "
        "signal_seconds decimal(14,2)"
    )
    from decimal import Decimal as D

    rows = [("a", date(2024, m, 1), T0, "EndOfMonth", "X", "CPU", 1.0, D(10 * m), D(10 * m), D(0)) for m in (1, 2, 3)]
    source = spark.createDataFrame(rows, ddl)
    at = F.lit("2024-06-01").cast("timestamp_ntz")
    for m in (1, 2, 3):
        plans.roll_up(
            spark, source, lambda df, earlier: waits.wait_monthly(df, at, earlier), f"{tmp_path}/w",
            date(2024, m, 1), date(2024, m + 1, 1), ts=None,
        )
    got = spark.read.parquet(f"{tmp_path}/w").orderBy("rollup_month").collect()
    assert [r.mom_cpu_wait_change_pct for r in got] == [None, D(100), D(50)]


def test_other_rollup_types_do_not_block(spark, tmp_path):
    ddl = "server_name string, event_time_utc timestamp_ntz"
    source = spark.createDataFrame([("a", datetime(2024, 1, 5))], ddl)

    def rows_of(kind):
        return lambda df, earlier: df.select(
            "server_name", F.trunc("event_time_utc", "MM").alias("rollup_month"), F.lit(kind).alias("rollup_type")
        )

    for kind in ("Drive", "DatabaseFile", "Drive"):
        plans.roll_up(
            spark, source, rows_of(kind), f"{tmp_path}/d", date(2024, 1, 1), date(2024, 2, 1),
            keys=["server_name", "rollup_month", "rollup_type"], kind=kind,
        )
    assert sorted(r.rollup_type for r in spark.read.parquet(f"{tmp_path}/d").collect()) == ["DatabaseFile", "Drive"]


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_layouts_parse(spark, name):
    assert schema(name).fields


@pytest.mark.parametrize(
    "query,name",
    [
        ("cp9_cpu_monthly", "cpu_monthly"), ("mm8_memory_monthly", "memory_monthly"), ("wa10_wait_monthly", "wait_monthly"),
        ("bk7_blocking_monthly", "blocking_monthly"), ("dd7_deadlock_monthly", "deadlock_monthly"),
        ("dk12_disk_monthly", "disk_monthly"), ("ge7_system_health", "system_health"), ("ge13_database_health", "database_health"),
    ],
)
def test_rollups_have_their_stored_layout(spark, query, name):
    df = entry_point.queries()[query](spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == dict((f.name, f.dataType.simpleString()) for f in schema(name))


def test_conform_trims_and_fills(spark):
    df = spark.createDataFrame([("a", "Page life expectancy   ", 5)], "server_name string, counter_name string, counter_value int")
    r = conform(df, "counter_samples").first()
    assert (r.counter_name, r.counter_value, r.instance_name) == ("Page life expectancy", 5, None)
    assert conform(df, "counter_samples").schema == schema("counter_samples")


@pytest.mark.parametrize("fmt", ["csv", "json", "orc"])
def test_landed_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame(cpu_rows(range(3)), CPU)
    df.write.format(fmt).save(f"{tmp_path}/x")
    assert bag(read_table(spark, f"{tmp_path}/x", "cpu_samples", fmt)) == bag(df)


def test_checkpoints_go_where_the_session_says(spark):
    assert checkpoint_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_append_partitions_by_month(spark, tmp_path):
    append_samples(spark.createDataFrame(cpu_rows([0, 200]), CPU), f"{tmp_path}/h", "cpu_samples")
    assert {str(r.event_month) for r in spark.read.parquet(f"{tmp_path}/h").collect()} == {"2024-01-01", "2024-02-01"}
