"""Streams keep rows that arrive out of order; renames, open months and long tables in rollups."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.ordered import with_previous_month
from fleetgauge.operators import ingest
from fleetgauge.operators.waits import boundary_net
from fleetgauge.streaming import jobs

T0 = datetime(2024, 1, 31, 20)
DDL = "server_name string, counter string, event_time_utc timestamp_ntz, sample_id long, raw_counter_value long"


def landed(spark, folder, parts, ddl):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in/{i:02d}")
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")


def bag(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_deltas_of_rows_out_of_order_equal_batch(spark, tmp_path):
    at = lambda m: T0 + timedelta(minutes=m)
    parts = [
        [("a", "x", at(0), 1, 10), ("a", "x", at(10), 3, 30), ("a", "x", at(600), 9, 90)],
        [("a", "y", at(0), 1, 5), ("a", "y", at(10), 2, 9)],  # another counter of the server, hours behind
        [("a", "x", at(595), 7, 70), ("a", "x", at(600), 10, 95)],  # five minutes behind; the same instant again
        [("a", "x", at(900), 11, 99), ("a", "y", at(12), 3, 4)],
    ]
    query, out = jobs.counter_delta_stream(landed(spark, tmp_path, parts, DDL), f"{tmp_path}/run", keys=["server_name", "counter"], order=["event_time_utc", "sample_id"])
    query.awaitTermination()
    whole = spark.createDataFrame([r for p in parts for r in p], DDL)
    assert query.lastProgress["batchId"] >= 3 and out.late().count() == 0
    assert bag(out.read()) == bag(ingest.counter_delta(whole, keys=["server_name", "counter"], order=["event_time_utc", "sample_id"]))


def test_rows_after_the_look_back_are_put_aside_and_counted(spark, tmp_path):
    parts = [[("a", "x", T0, 1, 10)], [("a", "x", T0 + timedelta(hours=9), 2, 20)], [("a", "x", T0 - timedelta(hours=1), 3, 1)]]
    query, out = jobs.counter_delta_stream(landed(spark, tmp_path, parts, DDL), f"{tmp_path}/run", order=["event_time_utc", "sample_id"])
    query.awaitTermination()
    assert (out.late().count(), out.read().count()) == (1, 2)


def test_boundaries_of_one_instant_in_two_files(spark, tmp_path):
    ddl = "server_name string, event_time_utc timestamp_ntz, wait_type string, value long"
    hours = [T0, T0 + timedelta(hours=3), T0 + timedelta(hours=5), T0 + timedelta(hours=20)]
    parts = [[("a", t, w, i)] for i, t in enumerate(hours) for w in ("x", "y")]
    restarts = spark.createDataFrame([], "server_name string, restart_ts timestamp_ntz")
    query, out = jobs.boundary_snapshot_stream(landed(spark, tmp_path, parts, ddl), lambda: restarts, f"{tmp_path}/run")
    query.awaitTermination()
    expected = bag(ingest.boundary_snapshots(spark.createDataFrame([r for p in parts for r in p], ddl), restarts))
    assert len(expected) == 4 and bag(out.read()) == expected


def test_open_months_have_no_net(frame):
    columns = "server_name:string snapshot_type:string rollup_month:date value:long"
    rows = frame(columns, *[("a", k, date(2024, m, 1), v) for k, m, v in [("StartOfMonth", 1, 5), ("EndOfMonth", 1, 9), ("StartOfMonth", 2, 9)]])
    net = boundary_net(ingest.closed_months(rows), ["server_name", "rollup_month"], ["value"])
    assert [tuple(r) for r in net.collect()] == [("a", date(2024, 1, 1), 4)]
    assert ingest.closed_months(rows, F.lit(date(2024, 1, 15))).count() == 0


def test_a_rename_keeps_the_previous_month(spark):
    rows = [("a", 1, "old", date(2024, 1, 1), 10), ("a", 1, "old", date(2024, 2, 1), 3), ("a", 1, "new", date(2024, 2, 1), 4), ("a", 1, "new", date(2024, 3, 1), 9)]
    df = spark.createDataFrame(rows, "server_name string, database_id int, name string, rollup_month date, v long")
    got = with_previous_month(df, "rollup_month", ["server_name", "database_id"], {"before": F.col("v")})
    assert sorted((r.rollup_month.month, r.name, r.before) for r in got.collect()) == [(1, "old", None), (2, "new", 10), (2, "old", 10), (3, "new", 7)]


def test_strict_minutes_of_a_long_table(spark):
    ddl = "server_name string, event_time_utc timestamp_ntz, counter_name string, counter_value long"
    df = spark.createDataFrame([("a", T0 + timedelta(seconds=s), f"c{i}", i) for i in range(8) for s in (0, 5)], ddl)
    with pytest.raises(ValueError):
        ingest.append_new_minutes(df, None, strict=True)
    assert ingest.append_new_minutes(df, None, ["server_name", "counter_name"], strict=True).count() == 8
