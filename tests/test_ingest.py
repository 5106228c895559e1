"""Ingest jobs on hand-made rows."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import ingest
from fleetgauge.operators.waits import boundary_net


def test_missing_xml_node_is_null(frame):
    node = "<Record id='1'><SchedulerMonitorEvent><SystemHealth><ProcessUtilization>7</ProcessUtilization>{}</SystemHealth></SchedulerMonitorEvent></Record>"
    raw = frame(
        "server_name:string ring_buffer_type:string tick_ms:bigint now_tick_ms:bigint sampled_at_utc:string record:string",
        ("a", ingest.SCHEDULER_MONITOR, 1000, 61500, "2024-01-01 00:10:00", node.format("")),
        ("b", ingest.SCHEDULER_MONITOR, 1000, 1000, "2024-01-01 00:10:00", node.format("<SystemIdle>90</SystemIdle>")),
        ("c", ingest.SCHEDULER_MONITOR, 1000, 1000, "2024-01-01 00:10:00", "not xml"),
        ("d", "OTHER", 1, 1, "2024-01-01 00:10:00", node.format("")),
    )
    got = {r[0]: tuple(r)[1:] for r in ingest.ingest_scheduler_records(raw).collect()}
    assert got["a"] == (datetime(2024, 1, 1, 0, 8, 59, 500000), 7, None, None)
    assert got["b"][1:] == (7, 90, 3)
    assert got["c"][1:] == (None, None, None)
    assert "d" not in got


BATCH = ("server_name:string event_time_utc:string v:int",)


def test_new_minutes_keep_or_collapse_duplicates(frame):
    batch = frame(
        *BATCH,
        ("a", "2024-01-01 00:00:31", 2), ("a", "2024-01-01 00:00:30", 1), ("a", "2024-01-01 00:02:10", 3),
        ("b", "2024-01-01 00:02:10", 4), ("a", "2024-01-31 23:59:45", 5),
    )
    history = frame(*BATCH, ("a", "2024-01-01 00:01:40", 0), ("a", "2024-02-01 00:00:20", 0))
    assert sorted(r.v for r in ingest.append_new_minutes(batch, history).collect()) == [1, 2, 4]
    assert sorted(r.v for r in ingest.append_new_minutes(batch, history, strict=True).collect()) == [1, 4]
    once = ingest.append_new_minutes(batch, history)
    assert ingest.append_new_minutes(batch, history.unionByName(once)).count() == 0


def test_counter_reset(frame):
    df = frame(
        "server_name:string event_time_utc:string raw_counter_value:bigint",
        *[("a", f"2024-01-01 0{h}:00:00", v) for h, v in enumerate([5, 7, 7, 2, 0, 4])],
    )
    got = [r.delta for r in ingest.counter_delta(df).orderBy("event_time_utc").collect()]
    assert got == [0, 2, 0, 2, 0, 4]


SAMPLES = "server_name:string event_time_utc:string entity:string value:bigint"
RESTARTS = "server_name:string restart_ts:string"


def snapshots(frame, samples, restarts=()):
    df = frame(SAMPLES, *[("a", t, "x", v) for t, v in samples])
    rs = frame(RESTARTS, *([("a", t) for t in restarts] or [("other", "2024-01-01 00:00:00")]))
    found = ingest.boundary_snapshots(df, rs)
    net = {r.rollup_month: r.value for r in boundary_net(found, ["rollup_month"], ["value"]).collect()}
    return sorted((r.snapshot_type, r.rollup_month, r.value) for r in found.collect()), net


JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def test_month_change_without_restart(frame):
    rows, net = snapshots(
        frame,
        [("2024-01-31 23:55:00", 100), ("2024-02-01 00:00:00", 103), ("2024-02-29 23:55:00", 160), ("2024-03-01 00:00:00", 161)],
    )
    assert net[FEB] == 60
    assert rows == [
        ("EndOfMonth", JAN, 100), ("EndOfMonth", FEB, 160), ("StartOfMonth", FEB, 100), ("StartOfMonth", MAR, 160),
    ]


def test_restart_inside_a_month(frame):
    rows, net = snapshots(
        frame,
        [("2024-01-31 23:55:00", 100), ("2024-02-10 00:00:00", 140), ("2024-02-20 00:00:00", 5),
         ("2024-02-29 23:55:00", 30), ("2024-03-01 00:00:00", 31)],
        ["2024-02-15 12:00:00"],
    )
    assert net[FEB] == 70
    assert ("PreRestart", FEB, 140) in rows


def test_restart_across_the_change_is_written_once(frame):
    rows, net = snapshots(
        frame,
        [("2024-01-31 23:55:00", 100), ("2024-02-01 00:05:00", 5), ("2024-02-29 23:55:00", 40), ("2024-03-01 00:00:00", 41)],
        ["2024-02-01 00:02:00"],
    )
    assert [r for r in rows if r[2] == 100] == [("EndOfMonth", JAN, 100)]
    assert net[FEB] == 40 and net[JAN] == 100


def test_pre_restart_is_labelled_by_its_own_month(frame):
    rows, _ = snapshots(
        frame,
        [("2024-02-10 00:00:00", 7), ("2024-02-20 00:00:00", 1)],
        ["2024-01-05 00:00:00", "2024-02-12 00:00:00"],
    )
    assert rows == [("PreRestart", FEB, 7)]


def test_restart_at_the_sample_time_belongs_to_the_sample(frame):
    rows, _ = snapshots(frame, [("2024-02-10 00:00:00", 7), ("2024-02-20 00:00:00", 8)], ["2024-02-10 00:00:00"])
    assert rows == []


def test_all_entities_of_a_boundary_sample_are_kept(frame):
    df = frame(
        SAMPLES,
        *[("a", "2024-01-31 23:55:00", e, v) for e, v in (("x", 1), ("y", 2))],
        ("a", "2024-02-01 00:00:00", "x", 3),
    )
    got = ingest.boundary_snapshots(df, frame(RESTARTS, ("a", "2023-01-01 00:00:00")))
    assert sorted((r.snapshot_type, r.entity) for r in got.collect()) == [
        ("EndOfMonth", "x"), ("EndOfMonth", "y"), ("StartOfMonth", "x"), ("StartOfMonth", "y"),
    ]


def test_net_of_closed_months_is_the_true_activity(spark):
    """Raw counts per month equal the signed net for every month a server has closed."""
    from fleetgauge.sources.bindings import bound

    d = "/root/testdata/sf0.001"
    samples, restarts = bound(spark, d, "cumulative_samples"), bound(spark, d, "restarts")
    net = boundary_net(ingest.boundary_snapshots(samples, restarts), ["server_name", "rollup_month"], ["value"])
    truth = (
        spark.read.parquet(f"{d}/orders.parquet")
        .groupBy(
            F.concat(F.lit("srv-"), (F.col("o_custkey") % 3).cast("string")).alias("server_name"),
            F.trunc("o_orderdate", "MM").alias("rollup_month"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = truth.join(net, ["server_name", "rollup_month"], "left").collect()
    last = {s: max(r.rollup_month for r in rows if r.server_name == s) for s in {r.server_name for r in rows}}
    closed = [r for r in rows if r.rollup_month < last[r.server_name]]
    assert len(closed) > 200 and all(r.n == r.value for r in closed)


def cumulative(seed: int, with_restarts: bool):
    """A counter read every 6 hours for four months; every restart shows as a drop."""
    rng = random.Random(seed)
    samples, restarts, value = [], [], 1000
    for i in range(480):
        at = datetime(2024, 1, 1) + timedelta(hours=6 * i)
        if with_restarts and i and rng.random() < 0.03:
            restarts.append(at - timedelta(minutes=90))
            value = rng.randrange(1, 5)
        else:
            value += rng.randrange(0, 50)
        samples.append(("a", at, value))
        value = max(value, 10)
    return samples, restarts


def test_deltas_without_reset_add_up_to_the_increase(spark):
    samples, _ = cumulative(5, False)
    df = spark.createDataFrame(samples, "server_name string, event_time_utc timestamp_ntz, raw_counter_value bigint")
    total = ingest.counter_delta(df).agg(F.sum("delta")).first()[0]
    assert total == samples[-1][2] - samples[0][2]


def test_net_of_closed_months_is_first_value_plus_deltas(spark):
    samples, restarts = cumulative(6, True)
    assert len(restarts) > 5
    df = spark.createDataFrame(samples, "server_name string, event_time_utc timestamp_ntz, raw_counter_value bigint")
    marks = spark.createDataFrame([("a", r) for r in restarts], "server_name string, restart_ts timestamp_ntz")
    net = boundary_net(ingest.boundary_snapshots(df, marks), ["rollup_month"], ["raw_counter_value"])
    closed = net.filter(F.col("rollup_month") < F.lit("2024-04-01").cast("date"))
    deltas = ingest.counter_delta(df).filter(F.col("event_time_utc") < F.lit("2024-04-01").cast("timestamp_ntz"))
    expected = samples[0][2] + deltas.agg(F.sum("delta")).first()[0]
    assert closed.agg(F.sum("raw_counter_value")).first()[0] == expected


@pytest.mark.parametrize(
    "wait_type,tasks,category",
    [
        ("LATCH_SH", 5, None), ("LCK_M_S", 5, "Blocking"), ("PAGEIOLATCH_EX", 5, "Disk"), ("WRITELOG", 0, None),
        ("LCK_ROW", 5, "Other"), ("LATCH_EX", 1, "Latches"), ("HADR_SYNC_COMMIT", 1, "AGSync"),
    ],
)
def test_wait_classification(frame, wait_type, tasks, category):
    raw = frame(
        "server_name:string wait_type:string waiting_tasks_count:bigint wait_time_ms:bigint signal_wait_time_ms:bigint",
        ("a", wait_type, tasks, 1005, 5),
    )
    capacity = frame("server_name:string total_server_time_seconds:double", ("a", 10.0))
    rows = ingest.classify_waits(raw, capacity).collect()
    assert [r.category for r in rows] == ([] if category is None else [category])
    if rows:
        r = rows[0]
        assert (r.wait_seconds, r.resource_seconds, r.signal_seconds) == (
            Decimal("1.01"), Decimal("1.00"), Decimal("0.01"),
        )
        assert r.total_wait_pct == Decimal("10.05")


def test_benign_table_replaces_the_list(frame):
    raw = frame(
        "server_name:string wait_type:string waiting_tasks_count:bigint wait_time_ms:bigint signal_wait_time_ms:bigint",
        ("a", "SLEEP_TASK", 1, 10, 0), ("a", "OLEDB", 1, 10, 0),
    )
    capacity = frame("server_name:string total_server_time_seconds:double", ("a", 10.0))
    benign = frame("wait_type:string", ("OLEDB",), ("OLEDB",))
    assert [r.wait_type for r in ingest.classify_waits(raw, capacity, benign).collect()] == ["SLEEP_TASK"]


def test_uptime_of_zero_counts_as_one(frame):
    restarts = frame(RESTARTS, ("a", "2024-01-01 00:00:00"), ("b", "2023-12-31 23:00:00"))
    schedulers = frame("server_name:string status:string", *[(s, "VISIBLE ONLINE") for s in "abab"], ("a", "HIDDEN ONLINE"))
    as_of = F.lit("2024-01-01 00:00:00.9").cast("timestamp_ntz")
    got = {r.server_name: (r.uptime_seconds, r.total_server_time_seconds) for r in ingest.server_capacity(restarts, schedulers, as_of).collect()}
    assert got == {"a": (1, 2.0), "b": (3600, 7200.0)}


def test_rollup_guard_respects_type(frame):
    cols = "server_name:string rollup_month:string rollup_type:string"
    new = frame(cols, ("a", "2024-01-01", "Drive"), ("a", "2024-02-01", "Drive"))
    stored = frame(cols, ("a", "2024-01-01", "DatabaseFile"), ("a", "2024-02-01", "Drive"))
    by_type = ["server_name", "rollup_month", "rollup_type"]
    left = ingest.append_missing_rollups(new, stored, by_type)
    assert [r.rollup_month for r in left.collect()] == [JAN]
    assert ingest.append_missing_rollups(new, stored, by_type[:2]).count() == 0
    assert ingest.append_missing_rollups(new, stored.unionByName(left), by_type).count() == 0


def test_volume_rules(frame):
    raw = frame(
        "server_name:string name:string label:string drive_letter:string file_system:string drive_type:int "
        "capacity_bytes:bigint free_bytes:bigint block_size:bigint",
        ("a", "C:\\", "sys", "C:", "NTFS", 3, 1024 * 3, 1024, 4096),
        ("a", "D:\\Data\\", None, None, "NTFS", 3, 1536, 512, 4096),
        ("a", "\\\\?\\Volume\\", "x", None, "NTFS", 3, 1024, 0, 4096),
        ("a", "E:\\", "RECOVERY", "E:", "NTFS", 3, 1024, 0, 4096),
        ("a", "F:\\", "x", "F:", None, 3, 1024, 0, 4096),
        ("a", "G:\\", "x", "G:", "CDFS", 5, 0, 0, 2048),
        ("a", "H:\\", "x", "H:", "NTFS", 1, 1024, 0, 4096),
    )
    got = {r.mount_path: r for r in ingest.normalize_volumes(raw).collect()}
    assert set(got) == {"C:", "D:\\Data", "G:"}
    assert (got["C:"].percent_free, got["C:"].percent_used, got["C:"].is_mount_point) == (
        Decimal("33.33"), Decimal("66.67"), False,
    )
    assert (got["D:\\Data"].size_kb, got["D:\\Data"].free_kb, got["D:\\Data"].is_mount_point) == (2, 0, True)
    assert (got["G:"].drive_type, got["G:"].percent_free, got["G:"].percent_used) == ("CD-ROM", 0, 100)
