"""Disk and health operators on hand-made rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import calendar, disk, health, ingest

VOLUMES = (
    "server_name:string event_time_utc:string mount_path:string drive_type:string label:string is_mount_point:boolean "
    "size_kb:bigint free_kb:bigint used_kb:bigint percent_free:decimal(5,2) percent_used:decimal(5,2)"
)
LATENCY = (
    "server_name:string event_time_utc:string database_name:string physical_name:string "
    "read_latency:int write_latency:int avg_latency:int"
)


def volumes(frame, *rows):
    return frame(
        VOLUMES,
        *[("a", t, m, kind, "v", False, 100, 100 - used, used, D(100 - used), D(used)) for t, m, kind, used in rows],
    )


def stamps():
    t = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return {"generated_utc": t, "generated_local": t}


def test_first_and_last_go_by_time(frame):
    df = volumes(
        frame,
        ("2024-01-20 00:00:00", "C:", "Local Disk", 5),
        ("2024-01-01 00:00:00", "C:", "Local Disk", 90),
        ("2024-01-10 00:00:00", "C:", "Local Disk", 95),
        ("2024-01-30 00:00:00", "E:", "CD-ROM", 1),
    )
    rows = disk.first_last_used(df).collect()
    assert [(r.mount_path, r.first_used_kb, r.last_used_kb) for r in rows] == [("C:", 90, 5)]


def test_growth_guards(frame):
    df = frame("f:bigint l:bigint", (0, 5), (4, 5), (8, 2))
    got = df.select(*[c.alias(n) for n, c in disk.drive_growth(F.col("f"), F.col("l")).items()]).collect()
    assert [tuple(r) for r in got] == [(5, None), (1, D("0.2500")), (-6, D("-0.7500"))]


FILES = [("D:\\Data2\\x.mdf", "D:", "D:\\Data"), ("D:\\Data\\x.mdf", "D:\\Data", "D:\\Data"), ("D:\\Data", "D:\\Data", "D:\\Data")]


@pytest.mark.parametrize("compat", [False, True])
def test_mounts_match_whole_directories(frame, compat):
    names = "server_name:string physical_name:string"
    files = frame(names, *[("a", f) for f, *_ in FILES], ("a", "Z:\\x.mdf"), ("b", "D:\\Data\\x.mdf"), ("a", FILES[0][0]))
    mounts = frame("server_name:string mount_path:string", ("a", "D:"), ("a", "D:\\Data"), ("a", "D:\\Data"))
    got = {r.physical_name: r.mount_path for r in disk.longest_prefix_join(files, mounts, compat).collect()}
    assert got == {f: (loose if compat else strict) for f, strict, loose in FILES}
    lengths = {(r.physical_name, r.mount_path) for r in disk.longest_prefix_join(files, mounts, compat).collect()}
    assert all(f.startswith(m) for f, m in lengths)


def test_drive_row(frame):
    v = volumes(
        frame,
        ("2024-01-01 00:00:00", "D:", "Local Disk", 95),
        ("2024-01-01 06:00:00", "D:", "Local Disk", 96),
        ("2024-01-02 00:00:00", "D:", "Local Disk", 50),
        ("2024-01-02 00:00:00", "L:", "Local Disk", 50),
        ("2024-01-02 00:00:00", "E:", "CD-ROM", 50),
    )
    l = frame(
        LATENCY,
        ("a", "2024-01-05 00:00:00", "db", "D:\\x.mdf", 1, 4, 3),
        ("a", "2024-01-06 00:00:00", "db", "D:\\x.mdf", 2, 4, 9),
        ("a", "2024-01-06 00:00:00", "db", "D:\\y.mdf", 2, 5, 1),
    )
    rows = {r.mount_path: r for r in disk.drive_monthly(v, l, **stamps()).collect()}
    assert set(rows) == {"D:", "L:"}
    d, log = rows["D:"], rows["L:"]
    assert (d.samples_critical_free, d.days_critical_free, d.max_used_space_kb, d.min_free_space_kb) == (2, 1, 96, 4)
    assert (d.used_space_kb, d.absolute_growth_kb, d.rollup_free_space_kb) == (80, -45, 50)
    assert (d.avg_read_latency_ms, d.avg_write_latency_ms, d.avg_overall_latency_ms, d.worst_observed_latency_ms) == (1, 4, 4, 9)
    assert (d.is_sql_disk, log.is_sql_disk, log.avg_read_latency_ms) == (True, False, None)


def test_samples_at_the_last_instant_all_stay(frame):
    df = volumes(frame, ("2024-01-02 00:00:00", "D:", "Local Disk", 50), ("2024-01-02 00:00:00", "D:", "Local Disk", 51))
    assert disk.last_sample(df).count() == 2


@pytest.mark.parametrize(
    "n,band,flag",
    [(99, "Normal", False), (100, "Warning", True), (499, "Warning", True), (500, "Severe", True),
     (999, "Severe", True), (1000, "Critical", True)],
)
def test_segment_bands(spark, n, band, flag):
    df = spark.range(n).select(F.lit("a").alias("server_name"), F.lit("db").alias("database_name"))
    assert disk.log_segment_severity(df).first().log_segment_severity == band
    assert health.high_segment_flag(df).first().has_high_segment_count is flag


def test_inventory(frame):
    files = frame(
        "server_name:string database_name:string physical_name:string type_desc:string size_pages:bigint growth_pages:bigint",
        ("a", "db", "D:\\x.mdf", "ROWS", 10, 1),
    )
    r = disk.file_inventory(files).first()
    assert (r.file_type, r.file_drive, r.file_size_kb, r.file_growth_kb) == ("ROWS", "D:", 80, 8)


AS_OF = datetime(2024, 3, 10)


@pytest.mark.parametrize(
    "model,full,log,expected",
    [
        ("FULL", None, timedelta(hours=25), (True, True)),
        ("FULL", timedelta(days=7, seconds=1), timedelta(hours=23), (True, False)),
        ("FULL", timedelta(days=7), timedelta(hours=24), (False, False)),
        ("SIMPLE", timedelta(days=1), None, (False, False)),
        ("BULK_LOGGED", timedelta(days=1), None, (False, True)),
    ],
)
def test_staleness(frame, model, full, log, expected):
    db = frame("server_name:string database_name:string recovery_model:string", ("a", "db", model), ("a", "tempdb", "FULL"))
    taken = [("a", "db", k, str(AS_OF - age)) for k, age in (("D", full), ("L", log)) if age is not None]
    backups = frame("server_name:string database_name:string backup_type:string backup_finish_ts:string", *taken, ("a", "db", "I", str(AS_OF)))
    rows = {r.database_name: r for r in health.backup_staleness(db, backups, F.lit(str(AS_OF)).cast("timestamp_ntz")).collect()}
    assert (rows["db"].is_backup_overdue, rows["db"].is_log_backup_overdue) == expected
    assert (rows["tempdb"].is_backup_overdue, rows["tempdb"].is_log_backup_overdue) == (False, False)


def test_integrity_check_values(frame):
    df = frame(
        "server_name:string database_name:string last_known_good:string",
        ("a", "never", health.NEVER_CHECKED), ("a", "bad", "??"), ("a", "ok", "2024-01-02 03:04:05.000"),
    )
    got = {r.database_name: r.last_good_check for r in health.last_good_check(df).collect()}
    assert got == {"never": None, "bad": None, "ok": datetime(2024, 1, 2, 3, 4, 5)}


def test_system_facts(frame):
    props = "server_name:string property_name:string property_value:string"
    p = frame(
        props,
        *[("new", n, v) for n, v in {
            "ProductMajorVersion": "14", "ServerName": "h", "InternalSQLName": "h", "LockedPagesKB": "4", "VirtualMachineType": "HYPERVISOR",
            "VersionBanner": "Server 2017\n(RTM) - 14.0", "HostDistribution": "d", "InstantFileInitialization": "1",
            "PhysicalMemoryKB": "2047", "InstanceName": "inst", "IsHadrEnabled": "1"}.items()],
        *[("old", n, v) for n, v in {"ServerName": "h", "VersionBanner": "no dash", "HostDistribution": "d", "CpuCount": "x"}.items()],
    )
    configs = frame("server_name:string name:string value:int", ("new", "max degree of parallelism", 8))
    schedulers = frame(
        "server_name:string parent_node_id:int status:string",
        ("new", 0, "VISIBLE ONLINE"), ("new", 1, "VISIBLE OFFLINE"), ("new", 64, "HIDDEN ONLINE"),
    )
    groups = frame("server_name:string group_name:string", ("new", "g1"), ("new", "g2"))
    rows = {r.server_name: r for r in health.system_health(p, configs, schedulers, F.lit("2024-01-01").cast("date"), groups).collect()}
    new, old = rows["new"], rows["old"]
    assert (new.is_name_matching, new.is_virtual_machine, new.lock_pages_in_memory, new.is_ag_present) == (True,) * 4
    assert (new.friendly_version, new.host_distribution, new.instant_file_initialization) == ("Server 2017 (RTM) ", "d", True)
    assert (new.host_ram_mb, new.numa_nodes, new.max_dop, new.instance_name) == (1, 2, 8, "inst")
    assert (old.is_name_matching, old.is_virtual_machine, old.is_ag_present, old.lock_pages_in_memory) == (False, None, False, False)
    assert (old.friendly_version, old.host_distribution, old.instance_name, old.cpu_cores) == (
        None, None, health.DEFAULT_INSTANCE, None,
    )


def test_files_on_c_count_for_user_databases_only(frame):
    db = frame(
        "server_name:string database_id:int database_name:string recovery_model:string page_verify:string "
        "is_auto_shrink_on:boolean is_auto_close_on:boolean",
        ("a", 4, "msdb", "SIMPLE", "NONE", False, False), ("a", 5, "user", "SIMPLE", "CHECKSUM", True, False),
        ("a", 2, "tempdb", "SIMPLE", "CHECKSUM", False, False),
    )
    files = frame(
        "server_name:string database_id:int physical_name:string type_desc:string is_percent_growth:boolean",
        ("a", 4, "C:\\x.mdf", "ROWS", True), ("a", 5, "C:\\y.ldf", "LOG", True),
    )
    empty = "server_name:string database_name:string"
    rows = {
        r.database_name: r
        for r in health.database_health(
            db, files, frame(empty, ("z", "z")),
            frame(f"{empty} backup_type:string backup_finish_ts:string", ("z", "z", "D", "2024-01-01")),
            frame(f"{empty} last_known_good:string", ("z", "z", "")),
            F.lit("2024-01-01").cast("date"), F.lit("2024-02-01").cast("timestamp_ntz"),
        ).collect()
    }
    assert set(rows) == {"msdb", "user"}
    assert (rows["msdb"].has_files_on_c_disk, rows["user"].has_files_on_c_disk) == (False, True)
    assert (rows["msdb"].has_percent_autogrowth, rows["user"].has_percent_autogrowth) == (True, False)
    assert (rows["msdb"].is_page_verification_not_checksum, rows["user"].log_segment_count) == (True, 0)


def test_report_period(frame):
    df = frame("event_time_utc:string", ("2023-12-31 23:59:59",), ("2024-02-10 00:00:00",))
    as_of = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    got = [tuple(r) for r in calendar.month_spine(df, as_of).orderBy("rollup_month").collect()]
    assert got == [
        (date(2023, 12, 1), date(2023, 12, 31), 44640), (date(2024, 1, 1), date(2024, 1, 31), 44640),
        (date(2024, 2, 1), date(2024, 2, 29), 41760),
    ]
    assert calendar.month_spine(df.limit(0), as_of).count() == 0


def test_month_slice_is_half_open(frame):
    df = frame("event_time_utc:string", ("2024-01-31 23:59:59.999",), ("2024-02-01 00:00:00",), ("2024-02-29 23:59:59.999",), ("2024-03-01 00:00:00",))
    assert calendar.month_slice(df, date(2024, 2, 1), date(2024, 3, 1)).count() == 2


def test_second_collection_of_an_inventory_does_not_double_its_counts(spark):
    rows = [
        ("a", 5, "d", "f1", "ROWS", 10, "2024-01-10 02:00:00"),
        ("a", 5, "d", "f1", "ROWS", 30, "2024-01-31 02:00:00"),
        ("a", 5, "d", "f2", "LOG", 20, "2024-01-31 02:00:00"),
        ("a", 5, "d", "f1", "ROWS", 99, "2024-02-03 02:00:00"),
        ("b", 5, "d", "f1", "ROWS", 40, "2024-01-12 02:00:00"),
        ("c", 5, "d", "f1", "ROWS", 50, "2024-02-02 02:00:00"),
    ]
    schema = "server_name string, database_id int, database_name string, physical_name string, type_desc string, size_pages long, at string"
    files = spark.createDataFrame(rows, schema).selectExpr("*", "cast(at AS timestamp_ntz) AS collected_utc")
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    found = disk.database_footprint(calendar.latest_collection(files, as_of)).collect()
    assert sorted((r.server_name, r.data_file_count, r.log_file_count, r.total_database_size_kb) for r in found) == [("a", 1, 1, 400), ("b", 1, 0, 320)]


def test_free_space_far_above_capacity_does_not_stop_the_job(spark):
    raw = spark.sql(
        "SELECT 's' AS server_name, timestamp_ntz'2024-01-01 00:00:00' AS event_time_utc, 'C:' || chr(92) AS name, 'x' AS label, 'C:' AS drive_letter,"
        " 'NTFS' AS file_system, 3 AS drive_type, capacity_bytes, 102400000L AS free_bytes, 4096L AS block_size"
        " FROM VALUES (1024L), (204800000L) AS t(capacity_bytes)"
    )
    found = {r.size_kb: (r.percent_free, r.percent_used) for r in ingest.normalize_volumes(raw).collect()}
    assert found[1] == (None, None)
    assert [float(x) for x in found[200000]] == [50.0, 50.0]
