"""What the physical plans must not contain, and what must reach the scans."""

import re

import pytest

from fleetgauge.operators import ingest, memory
from fleetgauge.plans import registry

SF_DIR = "/root/testdata/sf0.001"
BATCH = {n: q for n, q in registry.queries().items() if not n.startswith("st")}
UNSCALABLE = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "RoundRobin"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_cross_join_no_python_no_single_task(spark, name):
    text = plan(BATCH[name](spark, SF_DIR))
    assert [w for w in UNSCALABLE if w in text] == []
    if name != "dt1_report_period":  # one row: the first event time
        assert "SinglePartition" not in text


@pytest.mark.parametrize(
    "name,scans,exchanges", [("cp9_cpu_monthly", 2, 4), ("wa10_wait_monthly", 1, 3), ("bk7_blocking_monthly", 1, 3)]
)
def test_full_rollups_share_scans_and_exchanges(spark, name, scans, exchanges):
    text = plan(BATCH[name](spark, SF_DIR))
    assert (len(re.findall("FileScan", text)), len(re.findall("Exchange hash", text))) == (scans, exchanges)


def test_scans_read_needed_columns_and_filters(spark, tmp_path):
    ddl = "server_name string, event_time_utc timestamp_ntz, object_name string, counter_name string, counter_value bigint"
    spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/c")
    df = spark.read.schema(ddl).parquet(f"{tmp_path}/c")
    from pyspark.sql import functions as F

    text = plan(memory.memory_monthly(df, F.lit(1), F.lit(1)))
    assert "object_name" not in text
    assert "EqualTo(counter_name,Page life expectancy)" in text
    ddl = "server_name string, wait_type string, waiting_tasks_count bigint, wait_time_ms bigint, signal_wait_time_ms bigint"
    spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/w")
    raw = spark.read.schema(ddl).parquet(f"{tmp_path}/w")
    capacity = spark.createDataFrame([("a", 1.0)], "server_name string, total_server_time_seconds double")
    text = plan(ingest.classify_waits(raw, capacity))
    assert "GreaterThan(waiting_tasks_count,0)" in text


def test_hot_server_is_split_by_time(spark):
    """Raw samples are never shuffled or sorted by server alone."""
    from fleetgauge.sources.bindings import bound

    text = plan(ingest.counter_delta(bound(spark, SF_DIR, "counter_resets"), order=["event_time_utc", "sample_id"]))
    raw = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert any("__bucket" in line for line in raw)
    by_server = [i for i, line in enumerate(text.splitlines()) if re.search(r"hashpartitioning\(server_name#\d+, \d+\)", line)]
    lines = text.splitlines()
    assert by_server and all("Aggregate" in lines[i + 1] or "Project" in lines[i + 1] for i in by_server)


def test_raw_rows_meet_their_server_without_a_shuffle(spark):
    """What has one row per server is sent to the rows, small tables or not: by server they would be one task each."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        ddl = "server_name string, wait_type string, waiting_tasks_count bigint, wait_time_ms bigint, signal_wait_time_ms bigint"
        capacity = spark.createDataFrame([("a", 1.0)], "server_name string, total_server_time_seconds double")
        benign = spark.createDataFrame([("X",)], "wait_type string")
        text = plan(ingest.classify_waits(spark.createDataFrame([("a", "Y", 1, 2, 1)], ddl), capacity, benign))
        assert "SortMergeJoin" not in text and "hashpartitioning(server_name" not in text
    finally:
        spark.conf.set(name, before)


def test_last_sample_reads_once_and_is_cut_before_the_shuffle(spark):
    text = plan(BATCH["dk6_last_sample"](spark, SF_DIR))
    assert len(re.findall("FileScan", text)) == 1 and "Join" not in text
    before = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before


def test_nets_evaluate_boundaries_once(spark):
    """Closed months are found among the boundary rows; the samples behind them are not read again."""
    scans = [len(re.findall("FileScan", plan(BATCH[n](spark, SF_DIR)))) for n in ("in14_boundary_snapshots", "in14_monthly_net")]
    assert scans[0] == scans[1]


def test_only_named_blockers_are_carried_on(spark):
    assert "LeftSemi" in plan(BATCH["in10_blocked_sessions"](spark, SF_DIR))


def test_known_minutes_are_left_out_before_parsing(spark):
    text = plan(BATCH["in3_append_new_minutes"](spark, SF_DIR))
    assert text.index("from_xml") < text.index("LeftAnti")  # plans are printed from the result down
