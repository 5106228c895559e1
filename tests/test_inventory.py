"""Inventories over time, commit logs, restart marks and incremental boundaries."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import disk, health, ingest, inventory
from fleetgauge.plans import chains, jobs
from fleetgauge.sources.commits import CommitLog, Conflict, PublishedTable


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


SEGMENTS = "server_name string, database_name string, collected_utc timestamp_ntz"


def collections(seed: int = 3):
    """Rows (server, database, time) of collections at irregular times, some of which find nothing of a database."""
    rng = random.Random(seed)
    rows = []
    for server in ("a", "b"):
        for n in sorted(rng.sample(range(150), 9)):
            for db in ("d1", "d2", None):
                rows += [(server, db, day(n))] * rng.choice([0, 1, 1, 2])
    return rows


def plain_intervals(rows):
    times, bags = defaultdict(set), Counter(rows)
    for server, _, t in rows:
        times[server].add(t)
    out = []
    for server, db in {(s, d) for s, d, _ in rows}:
        ordered, current = sorted(times[server]), None
        for i, t in enumerate(ordered):
            n = bags[server, db, t]
            if current and current[1] != n:
                out.append((server, db, current[1], current[0], t, ordered[i - 1]))
                current = None
            if n and not current:
                current = (t, n)
        if current:
            out.append((server, db, current[1], current[0], None, ordered[-1]))
    return Counter(out)


def as_bag(df):
    columns = ["server_name", "database_name", inventory.ROWS, inventory.FROM, inventory.TO, inventory.SEEN]
    return Counter(tuple(r) for r in df.select(columns).collect())


def test_intervals_equal_brute_force(spark):
    rows = collections()
    assert as_bag(inventory.validity_intervals(spark.createDataFrame(rows, SEGMENTS))) == plain_intervals(rows)


def test_collections_that_find_nothing_close_intervals(spark):
    rows = spark.createDataFrame([("a", "d1", day(1)), ("a", "d1", day(9))], SEGMENTS)
    runs = spark.createDataFrame([("a", day(n)) for n in (1, 4, 9, 12)], "server_name string, collected_utc timestamp_ntz")
    found = inventory.validity_intervals(rows, collections=runs)
    assert as_bag(found) == Counter({("a", "d1", 1, day(1), day(4), day(1)): 1, ("a", "d1", 1, day(9), day(12), day(9)): 1})


@pytest.mark.parametrize("cuts", [[30], [20, 21, 90]])
def test_recorded_collections_equal_one_run(spark, tmp_path, cuts):
    """Any cut into landings, and landings that arrive again, give the intervals of one run over everything."""
    rows = collections(8)
    frame = spark.createDataFrame(rows, SEGMENTS)
    slices = chains.landings(frame, [day(c) for c in cuts], "collected_utc")
    for i, batch in enumerate([slices[0], *slices, slices[-1]]):
        jobs.record_collection(spark, batch, f"{tmp_path}/t", f"run-{i}")
    assert as_bag(jobs.stored_intervals(spark, f"{tmp_path}/t")) == plain_intervals(rows)
    assert not jobs.record_collection(spark, slices[0], f"{tmp_path}/t", "run-0")


def test_months_get_the_state_they_ended_with(spark):
    """Twelve months in one call, each counted by hand from its newest collection."""
    rows = collections(5)
    start, end = dt.date(2023, 12, 1), dt.date(2024, 12, 1)
    found = inventory.by_month(spark.createDataFrame(rows, SEGMENTS), start, end)
    want = Counter()
    for month in [dt.date(2023, 12, 1)] + [dt.date(2024, m, 1) for m in range(1, 12)]:
        limit = dt.datetime(month.year + month.month // 12, month.month % 12 + 1, 1)
        for server in ("a", "b"):
            times = [t for s, _, t in rows if s == server and t < limit]
            for s, db, t in rows:
                if times and s == server and t == max(times):
                    want[server, db, month] += 1
    got = {(r["server_name"], r["database_name"], r["rollup_month"]): r[inventory.ROWS] for r in found.collect()}
    assert got == dict(want)
    severity = disk.log_segment_severity(found).collect()
    assert {(r["server_name"], r["database_name"], r["rollup_month"]): r["log_segment_count"] for r in severity} == got


def test_a_table_of_one_state_next_to_months(spark):
    """Properties by month meet settings of one collection; the reverse is refused."""
    properties = spark.createDataFrame(
        [("a", "Edition", "x", day(3)), ("a", "Edition", "y", day(40))], "server_name string, property_name string, property_value string, collected_utc timestamp_ntz"
    )
    settings = spark.createDataFrame([("a", "max degree of parallelism", 8)], "server_name string, name string, value int")
    schedulers = spark.createDataFrame([("a", 0, "VISIBLE ONLINE")], "server_name string, parent_node_id int, status string")
    months = inventory.by_month(properties, dt.date(2024, 1, 1), dt.date(2024, 4, 1))
    rows = health.system_health(months, settings, schedulers).orderBy("rollup_month").collect()
    assert [(r["rollup_month"].month, r["edition"], r["max_dop"], r["numa_nodes"]) for r in rows] == [(1, "x", 8, 1), (2, "y", 8, 1), (3, "y", 8, 1)]
    with pytest.raises(ValueError):
        health.system_health(properties.drop("collected_utc"), settings, inventory.by_month(
            schedulers.withColumn("collected_utc", F.lit(day(1))), dt.date(2024, 1, 1), dt.date(2024, 4, 1)), F.lit(None))


def test_backups_known_at_the_end_of_each_month(spark):
    databases = spark.createDataFrame(
        [("a", "d", "FULL", dt.date(2024, m, 1)) for m in (1, 2, 3)], "server_name string, database_name string, recovery_model string, rollup_month date"
    )
    backups = spark.createDataFrame(
        [("a", "d", "D", dt.datetime(2024, 1, 30)), ("a", "d", "L", dt.datetime(2024, 2, 29, 12)), ("a", "d", "D", dt.datetime(2024, 4, 2))],
        "server_name string, database_name string, backup_type string, backup_finish_ts timestamp_ntz",
    )
    rows = health.backup_staleness(databases, backups).orderBy("rollup_month").collect()
    assert [(r["is_backup_overdue"], r["is_log_backup_overdue"], r["last_full_backup"]) for r in rows] == [
        (False, True, dt.datetime(2024, 1, 30)), (True, False, dt.datetime(2024, 1, 30)), (True, True, dt.datetime(2024, 1, 30)),
    ]


# --- commits -----------------------------------------------------------------------------------------------------------

ROLLUP = "server_name string, rollup_month date, v int"


def rollup(spark, *rows):
    return spark.createDataFrame([(s, dt.date(2024, m, 1), v) for s, m, v in rows], ROLLUP)


KEYS = ["server_name", "rollup_month"]


def test_a_run_that_dies_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, f"{tmp_path}/t")
    assert table.read() is None
    assert table.publish(rollup(spark, ("a", 1, 1)), KEYS, "one")

    def killed(self, run, after):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            table.publish(rollup(spark, ("b", 1, 2)), KEYS, "two")
    assert table.read().count() == 1
    assert table.publish(rollup(spark, ("a", 1, 9), ("b", 1, 3)), KEYS, "two")
    assert sorted((r["server_name"], r["v"]) for r in table.read().collect()) == [("a", 1), ("b", 3)]
    assert not table.publish(rollup(spark, ("c", 1, 3)), KEYS, "two")


def test_concurrent_runs_publish_each_key_once(spark, tmp_path, monkeypatch):
    """Another run commits between this one's look at the log and its commit."""
    table, other = PublishedTable(spark, f"{tmp_path}/t"), PublishedTable(spark, f"{tmp_path}/t")
    original, once = CommitLog.publish, []

    def beaten(self, run, after):
        if not once:
            once.append(run)
            other.publish(rollup(spark, ("a", 1, 7), ("c", 2, 8)), KEYS, "other")
        return original(self, run, after)

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "publish", beaten)
        assert table.publish(rollup(spark, ("a", 1, 1), ("b", 1, 2)), KEYS, "mine")
    assert sorted((r["server_name"], r["v"]) for r in table.read().collect()) == [("a", 7), ("b", 2), ("c", 8)]
    assert table.log.runs() == ["other", "mine"]
    monkeypatch.setattr(CommitLog, "publish", lambda *_: False)
    with pytest.raises(Conflict):
        table.publish(rollup(spark, ("z", 1, 1)), KEYS)


def test_an_empty_run_is_a_run(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    assert table.publish(rollup(spark), KEYS, "none")
    assert table.read().count() == 0 and table.publish(rollup(spark, ("a", 1, 1)), KEYS)
    assert table.read().count() == 1


def test_published_months_are_not_computed_again(spark, tmp_path):
    """The build step sees the months that are not published, and the month before them."""
    samples = spark.createDataFrame([("a", day(d), d) for d in range(0, 90, 5)], "server_name string, event_time_utc timestamp_ntz, v int")
    seen = []

    def build(pending, earlier):
        months = pending.groupBy("server_name", F.trunc("event_time_utc", "MM").alias("rollup_month")).agg(F.max("v").alias("v"))
        seen.append((months.count(), None if earlier is None else earlier.count()))
        return months

    def publish(end, run, **options):
        return jobs.publish_months(spark, samples, build, f"{tmp_path}/t", dt.date(2024, 1, 1), end, run=run, **options)

    assert publish(dt.date(2024, 2, 1), "one") and publish(dt.date(2024, 4, 1), "two", as_of=dt.date(2024, 3, 20))
    assert not publish(dt.date(2024, 4, 1), "two") and publish(dt.date(2024, 4, 1), "three")
    assert seen == [(1, None), (1, 1), (1, 2), (1, 2)]
    rows = PublishedTable(spark, f"{tmp_path}/t").read()
    assert sorted((r["rollup_month"].month, r["v"]) for r in rows.collect()) == [(1, 30), (2, 55), (3, 85)]


# --- restarts and boundaries -------------------------------------------------------------------------------------------

COUNTERS = "server_name string, counter string, event_time_utc timestamp_ntz, value bigint"


def readings(seed: int):
    """Two counters of two servers that restart now and then, sometimes passing their old value before the next reading."""
    rng = random.Random(seed)
    rows, restarts = [], []
    for server in ("a", "b"):
        values, t = {"x": 0, "y": 0}, day(0)
        for _ in range(80):
            t += dt.timedelta(hours=rng.randrange(1, 40))
            if rng.random() < 0.12:
                restarts.append((server, t - dt.timedelta(minutes=rng.choice([0, 5]))))
                values = dict.fromkeys(values, 0)
            for counter in values:
                values[counter] += rng.randrange(50) + (200 if rng.random() < 0.1 else 0)
                rows.append((server, counter, t, values[counter]))
    return rows, restarts


def test_deltas_with_restarts_equal_brute_force(spark):
    rows, restarts = readings(4)
    frame = spark.createDataFrame(rows, COUNTERS)
    marks = spark.createDataFrame(restarts, "server_name string, restart_ts timestamp_ntz")
    found = ingest.counter_delta(frame, "value", ["server_name", "counter"], restarts=marks).collect()
    last, want = {}, Counter()
    for server, counter, t, v in rows:
        before = last.get((server, counter))
        fresh = any(s == server and r <= t and (before is None or r > before[0]) for s, r in restarts)
        delta = v if fresh else 0 if before is None else v if v < before[1] else v - before[1]
        last[server, counter] = (t, v)
        want[server, counter, t, v, delta] += 1
    assert Counter(tuple(r) for r in found) == want


def test_sums_of_deltas_are_the_nets_of_closed_months(spark):
    rows, restarts = readings(9)
    restarts += [(s, day(0)) for s in ("a", "b")]
    frame = spark.createDataFrame(rows, COUNTERS)
    marks = spark.createDataFrame(restarts, "server_name string, restart_ts timestamp_ntz")
    deltas = ingest.counter_delta(frame, "value", ["server_name", "counter"], restarts=marks)
    sums = deltas.groupBy("server_name", "counter", F.trunc("event_time_utc", "MM").alias("rollup_month")).agg(F.sum("delta").alias("d"))
    from fleetgauge.operators.waits import boundary_net

    net = boundary_net(ingest.closed_months(ingest.boundary_snapshots(frame, marks)), ["server_name", "counter", "rollup_month"], ["value"])
    both = net.join(sums, ["server_name", "counter", "rollup_month"], "left").collect()
    assert len(both) >= 8 and all(r["value"] == r["d"] for r in both)


@pytest.mark.parametrize("cuts", [[11], [1, 31, 32, 60]])
def test_boundaries_in_any_cut_equal_one_run(spark, tmp_path, cuts):
    rows, restarts = readings(2)
    frame = spark.createDataFrame(rows, COUNTERS)
    marks = spark.createDataFrame(restarts, "server_name string, restart_ts timestamp_ntz")
    slices = chains.landings(frame, [day(c) for c in cuts])
    for i, batch in enumerate([*slices, slices[0], slices[-1]]):
        jobs.snapshot_boundaries(spark, batch, marks, f"{tmp_path}/b", f"run-{i}")
    got = Counter(tuple(r) for r in PublishedTable(spark, f"{tmp_path}/b").read().collect())
    want = Counter(tuple(r) for r in ingest.boundary_snapshots(frame, marks).collect())
    assert got == want and sum(want.values()) > 10


def test_a_chain_goes_on_at_its_first_unfinished_stage(spark, tmp_path, monkeypatch):
    at = "timestamp_ntz"
    raw = spark.createDataFrame(
        [("a", w, 5, 1000 * (i + 1) * k, 100 * (i + 1), day(i * 7), day(i * 7)) for i in range(12) for k, w in ((1, "CXPACKET"), (2, "LCK_M_X"))],
        f"server_name string, wait_type string, waiting_tasks_count bigint, wait_time_ms bigint, signal_wait_time_ms bigint, event_time_utc {at}, event_time_local {at}",
    )
    capacity = spark.createDataFrame([("a", 100.0)], "server_name string, total_server_time_seconds double")
    restarts = spark.createDataFrame([("a", day(-1))], f"server_name string, restart_ts {at}")
    now = F.lit("2024-06-01").cast(at)
    slices = chains.landings(raw, [day(40)])
    run = lambda i, root: chains.collect_waits(spark, f"{tmp_path}/{root}", f"landing-{i}", slices[i], capacity, restarts, now)
    assert run(0, "x") == chains.WAIT_STAGES
    with monkeypatch.context() as patch:
        patch.setattr(chains.waits, "wait_monthly", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(1, "x")
    assert [len(r) for r in chains.progress(spark, f"{tmp_path}/x", chains.WAIT_STAGES).values()] == [2, 2, 1]
    assert run(1, "x") == ["wait_monthly"] and run(1, "x") == []
    run(0, "y"), run(1, "y")
    left, right = (Counter(tuple(r) for r in PublishedTable(spark, f"{tmp_path}/{x}/wait_monthly").read().collect()) for x in "xy")
    assert left == right and sum(left.values()) == 2
