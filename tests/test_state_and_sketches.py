"""Streams on the state store, quantiles from daily sketches, damaged records."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.sketches import rank_error
from fleetgauge.operators import daily, ingest
from fleetgauge.plans import jobs
from fleetgauge.sources.commits import PublishedTable
from fleetgauge.streaming import stateful
from fleetgauge.streaming.jobs import counter_delta_stream

T0 = datetime(2024, 1, 30)
DDL = "server_name string, counter string, event_time_utc timestamp_ntz, raw_counter_value bigint"


def readings(seed: int = 5, n: int = 150):
    """Rows of four keys in parts; within a part, and a little beyond it, out of order."""
    rng = random.Random(seed)
    rows = []
    for server in ("a", "b"):
        for counter in ("x", "y"):
            value = 3
            for i in range(n):
                value = rng.randrange(4) if rng.random() < 0.1 else value + rng.randrange(9)
                rows.append((server, counter, T0 + timedelta(minutes=37 * i, seconds=rng.randrange(900)), value))
    rows.sort(key=lambda r: r[2] + timedelta(minutes=rng.randrange(120)))
    return [rows[i : i + 150] for i in range(0, len(rows), 150)]


def land(spark, path, part, rows, ddl=DDL):
    spark.createDataFrame(rows, ddl).repartition(3).write.parquet(f"{path}/in/part={part}")


def run(spark, found, path):
    with stateful.state_store(spark):
        query = found.writeStream.option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()


def stream(spark, path, ddl=DDL):
    return spark.readStream.schema(ddl).option("recursiveFileLookup", "true").parquet(f"{path}/in")


KEYS = ["server_name", "counter"]


def test_state_deltas_equal_batch_across_restarts_of_the_query(spark, tmp_path):
    parts = readings()
    for i, part in enumerate(parts):  # a new query on the old checkpoint each time
        land(spark, tmp_path, i, part)
        run(spark, stateful.counter_delta_state(stream(spark, tmp_path), keys=KEYS), tmp_path)
    whole = spark.createDataFrame([r for p in parts for r in p], DDL)
    final = max(r[2] for p in parts for r in p) - timedelta(hours=4)
    batch = ingest.counter_delta(whole, keys=KEYS).filter(F.col("event_time_utc") < F.lit(final))
    columns = [*KEYS, "event_time_utc", "raw_counter_value", "delta"]
    got = Counter(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select(columns).collect())
    assert got == Counter(tuple(r) for r in batch.select(columns).collect()) and sum(got.values()) > 500


def test_both_forms_of_the_delta_stream_agree(spark, tmp_path):
    parts = readings(8)
    for i, part in enumerate(parts):
        land(spark, tmp_path, i, part)
    run(spark, stateful.counter_delta_state(stream(spark, tmp_path), keys=KEYS), tmp_path)
    query, out = counter_delta_stream(stream(spark, tmp_path), f"{tmp_path}/other", keys=KEYS)
    query.awaitTermination()
    columns = [*KEYS, "event_time_utc", "delta"]
    one = Counter(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select(columns).collect())
    other = Counter(tuple(r) for r in out.read().select(columns).collect())
    assert one and not one - other


def test_state_boundaries_equal_batch(spark, tmp_path):
    rows = [r[:1] + r[2:] for p in readings(3) for r in p if r[1] == "x"]
    ddl = "server_name string, event_time_utc timestamp_ntz, value bigint"
    marks = [("a", T0 + timedelta(minutes=m)) for m in (500, 2890, 2900, 5010)] + [("b", T0 + timedelta(minutes=3000)), ("b", rows[70][1])]
    land(spark, tmp_path, 0, rows, ddl)
    restarts = spark.createDataFrame(marks, "server_name string, restart_ts timestamp_ntz")
    restarts.write.parquet(f"{tmp_path}/restarts")
    found = stateful.boundary_snapshot_state(
        stream(spark, tmp_path, ddl), spark.readStream.schema(restarts.schema).parquet(f"{tmp_path}/restarts"), ["value"]
    )
    run(spark, found, tmp_path)
    whole = spark.createDataFrame(rows, ddl)
    final = max(r[1] for r in rows) - timedelta(hours=4)
    settled = whole.filter(F.col("event_time_utc") < F.lit(final))  # the last settled reading has no settled follower
    columns = ["server_name", "snapshot_date_utc", "snapshot_type", "rollup_month", "value"]
    got = Counter(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select(columns).collect())
    want = Counter(tuple(r) for r in ingest.boundary_snapshots(settled, restarts).select(columns).collect())
    assert got == want and sum(want.values()) >= 6


class Kept:
    """A list or a value of a state handle, and the handle of one processor."""

    def __init__(self):
        self.items, self.value, self.timers = [], None, []

    getListState = getValueState = lambda self, name, schema: self
    listTimers = lambda self: iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)

    def get(self):
        return iter(self.items)

    def clear(self):
        self.items = []

    def appendList(self, items):
        self.items += items

    put = lambda self, items: setattr(self, "items", list(items))


class Last(Kept):
    get = lambda self: self.value
    update = lambda self, value: setattr(self, "value", value)


def test_rows_wait_in_blocks_and_give_the_same_as_one_by_one():
    """An item of state, a message and a Python step for each waiting row would take the most of a large micro-batch."""
    import pandas as pd
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    long = lambda *names: [StructField(n, LongType()) for n in names]
    kept = long("at_micros", "sample_id", "v")
    out = StructType([StructField("server_name", StringType()), *kept, *long("delta")])
    processor = stateful.Deltas(["server_name"], StructType(kept), ["at_micros", "sample_id"], StructType(long("v")), out)
    processor.handle, processor.pending, processor.last = Kept(), Kept(), Last()
    rng = random.Random(2)
    rows = [(rng.randrange(10**9), i, rng.randrange(2**62) if i % 100 else None) for i in range(25_000)]
    at = type("At", (), {"ms": 0, "getCurrentWatermarkInMs": lambda self: self.ms})()
    given = pd.DataFrame({c: pd.array(v, "Int64") for c, v in zip(["at_micros", "sample_id", "v"], zip(*rows))})
    assert list(processor.handleInputRows(("a",), iter([given[:9_000], given[9_000:]]), at)) == []
    assert len(processor.pending.items) == 3 and len(processor.handle.timers) == 1
    got = []
    for at.ms in (300_000, 1_000_001):
        for frame in processor.handleExpiredTimer(("a",), at, None):
            got += [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    want, last = [], None
    for when, i, v in sorted(rows):
        step = 0 if last is None else None if v is None else v if v < last else v - last
        want.append(("a", when, i, v, step))
        last = v
    assert got == want and processor.pending.items == [] and processor.handle.timers == []


VALUES = "server_name string, event_time_utc timestamp_ntz, v bigint"


def test_quantiles_of_merged_days_are_within_the_rank_error(spark, tmp_path):
    rng = random.Random(1)
    rows = [("a", datetime(2024, 1, 1 + i % 31, i % 24), int(rng.lognormvariate(8, 3))) for i in range(20_000)]
    rows += [("b", datetime(2024, 1, 3), None), ("c", datetime(2024, 2, 3), 7)]
    frame = spark.createDataFrame(rows, VALUES)
    for until in (date(2024, 1, 10), date(2024, 1, 10), date(2024, 3, 1)):
        jobs.sketch_days(spark, frame, ["v"], f"{tmp_path}/s", until)
    stored = PublishedTable(spark, f"{tmp_path}/s").read()
    wanted = {f"p{p}": ("v", p / 100) for p in (1, 5, 50, 90, 99)}
    found = {r["server_name"]: r for r in daily.monthly_quantiles(stored, wanted).collect()}
    ordered = sorted(v for s, _, v in rows if s == "a")
    for name, (_, p) in wanted.items():
        value = found["a"][name]
        below, upto = sum(v < value for v in ordered), sum(v <= value for v in ordered)
        room = 3 * rank_error() * len(ordered) + 1
        assert below - room <= p * len(ordered) <= upto + room
    assert found["a"]["n"] == 20_000 and found["b"]["p50"] is None and found["c"]["p50"] == 7
    assert stored.count() == 33


def test_a_closed_day_is_not_read_again(spark, tmp_path):
    """Samples that arrive for a stored day do not change it; the slice starts at the carried day."""
    first = spark.createDataFrame([("a", datetime(2024, 1, 1, 5), 1)], VALUES)
    later = spark.createDataFrame([("a", datetime(2024, 1, 1, 6), 100), ("a", datetime(2024, 1, 2, 6), 5)], VALUES)
    jobs.sketch_days(spark, first, ["v"], f"{tmp_path}/s", date(2024, 1, 2))
    jobs.sketch_days(spark, first.union(later), ["v"], f"{tmp_path}/s", date(2024, 1, 3))
    rows = {r["event_day"]: r["n"] for r in PublishedTable(spark, f"{tmp_path}/s").read().collect()}
    assert rows == {date(2024, 1, 1): 1, date(2024, 1, 2): 1}


def record(service, idle="<SystemIdle>50</SystemIdle>"):
    return f"<Record><SchedulerMonitorEvent><SystemHealth><ProcessUtilization>{service}</ProcessUtilization>{idle}</SystemHealth></SchedulerMonitorEvent></Record>"


def test_damaged_records_are_put_aside_and_counted(spark, tmp_path):
    records = [record(10), record(20, ""), record("1x"), record(5)[:-30], None, "  ", "no xml at all", record(7, "<SystemIdle>99999999999</SystemIdle>")]
    raw = spark.createDataFrame(
        [("a", ingest.SCHEDULER_MONITOR, 1000 * i, 100_000, T0, r) for i, r in enumerate(records)] + [("a", "OTHER", 0, 0, T0, "junk")],
        "server_name string, ring_buffer_type string, tick_ms bigint, now_tick_ms bigint, sampled_at_utc timestamp_ntz, record string",
    )
    counts = jobs.collect_scheduler_records(spark, raw, f"{tmp_path}/r", "landing-1")
    assert counts == {"records": 8, ingest.NO_RECORD: 2, ingest.NOT_XML: 2, ingest.NOT_A_NUMBER: 2}
    assert jobs.collect_scheduler_records(spark, raw, f"{tmp_path}/r", "landing-1") == {}
    stored = PublishedTable(spark, f"{tmp_path}/r").read()
    good = stored.filter("damage IS NULL")
    same = ingest.ingest_scheduler_records(raw.filter(F.col("record").isin(records[0], records[1])))
    assert sorted(map(str, good.select(same.columns).collect())) == sorted(map(str, same.collect()))
    damaged = {r["record"]: r["damage"] for r in stored.filter("damage IS NOT NULL").collect()}
    assert damaged[records[2]] == ingest.NOT_A_NUMBER and damaged[records[3]] == ingest.NOT_XML and damaged[None] == ingest.NO_RECORD
    assert stored.filter("damage IS NOT NULL AND (sql_service IS NOT NULL OR idle_process IS NOT NULL)").count() == 0


@pytest.mark.parametrize("until", [date(2024, 1, 1)])
def test_no_day_is_closed_yet(spark, tmp_path, until):
    frame = spark.createDataFrame([("a", datetime(2024, 1, 1, 5), 1)], VALUES)
    jobs.sketch_days(spark, frame, ["v"], f"{tmp_path}/s", until)
    assert PublishedTable(spark, f"{tmp_path}/s").read().count() == 0
