"""Ordered steps and wide percentiles against plain Python on hostile inputs."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetgauge.functions.ordered import with_latest_mark, with_previous, with_previous_month
from fleetgauge.functions.quantiles import wide_percentiles

T0 = datetime(2024, 1, 1)


def test_previous_value_crosses_buckets_and_gaps(spark):
    rng = random.Random(1)
    rows = [
        (f"s{rng.choice([0, 0, 0, 1, 2])}", T0 + timedelta(minutes=rng.randrange(0, 40000)), i, rng.choice([None, i]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "server_name string, t timestamp_ntz, seq bigint, v bigint")
    got = {r.seq: r.p for r in with_previous(df, ["server_name"], ["t", "seq"], "v", "p").collect()}
    last, expected = {}, {}
    for s, t, seq, v in sorted(rows, key=lambda r: (r[1], r[2])):
        expected[seq] = (last[s],) if s in last else None
        last[s] = v
    assert {k: None if p is None else tuple(p) for k, p in got.items()} == expected


def test_latest_mark_is_an_as_of_lookup(spark):
    rng = random.Random(2)
    times = {(f"s{rng.randrange(3)}", T0 + timedelta(minutes=rng.randrange(20000))) for _ in range(1500)}
    marks = {(f"s{rng.randrange(2)}", T0 + timedelta(minutes=rng.randrange(20000))) for _ in range(40)}
    marks |= set(random.Random(3).sample(sorted(times), 20))
    t = spark.createDataFrame(sorted(times), "server_name string, t timestamp_ntz")
    m = spark.createDataFrame(sorted(marks), "server_name string, restart_ts timestamp_ntz")
    got = {(r.server_name, r.t): r.e for r in with_latest_mark(t, m, ["server_name"], "t", "restart_ts", "e").collect()}
    assert got == {
        (s, at): max((x for k, x in marks if k == s and x <= at), default=None) for s, at in times
    }


def test_previous_month_needs_the_calendar_month_before(frame):
    df = frame(
        "server_name:string rollup_month:string v:int",
        ("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("a", "2024-04-01", 4), ("b", "2024-02-01", 9),
    )
    got = with_previous_month(df, "rollup_month", ["server_name"], {"p": F.col("v")})
    assert sorted((r.server_name, r.v, r.p) for r in got.collect()) == [
        ("a", 1, None), ("a", 2, 1), ("a", 4, None), ("b", 9, None),
    ]
    stored = frame("server_name:string rollup_month:string v:int extra:int", ("b", "2024-01-01", 7, 0))
    got = with_previous_month(df, "rollup_month", ["server_name"], {"p": F.col("v")}, stored)
    assert ("b", 9, 7) in [(r.server_name, r.v, r.p) for r in got.collect()] and got.count() == 4


def interpolated(values, percent):
    values = sorted(values)
    scaled = percent * (len(values) - 1)
    lo, frac = divmod(scaled, 100)
    hi = min(lo + 1, len(values) - 1)
    return int((values[lo] * 100 + (values[hi] - values[lo]) * frac) / 100)


def test_wide_percentiles_equal_brute_force(spark):
    rng = random.Random(4)
    groups = {
        "narrow": [rng.randrange(300, 302) for _ in range(500)],
        "wide": [rng.randrange(0, 2**31) for _ in range(700)],
        "edge": [65535, 65536, 65537, 131071, 131072],
        "split": [0] * 10 + [10_000_000] * 11,
        "single": [42],
        "hot": [rng.choice([5, 70_000, 2_000_000]) for _ in range(5000)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("narrow", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    wanted = {"p5": 5, "p50": 50, "p95": 95, "p0": 0, "p100": 100}
    got = {r.g: r for r in wide_percentiles(df, ["g"], "v", wanted).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert {n: got[g][n] for n in wanted} == {n: interpolated(vs, p) for n, p in wanted.items()}, g


def test_wide_percentiles_take_values_beyond_32_bits(spark):
    df = spark.createDataFrame([("a", 3_000_000_000)], "g string, v long")
    assert wide_percentiles(df, ["g"], "v", {"p50": 50}).first().p50 == 3_000_000_000
