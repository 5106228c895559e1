"""CPU, memory, wait, blocking and deadlock rollups on hand-made rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal as D

from pyspark.sql import functions as F

from fleetgauge.operators import blocking, cpu, deadlocks, memory, waits

JAN, FEB, MAR, APR = (date(2024, m, 1) for m in (1, 2, 3, 4))


def stamps():
    t = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return {"generated_utc": t, "generated_local": t}


CPU = "server_name:string event_time_utc:string sql_service:int idle_process:int non_sql_process:int"


def load(frame, *rows):
    return frame(CPU, *[("a", t, 10, 100 - total, total - 10) for t, total in rows])


def test_hourly_average_is_whole_number(frame):
    df = load(frame, ("2024-01-01 05:00:00", 85), ("2024-01-01 05:30:00", 86))
    r = cpu.saturation_hours(df).first()
    assert (r.saturation_hours, r.worst_hour_start) == (0, None)
    assert cpu.saturation_hours(df, 84).first().saturation_hours == 1


def test_saturation_tie_goes_to_the_earlier_hour(frame):
    df = load(frame, ("2024-01-02 07:10:00", 90), ("2024-01-01 05:10:00", 90), ("2024-01-01 06:10:00", 20))
    r = cpu.saturation_hours(df).first()
    assert (r.saturation_hours, r.worst_hour_start) == (2, datetime(2024, 1, 1, 5))


def test_zero_load_has_zero_shares(frame):
    df = frame(CPU, ("a", "2024-01-01 00:00:00", 0, 100, 0))
    r = cpu.cpu_share(df).first()
    assert (r.service_percent_of_total, r.non_service_percent_of_total) == (0, 0)
    assert cpu.load_above_median(df).first().load_above_median_total is None
    assert cpu.cpu_share(df.limit(0)).count() == 0


def test_full_cpu_row_equals_the_single_metrics(frame):
    df = load(frame, *[(f"2024-01-{d:02d} {h:02d}:00:00", 10 + (d * h) % 90) for d in range(1, 29) for h in range(24)])
    row = cpu.cpu_monthly(df, **stamps()).first().asDict()
    single = {}
    for op in (
        cpu.completeness, cpu.cpu_load, cpu.cpu_medians, cpu.load_above_median, cpu.cpu_p90,
        cpu.pct_at_or_above_p90, cpu.saturation_hours, cpu.cpu_share,
    ):
        single |= op(df).first().asDict()
    assert {k: row[k] for k in single} == single


MEM = "server_name:string event_time_utc:string counter_name:string counter_value:bigint"


def counters(frame, **series):
    names = {c: n for n, c in memory.COUNTER_COLUMNS.items()}
    rows = [
        ("a", str(datetime(2024, 1, 1) + timedelta(minutes=5 * i)), names[c], v)
        for c, values in series.items()
        for i, v in enumerate(values)
    ]
    return frame(MEM, *rows)


def test_page_life_bands_and_compat(frame):
    pivoted = memory.pivot_counters(counters(frame, ple=[300, 301, 600, 601]))
    r = memory.page_life_stats(pivoted).first()
    assert (r.pct_ple_below_300, r.pct_ple_below_600, r.median_ple, r.ple_5th_percentile) == (D(25), D(75), 450, 300)
    r = memory.page_life_stats(pivoted, compat=True).first()
    assert (r.pct_ple_below_300, r.pct_ple_below_600, r.ple_5th_percentile) == (D(2500), D(7500), 600)


def test_steady_ratio_guards(frame):
    df = counters(frame, target_server_memory_kb=[0, 100, 100, 100], total_server_memory_kb=[50, 80, 100, 90])
    pivoted = memory.pivot_counters(df)
    r = memory.steady_stats(pivoted).first()
    assert (r.avg_steady_state_ratio, r.min_steady_state_ratio, r.pct_below_90pct_steady) == (D("0.9"), D("0.8"), D(25))
    assert memory.steady_stats(pivoted, compat=True).first().pct_below_90pct_steady is None


def test_memory_row_fills_steady_and_grants_with_zero(frame):
    r = memory.memory_monthly(counters(frame, bchr=[94, 96]), **stamps()).first()
    assert (r.avg_steady_state_ratio, r.pct_with_grants_pending, r.max_grants_pending, r.median_ple) == (0, 0, None, None)
    assert (r.avg_bchr, r.min_bchr, r.pct_bchr_below_95) == (D(95), 94, D(50))
    assert (r.expected_points, r.collected_points) == (8928, 2)


WAIT = (
    "server_name:string rollup_month:string snapshot_date_local:string snapshot_type:string wait_type:string "
    "category:string total_server_time_seconds:double wait_seconds:decimal(14,2) resource_seconds:decimal(14,2) "
    "signal_seconds:decimal(14,2)"
)


def boundaries(frame, *rows):
    filled = []
    for month, at, kind, wait_type, category, seconds in rows:
        filled.append(("a", month, at, kind, wait_type, category, 100.0, D(seconds), D(seconds), D(0)))
    return frame(WAIT, *filled)


def test_opening_rows_are_subtracted_whatever_their_sign(frame):
    df = boundaries(
        frame,
        ("2024-01-01", "2024-01-01 00:00:00", "StartOfMonth", "X", "CPU", 30),
        ("2024-01-01", "2024-01-15 00:00:00", "PreRestart", "X", "CPU", 50),
        ("2024-01-01", "2024-01-31 00:00:00", "EndOfMonth", "X", "CPU", 5),
    )
    assert waits.net_by_type(df).first().wait_seconds == 25
    again = waits.signed_boundaries(waits.signed_boundaries(df, ["wait_seconds"]), ["wait_seconds"])
    assert sorted(r.wait_seconds for r in again.collect()) == [-30, 5, 50]


def test_top_types_tie_by_name_and_leave_gaps(frame):
    df = boundaries(
        frame,
        ("2024-01-01", "2024-01-31 00:00:00", "EndOfMonth", "B", "CPU", 10),
        ("2024-01-01", "2024-01-31 00:00:00", "EndOfMonth", "A", "Latches", 10),
    )
    r = waits.top_k_wide(df).first()
    assert (r.top_wait_type_1, r.top_wait_type_2, r.top_wait_type_3) == ("A", "B", None)
    assert (r.top_wait_type_1_pct, r.top_wait_type_3_seconds, r.top_wait_type_3_pct) == (D(50), None, None)
    c = waits.category_pivot(df).first()
    assert (c.total_wait_seconds, c.cpu_wait_pct, c.other_wait_pct) == (20, D(50), 0)


def test_peak_hour_and_top_blocking_type(frame):
    df = boundaries(
        frame,
        ("2024-01-01", "2024-01-31 09:30:00", "EndOfMonth", "LCK_M_S", "Blocking", 5),
        ("2024-01-01", "2024-01-31 10:30:00", "PreRestart", "LCK_M_X", "Blocking", 4),
        ("2024-01-01", "2024-01-30 10:10:00", "PreRestart", "LCK_M_S", "Blocking", 3),
        ("2024-01-01", "2024-01-30 11:10:00", "PreRestart", "OLEDB", "Other", 90),
        ("2024-02-01", "2024-02-28 11:10:00", "EndOfMonth", "OLEDB", "Other", 90),
    )
    assert waits.peak_hour(df).first().peak_blocking_hour_local == 10
    rows = {r.rollup_month: r for r in waits.wait_monthly(df, F.lit("2024-06-01").cast("timestamp_ntz")).collect()}
    assert (rows[JAN].peak_blocking_hour_local, rows[JAN].top_blocking_wait_type) == (10, "LCK_M_S")
    assert (rows[FEB].peak_blocking_hour_local, rows[FEB].top_blocking_wait_type) == (None, None)


def test_change_needs_the_month_before_and_never_overflows(frame):
    df = frame(
        "server_name:string rollup_month:string total_wait_seconds:decimal(18,2)",
        ("a", "2024-01-01", D("0.01")), ("a", "2024-02-01", D(5000)), ("a", "2024-04-01", D(1)),
        ("b", "2024-01-01", D(0)), ("b", "2024-02-01", D(9)),
    )
    got = {(r.server_name, r.rollup_month): r.change for r in waits.mom_pct(df, {"total_wait_seconds": "change"}).collect()}
    assert got == {
        ("a", JAN): None, ("a", FEB): D("49999900.00"), ("a", APR): None, ("b", JAN): None, ("b", FEB): None,
    }


def test_no_waits_give_zero_percents_and_null_ratio(frame):
    df = boundaries(frame, ("2024-01-01", "2024-01-31 00:00:00", "EndOfMonth", "X", "CPU", 0))
    r = waits.wait_monthly(df, F.lit("2024-06-01").cast("timestamp_ntz")).first()
    assert (r.cpu_wait_pct, r.top_wait_type_1_pct, r.signal_to_resource_ratio) == (0, 0, None)


LOCK = (
    "server_name:string rollup_month:string snapshot_type:string database_id:int database_name:string "
    "row_lock_wait_ms:bigint page_lock_wait_ms:bigint total_processor_time_seconds:bigint"
)


def test_blocking_rows(frame):
    df = frame(
        LOCK,
        ("a", "2024-01-01", "EndOfMonth", 5, "x", 3000, 3000, 100),
        ("a", "2024-01-01", "EndOfMonth", 6, "y", 1000, 5000, 300),
        ("a", "2024-01-01", "EndOfMonth", 7, "z", 0, 0, 0),
        ("a", "2024-01-01", "EndOfMonth", 2, "tempdb", 9000, 0, 900),
        ("a", "2024-02-01", "EndOfMonth", 5, "x", 6004, 3000, 100),
    )
    at = F.lit("2024-06-01").cast("timestamp_ntz")
    rows = {(r.rollup_month, r.database_name): r for r in blocking.blocking_monthly(df, at).collect()}
    x, y, z = (rows[JAN, n] for n in "xyz")
    assert len(rows) == 4
    assert (x.rank_within_instance, y.rank_within_instance, z.rank_within_instance) == (1, 2, 3)
    assert (x.top_blocking_type, x.top_blocking_type_pct) == ("ROW", D(50))
    assert (y.top_blocking_type, y.top_blocking_type_pct) == ("PAGE", D("83.33"))
    assert (z.top_blocking_type, z.top_blocking_type_pct, z.pct_of_instance_blocking) == (None, None, 0)
    assert (x.pct_of_instance_blocking, x.pct_of_total_processor_time) == (D(50), D(25))
    feb = rows[FEB, "x"]
    assert (feb.mom_row_lock_change_pct, feb.mom_page_lock_change_pct) == (D("100.13"), 0)
    compat = {r.database_name: r for r in blocking.blocking_monthly(df, at, compat=True).filter("rollup_month = '2024-01-01'").collect()}
    assert compat["x"].pct_of_total_processor_time == 0


def test_equal_changes_on_a_half_round_alike(frame):
    """-28.125 % in all three: half up, whatever a division of doubles would make of it."""
    df = frame(
        LOCK,
        ("a", "2024-01-01", "EndOfMonth", 5, "x", 57600, 35200, 100),
        ("a", "2024-02-01", "EndOfMonth", 5, "x", 41400, 25300, 100),
    )
    row = blocking.blocking_mom(blocking.blocking_net(df)).filter("rollup_month = '2024-02-01'").first()
    assert {row.mom_blocking_change_pct, row.mom_row_lock_change_pct, row.mom_page_lock_change_pct} == {D("-28.13")}


def events(frame, *rows):
    return frame("server_name:string event_time_local:string delta:bigint", *[("a", t, n) for t, n in rows])


def test_zero_days_count_missing_days(frame):
    df = events(
        frame,
        *[(f"2024-04-{d:02d} 08:00:00", 0) for d in range(1, 9)],
        ("2024-04-20 08:00:00", 2), ("2024-04-21 09:00:00", 1),
    )
    r = deadlocks.deadlock_monthly(df, **stamps()).first()
    assert (r.total_events, r.zero_event_days, r.busiest_day, r.busiest_day_count) == (3, 28, date(2024, 4, 20), 2)
    assert (r.avg_per_day, r.avg_per_week, r.month_over_month_delta) == (D("0.10"), D("0.70"), 3)


def test_quiet_month_names_its_first_day(frame):
    df = events(frame, ("2024-04-05 08:00:00", 0), ("2024-04-03 10:00:00", 0))
    r = deadlocks.deadlock_monthly(df, **stamps()).first()
    assert (r.busiest_day, r.busiest_day_count, r.peak_hour_label, r.zero_event_days) == (date(2024, 4, 3), 0, "8 AM", 30)


def test_peak_hour_labels_and_ties(frame):
    for hour, label in ((0, "12 AM"), (7, "7 AM"), (12, "12 PM"), (19, "7 PM"), (11, "11 AM"), (13, "1 PM")):
        df = events(frame, (f"2024-04-05 {hour:02d}:00:00", 5), ("2024-04-05 23:00:00", 5))
        r = deadlocks.peak_hour_label(df).first()
        assert (r.peak_hour_local, r.peak_hour_label, r.peak_hour_count) == (hour, label, 5)


def test_missing_month_counts_as_zero(frame):
    df = frame(
        "server_name:string rollup_month:string total_events:bigint",
        ("a", "2024-01-01", 5), ("a", "2024-02-01", 7), ("a", "2024-04-01", 4),
    )
    got = {r.rollup_month: r.month_over_month_delta for r in deadlocks.mom_delta(df).collect()}
    assert got == {JAN: 5, FEB: 2, APR: 4}
