"""Arithmetic and calendar rules."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from fleetgauge.functions import semantics as s


def one(df, *cols):
    return tuple(df.select(*cols).first())


def test_minute_rounds_to_nearest(frame):
    df = frame(
        "t_utc:string",
        ("2024-01-31 00:00:29.998",),
        ("2024-01-31 00:00:30",),
        ("2024-01-31 00:00:59",),
        ("2024-01-31 23:59:30",),
    )
    got = [tuple(r) for r in df.select(s.minute_round("t_utc"), s.month_of("t_utc")).collect()]
    assert got == [
        (datetime(2024, 1, 31, 0, 0), date(2024, 1, 1)),
        (datetime(2024, 1, 31, 0, 1), date(2024, 1, 1)),
        (datetime(2024, 1, 31, 0, 1), date(2024, 1, 1)),
        (datetime(2024, 2, 1, 0, 0), date(2024, 1, 1)),
    ]


def test_integer_average_truncates_toward_zero(frame):
    df = frame("a:int", (85,), (86,), (None,))
    assert one(df, s.int_avg(F.col("a"))) == (85,)
    assert one(df.select((-F.col("a")).alias("a")), s.int_avg(F.col("a"))) == (-85,)
    assert one(df.filter("a IS NULL"), s.int_avg(F.col("a"))) == (None,)


def test_division_guards(frame):
    df = frame("a:bigint b:bigint", (7, 0))
    a, b = F.col("a"), F.col("b")
    assert one(df, s.int_div(a, b), s.int_ratio(a, b), s.percent(a, b), s.percent_or_zero(a, b)) == (
        None, 0, None, Decimal("0.00"),
    )


def test_percent_rounds_half_up(frame):
    df = frame("a:bigint b:bigint", (1, 160), (-1, 160), (2, 3))
    got = [r[0] for r in df.select(s.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.63"), Decimal("-0.63"), Decimal("66.67")]


def test_lead_by_breaks_ties_and_skips_null(frame):
    df = frame("k:string w:int", ("b", 5), ("a", 5), ("z", None), ("c", 1))
    k = F.col("k")
    assert one(df, s.lead_by(k, F.col("w"), k)) == ("a",)


def test_calendar(frame):
    df = frame("m:string", ("2024-02-01",)).select(F.col("m").cast("date").alias("m"))
    assert one(df, s.days_in_month(F.col("m")), s.minutes_in_month(F.col("m"))) == (29, 41760)
