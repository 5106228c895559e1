"""Column helpers that pin down the arithmetic and calendar rules of the rollups.

Event times are TIMESTAMP_NTZ columns holding UTC (or, with the suffix ``_local``,
local) wall-clock time; the session time zone should be UTC.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERVER = "server_name"
MONTH = "rollup_month"
GROUP = [SERVER, MONTH]

PERCENT = "decimal(18,2)"


def scope(df: DataFrame, *others: DataFrame) -> list[str]:
    """What the facts of ``df`` belong to, and the columns others meet them by: the server, and the month if there is one.

    A table without months holds for all months of ``df``; the reverse would multiply rows and is refused.
    """
    if MONTH in df.columns:
        return [SERVER, MONTH] if all(MONTH in d.columns for d in others) else [SERVER]
    if any(MONTH in d.columns for d in others):
        raise ValueError("a table by month needs the other one by month")
    return [SERVER]


def row_total(df: DataFrame) -> Column:
    """Rows of a group. Inventories by month hold equal rows once, with their number."""
    return F.sum("row_count").cast("bigint") if "row_count" in df.columns else F.count(F.lit(1))


def month_of(ts: Column | str) -> Column:
    """First day of the month of ``ts`` (a date)."""
    return F.trunc(ts, "MM")


def hour_start(ts: Column | str) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def minute_start(ts: Column | str) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def minute_round(ts: Column | str) -> Column:
    """Nearest minute, 30 seconds going up. For de-duplication only, never for months."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return minute_start(ts + F.expr("INTERVAL 30 SECONDS"))


def days_in_month(month: Column) -> Column:
    return F.dayofmonth(F.last_day(month))


def minutes_in_month(month: Column) -> Column:
    return days_in_month(month) * 1440


def int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero; NULL when ``b`` is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def int_ratio(a: Column, b: Column) -> Column:
    """Integer division that yields 0 when ``b`` is 0."""
    return F.when(b == 0, F.lit(0)).otherwise(int_div(a, b))


def int_avg(c: Column) -> Column:
    """Average of an integer column, truncated toward zero."""
    return int_div(F.sum(c), F.count(c))


def percent(num: Column, den: Column, to: str = PERCENT) -> Column:
    """100 * num / den rounded half up; NULL when ``den`` is 0."""
    return F.try_divide(F.lit(100).cast("decimal(3,0)") * num, den).cast(to)


def percent_or_zero(num: Column, den: Column, to: str = PERCENT) -> Column:
    return F.when(den == 0, F.lit(0).cast(to)).otherwise(percent(num, den, to))


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(cond: Column, value: Column) -> Column:
    """Conditional sum, 0 (not NULL) when nothing matches."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def choose(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """First matching case wins, like a searched CASE."""
    (c0, v0), *rest = cases
    chain = reduce(lambda acc, cv: acc.when(cv[0], F.lit(cv[1])), rest, F.when(c0, F.lit(v0)))
    return chain.otherwise(F.lit(default))


def lead_by(label: Column, weight: Column, tiebreak: Column) -> Column:
    """Label with the largest weight; ties go to the smallest tiebreak. NULL weights lose."""
    return F.min_by(label, F.when(weight.isNotNull(), F.struct((-weight).alias("w"), tiebreak.alias("t"))))
