"""Small pieces of checking SQL shared by the query modules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

GENERATED_UTC = datetime(2024, 2, 1, 0, 5)
GENERATED_LOCAL = datetime(2024, 1, 31, 19, 5)
AS_OF = datetime(2001, 8, 1)

G = "server_name, rollup_month"
STAMPS = (
    f"TIMESTAMP '{GENERATED_UTC}' AS generated_utc, TIMESTAMP '{GENERATED_LOCAL}' AS generated_local"
)


def stamp(value: datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def stamps() -> dict[str, Column]:
    return {"generated_utc": stamp(GENERATED_UTC), "generated_local": stamp(GENERATED_LOCAL)}


def pct(num: str, den: str, to: str = "decimal(18,2)") -> str:
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE cast(round(100.0 * ({num}) / ({den}), 2) AS {to}) END"


def pct0(num: str, den: str, to: str = "decimal(18,2)") -> str:
    return f"CASE WHEN ({den}) = 0 THEN cast(0 AS {to}) ELSE cast(round(100.0 * ({num}) / ({den}), 2) AS {to}) END"


def month(ts: str) -> str:
    return f"cast(date_trunc('month', {ts}) AS date)"


def days(month_column: str) -> str:
    return f"day(last_day({month_column}))"
