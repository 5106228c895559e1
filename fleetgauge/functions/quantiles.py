"""Exact interpolated percentiles of integer columns whose value range is wide.

Spark's own ``percentile`` merges every distinct value of a group into one buffer. That is
the right tool for a load between 0 and 100, but not for page life in seconds. Here values
are counted first (map-side combined), the counts are summed into buckets of 65,536
neighbouring values to find the bucket that holds each wanted rank, and only those buckets
are looked at value by value. For 32-bit values no task sees more than 65,536 rows of one
group at either level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import int_div

_WIDTH = 1 << 16


def wide_percentiles(df: DataFrame, keys: list[str], value: str, percents: dict[str, int]) -> DataFrame:
    """One row per ``keys``; each entry of ``percents`` (name -> whole percent) is an integer,
    the interpolated percentile truncated toward zero. NULL values are ignored."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__b", F.floor(F.col("__v") / F.lit(_WIDTH)))
    )
    upto = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("p")) for n, p in percents.items()]))
    scaled = F.col("__want.p") * (F.col("__total") - 1)
    lo = int_div(scaled, F.lit(100))
    holders = (
        counts.groupBy(*keys, "__b")
        .agg(F.sum("__n").alias("__bn"))
        .withColumn("__end", F.sum("__bn").over(upto))
        .withColumn("__total", F.sum("__bn").over(whole))
        .withColumn("__want", wanted)
        .withColumn("__lo", lo)
        .withColumn("__frac", F.pmod(scaled, F.lit(100)))
        .withColumn("__hi", F.col("__lo") + F.when(F.col("__frac") > 0, 1).otherwise(0))
        .withColumn("__start", F.col("__end") - F.col("__bn"))
        .filter((F.col("__start") <= F.col("__hi")) & (F.col("__lo") < F.col("__end")))
        .select(*keys, "__b", "__start", "__lo", "__hi", "__frac", F.col("__want.name").alias("__name"))
    )
    ranked = (
        counts.join(holders, [*keys, "__b"])
        .withColumn(
            "__last",
            F.col("__start")
            + F.sum("__n").over(
                Window.partitionBy(*keys, "__b", "__name")
                .orderBy("__v")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .withColumn("__first", F.col("__last") - F.col("__n"))
    )

    def at(rank: str):
        return F.max(F.when((F.col("__first") <= F.col(rank)) & (F.col(rank) < F.col("__last")), F.col("__v")))

    per_name = ranked.groupBy(*keys, "__name", "__frac").agg(at("__lo").alias("__vlo"), at("__hi").alias("__vhi"))
    interpolated = int_div(
        F.col("__vlo") * 100 + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac"), F.lit(100)
    ).cast("bigint")
    return per_name.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__name") == n, interpolated)).alias(n) for n in percents]
    )
