"""Order-dependent steps that do not put a whole key into one task.

A window over ``server_name`` alone would sort every sample of a very chatty server in a
single task. Both helpers cut each key into time buckets, work inside the bucket, and carry
one value per bucket to the next. The second window sees one row per (key, bucket), so its
size is bounded by the calendar and not by the number of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__bucket"


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, bucket: str = "hour"
) -> DataFrame:
    """Add ``out``: the ``value`` of the previous row by ``order`` within ``keys``.

    ``order[0]`` is the event time. ``out`` is a struct ``(v)`` so that "no previous row"
    (NULL struct) and "previous value was NULL" stay apart.
    """
    boxed = F.struct(F.col(value).alias("v"))
    bucketed = df.withColumn(_BUCKET, F.date_trunc(bucket, order[0]))
    # A plain column as the order keeps the aggregation hash-based.
    latest = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    carry = (
        bucketed.groupBy(*keys, _BUCKET)
        .agg(F.max_by(value, latest).alias("__last"))
        .select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col(_BUCKET).alias("__kb"),
            F.lag(F.struct(F.col("__last").alias("v")))
            .over(Window.partitionBy(*keys).orderBy(_BUCKET))
            .alias("__carry"),
        )
    )
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    same_bucket = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    return (
        bucketed.withColumn("__inside", F.lag(boxed).over(inside))
        .join(carry, same_bucket + [F.col(_BUCKET) == F.col("__kb")], "left")
        .withColumn(out, F.coalesce("__inside", "__carry"))
        .select(*df.columns, out)
    )


def with_latest_mark(
    times: DataFrame, marks: DataFrame, keys: list[str], ts: str, mark: str, out: str, bucket: str = "hour"
) -> DataFrame:
    """As-of lookup: add ``out``, the greatest ``mark`` at or before ``ts`` for the same keys.

    Marks and times are merged into one ordered stream, so the cost is linear in both sides
    and no pair of rows is ever formed.
    """
    both = times.select(*keys, F.col(ts).alias("__ts"), F.lit(None).cast("timestamp_ntz").alias("__mark")).unionByName(
        marks.select(*keys, F.col(mark).alias("__ts"), F.col(mark).alias("__mark"))
    ).withColumn(_BUCKET, F.date_trunc(bucket, "__ts"))
    by_bucket = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        both.groupBy(*keys, _BUCKET)
        .agg(F.max("__mark").alias("__top"))
        .select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col(_BUCKET).alias("__kb"),
            F.max("__top").over(by_bucket).alias("__carry"),
        )
    )
    inside = (
        Window.partitionBy(*keys, _BUCKET)
        .orderBy("__ts")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same_bucket = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    return (
        both.withColumn("__seen", F.max("__mark").over(inside))
        .filter(F.col("__mark").isNull())
        .join(carry, same_bucket + [F.col(_BUCKET) == F.col("__kb")], "left")
        .select(*keys, F.col("__ts").alias(ts), F.coalesce("__seen", "__carry").alias(out))
    )


def with_previous_month(
    rollup: DataFrame,
    month: str,
    keys: list[str],
    values: dict[str, Column],
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Add one column per entry of ``values``: that expression on the previous calendar month.

    A month without a row leaves the next one with NULL. The window's frame is the previous
    month, whatever rows lie between: where a key has several rows in a month (a database that
    was renamed in it), each of them gets the sum over all rows of the month before. ``values``
    are numeric. ``earlier`` are stored rollup rows of other months, predecessors only.
    """
    rows = rollup.withColumn("__new", F.lit(True))
    if earlier is not None:
        shared = [c for c in earlier.columns if c in rollup.columns]
        stored = earlier.select(*shared).withColumn("__new", F.lit(False))
        rows = rows.unionByName(stored, allowMissingColumns=True)
    number = F.year(month) * 12 + F.month(month)
    w = Window.partitionBy(*keys).orderBy(number).rangeBetween(-1, -1)
    kinds = {f.name: f.dataType for f in rollup.select(*[c.alias(n) for n, c in values.items()]).schema}
    return (
        rows.withColumns({f"__prev_{n}": F.sum(c).over(w).cast(kinds[n]) for n, c in values.items()})
        .filter("__new")
        .select(*rollup.columns, *[F.col(f"__prev_{n}").alias(n) for n in values])
    )
