"""What several operators share: tables, words, cut lineage, running totals over split groups."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.sources.session import checkpoint_root

#: Odd multipliers of the 64-bit mixing step (fixed values of the splitmix64 generator).
GOLDEN, MIX_1, MIX_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: A side of a join is broadcast only if it has at most so many (narrow) rows.
BROADCAST_ROWS = 5_000
#: Rows that share one sorted window when a group is split.
CHUNK_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and reads it back; what follows no longer depends on its plan.

    ``free`` deletes the shuffle files of the write at its end, which Spark else keeps until the driver collects garbage:
    for loops whose rounds each shuffle anew.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true" if free else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Deletes what ``materialize`` wrote for these tables. Nothing may read them any more, a lazy plan included."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """CRC-32 of the id's decimal text modulo ``folds``."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case. ``bytes`` split at exactly the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_1
        x = (x ^ (x >> np.uint64(27))) * MIX_2
        return x ^ (x >> np.uint64(31))


class Memo(dict):
    """Remembers a function of a word; starts anew when full, so that memory stays bounded."""

    def __init__(self, function, most: int = 400_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


def row_tag(df: DataFrame) -> Column:
    """Tells rows of one id apart: a hash of all plain columns. Equal rows have the same tag."""
    kinds = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in kinds])


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small; otherwise Spark shuffles it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def seeded_order(seed: int | str, *columns: Column | str) -> Column:
    """A repeatable pseudo-random order: the MD5 text of the seed and the columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns]))


def running_total(df: DataFrame, group: list[str], order: str, tie: str, value: str, out: str, rows: int) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the group's rows before this one, by (``order``, ``tie``).

    ``order`` is an MD5 text, so equal ranges of its first 32 bits hold about equally many rows: a group is split into
    such ranges, range sums come before their running total, and only one range at a time is sorted. A group that holds
    most rows is thus many tasks. ``rows``: about how many rows there are.
    """
    chunks = max(1, rows // CHUNK_ROWS)
    df = df.withColumn("__chunk", F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * chunks / F.lit(2**32)).cast("long"))
    sums = df.groupBy(*group, "__chunk").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "__chunk", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    keys = [*group, "__chunk"]
    marked = df.alias("d").join(
        offsets.alias("o"), [F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    ).select("d.*", "o.__offset")
    within = Window.partitionBy(*keys).orderBy(order, tie).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("__offset") + F.coalesce(F.sum(value).over(within), F.lit(0))
    return marked.withColumn(out, total.cast("long")).drop("__chunk", "__offset")
