"""Differencing and boundary detection on Spark's own state store.

The state of a key is its last settled reading and the rows that may still be overtaken by earlier ones. A timer on event
time waits for the earliest of them; when the watermark passes it, rows are taken in order of time and give their results
once and for all. Rows that come after the watermark are dropped by Spark and counted in its progress reports.

All rows of a key in a micro-batch go through one task. For servers that send a large share of all rows, use the
``foreachBatch`` form in ``jobs``, which splits them by time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from fleetgauge.functions.semantics import SERVER
from fleetgauge.operators.ingest import END_OF_MONTH, PRE_RESTART, START_OF_MONTH

LOOK_BACK = "4 hours"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Columns of the rows in state. Their names have no leading underscore, which would not reach the processor.
_AT, _MARK, _TIME = "at_micros", "is_mark", "zoned_time"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside use the RocksDB provider, which the state API needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _matrix(frames: list[pd.DataFrame], names: list[str]) -> np.ndarray:
    """Rows as 64-bit integers, with a last column whose bits tell which of ``names`` are NULL."""
    parts = [np.empty((0, len(names) + 1), "int64")]
    for frame in frames:
        part = np.zeros((len(frame), len(names) + 1), "int64")
        for j, name in enumerate(names):
            null = frame[name].isna().to_numpy()
            part[:, j] = frame[name].fillna(0).astype("int64") if null.any() else frame[name].astype("int64")
            part[:, -1] |= null.astype("int64") << j
        parts.append(part)
    return np.concatenate(parts)


def _null(rows: np.ndarray, j: int) -> np.ndarray:
    return rows[:, -1] >> j & 1 == 1


def _column(values: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Integers, or objects with None where there is a NULL."""
    if not null.any():
        return values
    found = values.astype(object)
    found[null] = None
    return found


class InOrder(StatefulProcessor):
    """Keeps a key's rows until the watermark has passed them and hands them on in order.

    ``rows`` is the schema of a kept row, of integers (key columns are not kept) and ``order`` those that put rows in order, the
    time in microseconds first. ``last`` is the schema of the carried value. Subclasses say what settled rows give.
    Rows wait in blocks of many, as each item of a list state is a message of its own for Spark.
    """

    BLOCK = 10_000

    def __init__(self, key: list[str], rows: StructType, order: list[str], last: StructType, out: StructType):
        self.key, self.rows, self.order, self.last_schema, self.out = key, rows, order, last, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", StructType([StructField("block", BinaryType())]))
        self.last = handle.getValueState("last", self.last_schema)

    def close(self) -> None:
        pass

    def take(self, rows: np.ndarray, last: tuple | None) -> tuple[dict, tuple]:
        """Result columns of settled rows (a matrix in order), without the key, and the value to carry."""
        raise NotImplementedError

    def _waiting(self) -> np.ndarray:
        width = len(self.rows.names) + 1
        return np.concatenate([np.empty((0, width), "int64"), *(np.frombuffer(b, "<i8").reshape(-1, width) for (b,) in self.pending.get())])

    def _keep(self, rows: np.ndarray) -> None:
        self.pending.clear()
        blocks = [(rows[i : i + self.BLOCK].astype("<i8").tobytes(),) for i in range(0, len(rows), self.BLOCK)]
        for i in range(0, len(blocks), 50):  # a call is one message
            self.pending.appendList(blocks[i : i + 50])

    def _settle(self, key: tuple, rows: np.ndarray, watermark_ms: int) -> Iterator[pd.DataFrame]:
        places = [self.rows.names.index(c) for c in self.order]
        at = places[0]
        rows = rows[np.lexsort([k for p in reversed(places) for k in (rows[:, p], ~_null(rows, p))])]
        cut = int(np.searchsorted(rows[:, at] // 1000, watermark_ms))
        found = {}
        if cut:
            found, last = self.take(rows[:cut], self.last.get())
            self.last.update(last)
        kept = rows[cut:]
        self._keep(kept)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(kept):  # a timer fires once the watermark is past it
            self.handle.registerTimer(int(kept[0, at]) // 1000 + 1)
        if found:
            results = pd.DataFrame(dict(zip(self.key, key)) | found, columns=self.out.names)
            for i in range(0, len(results), self.BLOCK):
                yield results.iloc[i : i + self.BLOCK]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _matrix(list(rows), self.rows.names)
        yield from self._settle(key, np.concatenate([self._waiting(), new]), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, self._waiting(), timerValues.getCurrentWatermarkInMs())


class Deltas(InOrder):
    """Increase of a counter since the reading before; the carried value is one number."""

    def take(self, rows, last):
        names = self.rows.names
        value = len(names) - 1
        now, unknown = rows[:, value], _null(rows, value)
        carried = last[0] if last is not None else None
        before = np.concatenate([[0 if carried is None else carried], now[:-1]])
        none = np.concatenate([[carried is None], unknown[:-1]])  # nothing before, or a NULL
        step = np.where(now < before, now, now - before)
        if ((now >= before) & (step < 0) & ~none & ~unknown).any():
            raise OverflowError("an increase beyond 64 bits")
        step[none] = 0
        found = {c: _column(rows[:, j], _null(rows, j)) for j, c in enumerate(names)}
        return found | {"delta": _column(step, unknown & ~none)}, (None if unknown[-1] else int(now[-1]),)


class Boundaries(InOrder):
    """The reading that closes or opens a month, or precedes a restart; the carried value is the last reading."""

    def take(self, rows, last):
        names = self.rows.names
        at, is_mark = len(names) - 2, len(names) - 1
        mark = rows[:, is_mark] != 0
        marks = np.cumsum(mark)
        samples, seen = rows[~mark], marks[~mark]  # marks before each sample
        if last is not None and last[at] is not None:
            before = [0 if v is None else v for v in last[: at + 1]]
            nulls = sum(1 << j for j, v in enumerate(last[:at]) if v is None)
            samples = np.concatenate([np.array([[*before, 0, nulls]], "int64"), samples])
            seen = np.concatenate([[-1 if last[-1] else 0], seen])
        if not len(samples):
            return {}, (*[None] * at, None, 0)
        month = samples[:, at].astype("datetime64[us]").astype("datetime64[M]").astype("int64") + 1970 * 12
        restarted, turn = seen[1:] > seen[:-1], month[1:] != month[:-1]
        kinds = [
            (PRE_RESTART, ~turn & restarted, month[:-1]),
            (END_OF_MONTH, turn, month[:-1]),
            (START_OF_MONTH, turn & ~restarted, month[1:]),
        ]
        bounds = np.concatenate([samples[:-1][hit] for _, hit, _ in kinds])
        found = {_AT: bounds[:, at]}
        found["snapshot_type"] = np.concatenate([np.full(hit.sum(), kind, object) for kind, hit, _ in kinds])
        found["month"] = np.concatenate([of[hit] for _, hit, of in kinds])
        found |= {c: _column(bounds[:, j], _null(bounds, j)) for j, c in enumerate(names[:at])}
        final = samples[-1:]
        carried = [None if _null(final, j)[0] else int(final[0, j]) for j in range(at)]
        return found if len(bounds) else {}, (*carried, int(final[0, at]), int(mark.sum() > seen[-1]))


def _run(stream: DataFrame, keys: list[str], processor: InOrder, delay: str) -> DataFrame:
    timed = stream.withColumn(_TIME, F.timestamp_micros(_AT)).withWatermark(_TIME, delay)
    return timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.out, outputMode="Append", timeMode="EventTime"
    )


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp")).alias(_AT)


def counter_delta_state(
    stream: DataFrame, value: str = "raw_counter_value", keys: list[str] | None = None, order: list[str] | None = None, delay: str = LOOK_BACK
) -> DataFrame:
    """Counter increases in the order of ``order``, once they are older than ``delay``.

    Columns: keys, order and value columns and ``delta``. Order columns after the time are integers.
    """
    keys, order = keys or [SERVER], order or ["event_time_utc"]
    kept = [StructField(_AT, LongType()), *(StructField(c, LongType()) for c in [*order[1:], value])]
    names = [f.name for f in kept]
    out = StructType([*(StructField(k, StringType()) for k in keys), *kept, StructField("delta", LongType())])
    processor = Deltas(keys, StructType(kept), [_AT, *order[1:]], StructType([StructField("v", LongType())]), out)
    rows = stream.select(*keys, _micros(order[0]), *[F.col(c).cast("bigint").alias(c) for c in names[1:]])
    found = _run(rows, keys, processor, delay)
    return found.select(*keys, F.timestamp_micros(_AT).cast("timestamp_ntz").alias(order[0]), *names[1:], "delta")


def boundary_snapshot_state(
    samples: DataFrame, restarts: DataFrame, values: list[str], keys: list[str] | None = None, ts: str = "event_time_utc", delay: str = LOOK_BACK
) -> DataFrame:
    """Month and restart boundaries of each key, once the reading after them is older than ``delay``.

    ``restarts`` is a stream of restart marks of the servers and goes through the same state, so a restart that is
    registered late but within ``delay`` is seen. With more keys than the server, marks have to carry all of them.
    ``values`` are integer columns of the samples. A restart at the time of a reading comes before it.
    """
    keys = keys or [SERVER]
    payload = [StructField(c, LongType()) for c in values]
    kept = StructType([*payload, StructField(_AT, LongType()), StructField(_MARK, IntegerType())])
    last = StructType([*payload, StructField("at", LongType()), StructField("restarted", IntegerType())])
    found = [StructField(_AT, LongType()), StructField("snapshot_type", StringType()), StructField("month", IntegerType())]
    out = StructType([*(StructField(k, StringType()) for k in keys), *found, *payload])
    processor = Boundaries(keys, kept, [_AT, _MARK], last, out)
    rows = samples.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in values], _micros(ts), F.lit(0).alias(_MARK))
    # zeros that are never read; a NULL among them would make the column's integers doubles on their way to the processor
    marks = restarts.select(*keys, *[F.lit(0).cast("bigint").alias(c) for c in values], _micros("restart_ts"), F.lit(-1).alias(_MARK))
    bounds = _run(rows.unionByName(marks), keys, processor, delay)
    month = F.make_date(F.floor(F.col("month") / 12).cast("int"), F.col("month") % 12 + 1, F.lit(1))
    return bounds.select(
        *keys, F.timestamp_micros(_AT).cast("timestamp_ntz").alias("snapshot_date_utc"), "snapshot_type", month.alias("rollup_month"), *values
    )
