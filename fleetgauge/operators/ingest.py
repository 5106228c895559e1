"""Ingest jobs: landed raw records to sample history, and history to month boundaries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.ordered import with_latest_mark, with_previous
from fleetgauge.functions.semantics import PERCENT, SERVER, choose, int_div, int_ratio, minute_round, month_of

# The record type that carries scheduler load.
SCHEDULER_MONITOR = "RING_BUFFER_SCHEDULER_MONITOR"

# The part of a scheduler record that is read.
RECORD_SCHEMA = (
    "SchedulerMonitorEvent struct<SystemHealth: struct<ProcessUtilization: array<string>, SystemIdle: array<string>>>"
)

# Counters kept per object class.
BUFFER_MANAGER_COUNTERS = ["Page life expectancy"]
MEMORY_MANAGER_COUNTERS = [
    "Memory Grants Pending",
    "Memory Grants Outstanding",
    "Target Server Memory (KB)",
    "Total Server Memory (KB)",
    "Free Memory (KB)",
    "Stolen Server Memory (KB)",
]
COUNTER_SPEC = {"Buffer Manager": BUFFER_MANAGER_COUNTERS, "Memory Manager": MEMORY_MANAGER_COUNTERS}

# Drive type names by code.
DRIVE_TYPES = {
    0: "Unknown",
    1: "No Root Directory",
    2: "Removable Disk",
    3: "Local Disk",
    4: "Network Drive",
    5: "CD-ROM",
    6: "RAM Disk",
}

# Wait categories, tried in this order.
WAIT_CATEGORIES: list[tuple[str, dict[str, list[str]]]] = [
    ("AGSync", {"names": ["HADR_SYNC_COMMIT", "HADR_LOGCAPTURE_SYNC", "HADR_REPLICA_SYNC_STATUS"]}),
    (
        "AGSecondary",
        {"names": ["PARALLEL_REDO_WORKER_WAIT_FOR_WORK", "REDO_THREAD_PENDING_WORK", "PARALLEL_REDO_DRAIN_WORKER"]},
    ),
    ("CPU", {"names": ["SOS_SCHEDULER_YIELD", "THREADPOOL"]}),
    ("Parallelism", {"names": ["CXPACKET"]}),
    ("Memory", {"names": ["RESOURCE_SEMAPHORE", "CMEMTHREAD", "RESOURCE_SEMAPHORE_QUERY_COMPILE"]}),
    ("Disk", {"like": ["PAGEIOLATCH%"], "names": ["WRITELOG", "IO_COMPLETION"]}),
    ("Blocking", {"like": ["LCK_M_%"]}),
    ("Latches", {"names": ["LATCH_EX", "LATCH_SH"]}),
    ("DataOutput", {"names": ["ASYNC_NETWORK_IO"]}),
]

# Benign wait types that are never recorded.
BENIGN_WAITS = [
    "SLEEP_TASK", "SLEEP_SYSTEMTASK", "LAZYWRITER_SLEEP", "SQLTRACE_BUFFER_FLUSH",
    "XE_DISPATCHER_WAIT", "XE_TIMER_EVENT", "BROKER_TO_FLUSH", "BROKER_TASK_STOP",
    "BROKER_EVENTHANDLER", "FT_IFTS_SCHEDULER_IDLE_WAIT", "CHECKPOINT_QUEUE",
    "LOGMGR_QUEUE", "REQUEST_FOR_DEADLOCK_SEARCH", "WAITFOR", "WAITFOR_TASKSHUTDOWN",
    "HADR_FILESTREAM_IOMGR_IOCOMPLETION", "HADR_TIMER_TASK", "HADR_WORK_QUEUE",
    "DIRTY_PAGE_POLL", "SOS_WORK_DISPATCHER", "CXCONSUMER", "BROKER_RECEIVE_WAITFOR",
    "BROKER_TRANSMITTER", "DISPATCHER_QUEUE_SEMAPHORE", "FT_IFTSHC_MUTEX",
    "XE_DISPATCHER_JOIN", "LATCH_SH", "LATCH_UP", "LATCH_NL", "REPL_SCHEMA_ACCESS",
    "REPL_HISTORYCACHE_ACCESS", "REPL_CACHE_ACCESS", "REPL_TRANSPORT", "CLR_AUTO_EVENT",
    "CLR_MANUAL_EVENT", "CLR_SEMAPHORE", "LOGMGR_RESERVE_APPEND", "LOGMGR_FLUSH",
    "TRACEWRITE", "WAIT_XTP_HOST_WAIT", "WAIT_XTP_OFFLINE_CKPT_NEW_LOG",
    "WAIT_XTP_CKPT_CLOSE",
]

END_OF_MONTH = "EndOfMonth"
START_OF_MONTH = "StartOfMonth"
PRE_RESTART = "PreRestart"


def _shifted(clock: str) -> Column:
    """The time of a record: ``clock``, which is the time of sampling, less the record's age in ticks."""
    age_ms = F.col("now_tick_ms") - F.col("tick_ms")
    return F.timestamp_add("MILLISECOND", -age_ms, F.col(clock)).cast("timestamp_ntz")


def ingest_scheduler_records(raw: DataFrame, new_since: DataFrame | None = None) -> DataFrame:
    """Scheduler XML records to CPU samples; a missing XML node gives NULL, not 0.

    Each record is parsed once; the first node of a name counts. A record's age is the
    distance of its tick from the tick at sampling time. Local time is produced when the raw
    rows carry ``sampled_at_local``. With a history in ``new_since``, records of minutes that it has are left out by
    their ticks before the others are parsed.
    """

    def node(name: str) -> Column:
        return F.get(F.col(f"__xml.SchedulerMonitorEvent.SystemHealth.{name}"), F.lit(0)).try_cast("int")

    clocks = {"sampled_at_utc": "event_time_utc", "sampled_at_local": "event_time_local"}
    if new_since is not None:
        raw = append_new_minutes(raw.withColumn("event_time_utc", _shifted("sampled_at_utc")), new_since)
    return (
        raw.filter(F.col("ring_buffer_type") == SCHEDULER_MONITOR)
        .withColumn("__xml", F.from_xml("record", F.lit(RECORD_SCHEMA), {"rowTag": "Record"}))
        .select(
            SERVER,
            *[_shifted(c).alias(out) for c, out in clocks.items() if c in raw.columns],
            node("ProcessUtilization").alias("sql_service"),
            node("SystemIdle").alias("idle_process"),
        )
        .withColumn("non_sql_process", F.lit(100) - F.col("idle_process") - F.col("sql_service"))
    )


#: Why a scheduler record is put aside.
NO_RECORD, NOT_XML, NOT_A_NUMBER = DAMAGE = ["no record", "not well-formed", "not a number"]


def judge_scheduler_records(raw: DataFrame) -> DataFrame:
    """Scheduler records as ``ingest_scheduler_records`` gives them, with ``damage`` and, where there is any, the ``record``.

    ``damage`` is NULL for good records, a missing node included. A record is damaged if there is none, if it is not
    well-formed XML, or if the text of a load is no whole number; its loads are NULL. Each record is parsed once.
    """
    schema = RECORD_SCHEMA + ", __broken string"
    node = lambda name: F.get(F.col(f"__xml.SchedulerMonitorEvent.SystemHealth.{name}"), F.lit(0))
    clocks = {"sampled_at_utc": "event_time_utc", "sampled_at_local": "event_time_local"}
    parsed = raw.filter(F.col("ring_buffer_type") == SCHEDULER_MONITOR).withColumn(
        "__xml", F.from_xml("record", F.lit(schema), {"rowTag": "Record", "columnNameOfCorruptRecord": "__broken"})
    )
    loads = {"sql_service": node("ProcessUtilization"), "idle_process": node("SystemIdle")}
    unreadable = [text.isNotNull() & text.try_cast("int").isNull() for text in loads.values()]
    damage = choose(
        [
            (F.coalesce(F.trim("record"), F.lit("")) == "", NO_RECORD),
            (F.col("__xml.__broken").isNotNull() | F.col("__xml").isNull(), NOT_XML),
            (unreadable[0] | unreadable[1], NOT_A_NUMBER),
        ]
    )
    judged = parsed.withColumn("damage", damage)
    good = F.col("damage").isNull()
    return judged.select(
        SERVER,
        *[_shifted(c).alias(out) for c, out in clocks.items() if c in raw.columns],
        *[F.when(good, text.try_cast("int")).alias(name) for name, text in loads.items()],
        "damage",
        F.when(~good, F.col("record")).alias("record"),
    ).withColumn("non_sql_process", F.lit(100) - F.col("idle_process") - F.col("sql_service"))


def append_new_minutes(
    batch: DataFrame,
    history: DataFrame | None,
    keys: list[str] | None = None,
    ts: str = "event_time_utc",
    strict: bool = False,
) -> DataFrame:
    """Batch rows whose (server, rounded minute) is not in the history (if any) yet.

    The join key is the minute, so a chatty server spreads over its minutes; the history side
    is reduced to distinct minutes before the shuffle. Duplicates inside the batch stay, as
    polling keeps them; ``strict`` keeps the earliest row of each key and minute instead (a
    map-side combined minimum). A long table, with a row per counter, must name its counter
    columns in ``keys``; without them ``strict`` would keep one counter of a minute.
    """
    keys = keys or [SERVER]
    if strict and "counter_name" in batch.columns and "counter_name" not in keys:
        raise ValueError("strict removal in a table of counters needs the counter columns in keys")
    fresh = batch.withColumn("__minute", minute_round(ts))
    if strict:
        rest = [c for c in batch.columns if c != ts and c not in keys]
        fresh = (
            fresh.groupBy(*keys, "__minute")
            .agg(F.min(F.struct(ts, *rest)).alias("__row"))
            .select(*keys, "__minute", "__row.*")
        )
    if history is not None:
        seen = history.select(*keys, minute_round(ts).alias("__minute")).distinct()
        fresh = fresh.join(seen, [*keys, "__minute"], "left_anti")
    return fresh.select(*batch.columns)


def _as_counter_samples(raw: DataFrame) -> DataFrame:
    """Raw counter rows in the layout of the long counter table."""
    local = [F.col("sample_time_local").alias("event_time_local")] if "sample_time_local" in raw.columns else []
    return raw.select(
        SERVER,
        F.col("sample_time_utc").alias("event_time_utc"),
        *local,
        "object_name",
        F.rtrim("counter_name").alias("counter_name"),
        "instance_name",
        F.col("cntr_value").alias("counter_value"),
        F.col("cntr_type").alias("counter_type"),
    )


def ratio_counter(raw: DataFrame, numerator: str, base: str, object_like: str = "%Buffer Manager%") -> DataFrame:
    """Counter over its base counter in the same object and sample, x 100, truncated.

    Both sides meet on (server, sample time, object). A base of 0 gives NULL. Names may be
    padded with blanks; the prefix test is there because the scan can apply it.
    """
    scoped = raw.filter(F.col("object_name").like(object_like))
    key = [SERVER, "sample_time_utc", "object_name"]

    def named(counter: str) -> Column:
        return F.col("counter_name").startswith(counter) & (F.rtrim("counter_name") == counter)

    bases = scoped.filter(named(base)).select(*key, F.col("cntr_value").alias("__base"))
    ratio = int_div(F.col("cntr_value") * 100, F.col("__base"))
    joined = scoped.filter(named(numerator)).join(bases, key)
    return _as_counter_samples(joined.withColumn("cntr_value", ratio))


def select_counters(raw: DataFrame, spec: dict[str, list[str]] | None = None) -> DataFrame:
    """Keep the listed counters of each object class: one filter over one scan."""
    spec = COUNTER_SPEC if spec is None else spec
    wanted = F.lit(False)
    for object_class, names in spec.items():
        wanted = wanted | (F.col("object_name").contains(object_class) & F.rtrim("counter_name").isin(names))
    return _as_counter_samples(raw.filter(wanted))


def memory_counter_samples(raw: DataFrame) -> DataFrame:
    """All eight memory counters of a collection run in long form."""
    hits = ratio_counter(raw, "Buffer cache hit ratio", "Buffer cache hit ratio base")
    return hits.unionByName(select_counters(raw))


def file_latency(io_stats: DataFrame, files: DataFrame) -> DataFrame:
    """Cumulative file statistics joined to the file inventory, as integer latencies."""
    reads, writes = F.col("num_of_reads"), F.col("num_of_writes")
    moved = F.col("num_of_bytes_read") + F.col("num_of_bytes_written")
    key = [SERVER, "database_id", "file_id"]
    return io_stats.join(files.select(*key, "database_name", "physical_name"), key).select(
        *[c for c in io_stats.columns if c.startswith("event_time")],
        SERVER,
        "database_name",
        "physical_name",
        F.substring("physical_name", 1, 2).alias("drive"),
        int_ratio(F.col("io_stall_read_ms"), reads).alias("read_latency"),
        int_ratio(F.col("io_stall_write_ms"), writes).alias("write_latency"),
        int_ratio(F.col("io_stall"), reads + writes).alias("avg_latency"),
        F.floor(int_ratio(moved, reads + writes) / 1024).alias("avg_kb_per_transfer"),
    )


def normalize_volumes(raw: DataFrame) -> DataFrame:
    """Raw volume rows to volume samples: real, lettered or mounted volumes, sizes in KB.

    Halves round to even, as in the collector's language. A share that its type cannot hold (free space far above the
    capacity) is NULL and stops nothing.
    """
    lettered = F.coalesce(F.col("drive_letter"), F.lit("")) != ""
    kept = raw.filter(
        F.col("drive_type").between(2, 6)
        & F.col("file_system").isNotNull()
        & (F.lower(F.coalesce(F.col("label"), F.lit(""))) != "recovery")
        & (lettered | F.col("name").rlike(r"^.:\\"))
    )

    def kilobytes(c: str) -> Column:
        return F.bround(F.col(c).cast("decimal(20,0)") / 1024, 0).cast("bigint")

    free_pct = F.when(F.col("size_kb") == 0, F.lit(0)).otherwise(
        F.bround(F.try_divide(F.col("free_kb").cast("decimal(20,0)") * 100, F.col("size_kb")), 2)
    )
    names = choose([(F.col("drive_type") == code, name) for code, name in DRIVE_TYPES.items()], "Other")
    return (
        kept.withColumn("size_kb", kilobytes("capacity_bytes"))
        .withColumn("free_kb", kilobytes("free_bytes"))
        .withColumn("percent_free", free_pct.try_cast("decimal(5,2)"))
        .select(
            *[c for c in raw.columns if c.startswith("event_time")],
            SERVER,
            F.rtrim("name", F.lit("\\")).alias("mount_path"),
            "label",
            names.alias("drive_type"),
            (~lettered).alias("is_mount_point"),
            "size_kb",
            "free_kb",
            (F.col("size_kb") - F.col("free_kb")).alias("used_kb"),
            "percent_free",
            (F.lit(100) - F.col("percent_free")).try_cast("decimal(5,2)").alias("percent_used"),
            F.col("block_size").alias("cluster_size_bytes"),
        )
    )


def wait_category(wait_type: Column) -> Column:
    """Category of a wait type; the first matching entry of the table wins."""
    cases = []
    for category, rule in WAIT_CATEGORIES:
        hit = wait_type.isin(rule.get("names", []))
        for pattern in rule.get("like", []):
            literal = re.split("[%_]", pattern)[0]  # a cheap test before the pattern match
            hit = hit | (wait_type.startswith(literal) & wait_type.like(pattern))
        cases.append((hit, category))
    return choose(cases, "Other")


def classify_waits(raw: DataFrame, capacity: DataFrame, benign: DataFrame | None = None) -> DataFrame:
    """Raw wait counters to wait samples: benign and idle types dropped, ms to seconds.

    ``benign`` is an optional table with a ``wait_type`` column that replaces the fixed list.
    ``capacity`` has one row per server (see ``server_capacity``). Both are sent to the raw rows, which stay where they are:
    dealt by server, all rows of a server would be sorted in one task.
    """
    busy = raw.filter(F.col("waiting_tasks_count") > 0)
    if benign is None:
        busy = busy.filter(~F.col("wait_type").isin(BENIGN_WAITS))
    else:
        busy = busy.join(F.broadcast(benign.select("wait_type").distinct()), "wait_type", "left_anti")

    def seconds(ms: Column) -> Column:
        return (ms.cast("decimal(16,0)") * F.lit("0.001").cast("decimal(3,3)")).cast("decimal(14,2)")

    wait, signal = F.col("wait_time_ms"), F.col("signal_wait_time_ms")
    share = F.try_divide(wait / F.lit(1000.0), F.col("total_server_time_seconds")) * 100
    return busy.join(F.broadcast(capacity.select(SERVER, "total_server_time_seconds")), SERVER).select(
        *[c for c in raw.columns if c.startswith("event_time")],
        SERVER,
        "total_server_time_seconds",
        "wait_type",
        wait_category(F.col("wait_type")).alias("category"),
        seconds(wait).alias("wait_seconds"),
        seconds(wait - signal).alias("resource_seconds"),
        seconds(signal).alias("signal_seconds"),
        share.cast(PERCENT).alias("total_wait_pct"),
        "waiting_tasks_count",
    )


def server_capacity(restarts: DataFrame, schedulers: DataFrame, as_of: Column) -> DataFrame:
    """Uptime since the last restart (at least 1 s) times online schedulers, per server."""
    last = restarts.groupBy(SERVER).agg(F.max("restart_ts").alias("__last"))
    online = schedulers.groupBy(SERVER).agg(
        F.count_if(F.col("status") == "VISIBLE ONLINE").cast("int").alias("processor_count")
    )
    elapsed = F.timestamp_diff("SECOND", F.date_trunc("second", "__last"), F.date_trunc("second", as_of))
    uptime = F.when(elapsed == 0, F.lit(1)).otherwise(elapsed)
    return online.join(last, SERVER, "left").select(
        SERVER,
        uptime.cast("bigint").alias("uptime_seconds"),
        "processor_count",
        (uptime * F.col("processor_count")).cast("double").alias("total_server_time_seconds"),
    )


def blocked_sessions(requests: DataFrame, databases: DataFrame) -> DataFrame:
    """Requests that wait for a blocker, with their database and the blocker's own command."""
    at = [c for c in requests.columns if c.startswith("event_time")]
    named = requests.filter(F.col("blocking_session_id") != 0).select(SERVER, *at, "blocking_session_id").distinct()
    # only sessions that block another are carried on: few of all requests
    blockers = requests.select(
        SERVER,
        *at,
        F.col("session_id").alias("blocking_session_id"),
        F.col("command").alias("blocking_command"),
    ).join(named, [SERVER, *at, "blocking_session_id"], "left_semi")
    return (
        requests.filter(F.col("blocking_session_id") != 0)
        .join(databases.select(SERVER, "database_id", "database_name"), [SERVER, "database_id"])
        .join(blockers, [SERVER, *at, "blocking_session_id"], "left")
        .select(
            *at,
            SERVER,
            F.col("session_id").alias("blocked_session_id"),
            "blocking_session_id",
            "wait_type",
            "wait_time_ms",
            "database_id",
            "database_name",
            *[c for c in ("sql_handle",) if c in requests.columns],
            F.col("command").alias("blocked_command"),
            "blocking_command",
        )
    )


def lock_waits_by_database(index_stats: DataFrame, databases: DataFrame, capacity: DataFrame) -> DataFrame:
    """Row and page lock waits summed per database, with the server's capacity."""
    at = [c for c in index_stats.columns if c.startswith("event_time")]
    return (
        index_stats.groupBy(*at, SERVER, "database_id")
        .agg(
            F.sum("row_lock_wait_in_ms").alias("row_lock_wait_ms"),
            F.sum("page_lock_wait_in_ms").alias("page_lock_wait_ms"),
        )
        .join(databases.select(SERVER, "database_id", "database_name"), [SERVER, "database_id"], "left")
        .join(F.broadcast(capacity), SERVER, "left")
        .select(
            *at,
            SERVER,
            "database_id",
            "database_name",
            "row_lock_wait_ms",
            "page_lock_wait_ms",
            (F.col("row_lock_wait_ms") + F.col("page_lock_wait_ms")).alias("total_blocking_wait_ms"),
            "uptime_seconds",
            "processor_count",
            F.col("total_server_time_seconds").cast("bigint").alias("total_processor_time_seconds"),
        )
    )


def register_restarts(seen: DataFrame, registry: DataFrame, run_at: Column) -> DataFrame:
    """Restart times not registered yet, rounded to the minute, once per server and minute."""
    return (
        seen.select(SERVER, minute_round("start_time_utc").alias("restart_ts"))
        .distinct()
        .join(registry.select(SERVER, "restart_ts"), [SERVER, "restart_ts"], "left_anti")
        .withColumn("run_ts", minute_round(run_at))
    )


def counter_delta(
    samples: DataFrame,
    value: str = "raw_counter_value",
    keys: list[str] | None = None,
    order: list[str] | None = None,
    out: str = "delta",
    bucket: str = "hour",
    restarts: DataFrame | None = None,
) -> DataFrame:
    """Increase since the previous sample of a counter that may restart from zero.

    First sample 0; a drop means a reset, so the raw value is the increase.

    With a restart registry, a counter that was restarted and has passed its old value again is seen as well: restart
    marks are merged into the samples as readings of zero, so the first sample at or after a mark counts its raw value
    (also a key's first sample, if the server's restart is known). Sums over a closed month are then the net of its
    boundary snapshots. Marks go to every key of their server.
    """
    keys = keys or [SERVER]
    order = order or ["event_time_utc"]
    now, before = F.col(value), F.col("__before.v")
    step = F.when(before.isNull(), F.lit(0)).when(now < before, now).otherwise(now - before)
    columns = samples.columns
    if restarts is not None:
        marks = restarts.select(SERVER, F.col("restart_ts").alias(order[0])).distinct()
        if keys != [SERVER]:
            marks = marks.join(samples.select(*keys).distinct(), SERVER)
        marks = marks.withColumns({value: F.lit(0).cast(samples.schema[value].dataType), "__read": F.lit(False)})
        samples = samples.withColumn("__read", F.lit(True)).unionByName(marks, allowMissingColumns=True)
        order = [order[0], "__read", *order[1:]]  # false first: a restart at the time of a sample comes before it
    steps = with_previous(samples, keys, order, value, "__before", bucket)
    if restarts is not None:
        steps = steps.filter("__read")
    return steps.withColumn(out, step.cast("bigint")).select(*columns, out)


def boundary_marks(samples: DataFrame, restarts: DataFrame, ts: str = "event_time_utc") -> DataFrame:
    """Which sample of a server closes or opens which month, or precedes a restart.

    Samples fall into segments of one month and one uptime period. The last sample of a
    segment is a boundary when another segment follows:

    * month change: it closes its own month, and also opens the next sample's month unless
      the server restarted in between (the counters then began at zero);
    * restart only: it is the last reading before the restart.
    """
    times = samples.select(SERVER, ts).distinct()
    segments = (
        with_latest_mark(times, restarts, [SERVER], ts, "restart_ts", "__uptime")
        .groupBy(SERVER, month_of(ts).alias("__month"), "__uptime")
        .agg(F.min(ts).alias("__first"), F.max(ts).alias(ts))
    )
    follower = F.lead(F.struct("__month", "__uptime")).over(Window.partitionBy(SERVER).orderBy("__first"))
    opens, same_uptime = F.col("__next.__month"), F.col("__next.__uptime").eqNullSafe(F.col("__uptime"))

    def mark(kind: str, month: Column) -> Column:
        return F.struct(F.lit(kind).alias("snapshot_type"), month.alias("rollup_month"))

    own = F.col("__month")
    marks = F.when(
        own == opens,
        F.array(mark(PRE_RESTART, own)),
    ).when(
        same_uptime, F.array(mark(END_OF_MONTH, own), mark(START_OF_MONTH, opens))
    ).otherwise(F.array(mark(END_OF_MONTH, own)))
    return (
        segments.withColumn("__next", follower)
        .filter(F.col("__next").isNotNull())
        .select(SERVER, ts, F.explode(marks).alias("__mark"))
        .select(SERVER, ts, "__mark.*")
    )


def boundary_snapshots(samples: DataFrame, restarts: DataFrame, ts: str = "event_time_utc") -> DataFrame:
    """Sample rows at month and restart boundaries, labelled with the month they belong to.

    Marks are few (months + restarts per server); adaptive execution broadcasts them when
    they turn out small and otherwise joins on (server, sample time).
    """
    marks = boundary_marks(samples, restarts, ts)
    local = "event_time_local"
    rest = [F.col(c).alias("snapshot_date_local" if c == local else c) for c in samples.columns if c not in (SERVER, ts)]
    return samples.join(marks, [SERVER, ts]).select(
        SERVER, F.col(ts).alias("snapshot_date_utc"), "snapshot_type", "rollup_month", *rest
    )


def advance_boundaries(
    batch: DataFrame, carried: DataFrame | None, restarts: DataFrame, ts: str = "event_time_utc"
) -> tuple[DataFrame, DataFrame]:
    """Boundaries that newly landed samples decide, and what the next run has to know.

    ``carried`` holds the rows of each server's last instant, whose follower was not known yet. Runs over any cut of a
    history give the boundaries of one run over all of it, and none reads more than its own samples. Samples at or
    before the last instant of their server were seen already and are left out, so a batch may be applied again. The rows
    of one instant have to land together, and a restart has to be registered before the first sample after it.
    """
    if carried is not None:
        last = carried.groupBy(SERVER).agg(F.max(ts).alias("__last"))
        unseen = F.col("__last").isNull() | (F.col(ts) > F.col("__last"))
        batch = batch.join(F.broadcast(last), SERVER, "left").filter(unseen).select(*batch.columns).unionByName(carried)
    newest = batch.groupBy(SERVER).agg(F.max(ts).alias(ts))
    return boundary_snapshots(batch, restarts, ts), batch.join(newest, [SERVER, ts], "left_semi")


def closed_months(boundaries: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Boundary rows of the months that are over for their server: those with a closing row, and with ``as_of`` only
    months that ended by then. An open month has an opening row alone, whose net would be negative.

    The window runs over boundary rows, so the samples behind them are evaluated once.
    """
    over = F.col("snapshot_type") == END_OF_MONTH
    if as_of is not None:
        over = over & (F.add_months("rollup_month", 1) <= as_of)
    month = Window.partitionBy(SERVER, "rollup_month")
    return boundaries.withColumn("__over", F.bool_or(over).over(month)).filter("__over").drop("__over")


def append_missing_rollups(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rollup rows whose key is not stored yet. Applying it twice adds nothing.

    Put the rollup type in ``keys`` where one table holds several kinds of rows.
    """
    return new.join(existing.select(*keys).distinct(), keys, "left_anti").select(*new.columns)
