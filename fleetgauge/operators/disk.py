"""Disk rollups: drives, mount latency and database files per server and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import GROUP, MONTH, SERVER, choose, int_avg, int_div, month_of, row_total, scope

DRIVE = [*GROUP, "mount_path"]
OPTICAL = "CD-ROM"
CRITICAL_FREE_PERCENT = 10
PAGE_KB = 8

# Upper bounds of log-segment counts and their severity.
SEGMENT_BANDS = [(100, "Normal"), (500, "Warning"), (1000, "Severe")]
SEGMENT_WORST = "Critical"
HIGH_SEGMENTS = 99

_PCT = "decimal(5,2)"


def _drive_samples(volumes: DataFrame) -> DataFrame:
    return volumes.filter(F.col("drive_type") != OPTICAL).withColumn(MONTH, month_of("event_time_utc"))


def first_last_used(volumes: DataFrame) -> DataFrame:
    """Used space at the first and the last sample of the month, per drive.

    ``min_by``/``max_by`` combine map-side, unlike a window over the drive. Samples at the
    same instant are told apart by the used space itself, so the result is deterministic.
    """
    order = F.struct("event_time_utc", "used_kb")
    return (
        _drive_samples(volumes)
        .groupBy(*DRIVE)
        .agg(F.min_by("used_kb", order).alias("first_used_kb"), F.max_by("used_kb", order).alias("last_used_kb"))
    )


def _drive_aggregates() -> list[Column]:
    critical = F.col("percent_free") < CRITICAL_FREE_PERCENT
    return [
        int_avg(F.col("size_kb")).alias("total_size_kb"),
        int_avg(F.col("free_kb")).alias("free_space_kb"),
        int_avg(F.col("used_kb")).alias("used_space_kb"),
        F.avg("percent_free").cast(_PCT).alias("percent_free"),
        F.avg("percent_used").cast(_PCT).alias("percent_used"),
        F.max("used_kb").alias("max_used_space_kb"),
        F.min("free_kb").alias("min_free_space_kb"),
        F.count_if(critical).alias("samples_critical_free"),
        F.count_distinct(F.when(critical, F.to_date("event_time_utc"))).alias("days_critical_free"),
    ]


def drive_stats(volumes: DataFrame) -> DataFrame:
    """Average, extreme and critical space figures per drive, type, label and mount flag."""
    keyed = _drive_samples(volumes)
    return keyed.groupBy(*DRIVE, "drive_type", F.col("label").alias("drive_label"), "is_mount_point").agg(
        *_drive_aggregates()
    )


def drive_growth(first: Column, last: Column) -> dict[str, Column]:
    """Absolute growth, and growth as a fraction of the first value (NULL when that is <= 0)."""
    grown = last - first
    return {
        "absolute_growth_kb": grown,
        "percent_growth": F.when(first > 0, F.try_divide(grown.cast("decimal(18,4)"), first)).cast("decimal(18,4)"),
    }


def _prefixes(path: Column, any_prefix: bool) -> Column:
    """All prefixes of a path that end at a separator or at its end (or anywhere)."""
    if any_prefix:
        return F.transform(F.sequence(F.lit(1), F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    parts = F.split(path, r"\\")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "\\"))


def longest_prefix_join(files: DataFrame, mounts: DataFrame, compat: bool = False) -> DataFrame:
    """Each distinct file path with the longest mount path that contains it.

    Every path is unfolded into its few directory prefixes, which turns the prefix test into
    an equi-join on (server, prefix): no pair of file and mount is compared unless it
    matches, and nothing has to be broadcast. Files without a mount drop out. ``compat``
    accepts a prefix that ends inside a directory name.
    """
    paths = files.select(SERVER, "physical_name").distinct()
    known = mounts.select(SERVER, "mount_path").distinct()
    return (
        paths.withColumn("mount_path", F.explode(_prefixes(F.col("physical_name"), compat)))
        .join(known, [SERVER, "mount_path"])
        .groupBy(SERVER, "physical_name")
        .agg(F.max_by("mount_path", F.length("mount_path")).alias("mount_path"))
    )


_LATENCIES = ["read", "write", "avg"]


def _file_sums(latency: DataFrame) -> DataFrame:
    """Latency sums per server, month and file: one map-side combined pass over the samples.

    Mounts are resolved afterwards, on one row per file and month.
    """
    return (
        latency.withColumn(MONTH, month_of("event_time_utc"))
        .groupBy(*GROUP, "database_name", "physical_name")
        .agg(
            *[F.sum(f"{c}_latency").alias(f"{c}_sum") for c in _LATENCIES],
            *[F.count(f"{c}_latency").alias(f"{c}_n") for c in _LATENCIES],
            F.max("avg_latency").alias("worst"),
        )
    )


def _on_mounts(sums: DataFrame, mounts: DataFrame, compat: bool) -> DataFrame:
    """The sums of each file with the longest mount path that contains it.

    The same prefix equi-join as ``longest_prefix_join``, on the rows themselves: the samples
    are read once and no second join is needed to bring the mount back.
    """
    file = [*GROUP, "database_name", "physical_name"]
    row = F.struct("mount_path", *[c for c in sums.columns if c not in file])
    return (
        sums.withColumn("mount_path", F.explode(_prefixes(F.col("physical_name"), compat)))
        .join(mounts.select(SERVER, "mount_path").distinct(), [SERVER, "mount_path"])
        .groupBy(*file)
        .agg(F.max_by(row, F.length("mount_path")).alias("__row"))
        .select(*file, "__row.*")
    )


def _latency_averages() -> list[Column]:
    names = {"read": "avg_read_latency_ms", "write": "avg_write_latency_ms", "avg": "avg_overall_latency_ms"}
    return [
        *[int_div(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).cast("int").alias(n) for c, n in names.items()],
        F.max("worst").alias("worst_observed_latency_ms"),
    ]


def mount_latency(latency: DataFrame, mounts: DataFrame, compat: bool = False) -> DataFrame:
    """Whole-number average latencies and the worst one, per mount."""
    return _on_mounts(_file_sums(latency), mounts, compat).groupBy(*DRIVE).agg(*_latency_averages())


def file_latency_monthly(latency: DataFrame, mounts: DataFrame, compat: bool = False) -> DataFrame:
    """The same per (database, file, mount)."""
    resolved = _on_mounts(_file_sums(latency), mounts, compat)
    return resolved.groupBy(*DRIVE, "database_name", "physical_name").agg(*_latency_averages())


def last_sample(volumes: DataFrame) -> DataFrame:
    """Free space at the last sample of the month; samples at that same instant all stay.

    A rank that is cut at one: each task passes on the rows of its own last instant per drive, so one read of the samples
    is enough and next to nothing is shuffled, however many samples a drive has.
    """
    newest = F.rank().over(Window.partitionBy(*DRIVE).orderBy(F.desc("event_time_utc")))
    return (
        volumes.withColumn(MONTH, month_of("event_time_utc"))
        .withColumn("__rank", newest)
        .filter("__rank = 1")
        .select(*DRIVE, F.col("free_kb").alias("rollup_free_space_kb"), F.col("percent_free").alias("rollup_percent_free"))
    )


def _drive_state(volumes: DataFrame) -> DataFrame:
    """Space figures with first and last used space, in one pass.

    Samples are reduced per (drive, type, label, mount flag); the window then only sees those
    few variants of one drive. Optical drives are left out of the figures.
    """
    used = F.struct("event_time_utc", "used_kb")
    keyed = volumes.withColumn(MONTH, month_of("event_time_utc"))
    per_drive = Window.partitionBy(*DRIVE)
    spinning = F.col("drive_type") != OPTICAL
    return (
        keyed.groupBy(*DRIVE, "drive_type", F.col("label").alias("drive_label"), "is_mount_point")
        .agg(*_drive_aggregates(), F.min(used).alias("__lo"), F.max(used).alias("__hi"))
        .withColumns(
            {
                "first_used_kb": F.min(F.when(spinning, F.col("__lo"))).over(per_drive)["used_kb"],
                "last_used_kb": F.max(F.when(spinning, F.col("__hi"))).over(per_drive)["used_kb"],
            }
        )
        .filter(spinning)
        .drop("__lo", "__hi")
    )


def drive_monthly(
    volumes: DataFrame,
    latency: DataFrame,
    generated_utc: Column,
    generated_local: Column,
    mounts: DataFrame | None = None,
    compat: bool = False,
) -> DataFrame:
    """The drive row: space, growth, latency of the files on it, state at month end.

    ``mounts`` are the known mount paths of all history, by default those of ``volumes``.
    The state at month end has the rows of each drive's last instant (see ``last_sample``).
    """
    growth = drive_growth(F.col("first_used_kb"), F.col("last_used_kb"))
    speed = mount_latency(latency, volumes if mounts is None else mounts, compat)
    return (
        _drive_state(volumes)
        .join(speed.withColumn("is_sql_disk", F.lit(True)), DRIVE, "left")
        .join(last_sample(volumes), DRIVE, "left")
        .select(
            *GROUP,
            F.lit("Drive").alias("rollup_type"),
            *["mount_path", "drive_label", "drive_type", "is_mount_point"],
            F.coalesce("is_sql_disk", F.lit(False)).alias("is_sql_disk"),
            *["total_size_kb", "free_space_kb", "used_space_kb", "percent_free", "percent_used"],
            *["rollup_free_space_kb", "rollup_percent_free"],
            *[c.alias(n) for n, c in growth.items()],
            *["samples_critical_free", "days_critical_free", "max_used_space_kb", "min_free_space_kb"],
            *["avg_read_latency_ms", "avg_write_latency_ms", "avg_overall_latency_ms", "worst_observed_latency_ms"],
            generated_utc.alias("generated_utc"),
            generated_local.alias("generated_local"),
        )
    )


def file_inventory(files: DataFrame) -> DataFrame:
    """File sizes and growth steps in KB, file type and drive."""
    return files.select(
        *scope(files),
        "database_name",
        "physical_name",
        F.col("type_desc").alias("file_type"),
        F.substring("physical_name", 1, 2).alias("file_drive"),
        (F.col("size_pages") * PAGE_KB).alias("file_size_kb"),
        (F.col("growth_pages") * PAGE_KB).alias("file_growth_kb"),
    )


def database_footprint(files: DataFrame) -> DataFrame:
    """Data files, log files and total size per database."""
    return files.groupBy(*scope(files), "database_id", "database_name").agg(
        F.count_if(F.col("type_desc") == "ROWS").alias("data_file_count"),
        F.count_if(F.col("type_desc") == "LOG").alias("log_file_count"),
        (F.sum("size_pages") * PAGE_KB).alias("total_database_size_kb"),
    )


def log_segment_severity(log_segments: DataFrame) -> DataFrame:
    """Log segments per database and the severity band of that count."""
    n = F.col("log_segment_count")
    return (
        log_segments.groupBy(*scope(log_segments), "database_name")
        .agg(row_total(log_segments).alias("log_segment_count"))
        .withColumn("log_segment_severity", choose([(n < top, name) for top, name in SEGMENT_BANDS], SEGMENT_WORST))
    )


def file_monthly(
    latency: DataFrame,
    mounts: DataFrame,
    files: DataFrame,
    log_segments: DataFrame,
    generated_utc: Column,
    generated_local: Column,
    compat: bool = False,
) -> DataFrame:
    """The database-file row: latency with inventory, footprint and log-segment severity.

    ``files`` and ``log_segments`` are one collection each, or given by month (see ``inventory.by_month``); each month then
    gets its own state.
    """
    return (
        file_latency_monthly(latency, mounts, compat)
        .join(file_inventory(files), [*scope(files), "database_name", "physical_name"], "left")
        .join(database_footprint(files).drop("database_id"), [*scope(files), "database_name"], "left")
        .join(log_segment_severity(log_segments), [*scope(log_segments), "database_name"], "left")
        .select(
            *GROUP,
            F.lit("DatabaseFile").alias("rollup_type"),
            "mount_path",
            F.lit(True).alias("is_sql_disk"),
            *["database_name", "physical_name", "file_type", "file_drive", "file_size_kb", "file_growth_kb"],
            *["avg_read_latency_ms", "avg_write_latency_ms", "avg_overall_latency_ms", "worst_observed_latency_ms"],
            *["log_segment_count", "log_segment_severity", "data_file_count", "log_file_count"],
            "total_database_size_kb",
            F.lit(None).cast("bigint").alias("total_database_growth_kb"),
            generated_utc.alias("generated_utc"),
            generated_local.alias("generated_local"),
        )
    )


def disk_monthly(drives: DataFrame, files: DataFrame) -> DataFrame:
    """Drive and file rows in one sparse table."""
    return drives.unionByName(files, allowMissingColumns=True)
