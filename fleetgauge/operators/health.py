"""Configuration and health facts per server and per database.

Inventories are tables of one collection, or given by month (``inventory.by_month``) with a ``rollup_month``; facts of the
latter are per month, each from the state its month ended with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.semantics import MONTH, SERVER, month_of, row_total, scope, sum_where
from fleetgauge.operators.disk import HIGH_SEGMENTS

DEFAULT_INSTANCE = "MSSQLSERVER (Default Instance)"
DEFAULT_MAJOR_VERSION = 11
NEVER_CHECKED = "1900-01-01 00:00:00.000"
SCRATCH_DATABASE = "tempdb"
LAST_SYSTEM_DATABASE_ID = 4
SHARED_NODES_FROM = 64

# Property names, the columns they become and their types.
PROPERTY_SPEC = {
    "ServerName": ("host_name", "string"),
    "InternalSQLName": ("internal_name", "string"),
    "Collation": ("instance_collation", "string"),
    "InstanceName": ("instance_name", "string"),
    "Edition": ("edition", "string"),
    "ProductVersion": ("product_version", "string"),
    "ProductMajorVersion": ("major_version", "int"),
    "VersionBanner": ("version_banner", "string"),
    "IsHadrEnabled": ("is_ag_enabled", "int"),
    "IsClustered": ("is_clustered", "int"),
    "CpuCount": ("cpu_cores", "int"),
    "PhysicalMemoryKB": ("physical_memory_kb", "bigint"),
    "VirtualMachineType": ("virtual_machine_type", "string"),
    "PowerPlan": ("host_power_plan", "string"),
    "LockedPagesKB": ("locked_pages_kb", "bigint"),
    "InstantFileInitialization": ("instant_file_initialization", "int"),
    "HostDistribution": ("host_distribution", "string"),
    "HostOperatingSystem": ("host_operating_system", "string"),
}

# Setting names and the columns they become.
SETTING_COLUMNS = {
    "optimize for ad hoc workloads": "ad_hoc_enabled",
    "backup compression default": "backup_compression",
    "cost threshold for parallelism": "cost_threshold",
    "max degree of parallelism": "max_dop",
    "min server memory (MB)": "min_memory_mb",
    "max server memory (MB)": "max_memory_mb",
}


def pivot_properties(properties: DataFrame, spec: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Name/value rows to one typed row per server; absent or malformed values are NULL.

    The list of names is known, so this is one conditional aggregate over one shuffle.
    """
    spec = PROPERTY_SPEC if spec is None else spec

    def value(name: str, to: str) -> Column:
        return F.max(F.when(F.col("property_name") == name, F.col("property_value"))).try_cast(to)

    return properties.groupBy(*scope(properties)).agg(*[value(n, to).alias(c) for n, (c, to) in spec.items()])


def pivot_settings(configs: DataFrame) -> DataFrame:
    """The six named settings as columns."""
    return (
        configs.filter(F.col("name").isin(list(SETTING_COLUMNS)))
        .groupBy(*scope(configs))
        .agg(
            *[F.max(F.when(F.col("name") == n, F.col("value").cast("int"))).alias(c) for n, c in SETTING_COLUMNS.items()]
        )
    )


def _flag(cond: Column) -> Column:
    """A fact that is false, not unknown, when its inputs are missing."""
    return F.coalesce(cond, F.lit(False))


def derive_system_flags(properties: DataFrame, availability_groups: DataFrame | None = None) -> DataFrame:
    """Flags and defaults derived from the pivoted properties.

    ``availability_groups`` has a row per group and server; only the servers in it matter.
    """
    derived = properties.withColumns(
        {
            "instance_name": F.coalesce("instance_name", F.lit(DEFAULT_INSTANCE)),
            "is_name_matching": _flag(F.col("host_name") == F.col("internal_name")),
            "is_virtual_machine": F.col("virtual_machine_type") != "NONE",
            "is_ag_enabled": F.col("is_ag_enabled") == 1,
            "is_clustered": F.col("is_clustered") == 1,
            "lock_pages_in_memory": _flag(F.col("locked_pages_kb") > 0),
        }
    )
    if availability_groups is None:
        return derived.withColumn("is_ag_present", F.lit(False))
    at = scope(properties, availability_groups)
    present = availability_groups.select(*at).distinct().withColumn("is_ag_present", F.lit(True))
    return derived.join(present, at, "left").withColumn("is_ag_present", _flag(F.col("is_ag_present")))


def friendly_version(banner: Column) -> Column:
    """Version banner on one line, up to its first dash; NULL when there is no dash."""
    flat = F.regexp_replace(banner, "[\r\n]", " ")
    return F.when(F.instr(flat, "-") > 0, F.substring_index(flat, "-", 1))


def scheduler_topology(schedulers: DataFrame) -> DataFrame:
    """Memory nodes in use and scheduler counts per server, hidden nodes left out."""
    status = F.col("status")
    online, offline = status == "VISIBLE ONLINE", status == "VISIBLE OFFLINE"

    def number(cond: Column) -> Column:
        return sum_where(cond, F.col("row_count")) if "row_count" in schedulers.columns else F.count_if(cond)

    return (
        schedulers.filter(F.col("parent_node_id") < SHARED_NODES_FROM)
        .groupBy(*scope(schedulers))
        .agg(
            F.count_distinct("parent_node_id").cast("int").alias("numa_nodes"),
            number(online).alias("online_cpu_count"),
            number(offline).alias("offline_cpu_count"),
            number(online | offline).alias("allocated_cpu_count"),
        )
    )


def version_gated(fact: Column, minimum: int, major: Column | None = None) -> Column:
    """The fact on servers of at least that major version, else NULL."""
    major = F.col("major_version") if major is None else major
    return F.when(F.coalesce(major, F.lit(DEFAULT_MAJOR_VERSION)) >= minimum, fact)


def system_health(
    properties: DataFrame,
    configs: DataFrame,
    schedulers: DataFrame,
    month: Column | None = None,
    availability_groups: DataFrame | None = None,
) -> DataFrame:
    """One row of configuration facts per server for the report month, or per server and month of ``properties``.

    A table without months next to properties by month holds for all of them.
    """
    facts = derive_system_flags(pivot_properties(properties), availability_groups)
    month = F.col(MONTH) if MONTH in properties.columns else month
    at, of = scope(properties, configs), scope(properties, schedulers)
    return (
        facts.join(pivot_settings(configs), at, "left")
        .join(scheduler_topology(schedulers).select(*of, "numa_nodes"), of, "left")
        .select(
            month.alias(MONTH),
            SERVER,
            *["cpu_cores", "host_name", "host_power_plan"],
            F.floor(F.col("physical_memory_kb") / 1024).cast("int").alias("host_ram_mb"),
            *["is_virtual_machine", "numa_nodes"],
            *["instance_collation", "instance_name", "is_name_matching", "edition"],
            friendly_version(F.col("version_banner")).alias("friendly_version"),
            "product_version",
            (F.col("ad_hoc_enabled") != 0).alias("ad_hoc_enabled"),
            (F.col("backup_compression") != 0).alias("backup_compression"),
            *["cost_threshold", "is_ag_enabled", "is_ag_present", "is_clustered", "lock_pages_in_memory"],
            *["max_dop", "max_memory_mb", "min_memory_mb"],
            version_gated(_flag(F.col("instant_file_initialization") == 1), 14).alias("instant_file_initialization"),
            version_gated(F.col("host_distribution"), 14).alias("host_distribution"),
            version_gated(F.col("host_operating_system"), 14).alias("host_operating_system"),
        )
    )


def file_flags(files: DataFrame) -> DataFrame:
    """Per database: any data file that grows in percent, any file on the C: drive."""
    grows = (F.col("type_desc") == "ROWS") & F.col("is_percent_growth")
    on_c = F.col("physical_name").startswith("C:\\")
    return files.groupBy(*scope(files), "database_id").agg(
        F.coalesce(F.bool_or(grows), F.lit(False)).alias("has_percent_autogrowth"),
        F.coalesce(F.bool_or(on_c), F.lit(False)).alias("has_files_on_c_disk"),
    )


def latest_backups(backups: DataFrame) -> DataFrame:
    """Latest full and log backup per database."""

    def latest(kind: str) -> Column:
        return F.max(F.when(F.col("backup_type") == kind, F.col("backup_finish_ts")))

    return backups.groupBy(*scope(backups), "database_name").agg(
        latest("D").alias("last_full_backup"), latest("L").alias("last_log_backup")
    )


def latest_backups_by_month(databases: DataFrame, backups: DataFrame) -> DataFrame:
    """Latest backups before the end of each month of ``databases``.

    Backups shrink to one row per database and month; the months asked for are merged into them and a running maximum
    over a database's few months does the as-of lookup.
    """
    key, kinds = [SERVER, "database_name"], ["last_full_backup", "last_log_backup"]
    done = latest_backups(backups.withColumn(MONTH, month_of("backup_finish_ts"))).withColumn("__asked", F.lit(False))
    asked = databases.select(*key, MONTH).distinct().withColumn("__asked", F.lit(True))
    running = Window.partitionBy(*key).orderBy(MONTH).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = done.unionByName(asked, allowMissingColumns=True)
    return both.withColumns({k: F.max(k).over(running) for k in kinds}).filter("__asked").drop("__asked")


def backup_staleness(databases: DataFrame, backups: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Overdue flags: full backup older than 7 days or none; log backup older than 24 hours
    or none, unless the recovery model keeps no log. The scratch database is never overdue.

    Databases by month are judged at the end of their month, by the backups known then.
    """
    if MONTH in databases.columns:
        as_of = F.add_months(MONTH, 1).cast("timestamp_ntz")
        latest = latest_backups_by_month(databases, backups)
    else:
        latest = latest_backups(backups)
    full, log = F.col("last_full_backup"), F.col("last_log_backup")
    exempt = F.col("database_name") == SCRATCH_DATABASE
    full_due = full.isNull() | (full < as_of - F.expr("INTERVAL 7 DAYS"))
    log_due = log.isNull() | (log < as_of - F.expr("INTERVAL 24 HOURS"))
    return databases.join(latest, [*scope(databases), "database_name"], "left").withColumns(
        {
            "is_backup_overdue": ~exempt & full_due,
            "is_log_backup_overdue": ~exempt & (F.col("recovery_model") != "SIMPLE") & log_due,
        }
    )


def high_segment_flag(log_segments: DataFrame) -> DataFrame:
    """Log segments per database, and whether they are too many."""
    n = F.col("log_segment_count")
    return (
        log_segments.filter(F.col("database_name") != SCRATCH_DATABASE)
        .groupBy(*scope(log_segments), "database_name")
        .agg(row_total(log_segments).alias("log_segment_count"))
        .withColumn("has_high_segment_count", n > HIGH_SEGMENTS)
    )


def last_good_check(integrity_checks: DataFrame) -> DataFrame:
    """Last good integrity check; the never-checked sentinel and unreadable values are NULL."""
    text = F.nullif(F.col("last_known_good"), F.lit(NEVER_CHECKED))
    return integrity_checks.groupBy(*scope(integrity_checks), "database_name").agg(
        F.max(text.try_cast("timestamp_ntz")).alias("last_good_check")
    )


def database_health(
    databases: DataFrame,
    files: DataFrame,
    log_segments: DataFrame,
    backups: DataFrame,
    integrity_checks: DataFrame,
    month: Column | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """One row of flags and dates per database for the report month, or per database and month of ``databases``; no
    scratch database.

    Each detail table is reduced to one row per database before it is joined. One without months holds for all months.
    """
    month = F.col(MONTH) if MONTH in databases.columns else month
    name = "database_name"
    kept = databases.filter(F.col("database_name") != SCRATCH_DATABASE)
    user_database = F.col("database_id") > LAST_SYSTEM_DATABASE_ID
    return (
        backup_staleness(kept, backups, as_of)
        .join(file_flags(files), [*scope(databases, files), "database_id"], "left")
        .join(high_segment_flag(log_segments), [*scope(databases, log_segments), name], "left")
        .join(last_good_check(integrity_checks), [*scope(databases, integrity_checks), name], "left")
        .select(
            month.alias(MONTH),
            SERVER,
            *["database_name", "recovery_model"],
            (F.col("page_verify") != "CHECKSUM").alias("is_page_verification_not_checksum"),
            _flag(F.col("has_high_segment_count")).alias("has_high_segment_count"),
            F.coalesce("log_segment_count", F.lit(0)).alias("log_segment_count"),
            _flag(F.col("has_percent_autogrowth")).alias("has_percent_autogrowth"),
            *["is_backup_overdue", "last_full_backup", "is_log_backup_overdue", "last_log_backup"],
            (user_database & _flag(F.col("has_files_on_c_disk"))).alias("has_files_on_c_disk"),
            *["is_auto_shrink_on", "is_auto_close_on", "last_good_check"],
        )
    )
