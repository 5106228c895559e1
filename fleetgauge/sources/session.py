"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "fleetgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    Partition sizes are left to adaptive execution, which merges small shuffle partitions
    and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Only a local session may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="fleetgauge-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
