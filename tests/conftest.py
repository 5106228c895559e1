import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from fleetgauge.sources.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows to a DataFrame; strings in ``*_utc``/``*_local``/``*_ts`` columns become timestamps."""

    def build(columns: str, *rows):
        df = spark.createDataFrame(list(rows), ", ".join(c.replace(":", " ") for c in columns.split()))
        times = [c for c, t in df.dtypes if t == "string" and c.endswith(("_utc", "_local", "_ts"))]
        df = df.withColumns({c: df[c].cast("timestamp_ntz") for c in times}) if times else df
        months = [c for c, t in df.dtypes if t == "string" and c == "rollup_month"]
        return df.withColumns({c: df[c].cast("date") for c in months}) if months else df

    return build
