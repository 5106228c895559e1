"""Tables that are published by a commit log: written first, visible only once their commit is there.

A run writes its rows, their keys and its carried state below folders of its own and then puts one small file into the
log, whose name is the next free number. Creating that file succeeds for one of several concurrent runs; the others look
at what was committed meanwhile. A run that dies before its commit leaves folders that no reader looks at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from fleetgauge.functions.semantics import MONTH
from fleetgauge.operators.ingest import append_missing_rollups


class Conflict(RuntimeError):
    """Other runs kept committing first."""


class CommitLog:
    """Numbered commits below ``path``; each names the run it publishes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._rename = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.getUri(), spark._jsc.hadoopConfiguration()
        ).rename
        self._no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def runs(self) -> list[str]:
        """Published runs, oldest first. One listing; no file is opened."""
        folder = self._path(f"{self.path}/commits")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        numbered = sorted(n for n in names if n[:1].isdigit())
        return [self._run_of(n) for n in numbered]

    def _run_of(self, name: str) -> str:
        names = [f.getPath().getName() for f in self._files.listStatus(self._path(f"{self.path}/commits/{name}"))]
        return next(n for n in names if not n.startswith("."))

    def publish(self, run: str, after: int) -> bool:
        """Makes ``run`` visible as commit number ``after``; False if another run has taken that number."""
        draft = self._path(f"{self.path}/drafts/{run}")
        self._files.mkdirs(draft)
        self._files.create(self._path(draft, run), True).close()
        target = self._path(f"{self.path}/commits/{after:012d}")
        self._files.mkdirs(target.getParent())
        try:
            self._rename(draft, target, self._no_overwrite)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception) or self._files.exists(target):
                return False
            raise
        return True


class PublishedTable:
    """A table whose rows are keyed and published once, with an optional state carried from run to run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path.rstrip("/"), CommitLog(spark, path)

    def _read(self, kind: str, runs: list[str]) -> DataFrame | None:
        if not runs:
            return None
        return self.spark.read.parquet(*[f"{self.path}/{kind}/run={r}" for r in runs])

    def read(self) -> DataFrame | None:
        """All published rows; None before the first commit."""
        return self._read("rows", self.log.runs())

    def keys(self) -> DataFrame | None:
        """Keys of all published rows; only runs of ``publish`` have some."""
        return self._read("keys", self.log.runs())

    def state(self) -> tuple[DataFrame | None, int]:
        """State of the newest commit, and the number of commits it stands for."""
        runs = self.log.runs()
        return self._read("state", runs[-1:]), len(runs)

    def _write(self, kind: str, run: str, df: DataFrame) -> DataFrame:
        """Rows by month are sorted by it, so that the statistics of files and row groups tell months apart."""
        path = f"{self.path}/{kind}/run={run}"
        (df.sortWithinPartitions(MONTH) if MONTH in df.columns else df).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put(self, rows: DataFrame, run: str) -> bool:
        """Publishes all of ``rows`` as ``run``, unless that run is published already."""
        return self.advance(lambda _: (rows, None), run, stateful=False)

    def rows_of(self, run: str) -> DataFrame:
        """The rows of one published run."""
        return self._read("rows", [run])

    def advance(self, step: Callable[[DataFrame | None], tuple[DataFrame, DataFrame | None]], run: str | None = None, tries: int = 5, stateful: bool = True) -> bool:
        """Publishes the rows and the new state that ``step`` makes from the present state.

        The state is read, and both are committed as its successor. If another run commits in between, the step is made
        again from the new state. A run of the same name that is published already is not made again (False).
        """
        for _ in range(tries):
            runs = self.log.runs()
            if run is not None and run in runs:
                return False
            name = run or uuid.uuid4().hex
            rows, state = step(self._read("state", runs[-1:]) if stateful else None)
            if state is not None:
                self._write("state", name, state)
            self._write("rows", name, rows)
            if self.log.publish(name, len(runs)):
                return True
        raise Conflict(self.path)

    def publish(self, new: DataFrame, keys: list[str], run: str | None = None, tries: int = 5) -> bool:
        """Publishes the rows of ``new`` whose key is not published yet, each key once.

        Only keys are compared, and only published ones; with a ``rollup_month`` among them just the months of ``new``
        are read. If another run commits meanwhile, its keys are taken out and the rest is written anew.
        """
        for _ in range(tries):
            runs = self.log.runs()
            if run is not None and run in runs:
                return False
            name = run or uuid.uuid4().hex
            known = self._read("keys", runs)
            pending = new
            if known is not None:
                if MONTH in keys:
                    months = [r[0] for r in new.select(MONTH).distinct().toLocalIterator()]  # calendar months
                    known = known.filter(known[MONTH].isin(months))
                pending = append_missing_rollups(new, known, keys)
            written = self._write("rows", name, pending)
            self._write("keys", name, written.select(*keys))
            if self.log.publish(name, len(runs)):
                return True
        raise Conflict(self.path)
