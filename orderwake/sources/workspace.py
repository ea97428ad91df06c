"""Stage tables: a lazily written table is computed once and read back by every later stage.

Tables go below the shared folder that the session names in `spark.checkpoint.dir`, so they
outlive any executor. A session without that setting keeps them as persisted frames instead, which
Spark computes again from their inputs if an executor is lost.
"""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SETTING = "spark.checkpoint.dir"

# Rows per file of a stage table. Files are packed into tasks by their bytes, and a table of few distinct values has
# so few that one task would get tens of millions of rows.
FILE_ROWS = 250_000

# Spark's setting to remove the shuffle files of a query when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Stage tables are written once and read a few times; this codec takes about a third less than Spark's default.
CODEC = "zstd"


def scratch_folder(spark: SparkSession) -> str | None:
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    return folder.rstrip("/") if folder else None


def files_folder(spark: SparkSession) -> str:
    """Where a session may keep files: its shared folder. Only a local session may lack it; it gets a temporary one."""
    shared = scratch_folder(spark)
    if shared:
        return shared
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="orderwake-")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives the space of its shuffles back when it is finished.

    Spark keeps shuffle files until the driver collects its garbage, which a job of large tables and few objects hardly
    causes. A written table is read from its files, so nothing asks for these shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


class Workspace:
    """Named tables of one data set, written on first use. `close` gives their space back."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        shared = scratch_folder(spark)
        self.folder = f"{shared}/orderwake/{spark.sparkContext.applicationId}/{name}" if shared else None
        self._schemas: dict[str, StructType] = {}
        self._kept: dict[str, DataFrame] = {}
        self._files: str | None = None
        self._lock = threading.RLock()

    def table(self, name: str, build: Callable[[], DataFrame] | None = None) -> DataFrame:
        """The named table; built and written first if this workspace has not done so."""
        with self._lock:
            if name not in self._schemas:
                if build is None:
                    raise KeyError(f"no table {name} in this workspace")
                df = build()
                if self.folder:
                    with shuffles_removed(self.spark):
                        df.write.mode("overwrite").options(maxRecordsPerFile=FILE_ROWS, compression=CODEC).parquet(f"{self.folder}/{name}")
                else:
                    self._kept[name] = df.persist(StorageLevel.MEMORY_AND_DISK)
                self._schemas[name] = df.schema
        if name in self._kept:
            return self._kept[name]
        return self.spark.read.schema(self._schemas[name]).parquet(f"{self.folder}/{name}")

    def has(self, name: str) -> bool:
        """Is the named table written?"""
        return name in self._schemas

    def file_path(self, name: str) -> str:
        """Where this workspace keeps files of that name, apart from its tables."""
        if self._files is None:
            self._files = f"{self.folder}/files" if self.folder else files_folder(self.spark)
        return f"{self._files}/{name}"

    def close(self) -> None:
        """Forget the tables and delete this workspace's own folder."""
        with self._lock:
            for df in self._kept.values():
                df.unpersist()
            if self.folder and (self._schemas or self._files):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
                path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
            self._kept, self._schemas, self._files = {}, {}, None
