"""Shared-folder tables that cut lineage between the stages of a job.

A stage result that is read more than once, or that the next round of a loop builds on, is written
as parquet under the folder the cluster names in ``spark.checkpoint.dir``.  A lost executor then
costs a re-read and not a recomputation, and the written size lets Spark decide by itself whether
the table may be broadcast.
"""

from __future__ import annotations

import atexit
import itertools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

FILES_PER_CORE = 4
MIN_FILE_ROWS = 5_000
MAX_FILE_ROWS = 2_000_000


# With it Spark drops the shuffle files of a query as soon as the query ends, not when the driver's heap is next collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _cleaners = threading.Lock(), [0, None]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end meanwhile leave no shuffle files; for writes, as nothing else reads what they shuffled."""
    with _cleaning:
        if _cleaners[0] == 0:
            _cleaners[1] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _cleaners[0] += 1
    try:
        yield
    finally:
        with _cleaning:
            _cleaners[0] -= 1
            if _cleaners[0] == 0:
                spark.conf.set(SHUFFLE_CLEANUP, _cleaners[1]) if _cleaners[1] else spark.conf.unset(SHUFFLE_CLEANUP)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a fresh one is set only in local mode and only if unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starblend-"))
    return spark.sparkContext.getCheckpointDir()


class Workspace:
    """Names and writes the intermediate tables of one job."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self._numbers):03d}-{name}"

    def table(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write ``df`` and return a scan of what was written.

        Repetitive columns shrink so much in parquet that a scan would get too few, too long tasks.
        Where the number of ``rows`` is known it bounds the rows per file: a few files for each
        core of the cluster, each of a size that stays the same as the data grows.
        """
        path = self.path(name)
        writer = df.write
        if rows is not None:
            per_core = rows // (FILES_PER_CORE * self.spark.sparkContext.defaultParallelism)
            per_file = min(max(per_core, MIN_FILE_ROWS), MAX_FILE_ROWS)
            writer = writer.option("maxRecordsPerFile", per_file)
        with shuffles_dropped(self.spark):
            writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close_at_exit(self) -> Workspace:
        """For results that are read after the call that made them: the tables go when the driver ends."""
        atexit.register(self._close_if_running)
        return self

    def _close_if_running(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            self.close()

    def close(self) -> None:
        """Delete the job's tables; call it once nothing reads them any more."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)


def side_by_side(spark: SparkSession, *branches: Callable) -> list:
    """Results of independent parts of a job, submitted at the same time.

    Tree fitting is many short stages that leave cores idle; other parts can use them.
    """
    start = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(branches)) as pool:
        running = [pool.submit(start(branch)) for branch in branches]
        return [branch.result() for branch in running]
