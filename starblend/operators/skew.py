"""Joins of a large table to a table with one row per key, safe when a few keys hold most rows.

A key is hot when it alone would overload a task.  There are at most ``MAX_HOT_KEYS`` hot keys by
construction, so their rows of the one-row-per-key side fit a broadcast whatever the data size, and
the hot rows of the large side are joined where they lie.  All other rows take an ordinary join, in
which Spark broadcasts the small side only if its measured size allows it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starblend.workspace import Workspace

HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 100_000

ROWS_PER_PARTITION = 2_000_000
MAX_BUCKETS = 100_000

Key = str | list[str]


def hot_keys(
    counts: DataFrame, key: Key, total: int, hot_rows: int | None = None
) -> DataFrame | None:
    """Keys of ``counts(key, n)`` that hold too many rows for one task, or None if there are none.

    ``total`` is the sum of ``n``: at most ``MAX_HOT_KEYS`` keys can hold ``total / MAX_HOT_KEYS``.
    """
    floor = max(HOT_ROWS if hot_rows is None else hot_rows, total // MAX_HOT_KEYS + 1)
    names = [key] if isinstance(key, str) else key
    hot = counts.where(F.col("n") >= floor).select(*names).dropna()
    return None if hot.isEmpty() else hot


def hot_by(counts: DataFrame, key: Key, size: str = "n", rows: int | None = None) -> DataFrame | None:
    """``hot_keys`` of ``counts`` by the column ``size``.

    No key is hot where there are too few ``rows`` in all; otherwise one small job tells.
    """
    if rows is not None and rows < HOT_ROWS:
        return None
    total = counts.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    if total[1] < HOT_ROWS:
        return None
    return hot_keys(counts.withColumnRenamed(size, "n"), key, total[0])


def too_large_to_broadcast(dim: DataFrame) -> bool:
    """Whether Spark's own size of ``dim``, measured if it is a stored table, is beyond its broadcast limit."""
    size = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size > dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


class KeyedRows:
    """A large table to be joined by one key, its hot rows apart.

    With ``work`` given the table will be joined several times.  Once a side turns out too large to broadcast,
    the rows are stored in buckets of the key in the shared folder, so each join moves only that side.
    """

    def __init__(
        self,
        fact: DataFrame,
        key: Key,
        hot: DataFrame | None = None,
        work: Workspace | None = None,
        rows: int = 0,
    ):
        self.key = key
        self.hot = None if hot is None else F.broadcast(hot)
        self.hot_rows = None if hot is None else fact.join(self.hot, key, "left_semi")
        self.rest = fact if hot is None else fact.join(self.hot, key, "left_anti")
        self._work, self._rows = work, rows
        self._table: str | None = None

    def _keep(self) -> None:
        spark = self.rest.sparkSession
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = min(MAX_BUCKETS, max(shuffle, self._rows // ROWS_PER_PARTITION))
        names = [self.key] if isinstance(self.key, str) else self.key
        self._table = f"kept_{uuid.uuid4().hex}"
        (
            self.rest.repartition(parts, *names).write.bucketBy(parts, *names).sortBy(*names)
            .option("path", self._work.path("kept")).saveAsTable(self._table)
        )
        self.rest = spark.table(self._table)

    @property
    def stored(self) -> DataFrame | None:
        """All rows in buckets of the key; None where they are not stored or some keys are hot."""
        return self.rest if self._table is not None and self.hot is None else None

    def attach(self, dim: DataFrame, how: str = "left") -> DataFrame:
        """Join ``dim`` (one row per key); ``how`` is ``left``, ``inner`` or ``left_semi``."""
        if self._work is not None and self._table is None and too_large_to_broadcast(dim):
            self._keep()
        joined = self.rest.join(dim, self.key, how)
        if self.hot is None:
            return joined
        hot_dim = F.broadcast(dim.join(self.hot, self.key, "left_semi"))
        return self.hot_rows.join(hot_dim, self.key, how).unionByName(joined)

    def release(self) -> None:
        """Forget the stored copy; its files go with the workspace."""
        if self._table is not None:
            self.rest.sparkSession.sql(f"DROP TABLE IF EXISTS {self._table}")


def attach(
    fact: DataFrame, dim: DataFrame, key: Key, hot: DataFrame | None = None, how: str = "left"
) -> DataFrame:
    """One join of ``dim`` (one row per ``key``) to ``fact``."""
    return KeyedRows(fact, key, hot).attach(dim, how)
