"""How the words of a language's sources differ: divergence of each pair of sources, and each source's own terms.

Terms are runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`` with A-Z lower-cased; a language keeps the terms that occur in
at least ``least`` of its documents.  Counts become parts per thousand million, smoothed by 2: ``p = 1 + floor(10^9 (n + 2) /
(N + 2 V))``; two parts differ by ``floor((p - q)^2 / (p + q))``.  All of it is whole numbers.

*Terms.*  ``p`` grows with the count in the group and the language's ``q`` with the count in the language, and where
``p > q`` the difference grows with ``p`` and falls with ``q``.  So a term goes behind every term that has no lower group
count, no higher language count and an earlier name: it is dominated.  Each partition keeps its skyband, the terms that fewer
than k others dominate; skybands are merged, sixteen at a time, and only the last one is ranked.

*Pairs.*  With a term that only one of two groups has, or none, the other part is the constant of a count of 0.  So a pair's sum
is that of the constants, corrected by each group's histogram of parts, and by the terms both have.  Only the last needs
a join of terms; a term has at most as many rows there as the language has sources.

Texts are counted by task, at most ``HELD`` terms at once, so a frequent term or a large source costs a row a task.

Defined cases: null text, lang and source are empty.  A text without terms still makes its group occur.  A language without kept
terms gives its pairs the value 0 and no terms.  Repeated rows count each for itself.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starblend.llm.common import strings
from starblend.workspace import Workspace

#: Entries that a task counts at once before it hands them on; texts of long terms count by their bytes.
HELD = 400_000
LONG = 64
FAN_IN = 16

# Every byte that is not part of a term becomes a space; bytes from 0x80 on belong to characters that are.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order."""
    return text.translate(_TERM_BYTES).split()


class _Tally:
    """Occurrences and documents of each term of each group of a task."""

    def __init__(self):
        self.groups: dict[tuple, tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, group: tuple, text: bytes) -> None:
        seen, docs = self.groups.setdefault(group, (Counter(), Counter()))
        words = terms(text)
        before = len(seen)
        seen.update(words)
        docs.update(set(words))
        self.held += 1 + len(seen) - before + (len(text) // LONG if LONG * len(words) < len(text) else 0)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All that is counted; a row without a term says that its group occurs."""
        for (lang, source), (seen, docs) in self.groups.items():
            names = list(seen)
            n = len(names) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))),
                    pa.array([source], pa.string()).take(pa.array(np.zeros(n, np.int32))),
                    pa.array([None, *names], pa.binary()).cast(pa.string()),
                    pa.array([0, *seen.values()], pa.int64()), pa.array([0, *map(docs.__getitem__, names)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        self.__init__()


def _counted(docs: DataFrame) -> DataFrame:
    """Partial counts ``lang, source, term, n, docs``."""

    def run(batches):
        tally = _Tally()
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, strings(batch.column("text")), strict=True):
                tally.add((lang, source), text)
                if tally.held > HELD:
                    yield from tally.rows()
        yield from tally.rows()

    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return named.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _part(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), exact beyond 64 bits."""
    wide = [c.cast("decimal(18,0)") for c in (n, total, kept)]
    over = (F.lit(10**9).cast("decimal(10,0)") * (wide[0] + F.lit(2).cast("decimal(1,0)"))).cast("decimal(30,0)")
    under = (wide[1] + F.lit(2).cast("decimal(1,0)") * wide[2]).cast("decimal(30,0)")
    return F.call_function("div", over, under).cast("long") + 1


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(docs: DataFrame, work: Workspace, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """The kept terms of each group and the groups.

    Terms: ``lang, source, term, n, m, p, q`` with the counts in the group and in the language and their parts.
    Groups: ``lang, source, kept, base``: how many terms the language keeps, and the part of a count of 0.
    """
    # one shuffle by language and term serves the sums of the groups and of the language
    by_group = _counted(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    term = Window.partitionBy("lang", "term")
    whole = by_group.withColumn("m", F.sum("n").over(term)).withColumn("docs", F.sum("docs").over(term))
    lead = (F.row_number().over(term.orderBy("source")) == 1).cast("int")
    counts = whole.withColumn("lead", lead).where((F.col("docs") >= least) | F.col("term").isNull()).drop("docs")
    counts = work.table(counts, "counts")
    real = F.col("term").isNotNull()
    langs = counts.groupBy("lang").agg(
        F.coalesce(F.sum(F.when(real, F.col("lead"))), F.lit(0)).alias("kept"), F.sum("n").alias("all")
    )
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    base = F.when(F.col("kept") > 0, _part(F.lit(0), F.col("total"), F.greatest("kept", F.lit(1))))
    groups = work.table(groups.withColumn("base", base), "groups")
    found = counts.where(real).join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "m",
        _part(F.col("n"), F.col("total"), F.col("kept")).alias("p"), _part(F.col("m"), F.col("all"), F.col("kept")).alias("q"),
    )
    return work.table(found, "terms"), groups.select("lang", "source", "kept", "base")


def pair_values(found: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two different sources of a language."""
    one = groups.select("lang", "kept", "source", F.col("base").alias("here"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("there"))
    pairs = one.join(other, "lang").where(F.col("source") != F.col("item"))
    none = F.coalesce(_difference(F.col("here"), F.col("there")), F.lit(0))
    constants = pairs.select("lang", "source", "item", (F.col("kept") * none).alias("value"))

    parts = found.groupBy("lang", "source", "p").agg(F.count("*").alias("c"))
    single = parts.join(pairs, ["lang", "source"]).select(
        "lang", "source", "item",
        (F.col("c") * (_difference(F.col("p"), F.col("there")) - _difference(F.col("here"), F.col("there")))).alias("value"),
    ).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    based = found.join(groups, ["lang", "source"]).select("lang", "term", "source", "p", F.col("base").alias("here"))
    second = based.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"), F.col("here").alias("there"))
    p, r, here, there = map(F.col, ("p", "r", "here", "there"))
    shared = based.join(second, ["lang", "term"]).where(F.col("source") < F.col("item")).groupBy("lang", "source", "item").agg(
        F.sum(_difference(p, r) - _difference(p, there) - _difference(here, r) + _difference(here, there)).alias("value")
    )

    def turned(rows: DataFrame) -> DataFrame:
        return rows.unionByName(rows.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    everything = constants.unionByName(turned(single)).unionByName(turned(shared))
    return everything.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


class Skyband:
    """Terms of one group that fewer than ``k`` others dominate, offered by falling ``n``, then rising ``m``, then name.

    ``marks`` holds, for the kept terms by rising ``m``, the k-th earliest name so far: a term behind it has k that dominate it.
    It is made anew when a quarter more terms are kept; in between it lets some pass, which are compared with all.
    """

    def __init__(self, k: int):
        self.k = k
        self.m = np.empty(64, np.int64)
        self.names: list[bytes] = []
        self.sorted_m: list[int] = []
        self.marks: list[bytes] = []
        self.renew = 2 * k

    def _mark(self) -> None:
        order = np.argsort(self.m[: len(self.names)], kind="stable").tolist()
        earliest: list[bytes] = []
        self.sorted_m, self.marks = [], []
        for i in order:
            insort(earliest, self.names[i])
            del earliest[self.k :]
            if len(earliest) == self.k:
                self.sorted_m.append(int(self.m[i]))
                self.marks.append(earliest[-1])
        self.renew = len(self.names) * 5 // 4 + 1

    def offer(self, m: int, name: bytes) -> bool:
        """Whether the term is kept.  All that dominate it were offered before, and k of those that were kept do so too."""
        at = bisect_right(self.sorted_m, m)
        if at and self.marks[at - 1] < name:
            return False
        size = len(self.names)
        lower = np.flatnonzero(self.m[:size] <= m)
        if len(lower) >= self.k and sum(self.names[i] < name for i in lower.tolist()) >= self.k:
            return False
        if size == len(self.m):
            self.m = np.concatenate([self.m, np.empty(size, np.int64)])
        self.m[size] = m
        self.names.append(name)
        if len(self.names) >= self.renew:
            self._mark()
        return True


def _skybands(rows: DataFrame, k: int) -> DataFrame:
    """The skyband of every run of equal ``lang, source, part`` in each partition."""

    def run(batches):
        group, band = None, Skyband(k)
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "part")), strict=True)
            kept = []
            for i, (key, m, name) in enumerate(zip(keys, batch.column("m").to_pylist(), strings(batch.column("term")), strict=True)):
                if key != group:
                    group, band = key, Skyband(k)
                if band.offer(m, name):
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int32()))

    order = ["lang", "source", "part", F.col("n").desc(), "m", "term"]
    return rows.sortWithinPartitions(*order).mapInArrow(run, rows.schema)


def top_terms(found: DataFrame, k: int = 10) -> DataFrame:
    """``lang, source, item, value, rank`` of each group's ``k`` terms with the greatest values."""
    rows = found.where((F.col("n") > 0) & (F.col("p") > F.col("q"))).withColumn("part", F.spark_partition_id())
    parts = max(1, found.rdd.getNumPartitions())
    rows = _skybands(rows, k)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        rows = _skybands(rows.repartition("lang", "source", "part"), k)
    valued = rows.select("lang", "source", F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))
    return _ranked(valued).where(F.col("rank") <= k)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, work: Workspace, least: int = 10, k: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of sources and each group's first ``k`` terms."""
    found, groups = kept_terms(docs, work, least)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = _ranked(pair_values(found, groups)).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(top_terms(found, k).withColumn("part", F.lit("term")).select(columns))
