"""Shortest-pack-first packing over the length histogram.

Texts become pieces of at most ``capacity`` tokens.  Only the histogram of their lengths, at most
``capacity`` rows, reaches the driver.  There lengths are placed longest first, each into the pack pattern
that is filled least, a pattern counting for all sequences that look alike.  The patterns are joined back to the
pieces by their rank among the pieces of the same length.  A sequence is padded to the capacity, unless what it
holds is a power of two.

Size of what is broadcast: placing a length splits at most one pattern and opens at most one, so there are at
most ``2 * capacity`` patterns, and a pattern holds at most ``sqrt(2 * capacity)`` different lengths; for 4096 that
is 8,192 * 90 slots of 40 bytes at the most.

Defined cases: a null or empty text is one piece of the end id alone.  Repeated rows are packed each for itself.
A null id stays null.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starblend.llm.common import strings
from starblend.llm.token_ids import encoder
from starblend.workspace import Workspace

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096) -> DataFrame:
    """The token pieces of ``docs`` (``doc_id, text``), each with the checksum of its ids."""

    def cut(batches):
        ids_of = encoder(tokenizer, end_id)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of.encode(strings(batch.column("text"))), strict=True):
                data = ids.astype("<u4").tobytes()
                rows += [
                    (doc, at, min(capacity, len(ids) - at), zlib.crc32(data[4 * at : 4 * (at + capacity)]), len(ids))
                    for at in range(0, len(ids), capacity)
                ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )
        ids_of.rest()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """``(count, lengths)`` of the packs that hold the whole histogram, longest lengths first."""
    heap: list[tuple[int, int, int, tuple]] = []
    made = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            made += 1
            if not heap or heap[0][0] + length > capacity:
                heapq.heappush(heap, (length, made, left, (length, None)))
                break
            filled, number, count, chain = heapq.heappop(heap)
            taken = min(count, left)
            heapq.heappush(heap, (filled + length, made, taken, (length, chain)))
            if count > taken:
                heapq.heappush(heap, (filled, number, count - taken, chain))
            left -= taken
    out = []
    for _, _, count, chain in sorted(heap, key=lambda e: (-e[0], e[1])):
        lengths = []
        while chain is not None:
            lengths.append(chain[0])
            chain = chain[1]
        out.append((count, tuple(reversed(lengths))))
    return out


def slots(packs: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows ``length, first rank, count, first sequence, offset, times``: where the pieces of a length go."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for count, lengths in packs:
        offset = 0
        for length, times in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, used[length], count, sequence, offset, times))
            used[length] += count * times
            offset += length * times
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def pack(parts: DataFrame, work: Workspace, capacity: int = 4096) -> DataFrame:
    """``parts`` (with ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    columns = parts.columns
    staged = work.table(parts.withColumn("_place", F.monotonically_increasing_id()), "pieces")
    staged = staged.withColumn("_part", F.shiftright("_place", 33))
    counts = work.table(staged.groupBy("length", "_part").agg(F.count("*").alias("_n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    local = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_place")) - 1
    ranked = staged.withColumn("_local", local).join(firsts.hint("merge"), ["length", "_part"])
    ranked = ranked.select(*columns, (F.col("_first") + F.col("_local")).alias("_rank"))
    plan = parts.sparkSession.sparkContext.broadcast(slots(patterns(histogram, capacity)))

    def place(batches):
        rows = plan.value
        key = rows[:, 0] << 40 | rows[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            if not len(length):
                continue
            _, first, count, sequence, offset, _ = rows[np.searchsorted(key, length << 40 | rank, side="right") - 1].T
            slot, copy = np.divmod(rank - first, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(sequence + copy), pa.array(offset + slot * length)],
                names=[*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
