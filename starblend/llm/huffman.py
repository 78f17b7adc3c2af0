"""Token ids in files of canonical, length-limited Huffman codes.

A folder holds three parquet tables.  ``codebook`` has the code length of every id that occurs; the canonical
codes follow from it.  ``blocks`` has, for a run of whole documents in ascending order of their ids, the
position of the first token, the coded bits, the bit offset of every 256th token, and each document's id, start and
number of tokens.  A block needs only the codebook to be read.  Decoding takes one token of every 256 at a time for
all checkpoints of a block, each by one look-up in a table of all bit strings of the greatest code length.

Order: ascending id, null ids first, equal ids by a hash of their text; every row counts for itself.  A null or
empty text is the end id alone.  An empty table gives an empty codebook and no blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starblend.llm.common import steps, strings
from starblend.llm.token_ids import encoder
from starblend.workspace import Workspace

LIMIT = 20
STRIDE = 256
BLOCK_IDS = 1 << 18
BLOCKS = """first long, n_ids long, checkpoints binary, bits binary,
docs array<struct<doc_id: long, start: long, n_tokens: long>>"""


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(float)
    items, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        items.append(order < len(weights))
        ordered = merged[order]
        ordered = ordered[: len(ordered) // 2 * 2]
        packages = ordered[0::2] + ordered[1::2]
    take, lengths = 2 * len(used) - 2, np.zeros(len(used), dtype=np.int64)
    for level in reversed(items):
        single = int(level[:take].sum())
        lengths[:single] += 1
        take = 2 * (take - single)
    out[used] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The canonical code of every symbol: by length, then by symbol."""
    codes, code, last = np.zeros(len(lengths), dtype=np.uint64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    by_length = np.bincount(lengths[order], minlength=int(lengths.max(initial=0)) + 1)
    at = 0
    for length in range(1, len(by_length)):
        code <<= length - last
        n, last = int(by_length[length]), length
        codes[order[at : at + n]] = code + np.arange(n)
        code, at = code + n, at + n
    return codes


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids`` and the bit offset of every ``STRIDE``-th.

    Codes are put into words of 64 bits; of those that begin in a word at most the last reaches into the next.
    """
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    if not len(ids):
        return b"", starts
    word = starts >> 6
    room = 64 - (starts & 63) - size
    code = codes[ids]
    over = np.flatnonzero(room < 0)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    placed = code << np.maximum(room, 0).astype(np.uint64)
    placed[over] = code[over] >> (-room[over]).astype(np.uint64)
    out = np.zeros(int(ends[-1] + 63 >> 6), dtype=np.uint64)
    out[word[first]] = np.bitwise_or.reduceat(placed, first)
    out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7 >> 3)], starts[::STRIDE]


class Decoder:
    """Look-up tables of one codebook."""

    def __init__(self, lengths: np.ndarray):
        self.width = int(lengths.max(initial=0)) or 1
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        self.symbol = np.repeat(order.astype(np.uint32), 1 << (self.width - lengths[order]))
        self.length = lengths[self.symbol].astype(np.int64)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All ``n`` ids: one of each stride at a time, all strides together."""
        data = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
        words = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]  # the 32 bits from each byte on
        out = np.zeros((len(checkpoints), STRIDE), dtype=np.uint32)
        at = checkpoints.astype(np.int64).copy()
        most = len(self.symbol) - 1
        for step in range(STRIDE):
            live = len(at) if (len(at) - 1) * STRIDE + step < n else len(at) - 1
            now = at[:live]
            window = (words[now >> 3] >> (32 - self.width - (now & 7)).astype(np.uint32)) & np.uint32((1 << self.width) - 1)
            window = np.minimum(window, most)
            out[:live, step] = self.symbol[window]
            at[:live] = now + self.length[window]
        return out.ravel()[:n]


def write(docs: DataFrame, folder: str, work: Workspace, tokenizer: str, end_id: int) -> None:
    """Write the ids of ``docs`` (``doc_id, text``) to ``folder``."""
    spark = docs.sparkSession
    schema = "part int, doc_id long, start long, n_tokens long, ids binary"

    def number(batches):
        ids_of, at = encoder(tokenizer, end_id), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            texts = strings(batch.column("text"))
            for lo, hi in steps(texts):
                ids = list(ids_of.encode(texts[lo:hi]))
                sizes = np.array([len(x) for x in ids], dtype=np.int64)
                ends = at + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), batch.column("doc_id").slice(lo, hi - lo), pa.array(ends - sizes),
                     pa.array(sizes), pa.array([x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids], pa.binary())],
                    names=["part", "doc_id", "start", "n_tokens", "ids"],
                )
                at = int(ends[-1])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = texts.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    path = work.path("ids")
    ordered.mapInArrow(number, schema).write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(schema).parquet(path)

    def histogram(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                seen = np.bincount(np.concatenate(list(_ids(batch))), minlength=len(total))
                seen[: len(total)] += total
                total = seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    found = staged.select("n_tokens", "ids").mapInArrow(histogram, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=-1) + 1, dtype=np.int64)
    for row in found:
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    sizes = staged.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    firsts, at = {}, 0
    for row in sizes:
        firsts[row["part"]], at = at, at + row["n"]

    def blocks(batches):
        held: list[tuple] = []
        size = 0

        def close():
            ids = np.concatenate([x[3] for x in held])
            bits, marks = encode(ids, lengths, codes)
            return (held[0][1], len(ids), marks.astype("<i8").tobytes(), bits, [{"doc_id": d, "start": s, "n_tokens": n} for d, s, n, _ in held])

        for batch in batches:
            rows = []
            parts, docs_of, starts = (batch.column(c).to_pylist() for c in ("part", "doc_id", "start"))
            for part, doc, start, ids in zip(parts, docs_of, starts, _ids(batch), strict=True):
                start += firsts[part]
                if held and (size >= BLOCK_IDS or held[-1][1] + held[-1][2] != start):
                    rows.append(close())
                    held, size = [], 0
                held.append((doc, start, len(ids), ids))
                size += len(ids)
            yield _block_batch(rows)
        if held:
            yield _block_batch([close()])

    staged.mapInArrow(blocks, BLOCKS).write.parquet(f"{folder}/blocks")
    book = pd.DataFrame({"id": np.flatnonzero(lengths), "length": lengths[lengths > 0]}, dtype="int64")
    spark.createDataFrame(book, "id long, length long").coalesce(1).write.parquet(f"{folder}/codebook")


def _ids(batch: pa.RecordBatch):
    for n, data in zip(batch.column("n_tokens").to_pylist(), batch.column("ids").to_pylist(), strict=True):
        yield np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), _DOCS]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
        names=["first", "n_ids", "checkpoints", "bits", "docs"],
    )


def _lengths(spark: SparkSession, folder: str) -> np.ndarray:
    book = spark.read.parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max((r["id"] for r in book), default=-1) + 1, dtype=np.int64)
    for row in book:
        lengths[row["id"]] = row["length"]
    return lengths


def read(spark: SparkSession, folder: str, of_ids, schema: str) -> DataFrame:
    """Decode the files of ``folder``; ``of_ids(doc_id, start, ids)`` gives each document's row."""
    lengths = _lengths(spark, folder)

    def decode(batches):
        decoder = Decoder(lengths)
        for batch in batches:
            rows = []
            for block in batch.to_pylist():
                ids = decoder.decode(block["bits"], np.frombuffer(block["checkpoints"], "<i8"), block["n_ids"])
                for doc in block["docs"]:
                    at = doc["start"] - block["first"]
                    rows.append(of_ids(doc["doc_id"], doc["start"], ids[at : at + doc["n_tokens"]]))
            yield pd.DataFrame(rows, columns=names)

    names = [part.split()[0] for part in schema.split(",")]

    def arrow(batches):
        for frame in decode(batches):
            yield pa.RecordBatch.from_pandas(frame.astype({c: "Int64" for c in names}), preserve_index=False)

    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").mapInArrow(arrow, schema)


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""
    return read(
        spark, folder, lambda doc, start, ids: (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
        "doc_id long, start long, n_tokens long, ids_crc32 long",
    )
