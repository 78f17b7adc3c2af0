"""Phrase collocations from counting quotient filters.

1. Tasks turn texts into streams of word numbers of their own, one stream for about ``CHUNK_WORDS`` words of a language, and
   send its different words with their counts, packed by hash bucket.  Words that occur at least ``least`` times in their language
   get dense ids, which go back to the streams that hold them; every other word ends a run like punctuation does, as no phrase
   with it is frequent.
2. For 2 to 5 words in turn, each task counts the phrases of its streams in a quotient filter (``quotient_filter.py``), cut into
   buckets by its first bits.  The sorted filters of all tasks are merged bucket by bucket.  What occurs ``least`` times stays.
   A phrase is counted only if both phrases that are one word shorter may be frequent.  Tasks ask a map of
   ``2 ** MARK_BITS`` bits, one for all frequent phrases of the same first bits.  Its size does not grow: with very many frequent
   phrases it lets more through, which costs time and changes nothing.
3. Scores come from joins of the frequent phrases with themselves, as every part of a frequent phrase is frequent.

A phrase inside a longer one of the same count is dropped; a phrase that is one word longer tells, as counts only fall.

Defined cases: null text is empty, null lang is ``und``.  Repeated rows count each for itself.  A language without candidates, and
an empty table, give no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starblend.llm.common import STEP_BYTES, strings
from starblend.llm.quotient_filter import Lanes, Shape
from starblend.workspace import Workspace

LONGEST = 5
#: Words of a stream, and different words of a task's open streams, at which streams are closed.
CHUNK_WORDS = 1 << 20
OPEN_WORDS = 1 << 18
#: Phrases that a task counts at once.
HELD = 3 << 20
MARK_BITS = 27

# A-Z in lower case, a tab as a space, and every character that ends a piece as a line feed.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else 0x0A if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256)
)
_BORDER = re.compile(rb"[ \n]")


def _cut(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    at = 0
    while at < len(text):
        border = _BORDER.search(text, at + STEP_BYTES) if len(text) - at > STEP_BYTES else None
        stop = border.start() if border else len(text)
        yield text[at:stop]
        at = stop


class _Numbers(dict):
    """Numbers words from 1 in the order they come up; the end of a piece is 0, and nothing between two spaces -1."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number


class _Stream:
    """The words of one language as numbers; 0 ends a piece."""

    def __init__(self):
        self.numbers = _Numbers()
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, text: bytes) -> int:
        """Append a text and say how many words are new."""
        numbers = self.numbers
        before = len(numbers)
        for part in _cut((text + b"\n").translate(_BYTES)):
            words = part.replace(b"\n", b" \n ").split(b" ")
            part = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
            self.parts.append(part[part >= 0])
            self.words += len(self.parts[-1])
        return len(numbers) - before

    def rows(self, chunk: int, lang: str, bits: int) -> pa.RecordBatch:
        """The stream, and its words by bucket; they are numbered anew in the order of their buckets."""
        words = list(self.numbers)[2:]
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & ((1 << bits) - 1)
        order = np.argsort(bucket, kind="stable")
        number = np.zeros(len(words) + 1, np.int32)
        number[order + 1] = np.arange(1, len(words) + 1)
        stream = number[np.concatenate(self.parts)]
        times = np.bincount(stream, minlength=len(words) + 1)[1:]
        bucket = bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(words) else np.empty(0, np.int64)
        bounds = pa.array(np.r_[0, first, len(words)] if len(words) else [0, 0], pa.int32())
        n = len(bounds) - 1
        spelled = pa.array([words[i] for i in order.tolist()], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, chunk), pa.int64()), pa.array([-1, *bucket[first].tolist()], pa.int32()),
                pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))),
                pa.ListArray.from_arrays(bounds, spelled), pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64())),
                pa.array([_pressed(stream), *[None] * (n - 1)], pa.binary()),
            ],
            names=["chunk", "bucket", "lang", "words", "times", "stream"],
        )


def _pressed(stream: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(stream, "<i4").tobytes())


def _unpressed(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4")


def _streams(docs: DataFrame, work: Workspace) -> DataFrame:
    """``chunk, bucket, lang, words, times, stream``: bucket -1 has the stream of a chunk, the others its words in order."""
    bits = min(17, docs.rdd.getNumPartitions().bit_length() + 1)

    def run(batches) -> Iterator[pa.RecordBatch]:
        chunk, held, streams = TaskContext.get().partitionId() << 32, 0, {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), strings(batch.column("text")), strict=True):
                stream = streams.setdefault(lang, _Stream())
                held += stream.add(text) + 1
                if stream.words >= CHUNK_WORDS:
                    yield streams.pop(lang).rows(chunk, lang, bits)
                    held -= len(stream.numbers)
                    chunk += 1
                if held >= OPEN_WORDS:
                    for name, stream in streams.items():
                        yield stream.rows(chunk, name, bits)
                        chunk += 1
                    held, streams = 0, {}
        for name, stream in streams.items():
            yield stream.rows(chunk, name, bits)
            chunk += 1

    named = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    schema = "chunk long, bucket int, lang string, words array<string>, times array<long>, stream binary"
    return work.table(named.mapInArrow(run, schema), "streams")


def _answers(streams: DataFrame, least: int, work: Workspace) -> DataFrame:
    """Of each bucket its frequent words (``lang, word, n, local``), and for each chunk (``chunk, locals``) which of them it sent.

    ``local`` counts the frequent words of a bucket from 1 and is 0 for any other word.
    """

    def count(key, table):
        table = table.combine_chunks()
        lists = table.column("words").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        words, lang = lists.flatten().dictionary_encode(), table.column("lang").combine_chunks().dictionary_encode()
        code = words.indices.to_numpy() + len(words.dictionary) * np.repeat(lang.indices.to_numpy().astype(np.int64), size)
        code, first, back = np.unique(code, return_index=True, return_inverse=True)
        order = np.argsort(back, kind="stable")
        times = table.column("times").combine_chunks().flatten().to_numpy()
        total = np.add.reduceat(times[order], np.r_[0, np.cumsum(np.bincount(back))[:-1]]) if len(code) else np.empty(0, np.int64)
        local = np.cumsum(total >= least) * (total >= least)
        often, found = np.flatnonzero(local), len(table)
        ends = np.cumsum(size)
        locals_of = local[back].astype("<i4")
        n = len(often)
        return pa.table({
            "bucket": pa.array(np.full(n + found, key[0].as_py()), pa.int32()),
            "lang": pa.chunked_array([lang.dictionary.take(pa.array(code[often] // max(1, len(words.dictionary)))), pa.nulls(found, pa.string())]),
            "word": pa.chunked_array([words.dictionary.take(pa.array(code[often] % max(1, len(words.dictionary)))), pa.nulls(found, pa.string())]),
            "n": pa.chunked_array([pa.array(total[often], pa.int64()), pa.nulls(found, pa.int64())]),
            "local": pa.chunked_array([pa.array(local[often], pa.int64()), pa.nulls(found, pa.int64())]),
            "chunk": pa.chunked_array([pa.nulls(n, pa.int64()), table.column("chunk").combine_chunks()]),
            "locals": pa.array([*[None] * n, *(_pressed(locals_of[b - k : b]) for b, k in zip(ends, size, strict=True))], pa.binary()),
        })

    sent = streams.where("bucket >= 0").select("bucket", "chunk", "lang", "words", "times")
    schema = "bucket int, lang string, word string, n long, local long, chunk long, locals binary"
    return work.table(sent.groupBy("bucket").applyInArrow(count, schema), "answers")


def _id_streams(streams: DataFrame, answers: DataFrame, offsets: dict[int, int], work: Workspace) -> DataFrame:
    """``ids``: the streams in ids; 0 for the end of a piece and for any word that is not frequent."""
    replies = answers.where("chunk IS NOT NULL").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "locals"))).alias("replies"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stream, told in zip(batch.column("stream"), batch.column("replies"), strict=True):
                known = [np.zeros(1, np.int64)]
                for reply in told.as_py():
                    local = _unpressed(reply["locals"]).astype(np.int64)
                    known.append(np.where(local > 0, local + offsets.get(reply["bucket"], 0), 0))
                found = np.concatenate(known)[_unpressed(stream.as_py())]
                found = found[(found > 0) | np.r_[True, found[:-1] > 0]]
                yield pa.RecordBatch.from_arrays([pa.array([_pressed(found)], pa.binary())], names=["ids"])

    joined = streams.where("bucket = -1").select("chunk", "stream").join(replies, "chunk")
    return work.table(joined.drop("chunk").mapInArrow(run, "ids binary"), "id-streams")


def _phrases(ids: np.ndarray, shapes: dict[int, Shape], marks: dict[int, np.ndarray], words: int, mark_bits: int) -> Lanes:
    """The permuted phrases of ``words`` ids whose shorter parts may all be frequent."""
    open_at = ids > 0
    for k in range(2, words + 1):
        open_at = open_at[:-1] & open_at[1:]
        at = np.flatnonzero(open_at)
        lanes = shapes[k].permute(shapes[k].pack([ids[at + j] for j in range(k)]))
        if k < words:
            bit = shapes[k].head(lanes, min(mark_bits, shapes[k].head_bits))
            open_at[at[(marks[k][bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 0]] = False
    return lanes


def _counted(ids: DataFrame, shapes: dict[int, Shape], marks: dict, words: int, bucket_bits: int, least: int, work: Workspace) -> DataFrame:
    """``bucket, data, marks`` of the frequent phrases of ``words`` ids; ``marks`` is the bucket's slice of the bit map."""
    shape = shapes[words]
    most_bits = MARK_BITS
    mark_bits = min(most_bits, shape.head_bits)
    shared = ids.sparkSession.sparkContext.broadcast(marks)

    def send(batches) -> Iterator[pa.RecordBatch]:
        held: list[Lanes] = []

        def rows() -> pa.RecordBatch:
            lanes, counts = shape.tally([np.concatenate(parts) for parts in zip(*held, strict=True)])
            held.clear()
            buckets = list(shape.write(lanes, counts, bucket_bits))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in buckets], pa.int32()), pa.array([d for _, d in buckets], pa.binary())], names=["bucket", "data"]
            )

        for batch in batches:
            for data in batch.column("ids"):
                held.append(_phrases(_unpressed(data.as_py()), shapes, shared.value, words, most_bits))
                if sum(len(lanes[0]) for lanes in held) >= HELD:
                    yield rows()
        if held:
            yield rows()

    def merge(key, frame):
        bucket = int(key[0])
        parts = [shape.read(bucket, data, bucket_bits) for data in frame["data"]]
        lanes, counts = shape.tally(
            [np.concatenate(lane) for lane in zip(*(lanes for lanes, _ in parts), strict=True)], np.concatenate([c for _, c in parts])
        )
        often = counts >= least
        lanes, counts = [lane[often] for lane in lanes], counts[often]
        if not len(counts):
            return pd.DataFrame({"bucket": [], "data": [], "marks": []})
        seen = np.zeros(1 << mark_bits - bucket_bits, bool)
        seen[shape.head(lanes, mark_bits) & (len(seen) - 1)] = True
        data = [d for _, d in shape.write(lanes, counts, bucket_bits)]
        return pd.DataFrame({"bucket": [bucket], "data": data, "marks": [zlib.compress(np.packbits(seen).tobytes(), 1)]})

    sent = ids.mapInArrow(send, "bucket int, data binary")
    merged = sent.groupBy("bucket").applyInPandas(merge, "bucket int, data binary, marks binary")
    return work.table(merged, f"phrases-{words}")


def _marks(counted: DataFrame, shape: Shape, bucket_bits: int) -> np.ndarray:
    """The bit map of the frequent phrases, at most ``2 ** MARK_BITS`` bits."""
    size = 1 << min(MARK_BITS, shape.head_bits) - bucket_bits
    out = np.zeros((1 << bucket_bits) * max(1, size >> 3), np.uint8)
    for row in counted.select("bucket", "marks").collect():
        part = np.frombuffer(zlib.decompress(row["marks"]), np.uint8)
        out[row["bucket"] * len(part) : (row["bucket"] + 1) * len(part)] = part
    return out


def _listed(counted: DataFrame, shape: Shape, bucket_bits: int) -> DataFrame:
    """``gram, f`` of the phrases of a merged filter."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                lanes, counts = shape.read(bucket, data, bucket_bits)
                ids = np.stack(shape.unpack(shape.restore(lanes)), 1).astype(np.int32)
                bounds = np.arange(0, ids.size + 1, shape.words, dtype=np.int32)
                grams = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.ravel()))
                yield pa.RecordBatch.from_arrays([grams, pa.array(counts, pa.int64())], names=["gram", "f"])

    return counted.select("bucket", "data").mapInArrow(run, "gram array<int>, f long")


def frequent_phrases(streams: DataFrame, least: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """``id, lang, word`` of the frequent words, and ``gram, f``: each of them and each phrase of up to ``LONGEST``, with its count."""
    answers = _answers(streams, least, work)
    often = answers.where("word IS NOT NULL")
    offsets, at = {}, 0  # at most as many as there are buckets
    for row in often.groupBy("bucket").count().collect():
        offsets[row["bucket"]], at = at, at + row["count"]
    starts = streams.sparkSession.createDataFrame(list(offsets.items()), "bucket int, start long")
    words = often.join(F.broadcast(starts), "bucket").select((F.col("start") + F.col("local")).cast("int").alias("id"), "lang", "word", "n")
    words = work.table(words, "vocabulary")
    ids = _id_streams(streams, answers, offsets, work)
    bits = max(1, at.bit_length())
    shapes = {k: Shape(k, bits) for k in range(2, LONGEST + 1)}
    partitions = (4 * ids.rdd.getNumPartitions()).bit_length()
    marks: dict[int, np.ndarray] = {}
    out = words.select(F.array("id").alias("gram"), F.col("n").alias("f"))
    for k, shape in shapes.items():
        bucket_bits = max(0, min(partitions, 17, MARK_BITS - 3, shape.head_bits - 3))
        counted = _counted(ids, shapes, marks, k, bucket_bits, least, work)
        out = out.unionByName(_listed(counted, shape, bucket_bits))
        if k < LONGEST:
            marks = {**marks, k: _marks(counted, shape, bucket_bits)}
    return words.select("id", "lang", "word"), work.table(out, "frequent")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)), exact beyond 64 bits."""
    over = (F.lit(1000) * a).cast("decimal(19,0)") * n.cast("decimal(18,0)")
    return F.call_function("div", over, left.cast("decimal(18,0)") * right.cast("decimal(18,0)")).cast("long")


def collocations(docs: DataFrame, work: Workspace, least: int = 100, most: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``most`` phrases."""
    streams = _streams(docs, work)
    totals = streams.groupBy("lang").agg(F.sum(F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    words, found = frequent_phrases(streams, least, work)

    size = F.size("gram")
    longer = found.where(size > 2).select(
        F.explode(F.array(F.slice("gram", F.lit(1), size - 1), F.slice("gram", F.lit(2), size - 1))).alias("gram"), "f"
    ).groupBy("gram").agg(F.max("f").alias("longest"))
    kept = found.where(size > 1).join(longer, "gram", "left").where(F.coalesce(F.col("longest") < F.col("f"), F.lit(True)))
    cuts = kept.select("gram", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("gram", F.lit(1), F.col("k"))).withColumn("right", F.slice("gram", F.col("k") + 1, size - F.col("k")))
    cuts = cuts.join(found.select(F.col("gram").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(found.select(F.col("gram").alias("right"), F.col("f").alias("r")), "right")
    words = words.join(totals, "lang")
    scored = cuts.join(words.drop("word"), F.element_at("left", 1) == F.col("id"))
    scored = scored.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = scored.groupBy("gram", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    letters = best.select("gram", F.posexplode("gram").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = letters.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    named = best.join(spelled, "gram").select(
        "lang", F.array_join("spelled.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
