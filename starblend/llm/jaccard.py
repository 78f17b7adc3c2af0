"""Exact n-gram Jaccard join with prefix trees: similarity classes of documents.

1. Whole texts become sets of shingle hashes.  Counts over all documents tell which hashes occur in one
   document only.  Two sets can reach 80 % only if at most a fifth of either is found nowhere else, so most
   documents are settled here.  The counts go through packed buckets: every chunk of texts sends each of its
   hashes once, however often it holds it, so a hash of all documents costs one entry for each chunk.
2. Of equal sets one stays.  Their hashes are counted again and put in one global order, rare ones first.
   Two sets that link share a hash among the first ``n / 5 + 1`` of both.
3. All sets with such a hash meet the least of them.  They form teams, in which a prefix tree finds all links.
   A team that is too large is split, its parts meet the same least set, and what is then still apart
   meets part by part.  Nothing is dropped, and connected copies are never paired.
4. Star contraction gives the components.

Where links are counted or listed (``linked_classes``, ``similarity_links``), all sets of a team meet.  A large team
is split by length, as sets of lengths more than a factor 1.25 apart never link, and by hash within a length
class.  A set goes only to the lengths that it can link with: its first shared token stands at some place in its
order, so at most the tokens from there on are common.  Two sets may meet in several teams; the link counts in the
team of their first common token.

A hash is a 64-bit value of the words' bytes (the ordered sets keep 56 bits and a frequency class); different
shingles are taken as equal with a chance of about 1e-17 a pair.

Defined cases: null or empty text has the empty set and is linked with nothing.  A row with a null id is
returned with its set size and a null component and links nothing.  Repeated rows are in one component; an id
that occurs with several texts connects nothing by itself.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starblend.llm.common import steps, strings
from starblend.llm.components import components
from starblend.llm.prefix_tree import LevelTree, links, ragged
from starblend.llm.shingles import shingle_sets
from starblend.workspace import Workspace

CHUNK_BYTES = 8 << 20
TEAM_SETS = 512
TEAM_TOKENS = 2_000_000
BLOCK_SETS = 2048
LENGTH_CLASS = 1.26  # more than 1.25, so that linked sets are at most one class apart
SHARED = 0xFFFF  # in place of a document's number: several documents of the chunk hold the hash
ENTRY = np.dtype([("rest", "<u4"), ("doc", "<u2")])
INFO = np.dtype([("doc", "<i8"), ("known", "u1"), ("n", "<u8"), ("lone", "<u8"), ("fp1", "<i8"), ("fp2", "<i8")])
PACKED = "bucket int, chunk long, kind int, data binary"


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of ``data`` between ``bounds`` as one binary column."""
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _rest(keys: np.ndarray, bits: int) -> np.ndarray:
    """What 48-bit keys hold beyond their bucket, 32 bits at most."""
    if bits >= 16:
        return (keys & np.uint64((1 << (48 - bits)) - 1)).astype(np.uint32)
    return ((keys >> np.uint64(16 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _bucket_bounds(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (keys >> np.uint64(48 - bits)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    return bucket[first].astype(np.int32), np.r_[first, len(bucket)]


def _rows(buckets, chunk: int, kind: int, data: pa.Array) -> pa.RecordBatch:
    n = len(data)
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(np.full(n, chunk), pa.int64()), pa.array(np.full(n, kind), pa.int32()), data],
        names=["bucket", "chunk", "kind", "data"],
    )


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one = np.array([int(s.sum(dtype=np.uint64)) for s in sets], dtype=np.uint64)
    two = np.array([int(np.bitwise_xor.reduce(s * np.uint64(0xD6E8FEB86659FD93) ^ (s >> np.uint64(29)))) if len(s) else 0 for s in sets], dtype=np.uint64)
    return one.view(np.int64), two.view(np.int64)


def _sorted_with_index(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit values in order and where each was."""
    both = np.sort((values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64))
    return both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _same_as_neighbour(x: np.ndarray) -> np.ndarray:
    same = np.zeros(len(x) + 1, bool)
    same[1:-1] = x[1:] == x[:-1]
    return same[1:] | same[:-1]


def _bits(df: DataFrame) -> int:
    """Buckets, as a power of two: a few for each input partition, so that a bucket stays small."""
    return min(24, max(6, (4 * df.rdd.getNumPartitions() - 1).bit_length()))


def _settled(docs: DataFrame, work: Workspace) -> DataFrame:
    """``doc_id, n, fp1, fp2, open`` of each document; open: at most a fifth of its hashes are its own."""
    bits = _bits(docs)

    def send(batches) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids = strings(batch.column("text")), batch.column("doc_id").to_pylist()
            for lo, hi in steps(texts, CHUNK_BYTES):
                sets = list(shingle_sets(texts[lo:hi]))
                sizes = np.array([len(s) for s in sets])
                v = np.concatenate(sets)
                v = np.sort((v & ~np.uint64(0xFFFF)) | np.repeat(np.arange(hi - lo, dtype=np.uint64), sizes))
                keys, docs_of = v >> np.uint64(16), (v & np.uint64(0xFFFF)).astype(np.uint16)
                many = _same_as_neighbour(keys)
                info = np.zeros(hi - lo, INFO)
                info["doc"] = [i or 0 for i in ids[lo:hi]]
                info["known"] = [i is not None for i in ids[lo:hi]]
                info["n"], info["lone"] = sizes, np.bincount(docs_of[~many], minlength=hi - lo)
                info["fp1"], info["fp2"] = _fingerprints(sets)
                keep = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.empty(0, bool)
                entries = np.zeros(int(keep.sum()), ENTRY)
                entries["rest"], entries["doc"] = _rest(keys[keep], bits), np.where(many, SHARED, docs_of)[keep]
                buckets, bounds = _bucket_bounds(keys[keep], bits)
                yield _rows([chunk % (1 << bits)], chunk, 1, pa.array([info.tobytes()], pa.binary()))
                if len(buckets):
                    yield _rows(buckets, chunk, 0, _binary(entries, bounds))
                chunk += 1

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        """Of one bucket: the documents, by chunk, whose hash another chunk holds too."""
        passed = frame[frame["kind"] == 1][["chunk", "kind", "data"]]
        frame = frame[frame["kind"] == 0]
        entries = np.frombuffer(b"".join(frame["data"]), ENTRY)
        chunk = np.repeat(np.arange(len(frame)), frame["data"].map(len).to_numpy(dtype=np.int64) // ENTRY.itemsize)
        ordered, place = _sorted_with_index(entries["rest"])
        place = place[_same_as_neighbour(ordered)]
        place = np.sort(place[entries["doc"][place] != SHARED])
        owner, doc = chunk[place], entries["doc"][place]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)
        bounds = np.r_[first, len(owner)]
        chunks = frame["chunk"].to_numpy()
        rows = [(chunks[owner[a]], 0, doc[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pd.concat([passed, pd.DataFrame(rows, columns=["chunk", "kind", "data"])], ignore_index=True)

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        """Of one chunk: each document's row."""
        info = np.frombuffer(frame[frame["kind"] == 1]["data"].iloc[0], INFO)
        shared = np.frombuffer(b"".join(frame[frame["kind"] == 0]["data"]), np.uint16)
        own = info["lone"].astype(np.int64) - np.bincount(shared, minlength=len(info))
        n, known = info["n"].astype(np.int64), info["known"] == 1
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(info["doc"].astype(np.int64), ~known),
            "n": n, "fp1": info["fp1"].astype(np.int64), "fp2": info["fp2"].astype(np.int64),
            "open": known & (n > 0) & (5 * own <= n),
        })

    packed = docs.select("doc_id", "text").mapInArrow(send, PACKED)
    replies = packed.groupBy("bucket").applyInPandas(count, "chunk long, kind int, data binary")
    rows = replies.groupBy("chunk").applyInPandas(finish, "doc_id long, n long, fp1 long, fp2 long, open boolean")
    return work.table(rows, "settled")


def _ordered_sets(docs: DataFrame, reps: DataFrame, work: Workspace) -> DataFrame:
    """``rid, n, own, tokens`` of the open sets: tokens in the global order, the set's own ones left out."""
    named = docs.select(F.col("doc_id").cast("long"), "text").join(reps.hint("shuffle_hash"), "doc_id")

    def pack(batches) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = strings(batch.column("text"))
            rids, fp1, fp2 = (batch.column(c).to_numpy() for c in ("rid", "fp1", "fp2"))
            for lo, hi in steps(texts, CHUNK_BYTES):
                sets = list(shingle_sets(texts[lo:hi]))
                one, two = _fingerprints(sets)
                kept = np.flatnonzero((one == fp1[lo:hi]) & (two == fp2[lo:hi]))
                if len(kept):
                    sizes = np.array([len(sets[i]) for i in kept], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk]), *(pa.array([x.tobytes()], pa.binary()) for x in (rids[lo:hi][kept], sizes, np.concatenate([sets[i] for i in kept])))],
                        names=["chunk", "rids", "sizes", "tokens"],
                    )
                    chunk += 1

    sets = work.table(named.mapInArrow(pack, "chunk long, rids binary, sizes binary, tokens binary"), "sets")
    bits = _bits(sets)

    def send(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                keys, times = np.unique(np.frombuffer(data, np.uint64) >> np.uint64(16), return_counts=True)
                entries = np.zeros(len(keys), ENTRY)
                entries["rest"], entries["doc"] = _rest(keys, bits), np.minimum(times, 0xFFFF)
                buckets, bounds = _bucket_bounds(keys, bits)
                yield _rows(buckets, chunk, 0, _binary(entries, bounds))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        """Of one bucket: for each entry of each chunk the frequency class of its hash, 0 if it occurs once."""
        lengths = frame["data"].map(len).to_numpy(dtype=np.int64) // ENTRY.itemsize
        entries = np.frombuffer(b"".join(frame["data"]), ENTRY)
        _, where, back = np.unique(entries["rest"], return_index=True, return_inverse=True)
        total = np.bincount(back, weights=entries["doc"], minlength=len(where))
        kind = np.where(total < 2, 0, np.minimum(255, 8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)[back]
        ends = np.cumsum(lengths)
        return pd.DataFrame({
            "bucket": frame["bucket"], "chunk": frame["chunk"],
            "kinds": [kind[b - n : b].tobytes() for b, n in zip(ends, lengths, strict=True)],
        })

    def order(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Of one chunk: the ordered sets that are still open."""
        row = left.iloc[0]
        rids, sizes = np.frombuffer(row["rids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        tokens = np.frombuffer(row["tokens"], np.uint64)
        keys = np.unique(tokens >> np.uint64(16))
        kinds = np.frombuffer(b"".join(right.sort_values("bucket")["kinds"]), np.uint8)
        kind = kinds[np.searchsorted(keys, tokens >> np.uint64(16))].astype(np.uint64)
        tokens = (kind << np.uint64(56)) | (tokens >> np.uint64(8))
        out, start = [], 0
        for rid, n in zip(rids, sizes, strict=True):
            own = tokens[start : start + n]
            start += n
            shared = np.unique(own[own >> np.uint64(56) > 0])
            if 5 * (n - len(shared)) <= n:
                out.append((rid, n, n - len(shared), shared.view(np.int64)))
        return pd.DataFrame(out, columns=["rid", "n", "own", "tokens"])

    kinds = sets.select("chunk", "tokens").mapInArrow(send, PACKED).groupBy("bucket").applyInPandas(count, "bucket int, chunk long, kinds binary")
    ordered = sets.groupBy("chunk").cogroup(kinds.groupBy("chunk")).applyInPandas(order, "rid long, n long, own long, tokens array<long>")
    return work.table(ordered, "ordered")


def _solve(frame: pd.DataFrame) -> pd.DataFrame:
    """Links within each team of a task."""
    out = []
    for _, team in frame.groupby(["team", "part"], sort=False):
        team = team.drop_duplicates("rid")
        sets = [(int(r), np.asarray(t, np.int64).view(np.uint64)[::-1], int(n)) for r, t, n in zip(team["rid"], team["tokens"], team["n"], strict=True)]
        out += links(sets)
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _by_task(teams: DataFrame, sets: DataFrame) -> DataFrame:
    """``teams`` (``team, part, large, rid, n``) with the sets, and a ``task``: many small teams, or one part of a large one."""
    tokens = teams.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, int(tokens) // TEAM_TOKENS + 1) * 4
    task = F.when(F.col("large"), F.xxhash64("team", "part")).otherwise(F.pmod(F.xxhash64("team"), F.lit(tasks)))
    return teams.withColumn("task", task).drop("n", "large").join(sets, "rid").groupBy("task")


def _team_links(teams: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Links found in ``teams`` (``team, part, large, rid, n``)."""
    return work.table(_by_task(teams, sets.select("rid", "n", "tokens")).applyInPandas(_solve, "a long, b long"), "found")


def _length_class(n: Column) -> Column:
    return F.floor(F.log(n) / math.log(LENGTH_CLASS)).cast("int")


def _meetings(rows: DataFrame, work: Workspace) -> DataFrame:
    """``team, part, side, rid, n``: where the rows of large teams meet.

    ``rows`` are ``team, rid, n, main, least, most``: a row meets rows of lengths from ``least`` to ``most``, but rows
    marked ``main`` do not meet each other.  A part is a pair of blocks, or one block with itself; ``side`` is 0 or 1
    in a pair and 2 in a block with itself.
    """
    rows = work.table(rows.withColumn("length", _length_class(F.col("n"))), "large")
    units = rows.groupBy("team", "main", "length").agg(F.count("*").alias("c"), F.sum("n").alias("t"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("t") / TEAM_TOKENS)).cast("long")
    units = work.table(units.select("team", "main", "length", blocks.alias("blocks")), "units")
    unit = F.when(F.col("main"), 128).otherwise(0) + F.col("length")
    placed = rows.join(units, ["team", "main", "length"]).select(
        "team", "rid", "n", "main", _length_class(F.col("least")).alias("lo"), _length_class(F.col("most")).alias("hi"),
        F.struct(unit.alias("u"), F.pmod(F.xxhash64("rid"), F.col("blocks")).alias("b")).alias("own"),
    )
    lengths = placed.where("lo <= hi").withColumn("length", F.explode(F.sequence("lo", "hi"))).withColumnRenamed("main", "is_main")
    partners = lengths.join(units, ["team", "length"]).where("NOT (is_main AND main)")
    partners = partners.select("team", "rid", "n", "own", unit.alias("u"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"))
    other = F.struct("u", "b")
    first = F.col("own") < other
    side = F.when(F.col("own") == other, 2).when(first, 0).otherwise(1)
    part = F.when(first, F.xxhash64("own.u", "own.b", "u", "b")).otherwise(F.xxhash64("u", "b", "own.u", "own.b"))
    return work.table(partners.select("team", part.alias("part"), side.alias("side"), "rid", "n"), "meetings")


def _links(sets: DataFrame, work: Workspace) -> DataFrame:
    """Links ``a, b`` that connect all sets that are connected."""
    head = F.expr("cast(floor(n / 5) as int) + 1 - cast(own as int)")
    prefix = work.table(
        sets.select("rid", "n", F.explode(F.slice("tokens", F.lit(1), head)).alias("token")), "prefix"
    )
    least = prefix.groupBy("token").agg(F.min("rid").alias("team"), F.count("*").alias("c")).where("c > 1").select("token", "team")
    members = work.table(
        prefix.join(least, "token").where("rid <> team").select("team", "rid", "n").distinct(), "members"
    )
    sizes = members.groupBy("team").agg(F.count("*").alias("c"), F.sum("n").alias("t"))
    parts = F.greatest(F.ceil(F.col("c") / TEAM_SETS), F.ceil(F.col("t") / TEAM_TOKENS)).cast("int")
    sizes = work.table(sizes.select("team", parts.alias("parts")), "teams")
    dealt = members.join(sizes, "team").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
    heads = sizes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    heads = heads.join(sets.select(F.col("rid").alias("team"), "n"), "team").select("team", "part", (F.col("parts") > 1).alias("large"), F.col("team").alias("rid"), "n")
    split = (F.col("parts") > 1).alias("large")
    found = _team_links(dealt.select("team", "part", split, "rid", "n").unionByName(heads), sets, work)
    large = members.join(sizes.where("parts > 1"), "team")
    if large.isEmpty():
        return found
    return found.unionByName(_across(large, found, sets, work))


def _across(large: DataFrame, found: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Links between the parts of split teams, among members that are not connected yet.

    The members of a team's main component need not meet each other.  The others meet each other and them.
    """
    roots = components(found, work)
    marked = large.join(roots, large["rid"] == roots["node"], "left").select(
        "team", "rid", "n", F.coalesce("root", "rid").alias("root")
    )
    marked = work.table(marked, "marked")
    counts = marked.groupBy("team", "root").agg(F.count("*").alias("c"))
    main = counts.groupBy("team").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most"))
    apart = marked.join(main.where("`all` > most").select("team", "main"), "team").select(
        "team", "rid", "n", (F.col("root") == F.col("main")).alias("main"),
        F.ceil(F.col("n") * 0.8).alias("least"), F.floor(F.col("n") * 1.25).alias("most"),
    )
    teams = _meetings(apart, work).withColumn("large", F.lit(True))
    return _team_links(teams.select("team", "part", "large", "rid", "n"), sets, work)


def _all_teams(sets: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Teams in which all sets meet (``team, part, large, side, rid, n``), and the sets with the teams of their first tokens."""
    head = F.expr("cast(floor(n / 5) as int) + 1 - cast(own as int)")
    prefix = work.table(sets.select("rid", "n", "own", F.posexplode(F.slice("tokens", F.lit(1), head)).alias("pos", "token")), "prefix")
    least = prefix.groupBy("token").agg(F.min("rid").alias("team"), F.count("*").alias("c")).where("c > 1").select("token", "team")
    routes = work.table(prefix.join(least, "token").select("rid", "n", "own", "pos", "team"), "routes")
    members = work.table(routes.groupBy("team", "rid", "n").agg(F.min(F.col("own") + F.col("pos")).alias("before")), "members")
    sizes = members.groupBy("team").agg(F.count("*").alias("c"), F.sum("n").alias("t"))
    large = work.table(sizes.select("team", ((F.col("c") > BLOCK_SETS) | (F.col("t") > TEAM_TOKENS)).alias("large")), "teams")
    members = members.join(large, "team")
    # 180 common >= 80 (n + other) and common <= n - before
    most = F.least(F.floor(F.col("n") * 1.25), F.floor((5 * F.col("n") - 9 * F.col("before")) / 4))
    rows = members.where("large").select("team", "rid", "n", F.lit(False).alias("main"), F.ceil(F.col("n") * 0.8).alias("least"), most.alias("most"))
    small = members.where("NOT large").select("team", F.lit(0).cast("long").alias("part"), F.lit(2).alias("side"), "rid", "n")
    teams = small.withColumn("large", F.lit(False)).unionByName(_meetings(rows, work).withColumn("large", F.lit(True)))
    first = F.sort_array(F.collect_set(F.struct("pos", "team")))
    of = routes.groupBy("rid").agg(first.alias("first")).select("rid", F.col("first.pos").alias("places"), F.col("first.team").alias("leasts"))
    return teams, work.table(sets.join(of, "rid").dropDuplicates(["rid"]), "routed")  # a repeated row brings its set again


class _Team:
    """The sets that meet in one part of a team."""

    def __init__(self, team: int, frame: pd.DataFrame):
        self.team, self.rid = team, frame["rid"].to_numpy(np.int64)
        self.side, self.n = frame["side"].to_numpy(), frame["n"].to_numpy(np.int64)
        tokens = [np.asarray(t, np.int64).view(np.uint64) for t in frame["tokens"]]
        distinct, number = np.unique(np.concatenate(tokens), return_inverse=True)
        ends = np.cumsum([len(t) for t in tokens])
        self.tokens = np.split(number, ends[:-1])
        self.heads = np.array([len(x) for x in frame["places"]])
        self.head_at = np.cumsum(self.heads) - self.heads
        self.head = np.concatenate([t[np.asarray(p)] for t, p in zip(self.tokens, frame["places"], strict=True)])
        self.least = np.concatenate([np.asarray(x, np.int64) for x in frame["leasts"]])
        self.flags = np.zeros(len(distinct), np.int64)

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each set that asks and those it links with here, by their places; within one block both ask."""
        asked = np.flatnonzero(self.side > 0)
        tree = LevelTree([(i, self.tokens[i][::-1], int(self.n[i])) for i in asked]) if len(asked) else None
        for i in np.flatnonzero(self.side != 1) if tree else ():
            self.flags[self.tokens[i]] = 1
            found = tree.probe(self.tokens[i], self.flags, int(self.n[i]))
            found = found[found != i]
            if len(found):
                found = found[self._first_here(found)]
            self.flags[self.tokens[i]] = 0
            if len(found):
                yield i, found

    def _first_here(self, found: np.ndarray) -> np.ndarray:
        """Whether the first token in common with the marked set belongs to this team."""
        at = ragged(self.head_at[found], self.heads[found])
        marked = np.flatnonzero(self.flags[self.head[at]])
        ends = np.cumsum(self.heads[found])
        return self.least[at[marked[np.searchsorted(marked, ends - self.heads[found])]]] == self.team


def _parts(frame: pd.DataFrame) -> Iterator[_Team]:
    for (team, _), part in frame.groupby(["team", "part"], sort=False):
        yield _Team(team, part)


def _count(frame: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest (``a, b``) of the links of each part, and how many rows each set links with (``a, rows``)."""
    weight = frame.set_index("rid")["weight"].to_dict()
    out = []
    for team in _parts(frame):
        weights = np.array([weight[r] for r in team.rid], np.int64)
        rows, label = np.zeros(len(weights), np.int64), np.arange(len(weights))
        for i, found in team.links():
            rows[i] += weights[found].sum()
            if team.side[i] == 0:
                rows[found] += weights[i]
            others, where = np.unique(label[found], return_index=True)
            apart = others != label[i]
            if apart.any():
                out += [(team.rid[i], team.rid[found[w]], 0) for w in where[apart]]
                label[np.isin(label, others)] = label[i]
        out += [(r, r, c) for r, c in zip(team.rid, rows, strict=True) if c]
    return pd.DataFrame(out, columns=["a", "b", "rows"], dtype="int64")


def _list(frame: pd.DataFrame) -> pd.DataFrame:
    """Every link of each part once, the smaller set first."""
    out = [np.empty((0, 2), np.int64)]
    for team in _parts(frame):
        for i, found in team.links():
            pair = np.sort(np.c_[np.full(len(found), team.rid[i]), team.rid[found]], axis=1)
            out.append(pair if team.side[i] == 0 else pair[pair[:, 0] == team.rid[i]])
    return pd.DataFrame(np.concatenate(out), columns=["a", "b"])


def _distinct_sets(docs: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their set sizes, the different sets that may link (``rid``, ``weight`` rows), and their tokens."""
    settled = _settled(docs, work)
    reps = settled.where("open").groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("weight"))
    reps = work.table(reps.withColumn("rid", F.monotonically_increasing_id()), "reps")
    return settled, reps, _ordered_sets(docs, reps.select("doc_id", "rid", "fp1", "fp2"), work)


def _row_classes(docs: DataFrame, work: Workspace, count: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, fp1, fp2, root`` of every row of ``docs``.

    ``root`` is null for a class of one row, ``n_links`` wherever links are not counted.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    settled, reps, sets = _distinct_sets(docs, work)
    if count:
        teams, routed = _all_teams(sets, work)
        found = _by_task(teams, routed.join(reps.select("rid", "weight"), "rid").select("rid", "n", "tokens", "places", "leasts", "weight"))
        found = work.table(found.applyInPandas(_count, "a long, b long, rows long"), "counted")
        edges = found.where("a <> b").select("a", "b")
        met = found.where("a = b").groupBy(F.col("a").alias("rid")).agg(F.sum("rows").alias("rows"))
        reps = reps.join(met, "rid", "left").withColumn("links", F.coalesce("rows", F.lit(0)) + F.col("weight") - 1)
    else:
        edges = _links(sets, work)
        reps = reps.withColumn("links", F.lit(None).cast("long"))
    roots = components(edges, work)
    of = reps.join(roots, reps["rid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "rid"))
    least = of.groupBy("root").agg(F.min("doc_id").alias("least"))
    classes = work.table(of.join(least, "root").select("fp1", "fp2", "n", "least", "links", "root"), "classes")
    classes = classes.withColumn("open", F.lit(True))
    return settled.join(classes, ["fp1", "fp2", "n", "open"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
        (F.coalesce("links", F.lit(0)) if count else F.col("links")).alias("n_links"), "fp1", "fp2", "root",
    )


def similarity_classes(docs: DataFrame, work: Workspace) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id, text``)."""
    return _row_classes(docs, work).select("doc_id", "n_shingles", "component_id")


def linked_classes(docs: DataFrame, work: Workspace) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``docs`` (``doc_id, text``).

    ``n_links`` is the number of other rows that the row links with, rows of equal sets included; 0 with a null id.
    """
    return _row_classes(docs, work, count=True).select("doc_id", "n_shingles", "component_id", "n_links")


def similarity_links(docs: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Every link, as pairs of different sets and the rows that have each set.

    The first table is ``doc_id, n_shingles, set_id`` of every row; rows with one ``set_id`` link with each other, rows
    without one link with nothing.  The second is ``a, b``: sets that link, each pair once, ``a < b``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    settled, reps, sets = _distinct_sets(docs, work)
    teams, routed = _all_teams(sets, work)
    routed = routed.select("rid", "n", "tokens", "places", "leasts")
    found = work.table(_by_task(teams, routed).applyInPandas(_list, "a long, b long"), "pairs")
    of = reps.select("fp1", "fp2", "n", F.lit(True).alias("open"), F.col("rid").alias("set_id"))
    rows = settled.join(of, ["fp1", "fp2", "n", "open"], "left").select("doc_id", F.col("n").alias("n_shingles"), "set_id")
    return rows, found


def _with_sets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_n, _fp1, _fp2`` of each row's set."""
    columns = docs.columns

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column("text"))
            sizes, one, two = [], [], []
            for lo, hi in steps(texts, CHUNK_BYTES):
                sets = list(shingle_sets(texts[lo:hi]))
                sizes += map(len, sets)
                for out, values in zip((one, two), _fingerprints(sets), strict=True):
                    out += values.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in (sizes, one, two))], names=[*columns, "_n", "_fp1", "_fp2"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, _n long, _fp1 long, _fp2 long")


def representatives(docs: DataFrame, work: Workspace) -> DataFrame:
    """One document of each similarity class, the one with the least id, and one of each repeated row.

    Rows with a null id stay.  Of an id that occurs with several texts each row is judged by its own class: it stays
    if the class has no smaller id, and of the id's rows in one class the one with the least text stays.  Empty texts
    are in no class: each different one stays.
    """
    columns = docs.columns
    docs = docs.toDF(*(c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(columns)))  # no name clashes with those below
    return _one_of_each(docs, work).toDF(*columns)


def _one_of_each(docs: DataFrame, work: Workspace) -> DataFrame:
    classes = work.table(_row_classes(docs, work), "classes-of-rows")
    again = work.table(classes.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    dropped = classes.where("component_id <> doc_id").select("doc_id").distinct()
    if again.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    kept = docs.join(dropped.union(again).distinct(), "doc_id", "left_anti").select(docs.columns)
    rows = _with_sets(docs.join(again, "doc_id", "left_semi").select(docs.columns))
    least = classes.where("component_id = doc_id").join(again, "doc_id", "left_semi").select(
        F.col("doc_id").alias("_id"), F.col("n_shingles").alias("_n"), F.col("fp1").alias("_fp1"), F.col("fp2").alias("_fp2"),
        F.col("root").alias("_root"),
    ).distinct()
    own = rows.join(least.withColumnRenamed("_id", "doc_id"), ["doc_id", "_n", "_fp1", "_fp2"])
    alone = F.when(F.col("_root").isNull(), F.struct("text"))
    one = own.groupBy("doc_id", "_root", alone.alias("_alone")).agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("_row"))
    return kept.unionByName(one.select(*(F.col("_row")[c].alias(c) for c in docs.columns)))
