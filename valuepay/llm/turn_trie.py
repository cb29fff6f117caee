"""Conversation prefix trie (operator 12): which openings conversations share, and what a cache of them saves.

A node is a sequence of turns with which at least one conversation starts. A conversation's path is the
sequence of its turns' digests (16 bytes of SHA-256 each), so nodes are prefixes of paths and paths in byte
order are the trie in depth-first order.

* **Splitters.** A sample of paths, at most ``SAMPLES_A_SHARD`` for each shard and ``SPLIT_TURNS`` turns each, gives the
  bounds of the shards; ties between equal paths go on by ``conv_id``, so a group of copies is cut like any other.
* **Skeleton.** A node that a bound cuts is a prefix of that bound. The trie of the bounds is broadcast; its size
  follows from the number of shards and ``SPLIT_TURNS``. Every other node lies within one shard.
* **Shards.** A shard is read in order, with the nodes of the current path open: a node is done when the next path
  leaves it. Shards finish all nodes outside the skeleton and add up what they know of skeleton nodes.
* **Reduction.** The partial sums of skeleton nodes are added by Spark, one row for each node is left, and sums over
  subtrees run up the skeleton. Ids of conversations that end on a skeleton node come in order as chunks, whose
  digest is taken as a stream.

Texts are read once, for digests and word counts; what is shuffled are digests. ``prefix_trie`` takes any sequences;
``rebuilt`` makes those of the query.

Defined results: rows without a ``conv_id`` are left out; turns are ordered by ``turn`` (null first), then role, then
the digest of role and text, so a row repeated whole is as many equal turns; null role or text is empty; a conversation
may have no turns and is then a member of the root alone; an empty table gives an empty result, without a root;
other columns are not read. ``conv_id % 20`` has the sign of ``conv_id``, as in SQL.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.session import written

DIGEST = 16  # bytes of a turn's digest
SHARD_TURNS = 200_000  # turns of a shard, about, as long as there are fewer than
SHARDS = 10_000  # shards: what the driver holds, the sample and the skeleton, follows from their number
SAMPLES_A_SHARD = 20
SPLIT_TURNS = 256  # turns of a bound that are kept
CHUNK = 4096  # ids of a chunk
ROOT = b""

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
PART = f"{NODE}, part string, node binary, words long, first_id long, ids string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: every conversation as an ordered array of ``digest`` and ``words``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the role's length keeps role and text apart
    digest = F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), role.alias("role"), digest.alias("digest"), words.alias("words"))
    return (conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .select("conv_id", F.transform("ts", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")))


def rebuilt(conversations: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """``conv_id, turns``: every conversation c with its first h turns, h = crc32(c) % ``heads``, replaced by those of
    conversation c - c % ``block`` (none where that one is absent)."""
    own = written(turns_of(conversations), "turns")
    head = own.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % block, "h": h}).join(head, "base", "left")
    none = F.slice("turns", 1, 0)
    opening = F.when(F.col("h") > 0, F.coalesce(F.slice("head", F.lit(1), F.col("h")), none)).otherwise(none)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


def paths_of(sequences: DataFrame) -> DataFrame:
    """``conv_id, path, words``: the digests of all turns as one byte string, and the words of each turn."""
    return sequences.select("conv_id", F.transform("turns", lambda t: t["digest"]).alias("d"), F.transform("turns", lambda t: t["words"]).alias("words")).select(
        "conv_id", F.when(F.size("d") > 0, F.concat_ws("", F.transform("d", lambda x: F.hex(x)))).otherwise("").alias("hex"), "words").select(
        "conv_id", F.unhex("hex").alias("path"), "words")


def bounds_of(paths: DataFrame, shards: int, split_turns: int = SPLIT_TURNS) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` bounds ``(path, conv_id)`` in order, from a sample whose size follows from ``shards``."""
    if shards < 2:
        return []
    rows = paths.count()
    share = min(1.0, SAMPLES_A_SHARD * shards / max(rows, 1))
    sample = sorted((bytes(r["p"]), r["conv_id"]) for r in paths.sample(False, share, seed=7).select(
        F.substring("path", 1, split_turns * DIGEST).alias("p"), "conv_id").limit(2 * SAMPLES_A_SHARD * shards).collect())
    return sorted({sample[len(sample) * k // shards] for k in range(1, shards)}) if sample else []


def skeleton_of(bounds: list[tuple[bytes, int]]) -> set[bytes]:
    """The nodes that bounds may cut: all prefixes of their paths, the root first."""
    return {ROOT} | {path[:at] for path, _ in bounds for at in range(DIGEST, len(path) + 1, DIGEST)}


def _dealt(bounds) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            yield batch.append_column("shard", pa.array([bisect_right(bounds.value[0], k) for k in keys], pa.int32()))
    return run


class Open:
    """A node that the current path runs through; ``key`` is its path if it belongs to the skeleton."""

    __slots__ = ("key", "words", "least", "members", "children", "leaves", "saved", "done", "hash", "ids")

    def __init__(self, key: bytes | None, words: int):
        self.key, self.words, self.least = key, words, None
        self.members = self.children = self.leaves = self.saved = 0
        self.done: list[tuple] = []  # finished children, which wait for their parent's id
        self.hash = None
        self.ids: list[int] = []  # of conversations that end here, in the skeleton


class Shard:
    """Takes the paths of a shard in order. ``out`` gets finished nodes (``part`` is ``node``), finished nodes right below
    the skeleton (``edge``, with the parent's path), sums of skeleton nodes (``sum``) and ids that end there (``ids``)."""

    def __init__(self, skeleton: set[bytes], out: list[tuple]):
        self.skeleton, self.out = skeleton, out
        self.path, self.stack = ROOT, [Open(ROOT, 0)]

    def take(self, conv: int, path: bytes, words: list[int]) -> None:
        shared, most = 0, min(len(self.path), len(path))
        while shared < most and self.path[shared:shared + DIGEST] == path[shared:shared + DIGEST]:
            shared += DIGEST
        self.close(shared // DIGEST)
        for depth in range(shared // DIGEST + 1, len(words) + 1):
            key = None
            if self.stack[-1].key is not None and path[:depth * DIGEST] in self.skeleton:
                key = path[:depth * DIGEST]
            self.stack.append(Open(key, words[depth - 1]))
        self.path = path
        for node in self.stack:
            node.members += 1
            node.least = conv if node.least is None else min(node.least, conv)
        end = self.stack[-1]
        if end.key is not None:
            end.ids.append(conv)
            if len(end.ids) >= CHUNK:
                self.send_ids(end)
        elif end.hash is None:
            end.hash = hashlib.sha256(str(conv).encode())
        else:
            end.hash.update(b",%d" % conv)

    def close(self, depth: int) -> None:
        """Finish the open nodes deeper than ``depth`` turns."""
        while len(self.stack) > depth + 1:
            self.close_last()

    def close_last(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        if node.key is not None:
            self.send_ids(node)
            self.out.append((node.least, depth, None, node.members, node.children, node.leaves, node.saved, None, "sum", node.key, node.words, None, None))
            return
        node.leaves += not node.children
        node.saved += (node.members - 1) * node.words
        for row in node.done:
            self.out.append((*row[:2], node.least, *row[3:], "node", None, None, None, None))
        row = (node.least, depth, None, node.members, node.children, node.leaves, node.saved, (node.hash or hashlib.sha256()).hexdigest())
        parent = self.stack[-1]
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved
        if parent.key is not None:
            self.out.append((*row, "edge", parent.key, None, None, None))
        else:
            parent.done.append(row)

    def send_ids(self, node: Open) -> None:
        if node.ids:
            self.out.append((None,) * 8 + ("ids", node.key, None, node.ids[0], ",".join(map(str, node.ids))))
            node.ids = []


def _shards(bounds) -> Callable:
    """Rows sorted by shard, path and id to parts of the trie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        shard, number = None, None
        for batch in batches:
            for at, conv, path, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "words"))):
                if at != number:
                    if shard:
                        shard.close(-1)
                    shard, number = Shard(bounds.value[1], out), at
                shard.take(conv, path, words)
            if len(out) >= 10_000:
                yield _batch(out)
        if shard:
            shard.close(-1)
        yield _batch(out)
    return run


def _batch(out: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in PART.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = list(zip(*out)) or [()] * len(fields)
    out.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of ids, sorted by node and first id, to one SHA-256 for each node."""
    key, total, found = None, None, []
    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node == key:
                total.update(b"," + ids.encode())
                continue
            if key is not None:
                found.append((key, total.hexdigest()))
            key, total = node, hashlib.sha256(ids.encode())
    if key is not None:
        found.append((key, total.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], names=["node", "ends"])


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS, split_turns: int = SPLIT_TURNS) -> DataFrame:
    """The nodes of the trie of ``conv_id, turns`` (unique ids; arrays of ``digest``, ``words``), one row each: ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    spark = sequences.sparkSession
    paths = written(paths_of(sequences), "paths")
    turns = paths.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = min(-(-turns // shard_turns), SHARDS)
    bounds = bounds_of(paths, shards, split_turns)
    skeleton = skeleton_of(bounds)
    shared = spark.sparkContext.broadcast((bounds, skeleton))
    parts = written(
        paths.mapInArrow(_dealt(shared), "conv_id long, path binary, words array<int>, shard int")
        .repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
        .mapInArrow(_shards(shared), PART), "trie-parts")
    top = _skeleton_nodes(spark, parts, skeleton)
    columns = [f.split()[0] for f in NODE.split(", ")]
    if top is None:
        return spark.createDataFrame([], NODE)
    inner = parts.filter("part = 'node'").select(*columns)
    least = F.broadcast(top.select("node", F.col("conv_id").alias("least")))  # the skeleton, see above
    edge = parts.filter("part = 'edge'").join(least, "node").withColumn("parent_conv_id", F.col("least")).select(*columns)
    return top.select(*columns).union(inner).union(edge)


def _skeleton_nodes(spark, parts: DataFrame, skeleton: set[bytes]) -> DataFrame | None:
    """The nodes of the skeleton, from one summed row each: sums over subtrees run from the deepest node up."""
    sums = {bytes(r["node"]): r for r in parts.filter("part = 'sum'").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.first("words").alias("words")).collect()}  # at most the skeleton's size
    if not sums:
        return None
    # ids go to one task a node, as a stream: a digest is taken in order
    chunks = parts.filter("part = 'ids'").select("node", "first_id", "ids")
    ends = chunks.repartition("node").sortWithinPartitions("node", "first_id").mapInArrow(_digests, "node binary, ends string")
    ends = {bytes(r["node"]): r["ends"] for r in ends.collect()}
    children = dict.fromkeys(sums, 0)
    leaves = {k: r["n_leaves"] for k, r in sums.items()}
    saved = {k: r["saved_tokens"] + (r["n_convs"] - 1) * r["words"] for k, r in sums.items()}
    rows = []
    for key in sorted(sums, key=len, reverse=True):
        r, parent = sums[key], key[:-DIGEST] if key else None
        own = r["n_children"] + children[key]
        leaves[key] += not own
        if parent is not None:
            children[parent] += 1
            leaves[parent] += leaves[key]
            saved[parent] += saved[key]
        rows.append((r["conv_id"], len(key) // DIGEST, None if parent is None else sums[parent]["conv_id"], r["n_convs"], own,
                     leaves[key], saved[key], ends.get(key, hashlib.sha256().hexdigest()), bytearray(key)))
    return spark.createDataFrame(rows, f"{NODE}, node binary")
