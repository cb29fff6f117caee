"""Substring deduplication with difference-cover anchors (operator 2).

A window is a run of ``window`` words. Word offsets are taken modulo a period, and anchors (shorter runs)
are hashed only where the remainder lies in a difference cover. For any two offsets some shift smaller
than the period takes both into the cover, so two equal windows share an anchor at the same distance from
their starts, and a fifth of the positions is enough to find them. Documents with an anchor that also
stands in a different document are read again; their windows around such anchors are hashed in 128 bits,
which extends the match word by word to its ends, and the smallest document of each window decides.

Documents whose whole word sequences are equal are one class: all but the smallest id are removed whole
and take no part, so large groups of copies cost one document.

Joins go to Spark as aggregations and joins on hashes, whose hot keys it can split. Before a join, rows
that cannot match are left out by a bitmap of fixed size (``BITS`` bits whatever the data; a full one lets
everything through). Intermediate tables are written to the shared folder.

Defined results: null and empty texts have no words and keep none; a text shorter than a window keeps
all; windows are judged on the input, within one document or between equal ids nothing is removed; a row
whose id is null is neither removed nor a reason to remove; repeated rows get equal results; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.words import blocks, words_of
from valuepay.session import scratch_path

# Perfect difference sets, by period.
COVERS = {31: (1, 5, 11, 24, 25, 27), 21: (3, 6, 7, 12, 14), 13: (0, 1, 3, 9), 7: (1, 2, 4), 3: (0, 1), 1: (0,)}
BITS = 1 << 26
PAGE = 32768  # bits of one bitmap row, as Spark's bitmap functions have it
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least two fifths of the window."""
    period = max(p for p in COVERS if window + 1 - p >= 0.4 * window or p == 1)
    return period, COVERS[period]


class Powers:
    """Powers of a base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 16)
            one = np.ones(1, np.uint64)
            self.up, self.down = (np.cumprod(np.concatenate((one, np.full(size, b, np.uint64))), dtype=np.uint64)
                                  for b in (self.base, self.inverse))


POWERS = [Powers(b) for b in BASES]


class Hashes:
    """Hashes of any run of words of a block of texts: 64 bits from ``run(0, ...)``, 64 more from
    ``run(1, ...)``."""

    def __init__(self, texts: pa.Array):
        distinct, self.number, self.starts = words_of(texts)
        digests = b"".join([xxhash.xxh3_128_digest(w.encode()) for w in distinct.to_pylist()])
        values = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        self.sizes = np.diff(self.starts)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.offset = np.arange(len(self.number)) - self.starts[:-1][self.row]
        self.sums = []
        for k, p in enumerate(POWERS):
            p.to(len(self.number))
            total = np.zeros(len(self.number) + 1, np.uint64)
            np.cumsum(values[self.number, k] * p.up[:len(self.number)], out=total[1:])
            self.sums.append(total)

    def run(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ((self.sums[k][end] - self.sums[k][start]) * POWERS[k].down[start]).view(np.int64)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the anchors of texts that hold a window, and their hashes."""
        period, cover = cover_for(window)
        size = window + 1 - period
        chosen = np.zeros(period, bool)
        chosen[list(cover)] = True
        left = self.sizes[self.row] - self.offset
        at = np.flatnonzero(chosen[self.offset % period] & (left >= size) & (self.sizes[self.row] >= window))
        return at, self.run(0, at, at + size)


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows as ``doc_id, tx, t``; ``tx`` (a hash of the text) tells rows with one id apart."""
    body = F.col(text).cast("string")
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("tx"), body.alias("t"))


def _bitmap(df: DataFrame, *columns: str) -> np.ndarray:
    """A bitmap of ``BITS`` bits with a bit for each value of ``columns``: a filter of bounded size."""
    position = F.pmod(F.xxhash64(*columns), F.lit(BITS))
    pages = (df.select((position + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("page"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())  # at most BITS / PAGE rows
    found = np.zeros((BITS // PAGE + 2, PAGE // 8), np.uint8)
    for r in pages:
        found[r["page"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return np.ascontiguousarray(found[1:-1]).ravel()


def _has(bitmap: np.ndarray, position: np.ndarray) -> np.ndarray:
    return (bitmap[position >> 3] >> (position & 7).astype(np.uint8) & 1).astype(bool)


def _spark_hash(values: np.ndarray) -> np.ndarray:
    """Bitmap positions of longs: Spark's xxhash64 of one long column (seed 42), modulo ``BITS``."""
    v = values.view(np.uint64)
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turn(x, n):
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    h = np.uint64(42) + p5 + np.uint64(8)
    h = turn(h ^ (turn(v * p2, 31) * p1), 27) * p1 + p4
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    h ^= h >> np.uint64(32)
    return (h & np.uint64(BITS - 1)).astype(np.int64)


def profile(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, tx, n_words`` and ``whole_sha256`` (all words joined by one space) of every row."""
    def run(batches):
        for block in blocks(batches, "t"):
            words = _word_lists(block.column("t"))
            sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("tx"), pa.array(map(len, words), pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "tx", "n_words", "whole_sha256"])

    rows = _named(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, tx bigint, n_words bigint, whole_sha256 string")


def _word_lists(texts: pa.Array) -> list[list[bytes]]:
    return [t.split() for t in pc.fill_null(texts, "").cast(pa.binary()).to_pylist()]


def repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, tx, n_words, n_removed, kept_sha256`` and ``kept_text`` (kept
    words joined by one space; null where nothing is removed)."""
    spark = docs.sparkSession
    rows = _named(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    # classes of documents with one word sequence
    own = written(profile(docs, window, key, text), "substring-profile")
    long_rows = own.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    classes = (long_rows.groupBy("whole_sha256").agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"))
               .filter("smallest < largest").select("whole_sha256", "smallest"))
    judged = written(own.join(classes, "whole_sha256", "left").select(
        "doc_id", "tx", "n_words", "whole_sha256",
        F.coalesce((F.col("n_words") >= window) & (F.col("smallest") < F.col("doc_id")), F.lit(False)).alias("copy")), "substring-judged")

    # anchors that stand in documents of different classes
    def emit_anchors(batches):
        for block in blocks(batches, "t"):
            h = Hashes(block.column("t"))
            at, value = h.anchors(window)
            # the class, by SHA-256: polynomial hashes of long sequences can be made to agree
            whole = np.frombuffer(b"".join(hashlib.sha256(b" ".join(w)).digest()[:8] for w in _word_lists(block.column("t"))), np.int64)[h.row[at]]
            order = np.lexsort((whole, value))  # rows of one anchor and class are one row
            value, whole = value[order], whole[order]
            first = np.ones(len(value), bool)
            first[1:] = (value[1:] != value[:-1]) | (whole[1:] != whole[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(value[first]), pa.array(whole[first])], names=["h", "whole"])

    present = rows.filter("doc_id IS NOT NULL")
    shared = written(present.mapInArrow(emit_anchors, "h bigint, whole bigint").groupBy("h")
                     .agg(F.min("whole").alias("x"), F.max("whole").alias("y")).filter("x <> y").select("h"), "substring-anchors")
    anchor_bits = spark.sparkContext.broadcast(_bitmap(shared, "h"))

    # the documents that hold them
    def emit_hits(batches):
        for block in blocks(batches, "t"):
            h = Hashes(block.column("t"))
            at, value = h.anchors(window)
            near = _has(anchor_bits.value, _spark_hash(value))
            row, value = h.row[at[near]], value[near]
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            first = np.ones(len(value), bool)
            first[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
            row, value = pa.array(row[first]), value[first]
            yield pa.RecordBatch.from_arrays([pa.array(value), block.column("doc_id").take(row), block.column("tx").take(row)], names=["h", "doc_id", "tx"])

    hits = written(
        present.mapInArrow(emit_hits, f"h bigint, doc_id {kind}, tx bigint").join(shared, "h", "left_semi")
        .groupBy("doc_id", "tx").agg(F.collect_set("h").alias("hits"))  # of one document
        .join(judged.filter("copy").select("doc_id", "tx").distinct(), ["doc_id", "tx"], "left_anti"), "substring-hits")
    row_bits = spark.sparkContext.broadcast(_bitmap(hits, "tx"))

    def only_hit(batches):
        for batch in batches:
            near = _has(row_bits.value, _spark_hash(batch.column("tx").to_numpy(zero_copy_only=False)))
            if near.any():
                yield batch.filter(pa.array(near))

    texts = present.mapInArrow(only_hit, f"doc_id {kind}, tx bigint, t string")
    candidates = written(texts.join(hits, ["doc_id", "tx"]), "substring-candidates")

    # all windows around shared anchors
    def windows_of(block, bits=None):
        h = Hashes(block.column("t"))
        at, value = h.anchors(window)
        hit = np.zeros(len(at), bool)
        lists = block.column("hits")
        row_of = h.row[at]
        edges = np.searchsorted(row_of, np.arange(block.num_rows + 1))
        for i, (lo, hi) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
            hit[lo:hi] = np.isin(value[lo:hi], lists[i].values.to_numpy())
        marked = np.zeros(len(h.number), bool)
        for back in range(cover_for(window)[0]):
            p = at[hit] - back
            marked[p[h.offset[at[hit]] >= back]] = True
        begin = np.flatnonzero(marked & (h.sizes[h.row] - h.offset >= window))
        return h, begin, h.run(0, begin, begin + window), h.run(1, begin, begin + window)

    def emit_windows(bits):
        def run(batches):
            for block in blocks(batches, "t"):
                h, begin, w1, w2 = windows_of(block)
                row = h.row[begin]
                if bits is not None:
                    near = _has(bits.value, _spark_hash(w1))
                    row, w1, w2 = row[near], w1[near], w2[near]
                order = np.lexsort((w2, w1, row))
                row, w1, w2 = row[order], w1[order], w2[order]
                first = np.ones(len(row), bool)
                first[1:] = (row[1:] != row[:-1]) | (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
                row = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1[first]), pa.array(w2[first]), block.column("doc_id").take(row), block.column("tx").take(row)],
                    names=["w1", "w2", "doc_id", "tx"])
        return candidates.mapInArrow(run, f"w1 bigint, w2 bigint, doc_id {kind}, tx bigint")

    repeated = written(emit_windows(None).groupBy("w1", "w2").agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"))
                       .filter("smallest < largest").select("w1", "w2", "smallest"), "substring-windows")
    window_bits = spark.sparkContext.broadcast(_bitmap(repeated, "w1"))
    flags = (emit_windows(window_bits).join(repeated, ["w1", "w2"]).filter("doc_id > smallest")
             .groupBy("doc_id", "tx").agg(F.collect_set("w1").alias("hits")))  # of one document

    # words covered by a repeated window go
    def cut(batches):
        for block in blocks(batches, "t"):
            h = Hashes(block.column("t"))
            removed, sha, kept = [], [], []
            for i, (lo, hi) in enumerate(zip(h.starts.tolist(), h.starts[1:].tolist())):
                begin = np.arange(lo, hi - window + 1)
                begin = begin[np.isin(h.run(0, begin, begin + window), block.column("hits")[i].values.to_numpy())]
                edge = np.zeros(hi - lo + 1, np.int64)
                edge[begin - lo] += 1
                edge[begin - lo + window] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                words = block.column("t")[i].as_py().encode().split()
                rest = b" ".join([w for w, s in zip(words, stay.tolist()) if s])
                removed.append(int((~stay).sum()))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("tx"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                names=["doc_id", "tx", "n_removed", "kept_sha256", "kept_text"])

    cuts = (candidates.join(flags.withColumnRenamed("hits", "flags"), ["doc_id", "tx"])
            .select("doc_id", "tx", "t", F.col("flags").alias("hits"))
            .mapInArrow(cut, f"doc_id {kind}, tx bigint, n_removed bigint, kept_sha256 string, kept_text string")
            .dropDuplicates(["doc_id", "tx"]))
    nothing = hashlib.sha256(b"").hexdigest()
    return judged.join(cuts, ["doc_id", "tx"], "left").select(
        "doc_id", "tx", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))


def digests(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` of every row."""
    return repeats(docs, window, key, text).select(F.col("doc_id").alias(key), "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with repeated words removed, columns as before and ``length`` (if there is one) kept
    up. A text that nothing was removed from stays as it is; one that loses all its words goes."""
    found = repeats(docs, window, key, text).filter("n_removed > 0").select(
        F.col("doc_id").alias("id"), "tx", F.col("kept_text").alias("kept")).dropDuplicates(["id", "tx"])
    # the document's columns stay apart from those made here
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("tx"))
    new = {text: F.col("kept"), length: F.char_length("kept")}
    columns = [F.when(F.col("kept").isNull(), F.col(f"row.`{c}`")).otherwise(new[c].cast(docs.schema[c].dataType)).alias(c)
               if c in new else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.join(found, ["id", "tx"], "left").filter("kept IS NULL OR kept <> ''").select(*columns)
