"""Line deduplication with two Bloom filters (operator 13).

Lines are compared by their key: stripped of white space at both ends, A-Z in lower case. Most keys stand
in one document only, and the filters keep those from being shuffled:

* The once-seen filter. Hashes of keys (64 bits, one for each key of a block of documents) are dealt to
  sections by hash. A section streams its hashes through a filter of its own, which is sized from the number of
  lines; a hash that the filter has already, or that came from two documents of a block, is suspected. Nothing
  is sorted or held but the filter.
* The twice-seen filter holds the suspected hashes, sized from their number. Up to ``FILTER_BYTES`` it goes to all
  tasks, which read the documents again and let only lines pass that it may hold. Beyond that size the
  suspected hashes stay a table, and the documents' hashes meet it in a semi join (``narrow`` rows of an id and a hash).

Only the suspected lines, with their whole keys, are shuffled for the exact count of documents. Keys that
enough documents hold give the line numbers to drop, which go back to the documents: by broadcast where they
are few, measured, by a join otherwise. A false suspicion costs a row; it changes no result.

A key of a third of all documents is one row for each block in its section and one for each task in the count.

Defined results: a null or empty text is one empty line; a document is a row, so a row repeated whole counts
as often as it stands there, each repeat getting the same result, and ids may be null; keys shorter than
``min_chars`` code points stay whatever their number; with ``keep="first"`` the first line with the key stays in the
document with the smallest id (null last, then the text's hash, repeats alike); a text all of whose lines go is empty;
an empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuepay.llm.words import LOWER, blocks, mapped_bytes
from valuepay.session import written

BLANK = " \t\n\x0b\f\r"
BITS_A_KEY = 16
SECTION_LINES = 4_000_000  # lines of a section, about; its filter has BITS_A_KEY bits for each
TASK_LINES = 50_000  # fewer lines than this do not get a section of their own
FILTER_BYTES = 32 << 20  # the largest twice-seen filter that is sent to all tasks
BROADCAST_BYTES = 16 << 20  # keys or line numbers that are sent to all tasks
PAGE = 32768  # bits of one bitmap row, as Spark's bitmap functions have it


class Lines:
    """The lines of a block of texts: ``keys`` (distinct), the number of each line's key, where each text's lines start."""

    def __init__(self, texts: pa.Array):
        parts = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        self.flat = pc.list_flatten(parts)
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        self.starts = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=self.starts[1:])
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        coded = mapped_bytes(pc.ascii_trim(self.flat, BLANK), LOWER).dictionary_encode()
        self.keys, self.number = coded.dictionary, coded.indices.to_numpy().astype(np.int64)

    def held(self, chosen: np.ndarray) -> np.ndarray:
        """Numbers of the ``chosen`` keys, once for each text that holds them, as ``text * len(keys) + key``."""
        at = chosen[self.number]
        return np.unique(self.text[at] * len(self.keys) + self.number[at])

    def long_enough(self, min_chars: int) -> np.ndarray:
        return pc.greater_equal(pc.utf8_length(self.keys), min_chars).to_numpy(zero_copy_only=False)


def hashes(keys: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k.encode()) for k in keys.to_pylist()), np.uint64, len(keys))


def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a filter of ``bits`` (a power of two up to 2**32): of its lower and its upper half."""
    return (h & np.uint64(bits - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64)


def holds(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for at in positions(h, len(bitmap) * 8):
        found &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def filter_bits(keys: int) -> int:
    return max(PAGE, 1 << max(0, int(keys * BITS_A_KEY - 1).bit_length()))


def _block_hashes(min_chars: int) -> Callable:
    """Hashes of a block's keys, and whether two of its documents hold the key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            lines = Lines(block.column("text"))
            times = np.bincount(lines.held(lines.long_enough(min_chars)) % max(1, len(lines.keys)), minlength=len(lines.keys))
            at = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays([pa.array(hashes(lines.keys.take(pa.array(at))).view(np.int64)), pa.array(times[at] > 1)],
                                             names=["h", "twice"])
    return run


def _once_seen(bits: int) -> Callable:
    """A section: hashes that the section's once-seen filter holds when they come, false hits included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            h, first, times = np.unique(batch.column("h").to_numpy().view(np.uint64), return_index=True, return_counts=True)
            sent_twice = batch.column("twice").to_numpy(zero_copy_only=False)[first]
            suspected = (times > 1) | sent_twice | holds(once, h)
            for at in positions(h, bits):
                np.bitwise_or.at(once, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(h[suspected].view(np.int64))], names=["h"])
    return run


def suspected_hashes(docs: DataFrame, min_chars: int, text: str = "text") -> DataFrame:
    """``h``: a hash of every key that two documents hold, and a few others."""
    spark = docs.sparkSession
    body = docs.select(F.col(text).cast("string").alias("text"))
    lines = body.agg(F.sum(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    sections = max(-(-lines // SECTION_LINES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // TASK_LINES)), 1)
    return (body.mapInArrow(_block_hashes(min_chars), "h long, twice boolean").repartition(sections, "h")
            .mapInArrow(_once_seen(filter_bits(-(-lines // sections))), "h long").distinct())


def twice_seen_filter(suspects: DataFrame, keys: int) -> np.ndarray:
    """The bitmap over the suspected hashes; its pages, at most ``FILTER_BYTES`` together, come to the driver."""
    bits = filter_bits(keys)
    at = F.explode(F.array(F.col("h").bitwiseAND(bits - 1) + 1, F.shiftrightunsigned("h", 32).bitwiseAND(bits - 1) + 1))
    pages = (suspects.select(at.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("page"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    found = np.zeros((bits // PAGE, PAGE // 8), np.uint8)
    for r in pages:
        found[r["page"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return found.ravel()


def _suspected_lines(min_chars: int, twice) -> Callable:
    """``doc_id, tx, key, at``: keys that the filter, or the row's own list of hashes, holds, with their line numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            lines = Lines(block.column("text"))
            width = max(1, len(lines.keys))
            h = hashes(lines.keys)
            chosen = lines.long_enough(min_chars)
            if twice is not None:
                held = lines.held(chosen & holds(twice.value, h))
            else:
                own = block.column("own")
                of_row = np.repeat(np.arange(block.num_rows), pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False))
                order = np.argsort(h)
                values = pc.list_flatten(own).to_numpy().view(np.uint64)
                held = lines.held(chosen)
                # every key of a row against that row's hashes
                known = np.unique(np.stack((of_row, order[np.minimum(np.searchsorted(h[order], values), width - 1)]), axis=1), axis=0)
                held = held[np.isin(held, known[:, 0] * width + known[:, 1])]
            if not len(held):
                continue
            cell = lines.text * width + lines.number
            mine = np.flatnonzero(np.isin(cell, held))
            mine = mine[np.argsort(cell[mine], kind="stable")]
            begins = np.append(np.searchsorted(cell[mine], held), len(mine)).astype(np.int32)
            row, key = pa.array(held // width), pa.array(held % width)
            at = (mine - lines.starts[lines.text[mine]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id").take(row), block.column("tx").take(row), lines.keys.take(key),
                pa.ListArray.from_arrays(pa.array(begins), pa.array(at))], names=["doc_id", "tx", "key", "at"])
    return run


def _block_narrow(min_chars: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            lines = Lines(block.column("text"))
            held = lines.held(lines.long_enough(min_chars))
            width = max(1, len(lines.keys))
            row = pa.array(held // width)
            yield pa.RecordBatch.from_arrays([block.column("doc_id").take(row), block.column("tx").take(row),
                                              pa.array(hashes(lines.keys)[held % width].view(np.int64))], names=["doc_id", "tx", "h"])
    return run


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows as ``doc_id, tx, text, row``; ``tx`` (a hash of the text) tells rows with one id apart."""
    body = F.col(text).cast("string")
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("tx"), body.alias("text"), F.struct("*").alias("row"))


def suspected_lines(rows: DataFrame, min_chars: int, limit: int = FILTER_BYTES) -> DataFrame:
    """``doc_id, tx, key, at`` for every row and key that two documents hold, and a few others."""
    suspects = written(suspected_hashes(rows, min_chars), "suspected-hashes")
    keys = suspects.count()
    texts = rows.select("doc_id", "tx", "text")
    ref = [T.StructField(c, rows.schema[c].dataType) for c in ("doc_id", "tx")]
    schema = T.StructType([*ref]).add("key", "string").add("at", T.ArrayType(T.IntegerType()))
    if filter_bits(keys) // 8 <= limit:
        twice = rows.sparkSession.sparkContext.broadcast(twice_seen_filter(suspects, keys))
        return texts.mapInArrow(_suspected_lines(min_chars, twice), schema)
    narrow = texts.mapInArrow(_block_narrow(min_chars), T.StructType([*ref]).add("h", "long")).join(suspects, "h", "left_semi")
    own = narrow.groupBy("doc_id", "tx").agg(F.collect_set("h").alias("own"))
    return _with(texts, own, False).mapInArrow(_suspected_lines(min_chars, None), schema)


def _with(rows: DataFrame, found: DataFrame, few: bool) -> DataFrame:
    """Rows joined to what was found for their id and text."""
    found = found.select(F.col("doc_id").alias("_id"), F.col("tx").alias("_tx"), *[c for c in found.columns if c not in ("doc_id", "tx")])
    joined = rows.join(F.broadcast(found) if few else found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tx") == F.col("_tx")), "left")
    return joined.drop("_id", "_tx")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose numbers are in ``drop``."""
    for block in blocks(batches, "text"):
        texts, drop = block.column("text"), block.column("drop")
        parts = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.append(0, np.cumsum(sizes))
        gone = pc.fill_null(pc.list_value_length(drop), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        stays = np.ones(starts[-1], bool)
        stays[np.repeat(starts[:-1], gone) + pc.list_flatten(drop).to_numpy()] = False
        edges = np.append(0, np.cumsum(sizes - gone)).astype(np.int32)
        kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), pc.list_flatten(parts).filter(pa.array(stays))), "\n")
        yield pa.RecordBatch.from_arrays([block.column("row"), pa.array(sizes), pa.array(gone), kept], names=["row", "n_lines", "n_dropped", "kept"])


def line_drops(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", key: str = "doc_id", text: str = "text",
               limit: int = FILTER_BYTES, few: int = BROADCAST_BYTES) -> DataFrame:
    """Every row as ``row`` (a struct of its columns), ``n_lines`` before dropping, ``n_dropped``, and the text that is
    ``kept``. Dropped are the lines with a key that at least ``min_docs`` documents hold: all of them, or with
    ``keep="first"`` all but the first one. ``limit`` and ``few`` say up to how many bytes the filter, and what was
    found, go to all tasks."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep is {keep!r}, not 'none' or 'first'")
    rows = _named(docs, key, text)
    suspected = written(suspected_lines(rows, min_chars, limit), "suspected-lines")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("tx").alias("tx"))
    frequent = written(suspected.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min(place).alias("first"))
                       .filter(F.col("docs") >= min_docs).select("key", "first"), "frequent-lines")
    size = frequent.agg(F.sum(F.octet_length("key") + 40)).first()[0] or 0
    at = F.col("at")
    if keep == "first":
        at = F.when(place.eqNullSafe(F.col("first")), F.slice("at", F.lit(2), F.greatest(F.size("at") - 1, F.lit(1)))).otherwise(at)
    drops = written(suspected.join(F.broadcast(frequent) if size <= few else frequent, "key").select("doc_id", "tx", at.alias("at"))
                    .groupBy("doc_id", "tx").agg(F.flatten(F.collect_set("at")).alias("drop")), "line-drops")
    size = drops.agg(F.sum(F.size("drop") * 4 + 64)).first()[0] or 0
    schema = T.StructType([rows.schema["row"]]).add("n_lines", "long").add("n_dropped", "long").add("kept", "string")
    return _with(rows.select("doc_id", "tx", "text", "row"), drops, size <= few).select("text", "drop", "row").mapInArrow(_without, schema)


def without_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "first", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns, texts without the lines that repeat (a text that loses nothing stays as it is)."""
    found = line_drops(docs, min_docs, min_chars, keep, key, text)
    return found.select(F.when(F.col("n_dropped") > 0, F.struct(*[
        F.col("kept").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])).otherwise(F.col("row")).alias("row")).select("row.*")


def digests(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row, all lines of frequent keys dropped."""
    found = line_drops(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), min_docs, min_chars, **limits)
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
