"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 7).

A document's 64-bit fingerprint is cut into three segments, each read as a word of the perfect binary
(23, 12, 7) Golay code. Decoding a segment and all words one bit away from it gives a few codeword
indices, and a word at distance at most one from the segment decodes to one of them. If two fingerprints
differ in at most three bits, some two of the three segments hold at most one error each, so for that
pair of segments one side's own codeword indices are among the other's keys. Where the third segment
holds two or three errors the other two hold one together, so only the pair (0, 1) needs both
neighbourhoods crossed. Keys are sorted next to each other, candidates are verified bit by bit, and
linked fingerprints are joined into components.

Equal fingerprints are one row from the start, so a large group of copies costs nothing more. Within a
key only the verified links that connect something new are kept, so a large group of near copies makes
no more rows than it has members (of a key above ``2 * CHUNK`` fingerprints: than its pairs of chunks have).

Defined results: a null or empty text has no words and fingerprint zero, which links like any other;
texts of fewer words than a shingle are one shingle; repeated rows share fingerprint and component; a
null id is passed over in the smallest id of a component; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.components import components
from valuepay.llm.words import LOWER, blocks, mapped_bytes
from valuepay.session import scratch_path

# Fixed value: generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width of each
PAIRS = ((0, 1), (0, 2), (1, 2))
CHUNK = 4096  # fingerprints; a task compares two chunks of a key at most


def remainder(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word on division by the generator: its 11-bit syndrome."""
    left = words.astype(np.uint32).copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> np.uint32(bit) & np.uint32(1), np.uint32(GENERATOR << (bit - 11)), np.uint32(0))
    return left


@lru_cache(maxsize=1)
def leaders() -> np.ndarray:
    """For each syndrome the one error of at most three bits that has it."""
    errors = [0]
    for a in range(23):
        errors.append(1 << a)
        for b in range(a):
            errors.append(1 << a | 1 << b)
            errors.extend(1 << a | 1 << b | 1 << c for c in range(b))
    errors = np.array(errors, np.uint32)
    table = np.zeros(2048, np.uint32)
    table[remainder(errors)] = errors
    return table


def codeword(words: np.ndarray) -> np.ndarray:
    """Index (the 12 information bits) of the codeword nearest to each 23-bit word."""
    return (words ^ leaders()[remainder(words)]) >> np.uint32(11)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of the fingerprints: key, fingerprint, and whether the key is the fingerprint's own."""
    own, near = [], []
    for first, width in SEGMENTS:
        part = ((prints >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.uint32)
        flips = np.concatenate(([0], np.uint32(1) << np.arange(width, dtype=np.uint32))).astype(np.uint32)
        found = np.sort(codeword(part[:, None] ^ flips[None, :]), axis=1)
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        own.append(codeword(part))
        near.append((found, fresh))
    keys, at, mine = [], [], []
    rows = np.arange(len(prints))

    def add(pair, left, right, row):
        keys.append((np.uint64(pair) << np.uint64(24)) | (left.astype(np.uint64) << np.uint64(12)) | right.astype(np.uint64))
        at.append(row)
        i, j = PAIRS[pair]
        mine.append((left == own[i][row]) & (right == own[j][row]))

    # pair (0, 1): both neighbourhoods crossed
    (a, fa), (b, fb) = near[0], near[1]
    both = fa[:, :, None] & fb[:, None, :]
    r, x, y = np.nonzero(both)
    add(0, a[r, x], b[r, y], r)
    # the other pairs: an error in one segment or the other, not in both
    for pair in (1, 2):
        i, j = PAIRS[pair]
        found, fresh = near[i]
        r, x = np.nonzero(fresh)
        add(pair, found[r, x], own[j][r], r)
        found, fresh = near[j]
        r, x = np.nonzero(fresh & (found != own[j][:, None]))
        add(pair, own[i][r], found[r, x], r)
    at = np.concatenate(at)
    return np.concatenate(keys).astype(np.int64), prints[at], np.concatenate(mine)


def fingerprint(texts: pa.Array, shingle: int) -> np.ndarray:
    """64-bit fingerprints: a bit is set if it is set in over half of the hashes of the text's shingles
    of words ``[^\\x20\\x09-\\x0D]+`` joined by spaces, repeats included, A-Z in lower case."""
    digest = xxhash.xxh64_digest
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    for row, text in enumerate(mapped_bytes(texts, LOWER).cast(pa.binary()).to_pylist()):
        words = text.split()
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        n = max(1, len(words) - shingle + 1)
        starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
        hashes = b"".join([digest(line[a:b], 42) for a, b in zip(starts, ends[min(shingle, len(words)) - 1:].tolist())])
        ones = np.zeros(64, np.int64)
        for lo in range(0, n, 1 << 16):  # bounded memory for very long texts
            ones += np.unpackbits(np.frombuffer(hashes[8 * lo:8 * (lo + (1 << 16))], np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        out[row] = weights[2 * ones > n].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, tx`` (a hash of the text) and ``bits`` (the fingerprint as a signed long) of every whole text."""
    def run(batches):
        for block in blocks(batches, "t"):
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("tx"), pa.array(fingerprint(block.column("t"), shingle).view(np.int64))], names=["id", "tx", "bits"])

    kind = docs.schema[key].dataType.simpleString()
    body = F.col(text).cast("string")
    return docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("tx"), body.alias("t")).mapInArrow(run, f"id {kind}, tx bigint, bits bigint")


def verified(key: np.ndarray, bits: np.ndarray, own: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key: fingerprints of one key, one of them by its own key, that differ
    in at most ``distance`` bits. Links that only repeat a connection within their key are left out."""
    left, right = [], []
    n = len(key)
    same = np.searchsorted(key, key, side="right") - np.arange(n) - 1  # rows of the key that follow
    step, at = 1, np.flatnonzero(same >= 1)
    root = np.arange(n)  # of what is connected within a key so far

    def top(x):
        while True:
            up = root[x]
            if (up == x).all():
                return x
            root[x] = root[up]
            x = up

    while len(at):
        near = (own[at] | own[at + step]) & (np.bitwise_count(bits[at] ^ bits[at + step]) <= distance)
        a, b = at[near], at[near] + step
        while len(a):
            ra, rb = top(a), top(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                break
            # one new connection for each part that is to be joined below another
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            once = np.unique(high, return_index=True)[1]
            root[high[once]] = low[once]
            left.append(bits[a[once]])
            right.append(bits[b[once]])
            rest = np.ones(len(a), bool)
            rest[once] = False
            a, b = a[rest], b[rest]
        step += 1
        at = at[same[at] >= step]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left) if left else none), (np.concatenate(right) if right else none)


def links(prints: DataFrame, distance: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``bits``), at least a spanning forest of all
    pairs that differ in at most ``distance`` bits (3 at most).

    A task compares the fingerprints of a key if they are ``2 * chunk`` at most. Those of a larger key pass
    through it uncompared; they are dealt to chunks by hash, and every two chunks of a key meet in a group of
    their own, so no task holds a whole large key and all its pairs are compared."""
    if not 0 <= distance <= 3:
        raise ValueError("the code finds fingerprints that differ in at most 3 bits")

    def emit(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(prints), 4096):
                key, bits, own = keys_of(prints[lo:lo + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bits.view(np.int64)), pa.array(own)], names=["key", "bits", "own"])

    def match(batches):
        # rows come sorted by key; the last key of a batch is held back until its rows are complete
        kept: list[pa.RecordBatch] = []
        late = None  # a key too large to be compared here

        def settle(rows):
            key, bits, own = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in range(3))
            a, b = verified(key, bits.view(np.uint64), own, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64()),
                                               pa.nulls(len(a), pa.bool_())], names=["a", "b", "key", "own"])

        def passed(rows):
            return [pa.RecordBatch.from_arrays([r.column(1), pa.nulls(r.num_rows, pa.int64()), r.column(0), r.column(2)],
                                               names=["a", "b", "key", "own"]) for r in rows]

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            changes = np.flatnonzero(key[1:] != key[:-1]) + 1
            edges = np.concatenate(([0], changes, [len(key)]))
            # rows that go on with the key held back
            head = int(edges[1]) if (late is not None and late == key[0]) or (kept and kept[-1].column(0)[0].as_py() == key[0]) else 0
            if head:
                kept.append(batch.slice(0, head))
            if late is None and sum(r.num_rows for r in kept) > 2 * chunk:
                late = kept[0].column(0)[0].as_py()
            if late is not None:
                yield from passed(kept)
                kept = []
                if head == batch.num_rows:
                    continue
                late = None
            elif head == batch.num_rows:
                continue
            if kept:
                yield settle(kept)
                kept = []
            # whole keys of this batch, then its last one
            low = max(head, int(edges[-2]))
            large = [k for k in np.flatnonzero(np.diff(edges[:-1]) > 2 * chunk).tolist() if edges[k] >= head]
            for k in large:
                yield from passed([batch.slice(int(edges[k]), int(edges[k + 1] - edges[k]))])
            for lo, hi in zip([head, *(int(edges[k + 1]) for k in large)], [*(int(edges[k]) for k in large), low]):
                if lo < hi:
                    yield settle([batch.slice(lo, hi - lo)])
            kept = [batch.slice(low)]
            if kept[0].num_rows > 2 * chunk:
                late = int(key[-1])
                yield from passed(kept)
                kept = []
        if kept:
            yield settle(kept)

    spark = prints.sparkSession
    schema = "a bigint, b bigint, key bigint, own boolean"

    def compared(keyed: DataFrame) -> DataFrame:
        return keyed.repartition("key").sortWithinPartitions("key", "bits").mapInArrow(match, schema)

    path = scratch_path(spark, "simhash-links")
    compared(prints.select("bits").mapInArrow(emit, "key bigint, bits bigint, own boolean")).write.parquet(path)
    found = spark.read.parquet(path)
    near = found.filter("b is not null").select("a", "b")
    large = found.filter("b is null").select("key", F.col("a").alias("bits"), "own")
    if large.isEmpty():
        return near
    return near.unionByName(pairs_of_chunks(large, distance, chunk))


def pairs_of_chunks(large: DataFrame, distance: int, chunk: int) -> DataFrame:
    """Links ``a, b`` among the fingerprints ``bits`` of each large ``key``, chunk against chunk."""
    parts = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))  # 3 at least
    mine = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    dealt = (large.join(parts, "key").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("mine <> other")
             .select("key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "bits", "own"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bits, own = rows["bits"].to_numpy().view(np.uint64), rows["own"].to_numpy(bool)
        a, b = verified(np.zeros(len(bits), np.int64), bits, own, distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("key", "lo", "hi").applyInPandas(run, "a bigint, b bigint")


def classes(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, tx`` (a hash of the text, which tells rows with one id apart), ``bits`` and ``first``, the id
    and text hash of the row with the smallest id (null last) among all that links reach, of every row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash")
    fingerprints(docs, shingle, key, text).write.parquet(path)
    prints = spark.read.parquet(path)
    row = F.struct(F.col("id").isNull().alias("none"), "id", "tx")
    distinct = prints.groupBy("bits").agg(F.min(row).alias("least"))
    # components are found among fingerprints; their first row follows by one aggregation
    part = components(links(distinct, distance)).select(F.col("id").alias("bits"), F.col("component").alias("root"))
    least = distinct.join(part, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    per_root = least.groupBy("root").agg(F.min("least").alias("first"))
    by_bits = least.select("bits", "root").join(per_root, "root").select("bits", "first")
    return prints.join(by_bits, "bits")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` (16 hex digits) and ``component_id`` (smallest key reachable by links between
    fingerprints that differ in at most ``distance`` bits, its own included) of every row."""
    return classes(docs, shingle, distance, key, text).select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, the first of each group of near duplicates, with all their columns; of
    rows that share id and text with the first, one."""
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash-classes")
    (classes(docs, shingle, distance, key, text)
     .select("id", "tx", (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tx") == F.col("first.tx"))).alias("leads"))
     .write.parquet(path))
    found = spark.read.parquet(path)
    # the document's columns stay apart from those made here
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("row_id"), F.xxhash64(F.col(text).cast("string")).alias("row_tx"))

    def same(few: DataFrame):
        return F.col("row_id").eqNullSafe(few["id"]) & (F.col("row_tx") == few["tx"])

    gone = found.filter(~F.col("leads")).select("id", "tx")
    stay = rows.join(gone, same(gone), "left_anti")
    repeated = found.filter("leads").groupBy("id", "tx").count().filter("count > 1").select("id", "tx")
    if not repeated.isEmpty():
        one = stay.join(repeated, same(repeated), "left_semi").groupBy("row_id", "row_tx").agg(F.first("row").alias("row"))
        stay = stay.join(repeated, same(repeated), "left_anti").select("row").unionByName(one.select("row"))
    return stay.select("row.*")
