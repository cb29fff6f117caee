"""Sharding by fixed virtual slots (operator 6), built from DataFrame operations only.

A record hashes to one of a fixed number of slots for ever; which shard holds a slot is a small table
with versions. The bytes of each slot are summed by Spark, and a rebalancing edits the table: slots move
or change places between heavy and light shards until no edit evens them out further. A grown version
adds one shard that only takes slots, so no record moves between old shards. The table has as many rows
as there are slots, whatever the data, so it is edited on the driver and joined by broadcast.

Defined results: a null text has no bytes; size is UTF-8 bytes plus 8; a record's slot comes from its id
and its text's checksum, so copies of one text and rows with one id spread out, while rows repeated
whole share a slot; places within a shard are gapless and ordered by slot, id, checksum; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuepay.session import scratch_path

SLOTS = 8192
PART_BYTES = 1 << 16  # bytes of a row repeated whole that share a slot, one row at least


def slotted(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, part, times, virtual_slot``: rows repeated whole are one row, ``times``
    over, for each part of them."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + F.lit(8)).cast("bigint").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    most = F.greatest(F.floor(F.lit(PART_BYTES) / F.col("size")), F.lit(1)).cast("bigint")  # repeats in a part
    parts = (rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")).withColumn("most", most)
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.col("most")).cast("bigint"))))
             .withColumn("times", F.least("most", F.col("n") - F.col("part") * F.col("most"))))
    first = F.xxhash64("doc_id", "text_crc32")
    return (parts.withColumn("virtual_slot", F.pmod(F.when(F.col("part") == 0, first).otherwise(F.xxhash64("doc_id", "text_crc32", "part")),
                                                    F.lit(slots)).cast("int"))
            .select("doc_id", "size", "text_crc32", "part", "times", "virtual_slot"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of each slot; at most ``slots`` rows come to the driver."""
    size, count = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for r in rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("times")).alias("b"), F.sum("times").alias("n")).collect():
        size[r["virtual_slot"]], count[r["virtual_slot"]] = r["b"], r["n"]
    return size, count


def first_map(slots: int, shards: int) -> np.ndarray:
    """Version 1: slots dealt in turn."""
    return np.arange(slots) % shards


def rebalanced(shard_of: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """An edited map: the heaviest shard gives a slot to a light one, or exchanges two, as long as that
    lowers the heavier of the two."""
    shard_of = shard_of.copy()
    load = np.bincount(shard_of, weights=size, minlength=shards).astype(np.int64)
    edited = True
    while edited:
        edited = False
        heavy = int(load.argmax())
        own = np.flatnonzero(shard_of == heavy)
        for light in np.argsort(load, kind="stable").tolist():
            gap = int(load[heavy] - load[light])
            if gap <= 1:
                break
            # what the heavy shard would lose by giving a slot, or by exchanging it for one of theirs
            theirs = np.append(np.flatnonzero(shard_of == light), -1)
            weight = np.where(theirs >= 0, size[theirs], 0)
            order = np.argsort(weight, kind="stable")
            at = np.searchsorted(weight[order], size[own] - gap // 2)
            best = None
            for side in (np.clip(at, 0, len(order) - 1), np.clip(at - 1, 0, len(order) - 1)):
                loss = size[own] - weight[order[side]]
                miss = np.abs(2 * loss - gap)
                k = int(miss.argmin())
                if 0 < loss[k] < gap and (best is None or miss[k] < best[0]):
                    best = (int(miss[k]), int(own[k]), int(theirs[order[side[k]]]), int(loss[k]))
            if best:
                _, give, take, loss = best
                shard_of[give] = light
                if take >= 0:
                    shard_of[take] = heavy
                load[heavy] -= loss
                load[light] += loss
                edited = True
                break
    return shard_of


def grown(shard_of: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """An edited map with one shard more: it takes slots from the heaviest shards, the largest that fit,
    until it has its share; no other slot moves."""
    shard_of = shard_of.copy()
    load = np.append(np.bincount(shard_of, weights=size, minlength=shards), 0).astype(np.int64)
    share = int(size.sum()) // (shards + 1)
    while load[shards] < share:
        heavy = int(load[:shards].argmax())
        own = np.flatnonzero((shard_of == heavy) & (size > 0) & (size <= share - load[shards]))
        if not len(own):
            break
        give = own[int(size[own].argmax())]
        shard_of[give] = shards
        load[heavy] -= size[give]
        load[shards] += size[give]
    return shard_of


def store_map(spark: SparkSession, path: str, version: int, shard_of: np.ndarray, size: np.ndarray, rows: np.ndarray) -> None:
    """Write one version of the map below ``path``; earlier versions stay as they are. ``first`` is the
    place of a slot's first record within its shard."""
    first = np.zeros(len(shard_of), np.int64)
    for shard in np.unique(shard_of):
        own = np.flatnonzero(shard_of == shard)
        first[own] = np.cumsum(rows[own]) - rows[own]
    lines = list(zip(range(len(shard_of)), shard_of.tolist(), first.tolist(), size.tolist(), rows.tolist()))
    (spark.createDataFrame(lines, "virtual_slot int, shard int, first long, bytes long, rows long")
     .coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}"))


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, key: str = "doc_id", text: str = "text",
                    path: str | None = None) -> DataFrame:
    """Deal every row to a shard so that shards hold nearly equal bytes: ``doc_id, size, text_crc32, law,
    shard, slot`` (place in the shard), ``grown_shard`` (null under this law), ``virtual_slot`` and
    ``map_version``. The map's versions are stored below ``path`` (default: the shared scratch folder)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "slot-map")
    rows = slotted(docs, slots, key, text)
    size, count = slot_sizes(rows, slots)
    dealt = first_map(slots, shards)
    store_map(spark, path, 1, dealt, size, count)
    store_map(spark, path, 2, rebalanced(dealt, size, shards), size, count)
    in_slot = Window.partitionBy("virtual_slot").orderBy(F.asc_nulls_last("doc_id"), "text_crc32", "size", "part").rowsBetween(Window.unboundedPreceding, 0)
    current = F.broadcast(read_map(spark, path, 2).select("virtual_slot", "shard", "first"))  # ``slots`` rows
    return (
        rows.withColumn("last", F.sum("times").over(in_slot))
        .withColumn("place", F.explode(F.sequence(F.col("last") - F.col("times") + 1, F.col("last"))))
        .join(current, "virtual_slot")
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("first") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                "virtual_slot", F.lit(2).alias("map_version"))
    )
