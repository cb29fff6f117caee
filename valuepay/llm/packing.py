"""Best-fit packing with a grouping genetic algorithm on islands (operator 8).

Documents are tokenised, ended, and cut into pieces of at most ``capacity`` tokens; a full piece is a
sequence by itself. The other pieces are dealt to islands of bounded size. On an island a population of
packings evolves: crossover takes well-filled bins whole from one parent (or from a neighbouring island's
elite, as patterns of lengths), puts them into the other, dissolves the bins that hold the same pieces
twice, and places the displaced pieces by best fit, largest first. After an epoch an island's elite bins
are final; their patterns migrate to the next island, and the pieces of all other bins are dealt anew to
fewer islands, until one is left or an epoch settles nothing.

Spark deals, groups and joins; an island is one group of at most about ``ISLAND`` short rows. Each
epoch's packing is a written table, so a lost executor costs one epoch at most.

Defined results: a null text is empty and makes one piece of the end token; repeated rows are packed
each; pieces of equal length are interchangeable and ties go by piece number; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuepay.llm.bpe import BLOCK_BYTES, encode_block, merge_file
from valuepay.llm.words import blocks
from valuepay.session import scratch_path

ISLAND = 4096
POPULATION = 5
GENERATIONS = 16
ELITE = 64  # patterns that an island sends on


def token_ids(texts: pa.Array, path: str, pattern: str = PATTERN) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block of texts one after another, and where each text's begin, as the tokenizers
    library gives them for a byte-level file: merges in order, special strings as their own ids."""
    merges, special = merge_file(path)
    texts = pc.fill_null(texts, "")
    if not special:
        return encode_block(texts, pattern, merges)
    cuts = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
    odd = pc.match_substring_regex(texts, cuts.pattern).to_numpy(zero_copy_only=False)
    if not odd.any():
        return encode_block(texts, pattern, merges)
    # texts with special strings are cut there, and the ids of their parts put together again
    parts = [cuts.split(t.as_py()) if o else [t.as_py()] for t, o in zip(texts, odd.tolist())]
    ids, starts = encode_block(pa.array([x for p in parts for x in p[::2]], pa.string()), pattern, merges)
    out, at = [], 0
    for p in parts:
        row = []
        for k, x in enumerate(p):
            if k % 2:
                row.append(np.array([special[x]], ids.dtype))
            else:
                row.append(ids[starts[at]:starts[at + 1]])
                at += 1
        out.append(np.concatenate(row))
    begins = np.zeros(len(out) + 1, np.int64)
    np.cumsum([len(x) for x in out], out=begins[1:])
    return np.concatenate(out), begins


def cut(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False,
        key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32, piece_id`` (a number of its
    own) and, if asked for, ``ids``. ``path``: a tokenizer file readable on the executors."""
    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for block in blocks(batches, "t", BLOCK_BYTES):
            ids, starts = token_ids(block.column("t"), path)
            ids = np.insert(ids.astype(np.uint32), starts[1:], np.uint32(end_id))
            starts = starts + np.arange(len(starts))
            size = np.diff(starts)  # one token at least
            many = -(-size // capacity)
            rows = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
            head = ((size - 1) % capacity + 1)[rows]  # the first piece takes what does not fill one
            begin = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            lo = starts[:-1][rows] + begin
            data = memoryview(ids.astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(data[4 * x:4 * y]) for x, y in zip(lo.tolist(), (lo + length).tolist())]
            columns = [block.column("k").take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(begin, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.arange(number, number + len(rows)))]
            parts = pa.ListArray.from_arrays(pa.array(np.append(lo, starts[-1]), pa.int32()), pa.array(ids.astype(np.int32))) if with_ids else None
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "piece_id"]
            number += len(rows)
            yield pa.RecordBatch.from_arrays(columns + [parts] * with_ids,
                                             names=names + ["ids"] * with_ids)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, piece_id bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, schema)


def best_fit(bins: list[list[int]], items: list[int], size: list[int], capacity: int) -> None:
    """Place items, in their order, each into the fullest bin that has room; else into a new one."""
    room = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, members in enumerate(bins):
        left = capacity - sum(size[i] for i in members)
        if left:
            room[left].append(b)
            mask |= 1 << left
    for i in items:
        need = size[i]
        fits = mask >> need
        if fits:
            left = need + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
            bins[b].append(i)
            left -= need
        else:
            b = len(bins)
            bins.append([i])
            left = capacity - need
        if left:
            room[left].append(b)
            mask |= 1 << left


def inject(parent: list[list[int]], chosen: list[list[int]], size: list[int], capacity: int) -> list[list[int]]:
    """A child: the chosen bins whole, the parent's other bins, and what was displaced by best fit."""
    taken = {i for b in chosen for i in b}
    child, displaced = [list(b) for b in chosen], []
    for b in parent:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced.extend(i for i in b if i not in taken)
    displaced.sort(key=lambda i: (-size[i], i))
    best_fit(child, displaced, size, capacity)
    return child


def fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller full ones (the mean square of fill)."""
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def evolve(size: list[int], immigrants: list[list[int]], capacity: int, seed: int,
           population: int = POPULATION, generations: int = GENERATIONS) -> list[list[int]]:
    """The best packing (bins of item numbers) after ``generations`` crossovers."""
    rng = np.random.default_rng(seed)
    order = sorted(range(len(size)), key=lambda i: (-size[i], i))
    people = []
    for k in range(population):
        # the first is best-fit decreasing, the others place the items in a disturbed order
        noise = rng.normal(0, 0.02 * capacity * k, len(size))
        bins: list[list[int]] = []
        best_fit(bins, order if not k else sorted(order, key=lambda i: -(size[i] + noise[i])), size, capacity)
        people.append((fitness(bins, size, capacity), bins))

    def full(bins):
        return [b for b in bins if sum(size[i] for i in b) == capacity]

    if immigrants:
        # an immigrant pattern becomes a bin where pieces of its lengths are at hand
        stock: dict[int, list[int]] = {}
        for i in order:
            stock.setdefault(size[i], []).append(i)
        chosen = []
        for pattern in immigrants:
            got = []
            for n in pattern:
                if not stock.get(n):
                    break
                got.append(stock[n].pop())
            if len(got) == len(pattern):
                chosen.append(got)
            else:
                for i in got:
                    stock[size[i]].append(i)
        if chosen:
            child = inject(people[0][1], chosen, size, capacity)
            people.append((fitness(child, size, capacity), child))
    least = -(-sum(size) // capacity)
    for _ in range(generations):
        people.sort(key=lambda p: p[0], reverse=True)
        del people[population:]
        if -people[0][0][0] <= least:
            break
        a, b = rng.choice(len(people), 2, replace=False) if len(people) > 1 else (0, 0)
        donor = full(people[b][1]) or people[b][1]
        if not donor:
            break
        some = rng.permutation(len(donor))[: max(1, len(donor) // int(rng.integers(2, 6)))]
        child = inject(people[a][1], [donor[i] for i in some], size, capacity)
        people.append((fitness(child, size, capacity), child))
    return max(people, key=lambda p: p[0])[1]


def _island(capacity: int, seed: int, names: list[str]):
    """One island's epoch: its pieces and the patterns that reached it, to its pieces in bins."""
    def live(items: pd.DataFrame, patterns: pd.DataFrame) -> pd.DataFrame:
        if not len(items):
            return pd.DataFrame({n: [] for n in names})
        items = items.sort_values("piece_id", ignore_index=True)
        size = items["length"].tolist()
        bins = evolve(size, [list(p) for p in patterns["lengths"]], capacity, seed)
        out = items.iloc[[i for b in bins for i in b]].copy()
        out["sequence_id"] = [2 * min(int(items["piece_id"][i]) for i in b) for b in bins for _ in b]
        out["offset"] = [int(o) for b in bins for o in np.cumsum([0] + [size[i] for i in b[:-1]])]
        out["fill"] = [int(f) for b in bins for f in [sum(size[i] for i in b)] * len(b)]
        return out[names]

    return live


def pack(pieces: DataFrame, capacity: int = 1024, island: int = ISLAND, epochs: int = 6) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` (place in the sequence, gapless from 0).

    ``pieces`` holds ``piece_id`` (distinct) and ``length`` (1 to ``capacity``); it is read several times,
    so it should be a written table.
    """
    spark = pieces.sparkSession
    done = [pieces.filter(F.col("length") == capacity).withColumns({"sequence_id": F.col("piece_id") * 2 + 1, "offset": F.lit(0).cast("bigint")})]
    rest = pieces.filter(F.col("length") < capacity)
    schema = pieces.limit(0).withColumns({c: F.lit(0).cast("bigint") for c in ("island", "sequence_id", "offset", "fill")}).schema
    names = [f.name for f in schema]
    none = spark.createDataFrame([], "island int, lengths array<bigint>")
    elite, count = none, rest.count()
    for epoch in range(epochs):
        if not count:
            break
        islands = -(-count // island)
        last = islands == 1 or epoch == epochs - 1

        dealt = rest.withColumn("island", F.pmod(F.xxhash64("piece_id", F.lit(epoch)), F.lit(islands)))
        packed = dealt.groupBy("island").cogroup(elite.groupBy("island")).applyInPandas(_island(capacity, epoch, names), schema)
        path = scratch_path(spark, f"packing-{epoch}")
        packed.write.parquet(path)
        packed = spark.read.parquet(path)
        if last:
            done.append(packed)
            count = 0
            break
        # bins that waste next to nothing are final; the slack allowed grows with the epochs
        final = packed.filter(F.col("fill") >= capacity - epoch)
        done.append(final)
        rest = packed.filter(F.col("fill") < capacity - epoch).select(*pieces.columns)
        left = rest.count()
        best = Window.partitionBy("island").orderBy("sequence_id")
        target = max(1, -(-left // island))
        elite = (final.groupBy("island", "sequence_id").agg(F.sort_array(F.collect_list("length"), False).alias("lengths"))
                 .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= ELITE)
                 .select(F.pmod(F.col("island") + 1, F.lit(target)).cast("int").alias("island"), "lengths"))
        if left == count:
            done.append(packed.filter(F.col("fill") < capacity - epoch))
            break
        count = left
    columns = [*pieces.columns, "sequence_id", "offset"]
    out = done[0].select(*columns)
    for more in done[1:]:
        out = out.unionByName(more.select(*columns))
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, cut and pack all documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    place = scratch_path(spark, "pieces")
    cut(docs, path, capacity, end_id, key=key, text=text).write.parquet(place)
    return pack(spark.read.parquet(place), capacity).select(
        F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
