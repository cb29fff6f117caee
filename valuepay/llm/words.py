"""Words of a block of texts as numbers, for operators that work on Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20  # the arrays over a block take some thirty times as much memory


class Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def release() -> None:
    """Give memory that is free inside this worker back to the system: workers live on between tasks,
    and what one keeps is missing to the executor's other worker and its JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a block holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
        release()


def ragged(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``values[offsets[r]:offsets[r + 1]]`` of all ``rows`` one after another, and the
    position at which each begins (one more for the end)."""
    sizes = (offsets[1:] - offsets[:-1])[rows]
    begins = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=begins[1:])
    kind = np.int32 if max(len(values), int(begins[-1])) < 1 << 31 else np.int64
    at = np.repeat((offsets[:-1][rows] - begins[:-1]).astype(kind), sizes)
    at += np.arange(begins[-1], dtype=kind)
    return values[at], begins


def mapped_bytes(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """The texts with every UTF-8 byte replaced by ``table`` (which must keep bytes over 127)."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return texts
    _, offsets, data = texts.buffers()
    first = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[first[0]:first[-1]] if data is not None else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((first - first[0]).tobytes()), pa.py_buffer(table[raw].tobytes())])


#: A-Z in lower case, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts (null: none): the distinct words, the number of each
    word in reading order, and where each text's words start (one more for the end)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = pc.list_flatten(parts)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    edges = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=edges[1:])
    before = np.zeros(len(full) + 1, np.int64)
    np.cumsum(full, out=before[1:])
    coded = flat.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False)
    return coded.dictionary, number if full.all() else number[full], before[edges]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of batches sorted by ``keys`` (not null), run by run of equal keys, whatever the batches' cuts."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            column = batch.column(k)
            change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            key = [batch.column(k)[lo].as_py() for k in keys]
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)
