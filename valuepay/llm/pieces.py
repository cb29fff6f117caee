"""Token counts by heap-and-linked-list byte-pair merging (operator 10).

The library's result is a walk of merges over the characters of a text: the adjacent pair whose joined
piece has the best score merges first, the leftmost of equals. Here each distinct stretch of text that
no piece can cross is merged once with a heap of pairs over a linked list, and only its count
is kept: initial symbols minus merges, and for a character without a piece its UTF-8 bytes (byte
fallback). No token is ever written out, nothing is shuffled, and memory is bounded by a block and ``KNOWN`` counts.

Defined results: null counts as empty, the empty text has no token and no byte; texts of any length are
counted whole; repeated rows are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.words import blocks

KNOWN = 500_000  # distinct stretches whose counts a worker keeps between blocks
SPACE = "\u2581"  # stands for a space inside pieces
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """Ranks of the mergeable pieces (0 merges first; pieces of equal score share a rank) and the
    character pairs that stand side by side in some piece."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.known: dict[str, int] = {}
        scores = sorted({sp.get_score(i) for i in plain}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        self.rank = {sp.id_to_piece(i): place[sp.get_score(i)] for i in plain}
        self.joins = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        # a run of spaces begins a stretch only if no piece goes on into a space
        self.cut_at_space = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.joins)

    def stretches(self, unit: str) -> list[str]:
        """The unit cut between characters that no piece holds side by side."""
        joins, lo, out = self.joins, 0, []
        for i in range(1, len(unit)):
            if unit[i - 1:i + 1] not in joins:
                out.append(unit[lo:i])
                lo = i
        out.append(unit[lo:])
        return out

    def count(self, stretch: str) -> int:
        """Tokens of a stretch: a heap of adjacent pairs over a linked list of symbols."""
        rank = self.rank
        n = len(stretch)
        if n == 1:
            return 1 if stretch in rank else len(stretch.encode())
        end = list(range(1, n + 1))  # where the symbol that starts here ends; 0 once it is merged away
        prev = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(stretch[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 1, i + 2))
        heapify(heap)
        merges = 0
        while heap:
            _, left, mid, right = heappop(heap)
            if end[left] != mid or end[mid] != right:
                continue  # one of the two symbols has changed since
            end[left], end[mid] = right, 0
            merges += 1
            if right < n:
                prev[right] = left
                r = rank.get(stretch[left:end[right]])
                if r is not None:
                    heappush(heap, (r, left, right, end[right]))
            p = prev[left]
            if p >= 0:
                r = rank.get(stretch[p:right])
                if r is not None:
                    heappush(heap, (r, p, left, right))
        total, at = n - merges, 0
        while at < n:
            if end[at] == at + 1 and stretch[at] not in rank:
                total += len(stretch[at].encode()) - 1
            at = end[at]
        return total


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def count_block(texts: pa.Array, p: Pieces) -> np.ndarray:
    """Tokens of each text of a block. Every space becomes the piece mark and a text gets one before
    it; units begin at runs of marks."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, f"  |^ | $|{SPACE}").to_numpy(zero_copy_only=False)
    if not p.cut_at_space:
        odd = np.ones(len(texts), bool)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
    coded = pc.list_flatten(parts).dictionary_encode()
    known = p.known
    if len(known) > KNOWN:
        known.clear()

    def of(unit: str) -> int:
        total = 0
        for s in p.stretches(unit):
            n = known.get(s)
            if n is None:
                n = known[s] = p.count(s)
            total += n
        return total

    per_unit = np.array([of(SPACE + x) for x in coded.dictionary.to_pylist()], np.int64)
    sums = np.zeros(len(coded) + 1, np.int64)
    np.cumsum(per_unit[coded.indices.to_numpy(zero_copy_only=False)], out=sums[1:])
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), out=edges[1:])
    counts = sums[edges[1:]] - sums[edges[:-1]]
    counts[empty] = 0
    for i in np.flatnonzero(odd & ~empty).tolist():
        whole = SPACE + texts[i].as_py().replace(" ", SPACE)
        counts[i] = sum(of(u) for u in (RUNS.findall(whole) if p.cut_at_space else [whole]))
    return counts


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every
    whole text, as the piece model at ``path`` (readable on the executors) cuts it."""
    def run(batches):
        p = pieces(path)
        for block in blocks(batches, "t"):
            counts = count_block(block.column("t"), p)
            size = pc.fill_null(pc.binary_length(block.column("t")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [block.column("k"), size, pa.array(counts, pa.int64()), pa.array(counts > limit)],
                names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(
        run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
