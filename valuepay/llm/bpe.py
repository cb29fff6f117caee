"""Byte-level byte-pair encoding and decoding by corpus-level merge replay (operator 1).

A task holds a block of documents as one small corpus. Its distinct pre-tokens are laid out once
as byte symbols; an inverted index keeps, for every adjacent symbol pair that has a merge, the
positions at which it stands. Merges are then applied in rank order, each to all its positions at
once, and only the pairs to the left and right of a merged position are looked up again. A pre-token
that occurs a thousand times in the block is merged once, and ranks that do not occur cost nothing.

Pre-tokens are independent of each other, so the result does not depend on how documents are dealt
to blocks; nothing is shuffled and a lost task is simply recomputed.

Defined results: null and empty text give no ids; texts of any length are encoded whole; repeated
rows give repeated rows; an empty table gives an empty result; other columns are carried by the
caller or left out, never interpreted.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.words import Numbers, blocks, ragged

BLOCK_BYTES = 8 << 20  # a larger block holds fewer distinct words for its size
NONE = np.int32(2**31 - 1)
SHIFT = 20  # symbol ids of the tables used here stay below 2**20
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A pre-token never spans a step from a non-space to a space, so texts may be cut there.
UNITS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WHITE_RE2 = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LONG_WHITE = f"[{_WHITE_RE2}] | [{_WHITE_RE2}]|^ | $"


class Merges:
    """Merge rules as arrays: byte symbols, and for a symbol pair its rank and the merged symbol."""

    def __init__(self, symbols: list[bytes], byte_ids: list[int], rules: dict[tuple[int, int], tuple[int, int]]):
        self.symbols = symbols
        self.byte_ids = np.array(byte_ids, np.int32)
        self.rules = rules
        keys = np.fromiter(((a << SHIFT) | b for a, b in rules), np.int64, len(rules))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.rank = np.append(np.fromiter((r for r, _ in rules.values()), np.int32, len(rules))[order], NONE)
        self.into = np.zeros(int(self.rank[:-1].max(initial=-1)) + 1, np.int32)
        for r, new in rules.values():
            self.into[r] = new

        left, right = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.first = self.ranks(left, right).reshape(256, 256)  # of pairs of single bytes

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where the pair has no merge."""
        key = (left.astype(np.int64) << SHIFT) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], NONE)


@lru_cache(maxsize=4)
def rank_file(path: str) -> Merges:
    """Rules of a rank file: any two adjacent tokens merge whose joined bytes are a token, at that
    token's rank; a token's id is its rank."""
    with open(path, "rb") as f:
        vocab = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    symbols: list[bytes] = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        symbols[i] = token
    rules = {}
    for token, i in vocab.items():
        for k in range(1, len(token)):
            a, b = vocab.get(token[:k]), vocab.get(token[k:])
            if a is not None and b is not None:
                rules[a, b] = (i, i)
    return Merges(symbols, [vocab[bytes([x])] for x in range(256)], rules)


@lru_cache(maxsize=4)
def merge_file(path: str) -> tuple[Merges, dict[str, int]]:
    """Rules of a byte-level tokenizer file (vocabulary and merges by their order), and its special
    strings with their ids."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    # such files write a byte as itself where it is printable, the others from 256 on in order
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab = content["model"]["vocab"]
    symbols: list[bytes] = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        symbols[i] = bytes(byte_of[c] for c in token)
    single = {byte_of[t]: i for t, i in vocab.items() if len(t) == 1}
    rules = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(content["model"]["merges"])}
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return Merges(symbols, [single[b] for b in range(256)], rules), special


def encode_one(word: bytes, m: Merges) -> list[int]:
    """One pre-token by repeatedly merging its leftmost pair of lowest rank."""
    parts = m.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    while len(parts) > 1:
        best = min((m.rules.get((a, b), (NONE, 0)) + (i,) for i, (a, b) in enumerate(zip(parts, parts[1:]))),
                   key=lambda x: (x[0], x[2]))
        if best[0] == NONE:
            break
        parts[best[2]:best[2] + 2] = [best[1]]
    return parts


def replay(words: pa.Array, m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Encode distinct pre-tokens (string or binary) together: their ids one after another, and where each starts."""
    _, edges, data = words.buffers()
    starts = np.frombuffer(edges, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]] if data is not None else np.zeros(0, np.uint8)
    starts = starts - starts[0]
    sizes = np.diff(starts)
    n = int(starts[-1])
    sym = m.byte_ids[raw]
    nxt = np.arange(1, n + 1, dtype=np.int32)
    prv = np.arange(-1, n - 1, dtype=np.int32)
    filled = starts[:-1][sizes > 0]
    prv[filled] = -1
    nxt[starts[1:][sizes > 0] - 1] = -1
    alive = np.ones(n, bool)

    rk = np.full(n, NONE, np.int32)
    at = np.flatnonzero(nxt >= 0)
    rk[at] = m.first[raw[at], raw[at + 1]]
    at = np.flatnonzero(rk != NONE).astype(np.int32)
    at = at[np.argsort(rk[at], kind="stable")]
    cuts = np.flatnonzero(np.diff(rk[at])) + 1
    index: dict[int, list] = {int(rk[p[0]]): [p] for p in np.split(at, cuts) if len(p)}
    due = list(index)
    heapq.heapify(due)
    early: list[np.ndarray] = []  # positions where a merge made a pair of lower rank than its own
    while due:
        r = heapq.heappop(due)
        entries = index.pop(r)
        arrays = [x for x in entries if not isinstance(x, int)]
        single = [x for x in entries if isinstance(x, int)]
        if single:
            arrays.append(np.array(single, np.int32))
        pos = arrays[0] if len(arrays) == 1 else np.concatenate(arrays)
        pos = pos[rk[pos] == r]
        if not len(pos):
            continue
        right = nxt[pos]
        if sym[pos[0]] == sym[right[0]]:
            # a run such as "aaa" offers overlapping pairs: the leftmost wins, the next is gone
            pos = np.sort(pos)
            taken, keep = -1, []
            for p, q in zip(pos.tolist(), nxt[pos].tolist()):
                if p != taken:
                    keep.append(p)
                    taken = q
            pos = np.array(keep, np.int32)
            right = nxt[pos]
        sym[pos] = m.into[r]
        after = nxt[right]
        nxt[pos] = after
        alive[right] = False
        rk[right] = NONE
        rk[pos] = NONE
        inner = after >= 0
        prv[after[inner]] = pos[inner]
        before = prv[pos]
        touched = np.concatenate((pos[inner], before[before >= 0]))
        if not len(touched):
            continue
        touched.sort()
        touched = touched[np.append(True, touched[1:] != touched[:-1])]
        new = m.ranks(sym[touched], sym[nxt[touched]])
        rk[touched] = new
        some = new != NONE
        touched, new = touched[some], new[some]
        if not len(new):
            continue
        if new.min() <= r:
            early.append(touched[new <= r])
        if len(new) <= 48:
            for q, p in zip(new.tolist(), touched.tolist()):
                if q in index:
                    index[q].append(p)
                else:
                    index[q] = [p]
                    heapq.heappush(due, q)
        else:
            order = np.argsort(new, kind="stable")
            touched, new = touched[order], new[order]
            cuts = np.flatnonzero(new[1:] != new[:-1]) + 1
            edges = [0, *cuts.tolist(), len(new)]
            for q, lo, hi in zip(new[edges[:-1]].tolist(), edges, edges[1:]):
                if q in index:
                    index[q].append(touched[lo:hi])
                else:
                    index[q] = [touched[lo:hi]]
                    heapq.heappush(due, q)

    ids = sym[alive]
    count = np.zeros(n + 1, np.int64)
    np.cumsum(alive, out=count[1:])
    offsets = count[starts]
    if early:
        # Rank order over the block and rank order within a word can differ here: redo these words.
        odd = np.unique(np.searchsorted(starts, np.concatenate(early), side="right") - 1)
        redone = {int(w): encode_one(raw[starts[w]:starts[w + 1]].tobytes(), m) for w in odd}
        if any(ids[offsets[w]:offsets[w + 1]].tolist() != x for w, x in redone.items()):
            parts = [redone.get(w, None) for w in range(len(words))]
            parts = [ids[offsets[w]:offsets[w + 1]] if p is None else np.array(p, np.int32) for w, p in enumerate(parts)]
            offsets = np.zeros(len(words) + 1, np.int64)
            np.cumsum([len(p) for p in parts], out=offsets[1:])
            ids = np.concatenate(parts) if parts else ids
    return ids, offsets


def units_of(texts: pa.Array) -> tuple[pa.Array, list[str], np.ndarray, np.ndarray]:
    """Distinct units of a block of texts: words that stand behind one space (without it), and other
    units as they are; the number of each unit in reading order (the words' first, then the others'),
    and where each text's units start.

    A text whose only neighbours of spaces are other characters is cut at its spaces by Arrow; one
    with longer white space is scanned.
    """
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, LONG_WHITE).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
    flat = pc.list_flatten(parts).dictionary_encode()
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    bodies = flat.dictionary
    number = flat.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    firsts = begins[~odd]
    own = Numbers()  # the first unit of a text has no space before it; scanned texts have any units
    number[firsts] = len(bodies) + np.array([own[u] for u in bodies.take(pa.array(number[firsts])).to_pylist()], np.int32)
    if odd.any():
        scanned = {i: [own[u] for u in UNITS.findall(texts[i].as_py())] for i in np.flatnonzero(odd).tolist()}
        pieces = [number[b:b + n] if i not in scanned else np.array(scanned[i], np.int32) + len(bodies)
                  for i, (b, n) in enumerate(zip(begins.tolist(), sizes.tolist()))]
        number = np.concatenate(pieces)
        sizes = np.array([len(x) for x in pieces], np.int64)
    starts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    return bodies, list(own), number, starts


def cut_units(units: pa.Array, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """Pre-tokens of units one after another, and how many each unit has. The units are cut in one scan
    of all of them joined, as they would stand in a text; by themselves if the pattern leaves gaps."""
    split = regex.compile(pattern).findall
    pieces = pa.array(split("".join(units.to_pylist())), pa.string())
    ends = np.cumsum(pc.utf8_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64))
    edges = np.cumsum(pc.utf8_length(units).to_numpy(zero_copy_only=False).astype(np.int64))
    upto = np.searchsorted(ends, edges, side="right")
    if len(ends) and len(edges) and ends[-1] == edges[-1] and (ends[np.maximum(upto, 1) - 1][edges > 0] == edges[edges > 0]).all():
        return pieces, np.diff(upto, prepend=0)
    rows = [split(u) for u in units.to_pylist()]
    return pa.array([w for row in rows for w in row], pa.string()), np.array([len(row) for row in rows], np.int64)


def encode_block(texts: pa.Array, pattern: str, m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Encode a block of texts: all ids one after another, and where each text's ids start.

    The block's distinct units are cut into pre-tokens by ``pattern``, and the distinct pre-tokens
    are replayed together.
    """
    bodies, own, number, starts = units_of(texts)
    units = pc.binary_join_element_wise(" ", bodies, "")
    letters = pc.ascii_is_alpha(bodies)  # one match of the letters' branch
    plain = letters.to_numpy(zero_copy_only=False)
    pieces, many = cut_units(units.filter(pc.invert(letters)), pattern)
    split = regex.compile(pattern).findall
    rows = [split(u) for u in own]
    words = pa.concat_arrays([units.filter(letters), pieces, pa.array([w for row in rows for w in row], pa.string())]).dictionary_encode()

    # where the pre-tokens of each unit stand among all of them
    count = np.ones(len(bodies) + len(own), np.int64)
    count[:len(bodies)][~plain] = many
    count[len(bodies):] = [len(row) for row in rows]
    first = np.zeros(len(count), np.int64)
    first[:len(bodies)][plain] = np.arange(plain.sum())
    first[:len(bodies)][~plain] = plain.sum() + np.cumsum(many) - many
    first[len(bodies):] = plain.sum() + many.sum() + np.cumsum(count[len(bodies):]) - count[len(bodies):]
    ends = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=ends[1:])
    at = np.repeat(first - ends[:-1], count) + np.arange(ends[-1])

    ids, offsets = replay(words.dictionary, m)
    # ids of each unit: those of its pre-tokens one after another
    unit_ids, begins = ragged(ids, offsets, words.indices.to_numpy(zero_copy_only=False)[at])
    out, begins = ragged(unit_ids, begins[ends], number)
    return out, begins[starts]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text: ``key`` and ``ids array<int>``, in one pass over the rows.

    ``path``: a rank file (lines of base64 token and rank) readable on the executors; ``pattern``:
    the regular expression that cuts texts into pre-tokens. Null or empty text: no ids.
    """
    def run(batches):
        m = rank_file(path)
        for block in blocks(batches, "t", BLOCK_BYTES):
            ids, starts = encode_block(block.column("t"), pattern, m)
            yield pa.RecordBatch.from_arrays(
                [block.column("k"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))],
                names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The bytes behind each row's ids: ``key`` and ``decoded binary``. Null or no ids: no bytes.

    An id outside the vocabulary raises ``IndexError``.
    """
    def run(batches):
        token = rank_file(path).symbols.__getitem__
        for batch in batches:
            rows = [b"".join(map(token, x or ())) for x in batch.column("i").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(rows, pa.binary())], names=[key, "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("k"), F.col(ids).alias("i")).mapInArrow(run, f"`{key}` {kind}, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every whole text in one pass and keep digests: ``key``, ``n_tokens``,
    ``ids_sha256`` (decimal ids joined by one space), ``decoded_sha256`` (decoded bytes), both in
    lowercase hex. Null or empty text: no tokens, digests of the empty string."""
    def run(batches):
        m = rank_file(path)
        token, decimal = m.symbols.__getitem__, [str(i) for i in range(len(m.symbols))].__getitem__
        sha = hashlib.sha256
        for block in blocks(batches, "t", BLOCK_BYTES):
            ids, starts = encode_block(block.column("t"), pattern, m)
            digests, decoded = [], []
            for lo, hi in zip(starts.tolist(), starts[1:].tolist()):
                row = ids[lo:hi].tolist()
                digests.append(sha(" ".join(map(decimal, row)).encode()).hexdigest())
                decoded.append(sha(b"".join(map(token, row))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [block.column("k"), pa.array(np.diff(starts), pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
