"""Licence scan with a generalised suffix automaton of licence words (operator 9).

The words of all templates and base phrases form one automaton. A document's words are streamed through
it, which gives the matching statistics: for each word, the length of the longest run ending there that
stands in some template, and where. Runs of at least ``least`` words that cannot be extended are chained
per template, in order in both the document and the template and with bounded gaps, into the chains that
cover most words, and a template is found where a chain covers enough of its words. A stray run costs no
more than the gap that it fills. Base phrases are read off the same states.

Only runs of words whose neighbouring pairs stand in a template can match two words or more, so other
places are passed over with array operations; their statistic is 0 or 1.

Defined results: null and empty text have no words, no label and score 0; texts are scanned whole;
repeated rows give repeated rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.words import blocks, mapped_bytes, words_of

# Base phrases with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Templates of licence notices with their labels, in lower-case words.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under cc by 4 0", "cc-by"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
)

# Bytes outside words become spaces, A-Z become lower case; bytes over 127 are word characters.
WORD_BYTES = np.full(256, 32, np.uint8)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    WORD_BYTES[_b] = _b
for _b in range(65, 91):
    WORD_BYTES[_b] = _b + 32


@dataclass
class Span:
    label: str
    start: int  # first word in the document
    end: int  # after the last word
    coverage: float  # share of the template's words that the chained runs cover


class Automaton:
    """Generalised suffix automaton over word numbers (0: a word of no template)."""

    def __init__(self, templates, phrases):
        self.templates = [(t.split(), label) for t, label in templates]
        self.phrases = [(p.split(), label) for p, label in phrases]
        words = dict.fromkeys(w for t, _ in (*self.templates, *self.phrases) for w in t)
        self.number = {w: i + 1 for i, w in enumerate(words)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [[self.number[w] for w in t] for t, _ in (*self.templates, *self.phrases)]
        for t in texts:
            last = 0
            for w in t:
                last = self._extend(last, w)
        # ends[state]: where its words end in each template (all occurrences are few and short)
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for k, t in enumerate(texts[:len(self.templates)]):
            state = 0
            for i, w in enumerate(t):
                state = self.next[state][w]
                at = state
                while at > 0:
                    self.ends[at].append((k, i + 1))
                    at = self.link[at]
        # phrases that end where a state's words end
        self.phrase_at: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for k, t in enumerate(texts[len(self.templates):]):
            for state in range(len(self.next)):
                if self._ends_with(state, t):
                    self.phrase_at[state].append((k, len(t)))
        width = len(self.number) + 1
        self.pairs = np.zeros((width, width), bool)
        for t in texts:
            for a, b in zip(t, t[1:]):
                self.pairs[a, b] = True

    def _extend(self, last: int, w: int) -> int:
        """Append word ``w`` to the text that ends in state ``last``."""
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        """A state of its own for the words of ``q`` that are no longer than ``p`` and ``w``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _ends_with(self, state: int, phrase: list[int]) -> bool:
        """Whether the longest words of ``state`` end with ``phrase``: its link path passes there."""
        target = 0
        for w in phrase:
            target = self.next[target].get(w, -1)
            if target < 0:
                return False
        while state > 0 and state != target:
            state = self.link[state]
        return state == target and state > 0

    def statistics(self, words: list[int]):
        """For each word the state and the length of the longest run ending there."""
        state = length = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                length += 1
            yield state, length

    def scan(self, words: np.ndarray, least: int, gap: int, cover: float):
        """Base phrase places ``(start, phrase)`` and found template spans of one document."""
        near = self.pairs[words[:-1], words[1:]]
        if not near.any():
            return [], []
        edge = np.diff(np.concatenate(([0], near.view(np.int8), [0])))
        phrases, runs = [], []
        for lo, hi in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + 1).tolist()):
            before = (0, 0)
            for i, (state, length) in enumerate(self.statistics(words[lo:hi].tolist()), lo):
                if length <= before[1] and before[1] >= least:
                    runs.append((i - before[1], i, before[0]))
                before = (state, length)
                for k, n in self.phrase_at[state]:
                    if length >= n:
                        phrases.append((i - n + 1, k))
            if before[1] >= least:
                runs.append((hi - before[1], hi, before[0]))
        return phrases, self._chain(runs, gap, cover)

    def _chain(self, runs: list[tuple[int, int, int]], gap: int, cover: float) -> list[Span]:
        """Long runs, in reading order, chained per template into spans: of the chains that cover enough,
        the heaviest first, those that share no word of the document."""
        places: dict[int, list[tuple[int, int, int]]] = {}  # template: start, end, end in it
        for start, end, state in runs:
            for k, at in self.ends[state]:
                places.setdefault(k, []).append((start, end, at))
        found = []
        for k, left in places.items():
            whole = len(self.templates[k][0])
            while left:
                taken = []  # (start, end), in order
                for covered, start, end in sorted(best_chains(left, gap), key=lambda c: (-c[0], -c[1], c[2])):
                    if covered < cover * whole:
                        break
                    i = bisect(taken, (start, end))
                    if (i and taken[i - 1][1] > start) or (i < len(taken) and taken[i][0] < end):
                        continue
                    taken.insert(i, (start, end))
                    found.append(Span(self.templates[k][1], start, end, min(1.0, covered / whole)))
                if not taken:
                    break
                ends = [end for _, end in taken]
                after = [bisect(ends, start) for start, _, _ in left]  # the first span that ends after the run's start
                left = [p for p, i in zip(left, after) if i == len(taken) or taken[i][0] >= p[1]]
        return sorted(found, key=lambda s: (s.start, s.end, s.label))


def best_chains(places: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """For each place ``start, end, end in the template`` (by end) the heaviest chain that ends there, as
    ``words covered, start, end``: places follow in the document, within ``gap`` words, and in the
    template; words that overlap count once. Of equal chains the one that starts last."""
    best = []
    for i, (start, end, at) in enumerate(places):
        weight, first = end - start, start
        for j in range(i - 1, -1, -1):
            _, before, inside = places[j]
            if start - before > gap:
                break
            fresh = min(end - start, at - inside, end - before)
            if fresh > 0 and (best[j][0] + fresh, best[j][1]) > (weight, first):
                weight, first = best[j][0] + fresh, best[j][1]
        best.append((weight, first, end))
    return best


@lru_cache(maxsize=4)
def automaton(templates: tuple, phrases: tuple) -> Automaton:
    return Automaton(templates, phrases)


def scan(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES, least: int = 3, gap: int = 6,
         cover: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan every whole text in one pass over the rows.

    Returns ``key, n_words, n_base`` (places of base phrases), ``first_word, last_word`` (smallest and
    largest such place, else null), ``base_labels, labels`` (comma-joined, the second with those of found
    templates), ``score`` (the largest share of a template that a span covers, 0 to 1) and ``spans``
    (``label, start, end, coverage``, in words).

    ``least``: words of the shortest run that is chained; ``gap``: words that may lie between chained
    runs; ``cover``: share of a template's words that makes it found.
    """
    span_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))

    def run(batches):
        a = automaton(templates, phrases)
        for block in blocks(batches, "t"):
            distinct, number, starts = words_of(mapped_bytes(block.column("t"), WORD_BYTES))
            known = np.array([a.number.get(w, 0) for w in distinct.to_pylist()] or [0], np.int32)
            words = known[number] if len(number) else np.zeros(0, np.int32)
            out = {c: [] for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for lo, hi in zip(starts.tolist(), starts[1:].tolist()):
                places, spans = a.scan(words[lo:hi], least, gap, cover)
                base = {a.phrases[k][1] for _, k in places}
                out["n_base"].append(len(places))
                out["first_word"].append(min((p for p, _ in places), default=None))
                out["last_word"].append(max((p for p, _ in places), default=None))
                out["base_labels"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted(base | {s.label for s in spans})))
                out["score"].append(max((s.coverage for s in spans), default=0.0))
                out["spans"].append([vars(s) for s in spans])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span_type)
            yield pa.RecordBatch.from_arrays(
                [block.column("k"), pa.array(np.diff(starts), pa.int64())] + [pa.array(v, t) for v, t in zip(out.values(), kinds)],
                names=[key, "n_words", *out])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(
        run, f"`{key}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
             "labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,coverage:double>>")
