"""Language identification with a linear-chain conditional random field (operator 4).

Every word of a document is labelled. A word's features are the hashed byte n-grams of the lower-cased
word between boundary marks (those that touch a mark are its affixes) and its whole form (the lexicon);
transitions between the labels of neighbouring words are learned with them. Forward-backward gives each
word's label probabilities, so a text that switches language keeps its parts apart; a document's
language is the one with the largest mean probability over its words with letters.

The model is fitted on the driver from a bounded sample of labelled rows (``PER_LANGUAGE`` rows of each
language, ``SAMPLE_CHARS`` characters of each) by full-batch Adagrad; a part of the training
sequences is spliced from rows of different languages, so transitions are seen. A chain is a run of at
most ``CHAIN`` words; longer texts are runs of chains, all of them read. Prediction is one pass over the
rows and shuffles nothing.

Defined results: a null text, or one without a letter, is ``und`` with score 0; if no row has a label,
every row is ``und``; ties go to the label that sorts first; a null id counts as the empty text in the
hold-out rule; repeated rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.llm.words import blocks, words_of

PER_LANGUAGE = 250
SAMPLE_CHARS = 1500
CHAIN = 64
BITS = 15  # buckets of each feature kind, as a power of two
KINDS = 5  # n-grams of 1 to 4 bytes, and whole words
EPOCHS = 25
BLOCK_BYTES = 2 << 20  # text labelled at once; its words' features take some fifty times as much memory


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    transitions: np.ndarray  # from label x to label
    start: np.ndarray


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' features one after another, and the word each belongs to."""
    lower = pc.utf8_lower(words).combine_chunks() if isinstance(words, pa.ChunkedArray) else pc.utf8_lower(words)
    sizes = pc.binary_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(sizes)
    if not n:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    _, offsets, data = lower.buffers()
    first = np.frombuffer(offsets, np.int32)[lower.offset:lower.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[first[0]:first[-1]]
    padded = np.full(len(raw) + 2 * n, 2, np.uint64)  # every word between marks 1 and 2
    begins = np.cumsum(sizes + 2) - (sizes + 2)
    padded[begins] = 1
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes + 2)
    inside = np.arange(len(raw)) + 2 * np.repeat(np.arange(n), sizes) + 1
    padded[inside] = raw
    buckets, owners = [], []
    code = padded.copy()
    for k in range(KINDS - 1):
        if k:
            code = code[:-1] * np.uint64(257) + padded[k:]
        same = owner[:len(code)] == owner[k:] if k else np.ones(len(code), bool)
        mixed = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
        buckets.append(mixed[same].astype(np.int32) + np.int32(k << BITS))
        owners.append(owner[:len(code)][same])
    # the whole word: a sum over its bytes, each weighted by its place
    place = np.arange(len(padded)) - np.repeat(begins, sizes + 2)
    power = (np.uint64(0x100000001B3) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))) ** np.uint64(3)
    whole = np.add.reduceat(padded * power, begins)
    mixed = (whole * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    buckets.append(mixed.astype(np.int32) + np.int32((KINDS - 1) << BITS))
    owners.append(np.arange(n, dtype=np.int32))
    return np.concatenate(buckets), np.concatenate(owners)


def word_scores(words: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Score of each label for each word: the mean weight of its features, times a constant number."""
    buckets, owners = features(words)
    count = np.maximum(np.bincount(owners, minlength=len(words)), 1)
    return np.stack([np.bincount(owners, weights=weights[buckets, y], minlength=len(words)) / np.sqrt(count)
                     for y in range(weights.shape[1])], axis=1)


def forward_backward(emission: np.ndarray, valid: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Label probabilities of each word, expected transition counts and expected first labels.

    ``emission``: chains x words x labels of scores; ``valid``: chains x words, each chain a prefix.
    """
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    t, s = np.exp(transitions), np.exp(start)
    n, length, labels = e.shape
    alpha = np.empty_like(e)
    beta = np.ones_like(e)
    a = s * e[:, 0]
    alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
    for k in range(1, length):
        a = (alpha[:, k - 1] @ t) * e[:, k]
        alpha[:, k] = a / a.sum(axis=1, keepdims=True)
    for k in range(length - 2, -1, -1):
        b = (e[:, k + 1] * beta[:, k + 1]) @ t.T
        b /= b.sum(axis=1, keepdims=True)
        beta[:, k] = np.where(valid[:, k + 1, None], b, 1.0)
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    return p, alpha, beta, e, t


def chains(number: np.ndarray, starts: np.ndarray, size: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts laid out as chains of at most ``size``: word positions (0 where there is none)
    and which of them are words."""
    lengths = np.diff(starts)
    per_text = -(-lengths // size)
    begin = np.repeat(starts[:-1], per_text) + size * (np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text))
    end = np.minimum(begin + size, np.repeat(starts[1:], per_text))
    at = begin[:, None] + np.arange(size)
    valid = at < end[:, None]
    return np.where(valid, at, 0), valid


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 1 divided by 3."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")), F.lit(3)) == 1


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, sample_chars: int = SAMPLE_CHARS, epochs: int = EPOCHS,
          key: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 5) -> Model:
    """Fit a model on a bounded sample of the rows with text and label outside the hold-out."""
    labelled = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("y")).filter(
        F.col("t").isNotNull() & F.col("y").isNotNull() & ~held_out("doc_id"))
    counts = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    labels = sorted(counts)
    rng = np.random.default_rng(seed)
    if not labels:
        return Model([], np.zeros((KINDS << BITS, 0)), np.zeros((0, 0)), np.zeros(0))
    from_char = F.pmod(F.xxhash64("doc_id"), F.greatest(F.char_length("t") - sample_chars, F.lit(0)) + 1) + 1
    rows = (labelled.sampleBy("y", {y: min(1.0, per_language / c) for y, c in counts.items()}, seed)
            .select("y", F.substring("t", from_char.cast("int"), F.lit(sample_chars)).alias("t")).collect())
    distinct, number, starts = words_of(pa.array([r["t"] for r in rows], pa.string()))
    label_of = {y: i for i, y in enumerate(labels)}
    at, valid = chains(number, starts)
    if not len(at):
        return Model([], np.zeros((KINDS << BITS, 0)), np.zeros((0, 0)), np.zeros(0))
    row_of_word = np.repeat(np.arange(len(rows)), np.diff(starts))
    gold_of_row = np.array([label_of[r["y"]] for r in rows])
    word, gold = number[at], gold_of_row[row_of_word[at]]
    # splice: the second half of every third chain comes from another chain
    other = rng.permutation(len(at))
    third = np.arange(len(at)) % 3 == 0
    half = CHAIN // 2
    word[third, half:], gold[third, half:] = word[other[third], :half], gold[other[third], :half]
    valid[third, half:] = valid[other[third], :half] & valid[third, half - 1:half]
    n, k = len(distinct), len(labels)
    buckets, owners = features(distinct)
    root = np.sqrt(np.maximum(np.bincount(owners, minlength=n), 1))
    m = Model(labels, np.zeros((KINDS << BITS, k)), np.zeros((k, k)), np.zeros(k))
    one = np.eye(k)[gold]
    sums = [np.full_like(x, 1e-6) for x in (m.weights, m.transitions, m.start)]
    inner = valid[:, 1:, None, None]
    weight = 1.0 / max(1, valid.sum())
    for _ in range(epochs):
        scores = np.stack([np.bincount(owners, weights=m.weights[buckets, y], minlength=n) / root for y in range(k)], axis=1)
        p, alpha, beta, e, t = forward_backward(scores[word], valid, m.transitions, m.start)
        diff = (p - one) * valid[:, :, None]
        by_word = np.stack([np.bincount(word.ravel(), weights=diff[:, :, y].ravel(), minlength=n) for y in range(k)], axis=1) / root[:, None]
        g_weights = np.stack([np.bincount(buckets, weights=by_word[owners, y], minlength=KINDS << BITS) for y in range(k)], axis=1)
        pair = alpha[:, :-1, :, None] * t * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        g_transitions = ((pair - one[:, :-1, :, None] * one[:, 1:, None, :]) * inner).sum(axis=(0, 1))
        g_start = diff[:, 0].sum(axis=0)
        for x, total, g in zip((m.weights, m.transitions, m.start), sums, (g_weights, g_transitions, g_start)):
            g = g * weight * 1e3 + 1e-3 * x
            total += g * g
            x -= 0.3 * g / np.sqrt(total)
    m.weights = m.weights.astype(np.float32)
    return m


def classify(texts: pa.Array, model: Model):
    """For each text the label number (the number of labels for ``und``), its score, every word's label
    number, and where each text's words start."""
    k, n = len(model.labels), len(texts)
    distinct, number, starts = words_of(texts)
    if not k or not len(number):
        return np.full(n, k), np.zeros(n), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    lettered = pc.match_substring_regex(distinct, r"\pL").to_numpy(zero_copy_only=False)[number]
    per_word = word_scores(distinct, model.weights).astype(np.float32)
    at, valid = chains(number, starts)
    p = forward_backward(per_word[number[at]], valid, model.transitions.astype(np.float32), model.start.astype(np.float32))[0]
    words = np.empty((len(number), k), np.float32)
    words[at[valid]] = p[valid]
    ends = np.zeros((len(number) + 1, k + 1))
    np.cumsum(np.column_stack((words * lettered[:, None], lettered)), axis=0, out=ends[1:])
    sums = ends[starts[1:]] - ends[starts[:-1]]
    some = sums[:, k] > 0.5
    mean = np.clip(sums[:, :k] / np.maximum(sums[:, k:], 1), 0.0, 1.0)
    return np.where(some, mean.argmax(axis=1), k), np.where(some, mean.max(axis=1), 0.0), words.argmax(axis=1), starts


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, lang_pred, score`` (mean probability of that language over the words with
    letters) and ``runs`` (stretches of words of one language: ``lang, start, end``) of every whole text."""
    labels = model.labels
    names = np.array([*labels, "und"], dtype=object)
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for block in blocks(batches, "t", BLOCK_BYTES):
            best, score, own, starts = classify(block.column("t"), model)
            runs = [[] for _ in range(block.num_rows)]
            if len(own):
                edge = np.ones(len(own) + 1, bool)
                edge[1:-1] = own[1:] != own[:-1]
                edge[starts[:-1][np.diff(starts) > 0]] = True
                cuts = np.flatnonzero(edge)
                for lo, hi, row in zip(cuts.tolist(), cuts[1:].tolist(), (np.searchsorted(starts, cuts[:-1], side="right") - 1).tolist()):
                    runs[row].append({"lang": labels[own[lo]], "start": lo - int(starts[row]), "end": hi - int(starts[row])})
            yield pa.RecordBatch.from_arrays(
                [block.column("k"), block.column("h"), pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(runs, run_type)],
                names=[key, "held_out", "lang_pred", "score", "runs"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), held_out(key).alias("h")).mapInArrow(
        run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double, runs array<struct<lang:string,start:bigint,end:bigint>>")


def accepted(docs: DataFrame, model: Model, languages: tuple[str, ...] | None = None, text: str = "text") -> DataFrame:
    """The documents, columns as they are, whose predicted language is one of ``languages`` (default: any
    the model knows); texts without a letter go. A model that learned no label rejects nothing else by
    default."""
    wanted = np.array([languages is None or x in languages for x in model.labels] + [False])
    unlearned = not model.labels and languages is None
    place = docs.columns.index(text)

    def run(batches):
        for block in blocks(batches, place, BLOCK_BYTES):
            if unlearned:
                stays = pc.fill_null(pc.match_substring_regex(block.column(place), r"\pL"), False)
            else:
                stays = pa.array(wanted[classify(block.column(place), model)[0]])
            yield block.filter(stays)

    return docs.mapInArrow(run, docs.schema)
