"""Source divergence audit (operator 11): how far the term shares of one source lie from those of every
other source of its language, and which terms set a source apart.

Row accumulation after Gustavson. The counts of all kept terms are a sparse matrix of sources by terms,
dealt to shards by term, so a shard holds the whole posting list of each of its terms (the term-major
index). In a shard every source walks its own terms through the index and scatters what each posting adds
into one dense accumulator, a number for each peer; a pair of postings never becomes a row. A term that
both sources lack still has a share, as shares are smoothed: the accumulator starts from that baseline and
a posting adds the difference to it, so shares of absent terms are never written out. What leaves a shard
is one array for each source that has terms in it; Spark sums the arrays.

A term counts for a language if at least ``min_docs`` of the language's documents (rows) hold it. Counts
are combined in blocks, then per task, then by (language, source, term) and by (language, term), so a
term, source or language with a third of all words is a few rows per task. Shards are cut by the number of
postings, at most about ``SHARD_ROWS`` each.

All arithmetic is in integers: a count ``c`` becomes the share ``1 + floor(10**9 * (c + 2) / (N + 2 V))`` with
``N`` the counted words of the source and ``V`` the kept terms of the language, and two shares differ by
``floor((p - q) ** 2 / (p + q))``. Quotients are taken in 38 digits; sums stay below 2**63.

Defined results: null text, language and source count as empty strings, and empty is a language and a
source of its own; a source without terms, or a language without kept terms, has its pairs all the same (value
0 where there are no kept terms); a language with one source has no pairs; a row repeated whole counts as
often as it stands there, ids are not read; ranks break ties by the name's UTF-8 bytes; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuepay.llm.words import blocks, mapped_bytes, ragged, runs, words_of
from valuepay.session import written

SHARE = 1_000_000_000
SHARD_ROWS = 250_000  # postings of a shard, about
CELLS = 1 << 20  # numbers in the matrix that a source's baseline is added up from at once

#: A-Z in lower case, a-z and bytes over 127 as they are, every other byte a blank.
TERM_BYTES = np.full(256, 32, np.uint8)
TERM_BYTES[128:] = np.arange(128, 256)
TERM_BYTES[97:123] = TERM_BYTES[65:91] = np.arange(97, 123)


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n`` (occurrences), ``df`` (documents)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    parts = rows.mapInArrow(_block_counts, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        terms, number, starts = words_of(mapped_bytes(block.column("text"), TERM_BYTES))
        if not len(number):
            continue
        langs, sources = (block.column(c).dictionary_encode() for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        width = len(terms)
        doc = np.repeat(np.arange(block.num_rows, dtype=np.int64), np.diff(starts))
        in_doc, times = np.unique(doc * width + number, return_counts=True)
        cell, back = np.unique(group[in_doc // width] * width + in_doc % width, return_inverse=True)
        n = np.zeros(len(cell), np.int64)
        np.add.at(n, back, times)
        at = cell // width
        yield pa.RecordBatch.from_arrays([
            langs.dictionary.take(pa.array(at // len(sources.dictionary))), sources.dictionary.take(pa.array(at % len(sources.dictionary))),
            terms.take(pa.array(cell % width)), pa.array(n), pa.array(np.bincount(back, minlength=len(cell)))],
            names=["lang", "source", "term", "n", "df"])


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """The postings of the terms that at least ``min_docs`` documents of their language hold, with the count
    over the language and ``head``, true for one posting of each term."""
    posting_list = Window.partitionBy("lang", "term")  # one row for each source of a language
    return (counts.withColumns({"lang_df": F.sum("df").over(posting_list), "lang_n": F.sum("n").over(posting_list),
                                "head": F.row_number().over(posting_list.orderBy("source")) == 1})
            .filter(F.col("lang_df") >= min_docs).select("lang", "source", "term", "n", "lang_n", "head"))


def share(count, total, terms):
    """``1 + floor(SHARE * (count + 2) / (total + 2 * terms))``, exact."""
    c, n, v = (F.col(x) if isinstance(x, str) else x for x in (count, total, terms))
    # decimal division to a whole number: the product may exceed 64 bits
    whole = F.call_function("div", F.lit(SHARE).cast("decimal(10,0)") * (c + 2).cast("decimal(19,0)"), (n + v * 2).cast("decimal(19,0)"))
    return whole.cast("bigint") + 1


def sources_of(docs: DataFrame, kept: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Every (language, source): ``peer`` (its number in the language, by name), ``total`` (counted words),
    ``terms`` and ``lang_total`` of the language, ``zero`` (share of an absent term; null without kept terms) and
    ``shards``, into which the language's terms are dealt."""
    pairs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("head").alias("terms"), F.count(F.lit(1)).alias("postings"))
    filled = (pairs.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["total", "lang_total", "terms", "postings"]))
    return filled.select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("peer"),
        "total", "lang_total", "terms",
        F.when(F.col("terms") > 0, share(F.lit(0), "total", "terms")).alias("zero"),
        F.ceil(F.greatest("postings", F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q) ** 2 / (p + q))``; shares are at most ``SHARE + 1``, so squares fit in 64 bits."""
    return (p - q) * (p - q) // (p + q)


def _accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards as sorted runs, peers before postings: for every source a dense row of sums over the shard.
    The sums of a pair are complete once the rows of both sources are added."""
    for shard in runs(batches, ["lang", "shard"]):
        peer, value, terms = (shard.column(c).to_numpy() for c in ("peer", "value", "terms"))
        is_peer = pc.is_null(shard.column("term")).to_numpy()
        zero = np.zeros(int(is_peer.sum()), np.int64)
        zero[peer[is_peer]] = value[is_peer]
        first = shard.column("shard")[0].as_py() == 0
        kept = int(terms[0])
        coded = shard.column("term").combine_chunks().filter(pa.array(~is_peer)).dictionary_encode()
        term, owner, p = coded.indices.to_numpy().astype(np.int64), peer[~is_peer], value[~is_peer]
        # the index: postings in order of their terms; rows: the postings of each source
        by_term = np.argsort(term, kind="stable")
        owner, p, term = owner[by_term], p[by_term], term[by_term]
        edges = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
        by_owner = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[by_owner], np.arange(len(zero) + 1))
        lang = shard.column("lang")[0].as_py()
        for g in range(len(zero)):
            own = by_owner[ends[g]:ends[g + 1]]
            if not len(own) and not first:
                continue
            row = np.zeros(len(zero), np.int64)
            if first and kept:  # the baseline of a pair is in the row of its smaller source
                row[g + 1:] = kept * apart(zero[g], zero[g + 1:])
            values, times = np.unique(p[own], return_counts=True)
            step = max(1, CELLS // len(zero))
            for at in range(0, len(values), step):
                v, m = values[at:at + step, None], times[at:at + step, None]
                row += (m * (apart(v, zero) - apart(zero[g], zero))).sum(axis=0)
            posting, begins = ragged(np.arange(len(owner)), edges, term[own])
            mine = np.repeat(p[own], np.diff(begins))
            after = owner[posting] > g  # what both hold is added once, in the row of the smaller
            h, theirs, mine = owner[posting][after], p[posting][after], mine[after]
            np.add.at(row, h, apart(mine, theirs) - apart(mine, zero[h]) - apart(zero[g], theirs) + apart(zero[g], zero[h]))
            row[g] = 0
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([g], pa.int32()), pa.array([row], pa.list_(pa.int64()))],
                                             names=["lang", "peer", "sums"])


def divergences(kept: DataFrame, sources: DataFrame) -> DataFrame:
    """``lang, low, high, value``: the divergence of every two sources of a language, by their numbers."""
    peers = sources.select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(None).cast("string").alias("term"),
                           "peer", F.coalesce("zero", F.lit(1).cast("bigint")).alias("value"), "terms")
    postings = kept.join(sources, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "term", "peer",
        share("n", "total", "terms").alias("value"), "terms")
    rows = (peers.union(postings).repartition("lang", "shard").sortWithinPartitions("lang", "shard")
            .mapInArrow(_accumulated, "lang string, peer int, sums array<bigint>"))
    other = rows.select("lang", "peer", F.posexplode("sums").alias("other", "value")).filter("peer != other")
    return other.groupBy("lang", F.least("peer", "other").alias("low"), F.greatest("peer", "other").alias("high")).agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has the divergence from every other source of
    the language; part ``term`` the ``top`` terms that the source uses more than its language does."""
    kept = written(kept_terms(term_counts(docs, lang, source, text), min_docs), "kept-terms")
    sources = written(sources_of(docs, kept, lang, source), "sources")
    names = sources.select("lang", "peer", "source")
    pairs = divergences(kept, sources)
    both = pairs.select("lang", "value", F.explode(F.array(
        F.struct(F.col("low").alias("peer"), F.col("high").alias("other")),
        F.struct(F.col("high").alias("peer"), F.col("low").alias("other")))).alias("ends")).select("lang", "value", "ends.*")
    pair = (both.join(names, ["lang", "peer"])
            .join(names.select("lang", F.col("peer").alias("other"), F.col("source").alias("item")), ["lang", "other"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    p, q = F.col("p"), F.col("q")
    term = (kept.join(sources, ["lang", "source"])
            .select("lang", "source", "term", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"))
            .filter("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    F.call_function("div", (p - q) * (p - q), p + q).alias("value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pair.withColumn("rank", F.row_number().over(ranked))
            .union(term.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)))
