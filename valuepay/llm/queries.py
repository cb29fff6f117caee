"""The registered queries of the numbered operators: each applies its operator with production parameters to its whole
table and derives the contract's columns. ``ORACLE`` holds DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from valuepay.llm import (
    bpe, content_sort, divergence, language, licences, line_repeats, packing, pieces, simhash, slots, substrings, turn_trie,
    vectors,
)
from valuepay.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"), window=50)


def op3_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(table(spark, sf_dir, "documents"))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op8_island_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  capacity=1024, end_id=2)


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("spans")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.count_tokens(table(spark, sf_dir, "documents"),
                               public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op11_row_accumulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, top=10)


def op12_splitter_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.prefix_trie(turn_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_two_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_repeats.digests(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_difference_cover": op2_difference_cover,
    "op3_sorted_projections": op3_sorted_projections,
    "op4_language_crf": op4_language_crf,
    "op5_content_sort": op5_content_sort,
    "op6_virtual_slots": op6_virtual_slots,
    "op7_simhash_golay": op7_simhash_golay,
    "op8_island_packing": op8_island_packing,
    "op9_licence_scan": op9_licence_scan,
    "op10_token_counts": op10_token_counts,
    "op11_row_accumulation": op11_row_accumulation,
    "op12_splitter_skeleton": op12_splitter_skeleton,
    "op13_two_filters": op13_two_filters,
}

ORACLE: dict[str, str] = {
    "op2_difference_cover": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        win AS (
            SELECT doc_id, i, hash(array_to_string(w[i:i + 49], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
        ),
        firsts AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
            FROM win JOIN firsts USING (h) WHERE doc_id > m
        ),
        cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
        word AS (
            SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d
        ),
        kept AS (
            SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t
            FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p
            GROUP BY word.doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
    "op5_content_sort": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM n
        WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
    """,
    "op11_row_accumulation": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents
        ),
        occ AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
        vocab AS (SELECT lang, term, count(*) AS lang_n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        cnt AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
        langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS ln FROM vocab GROUP BY lang),
        grp AS (SELECT DISTINCT lang, source FROM d),
        tot AS (SELECT lang, source, sum(n) AS t FROM cnt GROUP BY ALL),
        p AS (
            SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.t, 0) + 2 * l.v) AS p,
                   1 + (1000000000::HUGEINT * (w.lang_n + 2)) // (l.ln + 2 * l.v) AS q
            FROM grp g JOIN vocab w ON w.lang = g.lang JOIN langs l ON l.lang = g.lang
            LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source
            LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term
        ),
        summed AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS s
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        out AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.s, 0)::BIGINT AS value
            FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
        FROM out QUALIFY part = 'pair' OR rank <= 10
    """,
    "op12_splitter_skeleton": r"""
        WITH t AS (
            SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        byte AS (  -- CRC-32 of the id's digits, bit by bit, modulo 4: the two lowest bits
            SELECT c, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                                           lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)) AS r
            FROM (SELECT DISTINCT c FROM t)
        ),
        h AS (SELECT c, xor(r, 4294967295) % 4 AS h FROM byte),
        seq AS (
            SELECT h.c, 0 AS own, t.i, t.k, t.w FROM h JOIN t ON t.c = h.c - h.c % 20 AND t.i <= h.h
            UNION ALL
            SELECT h.c, 1, t.i, t.k, t.w FROM h JOIN t ON t.c = h.c AND t.i > h.h
        ),
        conv AS (
            SELECT h.c, coalesce(list(k ORDER BY own, i) FILTER (WHERE k IS NOT NULL), []) AS ks, coalesce(list(w ORDER BY own, i) FILTER (WHERE k IS NOT NULL), []) AS ws
            FROM h LEFT JOIN seq ON seq.c = h.c GROUP BY h.c
        ),
        place AS (
            SELECT c, d, sha256(array_to_string(ks[1:d], ',')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(ks[1:d - 1], ',')) END AS up,
                   CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, len(ks) = d AS ends
            FROM (SELECT c, ks, ws, unnest(range(0, len(ks) + 1)) AS d FROM conv)
        ),
        node AS (
            SELECT node, d, any_value(up) AS up, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(w) AS s,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS e
            FROM place GROUP BY node, d
        ),
        kids AS (SELECT up AS node, d - 1 AS d, count(*) AS kids FROM node WHERE d > 0 GROUP BY ALL),
        full_node AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (node, d)),
        below AS (  -- every node with each node above it, itself included
            SELECT a.node, a.d, sum(x.s) AS s, sum((x.kids = 0)::INT) AS leaves
            FROM full_node x JOIN place a ON a.c = x.c AND a.d <= x.d GROUP BY ALL
        )
        SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, x.kids AS n_children, b.leaves::BIGINT AS n_leaves,
               b.s::BIGINT AS saved_tokens, x.e AS ends_sha256
        FROM full_node x JOIN below b ON b.node = x.node AND b.d = x.d LEFT JOIN full_node p ON p.node = x.up AND p.d = x.d - 1
    """,
    "op13_two_filters": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        line AS (SELECT r, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM d),
        keyed AS (
            SELECT r, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM line
        ),
        gone AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
        kept AS (SELECT r, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS t FROM keyed ANTI JOIN gone USING (k) GROUP BY r)
        SELECT doc_id, len(ls) AS n_lines, len(ls) - coalesce(n, 0) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
}
