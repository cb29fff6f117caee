"""The corpus pipeline: every stage on what the one before kept, and its end against brute force."""

import re
import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_text_operators import brute_components, brute_print, brute_repeats, prose


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF001)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes, name
        before, after = {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in kept.collect()}
        assert after <= before and len(after) >= 0.8 * len(before), name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    total = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = {}
    for r in packed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == total


def test_no_repeat_is_left_in_the_kept_texts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF001).collect(), docs.schema)
    rows = docs.collect()
    assert len({"".join(r["text"].split()) for r in rows}) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_documents_without_labels_stay(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "12 34 !", None, None, 7), (-3, "", None, None, 0)], docs.schema)
    bare = docs.withColumn("lang", F.lit(None).cast("string")).union(odd)
    kept = corpus_pipeline.keep_known_language(spark, bare, SF001).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in docs.collect())


def plain_pipeline(rows, library):
    """``doc_id, piece, start, length, ids_crc32`` of the pieces, in plain Python."""
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t), []).append((-len(t), i, t))
    rows = sorted(min(g)[1:] for g in groups.values())
    root = brute_components([brute_print(t) for _, t in rows])
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    removed = {i: (n, gone) for i, n, gone, _ in brute_repeats(rows, 50)}
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), i)
    out = []
    for i, t in rows:
        n, gone = removed[i]
        if gone:
            w, go = t.split(), set()
            for k in range(len(w) - 49):
                if first[tuple(w[k:k + 50])] < i:
                    go |= set(range(k, k + 50))
            t = " ".join(x for k, x in enumerate(w) if k not in go)
            assert len(go) == gone
        if n and n == gone:
            continue
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        at, size, k = 0, (len(ids) - 1) % 1024 + 1, 0
        while at < len(ids):
            out.append((i, k, at, size, zlib.crc32(ids[at:at + size].tobytes())))
            at, size, k = at + size, 1024, k + 1
    return sorted(out)


def test_run_equals_a_plain_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    base, passage = prose(5, 400).split(), prose(77, 70)
    more = [(None, 3), ("", 4), ("12 34 !", 5), (rows[0][1].replace(" ", "  "), 6), (rows[1][1], 7), (passage, 60), (f" {passage}\n", 61)]
    more += [(" ".join([*base[:k * 9], f"new{k}", *base[k * 9 + 1:]]), 10 + k) for k in range(12)]          # near copies
    more += [(f"{prose(90 + k, 80)} {passage} {prose(190 + k, 2000 * (k == 3) + 60)}", 30 + k) for k in range(6)]
    rows += [(10**6 + i, t, "en", "x", None if t is None else len(t)) for t, i in more]
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = plain_pipeline([r[:2] for r in rows], Tokenizer.from_file(P.path("byte_bpe_50k.json")))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    left = {i - 10**6 for i, *_ in want if i >= 10**6}
    assert len(left & set(range(10, 22))) < 12 and left & set(range(30, 36)) == set(range(30, 36)) and not left & {3, 4, 5, 7}


def test_an_empty_table_passes_through(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0
