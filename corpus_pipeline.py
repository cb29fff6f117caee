"""Corpus pipeline: ``documents`` through language identification, exact, near and substring
deduplication, to packed training sequences.

A stage takes ``(spark, docs, sf_dir)``, works on all documents that the stage before it kept, and returns
those that it keeps with the columns of ``documents``; the last returns packed pieces. ``run`` writes each
stage's result to the shared folder and reads it again, so a lost executor costs one stage at most.

An empty table passes through every stage. Rows with a null text, or one without a letter, go in the
first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from valuepay.llm import content_sort, language, packing, simhash, substrings
from valuepay.session import apply_scale_defaults, scratch_path, ship_package


def _ready(spark: SparkSession) -> None:
    apply_scale_defaults(spark)
    ship_package(spark)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell; texts without a letter go, and nothing else where no
    row has a label to learn from."""
    _ready(spark)
    return language.accepted(docs, language.train(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal but for white space."""
    _ready(spark)
    return content_sort.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 3 bits or fewer, 3-word shingles."""
    _ready(spark)
    return simhash.one_of_each(docs, shingle=3, distance=3)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 50-word windows that an earlier document has too; a document of
    which nothing is left goes."""
    _ready(spark)
    return substrings.without_repeats(docs, window=50)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    _ready(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("language identification", keep_known_language),
    ("exact deduplication", drop_exact_copies),
    ("near deduplication", drop_near_copies),
    ("substring deduplication", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Trained predictions, fingerprints and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
