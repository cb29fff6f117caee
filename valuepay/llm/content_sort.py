"""Exact deduplication by a content sort (operator 5), built from DataFrame operations only.

White space is deleted and the remaining bytes are range-partitioned at sampled splitters
(``repartitionByRange``; a splitter holds a text's first characters and a hash, so the driver's sample
stays small) and sorted externally within each range, so equal texts lie next to each other; one window
pass compares each row's whole normalised text with its neighbour's and finds the row that stays. A text held by many rows would fill one range: texts that are frequent in a sample get a
second sort column (``ways`` values), which lets the splitters cut their group into several ranges, and
the parts' results, one small row each, are merged afterwards (rows with one id stay in one part). The sample decides only how work is
dealt; every row is compared whatever it says.

Defined results: null text counts as empty, and all empty texts are equal; of equal texts the row with
the most code points in its original text stays, then the smallest ``doc_id`` (null last); of repeated
rows with one id exactly one is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuepay.session import scratch_path

WHITE_SPACE = r"[\x20\x09-\x0D]+"
SAMPLE_ROWS = 20_000  # rows looked at to find frequent texts
FREQUENT = 0.001  # share of the sample from which a text's group is split: at most 1,000 texts
HEAD = 24  # leading characters that splitters hold
WAYS = 64  # parts of a frequent text's group


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", ways: int = WAYS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    spark = docs.sparkSession
    rows, bounds = _prepared(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", ways)
    found = _placed(rows, bounds).select("doc_id", *bounds[2:], "_sha", "_place", "_keep", "_most", "_size")
    if len(bounds) == 2:
        return found.select("doc_id", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
                            (F.col("_place") == 1).alias("kept"), F.col("_sha").alias("text_sha256"))
    path = scratch_path(spark, "content-sort")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    merged = (  # one row for each frequent text, of which there are at most 1 / FREQUENT
        found.filter("_salt > 0 AND _place = 1").groupBy("_sha")
        .agg(F.min(_rank("_most", "_keep")).alias("_best"), F.sum("_size").alias("_all"))
    )
    return found.join(F.broadcast(merged), "_sha", "left").select(
        "doc_id",
        F.when(F.col("_best").isNull(), F.col("_keep")).otherwise(F.col("_best.id")).alias("keep_id"),
        F.coalesce("_all", "_size").alias("group_size"),
        ((F.col("_place") == 1) & (F.col("_best").isNull() | (F.col("_best.salt") == F.col("_salt")))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", ways: int = WAYS) -> DataFrame:
    """The documents that stay, one of each group of equal texts, with all their columns."""
    key, text = f"row.`{key}`", f"row.`{text}`"  # the document's columns stay apart from those made here
    rows, bounds = _prepared(docs.select(F.struct("*").alias("row")), key, text, ways)
    first = _placed(rows, bounds, key, text).filter("_place = 1")
    if len(bounds) > 2:
        # a frequent text's parts each have a first row: the best of them stays
        frequent = rows.filter("_salt > 0")
        best = (frequent.groupBy(F.sha2(_norm(text), 256).alias("_sha")).agg(F.min(_rank("_chars", key)).alias("_best")))
        first = first.join(F.broadcast(best), "_sha", "left").filter("_best IS NULL OR _best.salt = _salt")
    return first.select("row.*")


def _norm(text: str):
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), WHITE_SPACE, "")


def _rank(chars: str, key: str):
    """Orders rows of one text: most code points, then smallest id (null last); ids carry their salt."""
    return F.struct((-F.col(chars)).alias("less"), F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("_salt").alias("salt"))


def _prepared(docs: DataFrame, key: str, text: str, ways: int) -> tuple[DataFrame, list[str]]:
    """The rows with the columns that splitters are sampled from: the first characters in order, a hash
    where many texts begin alike, and for frequent texts a part number from the id."""
    rows = docs.withColumns({
        "_head": F.substring(_norm(text), 1, HEAD), "_hash": F.xxhash64(_norm(text)),
        "_chars": F.char_length(F.coalesce(F.col(text).cast("string"), F.lit("")))})
    frequent = _frequent_texts(docs, rows)
    if not frequent:
        return rows, ["_head", "_hash"]
    part = F.pmod(F.xxhash64(key), F.lit(ways)) + 1
    return rows.withColumn("_salt", F.when(F.col("_hash").isin(frequent), part).otherwise(0).cast("int")), ["_head", "_hash", "_salt"]


def _placed(rows: DataFrame, bounds: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its place among the equal texts of its part, and that part's best row and size."""
    # the range partitioning by ``bounds`` serves the window too: equal texts have equal bounds
    ordered = Window.partitionBy(*bounds, "_norm").orderBy(F.desc("_chars"), F.asc_nulls_last(key))
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.repartitionByRange(*bounds).withColumn("_norm", _norm(text)).withColumns({
        "_sha": F.sha2("_norm", 256),
        "_place": F.row_number().over(ordered),
        "_keep": F.first(key).over(whole),
        "_most": F.first("_chars").over(whole),
        "_size": F.count(F.lit(1)).over(whole),
    })


def _frequent_texts(docs: DataFrame, rows: DataFrame) -> list[int]:
    """Hashes of texts that hold at least ``FREQUENT`` of a sample of about ``SAMPLE_ROWS`` rows."""
    total = docs.count()
    if not total:
        return []
    share = min(1.0, SAMPLE_ROWS / total)
    least = max(8, int(FREQUENT * share * total))
    found = rows.sample(False, share, seed=11).groupBy("_hash").count().filter(F.col("count") >= least).collect()
    return [r["_hash"] for r in found]
