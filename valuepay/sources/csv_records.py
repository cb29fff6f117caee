"""Multi-line CSV in parallel: records put together from lines that were read split by split.

Spark's ``multiLine`` reader gives a file to one task. Here a file is read as text, which splits anywhere: a split
has the lines that begin in it, in order. In RFC 4180 files (quotes only around fields, doubled inside them) a line
break belongs to a field exactly if the number of quotes before it in the file is odd, so:

1. one scan counts the quotes of every split; the parity before a split is a prefix sum over the splits of its
   file, a table of one row per split;
2. within a split the running parity tells which lines begin a record; lines are numbered by record and the lines
   of a record joined. What a split has of a record that began earlier, and its last record if that goes on, are
   pieces, two per split at most;
3. pieces are put together across splits, by file.

The text is shuffled once, by split, because a window asks for it; no task gets more than a split, and only
pieces of records that cross splits meet by file. A record longer than a split is as many pieces, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ("file", "start")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start`` (of the split), ``place`` (grows within a split), ``value``, ``quotes``."""
    value = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), value,
        (F.char_length(value) - F.char_length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"))


def _parities(lines: DataFrame) -> DataFrame:
    """``file, start, before``: the parity of the quotes before each split. A file that ends within quotes is an error."""
    per_split = lines.groupBy(*SPLIT).agg(F.sum("quotes").alias("q"))
    in_file = Window.partitionBy("file")     # one row for each split of the file
    total = F.sum("q").over(in_file)
    before = F.coalesce(F.sum("q").over(in_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per_split.select(*SPLIT, F.when(total % 2 == 0, (before % 2).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("quotes do not pair up in "), F.col("file"))).cast("int")).alias("before"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, record``: every record's text without its line end; ``first`` marks a file's first one. Empty
    records, such as a file's end after its last line break, are left out."""
    lines = _lines(spark, path)
    in_split = Window.partitionBy(*SPLIT).orderBy("place")
    earlier = in_split.rowsBetween(Window.unboundedPreceding, -1)
    placed = (lines.join(_parities(lines), [*SPLIT])
              .withColumn("open", (F.col("before") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2)
              .withColumn("number", F.count_if(F.col("open") == 0).over(in_split.rowsBetween(Window.unboundedPreceding, 0))))
    # number 0: the rest of a record that an earlier split began; a piece goes on if quotes are open at its end
    pieces = placed.groupBy(*SPLIT, "number").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"),
        ((F.min_by("open", "place") + F.sum("quotes")) % 2 == 1).alias("goes_on")).select(
        *SPLIT, "number", "goes_on", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    whole = pieces.where((F.col("number") > 0) & ~F.col("goes_on")).select(
        "file", ((F.col("start") == 0) & (F.col("number") == 1)).alias("first"), "record")
    # a record over several splits: its begin, which goes on, then one piece for each split up to its end
    begins = F.col("number") > 0
    order = Window.partitionBy("file").orderBy("start", "number")
    crossing = (pieces.where(F.col("goes_on") | ~begins)
                .withColumn("which", F.count_if(begins).over(order.rowsBetween(Window.unboundedPreceding, 0)))
                .groupBy("file", "which").agg(
                    F.sort_array(F.collect_list(F.struct("start", "number", "record"))).alias("parts"))
                .select("file", ((F.col("parts")[0]["start"] == 0) & (F.col("parts")[0]["number"] == 1)).alias("first"),
                        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))
    text = F.regexp_replace("record", r"\r$", "")
    return whole.union(crossing).select("file", "first", text.alias("record")).where(F.col("record") != "")


def read_csv_records(spark: SparkSession, path: str, header: Sequence[str], options: dict) -> DataFrame:
    """The records under ``header``, every column as text; every file must begin with that header. Equal to the
    ``multiLine`` reader with the same options on RFC 4180 files."""
    schema = ", ".join(f"`{n}` string" for n in header)
    parsed = read_records(spark, path).select("file", "first", F.from_csv("record", schema, options).alias("r"))
    same = F.lit(True)
    for n in header:
        same &= F.col(f"r.`{n}`").eqNullSafe(F.lit(n))
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    return parsed.where(F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(wrong)).select("r.*")
