"""CSV landing: read a header CSV, repair types, validate (S1-S5, T1-T4).

Every column is first read as text, so that the repair step decides how a bad
field is treated: date-time columns parse leniently (unparseable -> NULL, the
reference's coerce behaviour), numbers cast strictly (a malformed number fails
the load, as inserting it into the fixed DDL would), missing text becomes ''.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuepay.schemas import CATEGORY_TRANSLATION, DATETIME_COLUMNS, MULTILINE_TABLES, SOURCES, UNSIGNED_MAX
from valuepay.session import planned_bytes, scan_split_bytes
from valuepay.sources.csv_records import read_csv_records


class SourceMissing(FileNotFoundError):
    """The source file of a table does not exist."""


class SourceColumns(ValueError):
    """The header of a source does not hold exactly the table's columns."""


class SourceEmpty(ValueError):
    """A source parsed to zero rows."""


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def check_header(header: Sequence[str], want: Sequence[str], path: str) -> None:
    """Raise ``SourceColumns`` unless the header holds every wanted column once and no other."""
    missing = sorted(set(want) - set(header))
    unknown = sorted(set(header) - set(want))
    if missing or unknown:
        raise SourceColumns(f"{path}: missing columns {missing}, unknown columns {unknown}")


def spans_splits(spark: SparkSession, path: str) -> bool:
    """Whether the files at ``path`` hold more than one scan split (Catalyst's size of the scan, no job)."""
    return planned_bytes([spark.read.text(path)]) > scan_split_bytes(spark)


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True,
                  by_records: bool | None = None) -> DataFrame:
    """Scan a header CSV with every column as text, bound by header name.

    The columns may stand in any order; a missing, unknown or repeated column raises
    ``SourceColumns`` naming it. Files of one folder must share one order of columns, which
    the scan verifies file by file. A file without a header line has no rows.

    ``multiline`` keeps quoted line breaks inside one record. Files of more than a scan split
    together, or any with ``by_records``, are then read split by split and their records put together
    (``csv_records``, same rows); small ones by Spark's own reader, one task per file.
    Only the empty field is missing (words such as ``NA`` stay text).
    """
    options = {"header": True, "multiLine": multiline, "escape": '"', "mode": "FAILFAST"}
    want = [f.name for f in schema.fields]
    try:
        header = spark.read.options(**options).csv(path).columns   # reads one header line
        if not header:
            return spark.createDataFrame([], _text_schema(want))
        check_header(header, want, path)
        if multiline and (spans_splits(spark, path) if by_records is None else by_records):
            return read_csv_records(spark, path, header, {"escape": '"', "mode": "FAILFAST"}).select(*want)
        # enforceSchema off: every file's own header must match the order found here
        return spark.read.schema(_text_schema(header)).options(**options, enforceSchema=False).csv(path).select(*want)
    except Exception as exc:  # path resolution happens eagerly in spark.read
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise SourceMissing(path) from exc
        raise


def to_second(ts: Column) -> Column:
    """Drop sub-second digits of a timestamp_ntz (the staging type has second resolution)."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts)
    )


def repair_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast a text frame to the staging schema (T1-T4)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name in DATETIME_COLUMNS or isinstance(f.dataType, T.TimestampNTZType):
            c = to_second(c.try_cast(T.TimestampNTZType()))          # T1 lenient
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))                              # T2, T3
        else:
            c = c.cast(f.dataType)                                    # T4 strict (ANSI)
            if not f.nullable:                                        # missing number: fail
                c = F.when(c.isNull(), F.raise_error(
                    F.lit(f"missing value in non-null column {f.name}"))).otherwise(c)
            if f.name in UNSIGNED_MAX:                                # outside the unsigned type: fail
                c = F.when((c < 0) | (c > UNSIGNED_MAX[f.name]), F.raise_error(F.concat(
                    F.lit(f"value outside 0..{UNSIGNED_MAX[f.name]} in column {f.name}: "), c.cast("string")))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(cols)


def read_source(spark: SparkSession, data_dir: str, table: str, multiline: bool | None = None,
                by_records: bool | None = None) -> DataFrame:
    """Typed staging frame of one registered source (lazy). ``multiline`` defaults to
    on only for tables with free-text columns; ``by_records``: see ``read_csv_text``."""
    if table not in SOURCES:
        raise KeyError(f"unknown source table {table!r}")
    schema = SOURCES[table]
    path = f"{data_dir.rstrip('/')}/{table}.csv"
    if multiline is None:
        multiline = table in MULTILINE_TABLES
    return repair_types(read_csv_text(spark, path, schema, multiline, by_records), schema)


def validate_source(spark: SparkSession, data_dir: str, table: str) -> int:
    """The rows of a source, every field of which was parsed (S4). Raises ``SourceMissing``, ``SourceEmpty``, or what
    the parser says. For checks ahead of a load: a refresh does the same in the scan that also loads."""
    df = read_source(spark, data_dir, table)
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns))).first()
    if not seen["n"]:
        raise SourceEmpty(f"empty source: {table}")
    return seen["n"]


def read_category_translation(spark: SparkSession, data_dir: str) -> DataFrame:
    """The two-column product-category translation lookup (S7). No mart reads it; a join
    to it stays an ordinary equi-join, broadcast by AQE only when measured small."""
    path = f"{data_dir.rstrip('/')}/category_translation.csv"
    return repair_types(read_csv_text(spark, path, CATEGORY_TRANSLATION, False), CATEGORY_TRANSLATION)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a frame as header CSV (used to land test sources)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))
