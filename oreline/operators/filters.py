"""Row selection: high watermark, recent slice."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the watermark of an empty target.
EPOCH = "1900-01-01 00:00:00"


def max_value(df: DataFrame, column: str) -> DataFrame:
    """One row with the column's greatest value; NULL when there is none."""
    return df.agg(F.max(column).alias(f"max_{column}"))


def footer_max(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType, column: str
) -> DataFrame:
    """``max_value`` of Parquet files from the statistics in their footers; no row is read.

    ``schema`` must be that of every file, column by column in order, as it is for the
    files of one table: the statistics are found by place. Spark pushes a maximum of
    whole numbers and dates down; timestamps are numbers to it here. A file in which
    the column is all NULL has no statistics, and the column is scanned after all.
    """
    paths = list(paths)
    pushed = _pushed_max(spark, paths, schema, column)
    try:
        greatest = pushed.first()[0]
    except Py4JJavaError as e:
        if "aggregatePushdown" not in str(e):
            raise
        return max_value(spark.read.schema(schema).parquet(*paths), column)
    kind = schema[column].dataType
    return spark.range(1).select(F.lit(greatest).cast(kind).alias(f"max_{column}"))


def _pushed_max(
    spark: SparkSession, paths: list[str], schema: T.StructType, column: str
) -> DataFrame:
    """The maximum as text, in a session of its own that has the push-down switched on."""
    timed = isinstance(schema[column].dataType, T.TimestampNTZType)
    read_as = [T.StructField(f.name, T.LongType()) if timed and f.name == column else f for f in schema]
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = max_value(own.read.schema(T.StructType(read_as)).parquet(*paths), column)
    greatest = F.col(f"max_{column}")
    if timed:
        greatest = F.timestamp_micros(greatest).cast("timestamp_ntz")
    return found.select(greatest.cast("string"))


def watermark(target: DataFrame, column: str) -> DataFrame:
    """One row: the target's greatest timestamp, or the epoch when it is empty."""
    highest = F.coalesce(F.max(column), F.lit(EPOCH).cast("timestamp_ntz"))
    return target.agg(highest.alias("watermark"))


def newer_than(
    df: DataFrame,
    target: DataFrame,
    source_column: str,
    target_column: str | None = None,
    lookback_days: int = 0,
) -> DataFrame:
    """Rows stamped strictly after the target's watermark.

    The watermark is a scalar subquery, so it never visits Python and the
    comparison is pushed into the Parquet scan. A row at or before the watermark,
    or without a timestamp, is not picked up; ``lookback_days`` (off by default)
    re-reads that many days for late rows.
    """
    mark = watermark(target, target_column or source_column)
    if lookback_days:
        back = F.make_dt_interval(F.lit(lookback_days))
        mark = mark.select((F.col("watermark") - back).alias("watermark"))
    return df.where(F.col(source_column) > mark.scalar())


def newer_than_time(
    df: DataFrame, time: str | None, column: str, lookback_days: int = 0
) -> DataFrame:
    """``newer_than`` for a known watermark; None is that of an empty target."""
    mark = F.lit(time or EPOCH).cast("timestamp_ntz")
    if lookback_days:
        mark = mark - F.make_dt_interval(F.lit(lookback_days))
    return df.where(F.col(column) > mark)


def recent_slice(
    df: DataFrame, column: str, as_of: str | Column, days: int = 30, enabled: bool = True
) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``; everything when not enabled.

    For tables of the finest grain only: a cut parent would orphan its children.
    """
    if not enabled:
        return df
    now = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return df.where(F.col(column) >= now - F.make_dt_interval(F.lit(days)))
