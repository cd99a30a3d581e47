"""Scalar expressions shared by every layer.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; there is no Python UDF anywhere in the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# They decide every stored key, so they never change.
NULL_KEY_PART = "_surrogate_key_null_"
KEY_PART_SEPARATOR = "-"
KEY_HEX_DIGITS = 14  # 7 bytes = 56 bits, always non-negative as a bigint


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: ColumnLike) -> Column:
    """Deterministic, case-insensitive 56-bit key over one or more parts.

    Strings name columns; pass ``F.lit(tag)`` for a constant part. Parts are
    cast to text as they are, so give decimals, booleans and timestamps a fixed
    text form first: engines print those differently.
    """
    if not parts:
        raise ValueError("surrogate_key needs at least one part")
    texts = [
        F.coalesce(F.upper(col(p).cast("string")), F.lit(NULL_KEY_PART)) for p in parts
    ]
    text = texts[0] if len(texts) == 1 else F.concat_ws(KEY_PART_SEPARATOR, *texts)
    digest = F.substring(F.sha2(text, 256), 1, KEY_HEX_DIGITS)
    key = F.conv(digest, 16, 10).cast("bigint")
    # Never NULL, but Spark cannot tell; said plainly, a join on the key does not
    # hash every row a second time just to filter NULL keys.
    return F.coalesce(key, F.lit(0).cast("bigint"))


def varchar(c: ColumnLike, n: int) -> Column:
    """Text of at most ``n`` characters; longer values are cut, never refused."""
    return F.substring(col(c).cast("string"), 1, n)


def lower(c: ColumnLike) -> Column:
    return F.lower(col(c))


def upper(c: ColumnLike) -> Column:
    return F.upper(col(c))


def blank_to_date(c: ColumnLike) -> Column:
    """Text to date where an empty text means "no date"."""
    return F.nullif(col(c).cast("string"), F.lit("")).cast("date")


def to_bit(c: ColumnLike) -> Column:
    """Integer flag to boolean; any non-zero value is true."""
    return col(c).cast("boolean")


def typed_lit(value, dtype: str | T.DataType) -> Column:
    return F.lit(value).cast(dtype)


def with_batch_id(df: DataFrame, batch_id: str) -> DataFrame:
    """Stamp the load's batch id (36 characters at most)."""
    return df.withColumn("dbt_batch_id", varchar(F.lit(batch_id), 36))


def cast_columns(df: DataFrame, spec: dict[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns in place; unparsable input raises under ANSI mode."""
    return df.withColumns({name: F.col(name).cast(dtype) for name, dtype in spec.items()})


def map_values(c: ColumnLike, mapping: dict[str, str], default: str) -> Column:
    """Translate exact values; anything else, NULL included, becomes ``default``."""
    out = None
    for value, label in mapping.items():
        hit = col(c) == F.lit(value)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def is_open_ended(c: ColumnLike) -> Column:
    return col(c).isNull()


def net_amount(quantity: ColumnLike, price: ColumnLike, discount: ColumnLike) -> Column:
    """``quantity * price - discount`` as decimal(18,2); NULL in, NULL out."""
    return (col(quantity) * col(price) - col(discount)).cast("decimal(18,2)")


def date_key(c: ColumnLike) -> Column:
    """Date as a ``YYYYMMDD`` integer, computed without text formatting."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(c: ColumnLike) -> Column:
    return varchar(F.date_format(col(c), "MMMM"), 50)


def iso_week(c: ColumnLike) -> Column:
    return F.weekofyear(col(c))


def calendar_parts(c: ColumnLike) -> list[Column]:
    """The calendar attributes of the date dimension, in its column order."""
    d = col(c)
    return [
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("month_number"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_week(d).alias("iso_week_number"),
    ]


def utc_naive(c: ColumnLike, zone: str | None = None) -> Column:
    """Timestamp as naive UTC wall-clock time.

    An instant (``timestamp``) needs no zone. Give the ``zone`` of a naive
    timestamp that was not taken in UTC.
    """
    source = F.current_timezone() if zone is None else F.lit(zone)
    return F.convert_timezone(source, F.lit("UTC"), col(c).cast("timestamp_ntz"))
