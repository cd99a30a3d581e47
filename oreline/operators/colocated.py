"""Tables that meet without moving: stored by the key they are joined on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def store_colocated(
    df: DataFrame, path: str, key: str, buckets: int, table: str | None = None
) -> DataFrame:
    """Write ``df`` below ``path`` in ``buckets`` of ``key``, and read it back.

    Joins and groupings by ``key`` of tables with as many buckets then need no
    exchange. The layout is Spark's own bucketing, which only the session's catalog
    remembers: the table is listed there as ``table`` (a name of its own by default)
    and its files stay where ``path`` says. A key that holds a large share of the rows
    makes a bucket of that size, which adaptive execution cannot split: store by such
    a key only what has none.
    """
    spark = df.sparkSession
    table = table or f"colocated_{uuid.uuid4().hex}"
    # Dealt out as the buckets are, so each of them is one file.
    dealt = df.repartition(buckets, key)
    writer = dealt.write.format("parquet").mode("errorifexists").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def open_colocated(
    spark: SparkSession, path: str, like: DataFrame, key: str, buckets: int, table: str | None = None
) -> DataFrame:
    """Read what ``store_colocated`` wrote, in a session that does not list it yet."""
    table = table or f"colocated_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    spark.sql(
        f"""create table `{table}` ({columns}) using parquet
            clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{path}'"""
    )
    return spark.table(table)
