"""Sharding by extendible hashing.

A document's place is the first bits of the hash of its key. The directory starts
with one bucket; a bucket above the byte limit, and no other, splits on its next
bit until every one fits. Bytes are summed by hash prefix first, so the splits of
many levels are found from one small table; only documents whose bucket is still
too large go to the next levels. Rows of equal hash (one key repeated) cannot be
split by bits: they are cut in order into pages that fit, by running sums in two
levels. A single row above the limit is a shard of its own.

Cases: a null size is zero bytes; a null key is hashed like any value; repeated
rows are rows like others; an empty table gives an empty result. Columns named
like a result are replaced, others stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import require, stored

LEVEL_BITS = 12
HASH_BITS = 60  # what 15 hexadecimal digits hold


def byte_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def hash_bits(key: Column) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def directory(sizes: DataFrame, limit_bytes: int) -> DataFrame:
    """``(hash, depth, bucket, shard_bytes)`` for ``sizes(hash, bytes)``, one row per hash.

    ``bucket`` is the number that the first ``depth`` bits of the hash make.
    """
    rest, found = sizes, []
    for level in range(0, HASH_BITS, LEVEL_BITS):
        deepest = level + LEVEL_BITS
        depths = F.lit(list(range(level + (level > 0), deepest + 1))).cast("array<int>")
        ids = F.expr(f"shiftright(prefix, {deepest} - depth)")
        prefixes = rest.withColumn("prefix", F.shiftright("hash", HASH_BITS - deepest))
        each = prefixes.groupBy("prefix").agg(F.sum("bytes").alias("bytes"))
        each = each.withColumn("depth", F.explode(depths)).withColumn("bucket", ids)
        sums = each.groupBy("depth", "bucket").agg(F.sum("bytes").alias("shard_bytes"))
        fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("depth") == HASH_BITS)
        leaf = each.join(sums.where(fits), ["depth", "bucket"]).groupBy("prefix")
        leaf = leaf.agg(F.min(F.struct("depth", "bucket", "shard_bytes")).alias("leaf"))
        leaf = stored(leaf.select("prefix", "leaf.*"), "leaves")
        found.append(
            prefixes.join(leaf, "prefix").select("hash", "depth", "bucket", "shard_bytes")
        )
        rest = stored(prefixes.join(leaf, "prefix", "left_anti").select("hash", "bytes"), "open")
        if rest.isEmpty():
            break
    return reduce(DataFrame.union, found)


def assign_shards(
    rows: DataFrame, limit_bytes: int, key: str = "doc_id", size: str = "n_bytes"
) -> DataFrame:
    """``rows`` with ``depth``, ``shard_id`` (prefix bits, a page after a dash) and ``shard_bytes``."""
    require(rows, key, size)
    added = ["depth", "shard_id", "shard_bytes"]
    columns = [c for c in rows.columns if c not in added or c in (key, size)]
    # The caller's columns travel in one, whatever their names.
    hashed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("own"),
        hash_bits(F.col(key)).alias("shard_hash"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("shard_size"),
    )
    sizes = hashed.groupBy(F.col("shard_hash").alias("hash")).agg(F.sum("shard_size").alias("bytes"))
    leaves = stored(directory(stored(sizes, "sizes"), limit_bytes), "directory")
    bits = F.when(F.col("depth") == 0, "").otherwise(
        F.lpad(F.bin("bucket"), F.col("depth"), F.lit("0"))
    )
    placed = hashed.join(leaves.withColumn("bits", bits), F.col("shard_hash") == F.col("hash"))
    fits = F.col("shard_bytes") <= limit_bytes
    whole = placed.where(fits).select("own", "depth", F.col("bits").alias("shard_id"), "shard_bytes")

    # One hash with more than a shard: pages of half the limit, so that the last row fits too.
    many = stored(placed.where(~fits), "pages")
    many = many.withColumn("part", F.spark_partition_id())
    half = max(1, limit_bytes // 2)
    small = many.where(F.col("shard_size") <= half)
    inner = Window.partitionBy("bits", "part").orderBy("shard_size").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("bits").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = small.groupBy("bits", "part").agg(F.sum("shard_size").alias("n"))
    ahead = ahead.select("bits", "part", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("base"))
    small = small.withColumn("inside", F.coalesce(F.sum("shard_size").over(inner), F.lit(0)))
    small = small.join(ahead, ["bits", "part"])
    page = F.floor((F.col("base") + F.col("inside")) / half).cast("string")
    small = small.withColumn("page", page)
    large = many.where(F.col("shard_size") > half)
    alone = F.concat(F.lit("x"), F.monotonically_increasing_id().cast("string"))
    large = large.withColumn("page", alone)
    used = ["own", "depth", "bits", "page", "shard_size"]
    paged = stored(small.select(*used).union(large.select(*used)), "paged")
    paged = paged.withColumn("shard_id", F.concat_ws("-", "bits", "page"))
    totals = paged.groupBy(F.col("shard_id").alias("of")).agg(F.sum("shard_size").alias("shard_bytes"))
    paged = paged.join(totals, F.col("shard_id") == F.col("of"))
    out = whole.union(paged.select("own", "depth", "shard_id", "shard_bytes"))
    return out.select(*[F.col(f"own.`{c}`") for c in columns], *added)


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write ``docs`` into one folder per shard; ``assigned`` has one row per key."""
    named = assigned.select(F.col(key).alias("shard_key"), "shard_id").distinct()
    placed = docs.join(named, F.expr(f"`{key}` <=> shard_key")).drop("shard_key")
    placed.repartition("shard_id").write.partitionBy("shard_id").parquet(path)
