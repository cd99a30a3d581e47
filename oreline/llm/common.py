"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators import files
from oreline.operators.tables import work_dir, written

# Fixed value: the white space that separates words (space, tab to carriage return).
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Folders stored inside each open ``scratch``, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open_scratch", default=())


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """Cut the lineage with a table in the shared work folder, and read it back."""
    return _stored(df, name, _open.get()[-1:])


def kept(df: DataFrame, name: str = "result") -> DataFrame:
    """As ``stored``, for a table that outlives the innermost ``scratch``."""
    return _stored(df, name, _open.get()[-2:-1])


def _stored(df: DataFrame, name: str, scopes: tuple[list[str], ...]) -> DataFrame:
    folder = work_dir(df.sparkSession)
    for scope in scopes:
        scope.append(folder)
    out = written(df, f"{folder}/{name}")
    out.stored_in = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for table in tables:
        files.delete(table.sparkSession, table.stored_in)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is removed at the end; ``kept`` tables stay."""
    scope: list[str] = []
    before = _open.get()
    _open.set((*before, scope))
    try:
        yield
    finally:
        _open.set(before)
        for folder in scope:
            files.delete(spark, folder)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def word_array(text: Column) -> Column:
    """Words of a text, empty for null; JVM only."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(plain, " "), "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def meet_totals(rows: DataFrame, totals: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join of ``rows`` with ``totals``, a table grouped by ``keys``.

    A grouped table already lies by its keys, and a join that reuses this cannot be
    split where a key is hot. Joining by a hash of the keys as well deals out both
    sides anew, so adaptive execution may broadcast small totals or split hot rows.
    """
    spread = F.xxhash64(*keys)
    both = [x.withColumn("spread__", spread) for x in (rows, totals)]
    return both[0].join(both[1], ["spread__", *keys], how).drop("spread__")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, component)``.

    ``component`` is the smallest node reachable. Nodes without an edge are not
    listed. Alternates the large-star and small-star steps, which need a number
    of rounds logarithmic in the number of nodes; each round is a pre-aggregated
    minimum and a join, written to shared storage. Rounds end as soon as every node
    hangs on one hub that hangs on none. Only one flag a round reaches the driver.
    """
    both = edges.where("a is not null and b is not null and a <> b")
    stars = stored(
        both.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct()
    )
    for _ in range(max_rounds):
        if _settled(stars):
            break
        last, stars = stars, stored(_small_star(_large_star(stars)))
        discard(last)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    hubs = stars.select(F.col("small").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("big").alias("node"), F.col("small").alias("component")).union(hubs)


def _settled(stars: DataFrame) -> bool:
    """Whether each larger node has one edge and is the smaller node of none."""
    ends = stars.select(F.col("big").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        stars.select("small", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _large_star(stars: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    ways = stars.select(F.col("big").alias("u"), F.col("small").alias("v")).union(
        stars.select(F.col("small").alias("u"), F.col("big").alias("v"))
    )
    least = ways.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = meet_totals(ways, least, "u").where("v > u and v <> m")
    return linked.select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = stars.groupBy("big").agg(F.min("small").alias("m"))
    linked = meet_totals(stars, least, "big").where("small <> m")
    moved = linked.select(F.col("small").alias("big"), F.col("m").alias("small"))
    return moved.union(least.select("big", F.col("m").alias("small"))).distinct()
