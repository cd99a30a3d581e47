"""Table maintenance: incremental refresh and type-1 dimensions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.operators.filters import newer_than_time
from oreline.operators.tables import VersionedTable, written, written_in_parts


R = TypeVar("R")

# Fixed value: how many independent tables are written at a time.
CONCURRENT_WRITES = 4


def together(actions: Mapping[str, Callable[[], R]]) -> dict[str, R]:
    """Run independent writes side by side, so that small ones do not wait for big ones.

    The first failure is raised after all of them have ended.
    """
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        running = {name: pool.submit(action) for name, action in actions.items()}
    return {name: done.result() for name, done in running.items()}


def incremental(
    table: VersionedTable,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    source_column: str,
    target_column: str | None = None,
    build_changes: Callable[[DataFrame, str], DataFrame] | None = None,
    full_refresh: bool = False,
    lookback_days: int = 0,
    parts_by: str | None = None,
) -> int:
    """Refresh ``table`` with what changed in ``source``; return rows processed.

    The first run, or a full refresh, builds from the whole source. Later runs
    take the rows stamped after the table's watermark, write them down once, so
    that their real size is known to the joins of ``build_changes`` (``build``
    if not given), and upsert the result. The watermark comes with the table's
    version where that knows it, else from the files' footers. ``build_changes``
    also gets a folder for tables of its own, which is removed after the merge.
    ``parts_by`` names a column of both the source and the table by which big input is
    taken in parts.
    """
    if full_refresh or not table.exists():
        return table.write(build(source), parts_by=parts_by)
    highest = table.greatest(target_column or source_column)
    fresh = newer_than_time(source, highest, source_column, lookback_days)
    with table.work() as folder:
        if parts_by:
            changed = written_in_parts(fresh, f"{folder}/changed", parts_by)
        else:
            changed = written(fresh, f"{folder}/changed")
        delta = build_changes(changed, folder) if build_changes else build(changed)
        return table.upsert(delta, parts_by=parts_by)


def scd1_seen(
    dim: DataFrame,
    observed: DataFrame,
    key: str,
    observed_at: str,
    first_seen: str = "first_seen_at",
    last_seen: str = "last_seen_at",
) -> DataFrame:
    """Type-1 merge of observations into a dimension with first and last seen times.

    A known key takes the newest attributes and moves ``last_seen``; a new key
    gets both times. Several observations of a key, a history of runs say, count
    as if applied one after the other.
    """
    attributes = [c for c in dim.columns if c not in (key, first_seen, last_seen)]
    newest = F.max(F.struct(F.col(observed_at), *[F.col(a) for a in attributes]))
    news = (
        observed.groupBy(key)
        .agg(F.min(observed_at).alias("__first"), newest.alias("__newest"))
        .withColumn("__seen", F.lit(True))
    )
    seen = F.col("__seen").isNotNull()

    def newer(column: str, value: Column) -> Column:
        return F.when(seen, value).otherwise(F.col(column)).alias(column)

    merged = dim.join(news, key, "full")
    columns = {
        key: F.col(key),
        first_seen: F.coalesce(F.col(first_seen), F.col("__first")).alias(first_seen),
        last_seen: newer(last_seen, F.col(f"__newest.{observed_at}")),
        **{a: newer(a, F.col(f"__newest.{a}")) for a in attributes},
    }
    return merged.select(*[columns[c].cast(dim.schema[c].dataType).alias(c) for c in dim.columns])


def materialize(df: DataFrame, kind: str, table: VersionedTable | None = None, **options) -> int:
    """Keep ``df`` lazy ("view") or rebuild its table ("table"); return the rows written.

    For the third kind, a table kept up to date by merging, use ``incremental``.
    ``view=<name>`` registers a view with the session.
    """
    if kind == "view":
        name = options.get("view")
        if name:
            df.createOrReplaceTempView(name)
        return 0
    if kind != "table" or table is None:
        raise ValueError('materialize needs kind "view", or "table" and a table')
    return table.write(df, **options)
