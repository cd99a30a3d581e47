"""Joins that enrich rows, and the unknown member they fall back to.

No join here is forced to broadcast: Spark broadcasts a side whose size is
known to be small and otherwise sorts and merges, where adaptive execution
splits a key that holds too many rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN_KEY = 0


def lookup_key(
    rows: DataFrame,
    dim: DataFrame,
    on: str,
    keys: Mapping[str, str] | str,
    default: int = UNKNOWN_KEY,
) -> DataFrame:
    """Add surrogate keys of ``dim`` by natural key, ``default`` where none matches.

    ``keys`` maps dimension columns to output names (or is the one column to
    take). A NULL natural key gets the default as well.
    """
    keys = {keys: keys} if isinstance(keys, str) else dict(keys)
    slim = dim.select(on, *[F.col(source).alias(name) for source, name in keys.items()])
    joined = rows.join(slim, on, "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(default).cast("bigint")) for name in keys.values()}
    )


def enrich(
    rows: DataFrame,
    attributes: DataFrame,
    on: str,
    defaults: Mapping[str, object],
    plain: tuple[str, ...] = (),
) -> DataFrame:
    """Left-join attributes; ``defaults`` fill the gaps, ``plain`` ones stay NULL."""
    slim = attributes.select(on, *plain, *defaults)
    types = {f.name: f.dataType for f in slim.schema}
    joined = rows.join(slim, on, "left")
    return joined.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
            for name, value in defaults.items()
        }
    )


def only_matching(df: DataFrame, column: str, needed: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``needed``.

    Cuts a big table down to what a small change set can touch: while ``needed``
    is small the table is scanned in place and not shuffled.
    """
    return df.join(needed.select(column).distinct(), column, "left_semi")


def with_unknown_member(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add the one row that unmatched facts point to; unnamed columns are NULL."""
    stray = set(values) - set(dim.columns)
    if stray:
        raise ValueError(f"unknown member sets columns the dimension lacks: {sorted(stray)}")
    member = dim.sparkSession.range(1).select(
        *[
            F.lit(values.get(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in dim.schema
        ]
    )
    return member.unionByName(dim)


def relink_unknown(
    fact: DataFrame, natural: str, dim: DataFrame, key: str, dim_key: str | None = None
) -> DataFrame:
    """Extension: point rows on the unknown key to members that arrived later.

    Only the unknown rows take part in the join.
    """
    unknown = fact.where(F.col(key) == UNKNOWN_KEY)
    known = fact.where((F.col(key) != UNKNOWN_KEY) | F.col(key).isNull())
    relinked = lookup_key(unknown.drop(key), dim, natural, {dim_key or key: key})
    return known.unionByName(relinked.select(*fact.columns))
