"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(
    df: DataFrame,
    key: list[str],
    order: list[str | Column],
    keep_null_keys: bool = False,
) -> DataFrame:
    """The last row of each key by ``order`` (ascending columns; the greatest wins).

    Spark turns the rank filter into a limit per group that runs before the
    shuffle, so a key that holds much of the table is cut down where it is read
    and never collected. With ``keep_null_keys`` rows without a key stay as
    they are.
    """
    by = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*by)))
    if not keep_null_keys:
        return ranked.where("__rank = 1").drop("__rank")
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    keyed = ranked.where(~null_key).where("__rank = 1").drop("__rank")
    return keyed.unionByName(df.where(null_key))
