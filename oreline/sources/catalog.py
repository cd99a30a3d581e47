"""Where the raw tables come from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oreline.operators.tables import VersionedTable
from oreline.schemas import RAW_TABLES


class SourceCatalog:
    """Resolves ``schema.table`` names of the declared raw tables.

    A name is looked up among the frames passed in, then under ``root`` (tables
    landed by ``ingest``), then in the session catalog.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        frames: Mapping[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self.root = root
        self.frames = dict(frames or {})

    def __call__(self, name: str) -> DataFrame:
        if name not in RAW_TABLES:
            raise KeyError(f"unknown source {name!r}; declared: {sorted(RAW_TABLES)}")
        if name in self.frames:
            return self.frames[name]
        if self.root:
            return VersionedTable(self.spark, table_path(self.root, name)).read()
        return self.spark.table(name)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def rows_df(
    spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType
) -> DataFrame:
    """Typed relation over a handful of literal rows."""
    return spark.createDataFrame(list(rows), schema)
