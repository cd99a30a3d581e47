"""Typed CSV reads and the batch load of the raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.operators.changes import together
from oreline.operators.tables import VersionedTable
from oreline.schemas import RAW_TABLES, raw_schema
from oreline.sources.catalog import table_path


class HeaderMismatch(ValueError):
    """The file's columns are not the declared ones."""


# The text forms a declared type accepts.
TEXT_FORMS = {
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp_ntz": (
        r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
        r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"
    ),
}


def _text_form(dtype: T.DataType) -> str | None:
    if isinstance(dtype, T.DecimalType):
        return rf"^[+-]?[0-9]*([.][0-9]{{0,{dtype.scale}}})?$"
    return TEXT_FORMS.get(dtype.simpleString())


def _typed(field: T.StructField, file: str) -> Column:
    """Declared cast that refuses what a lenient cast would round or shorten."""
    text = F.col(f"`{field.name}`")
    form = _text_form(field.dataType)
    cast = text.cast(field.dataType)
    if form is None:
        return cast.alias(field.name, metadata=field.metadata)
    problem = F.concat(
        F.lit(f"{file}: column {field.name} is not a {field.dataType.simpleString()}: "), text
    )
    return (
        F.when(text.isNull() | text.rlike(form), cast)
        .otherwise(F.raise_error(problem).cast(field.dataType))
        .alias(field.name, metadata=field.metadata)
    )


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read CSV with a header into exactly ``schema``.

    Columns are matched by name, whatever their order in the file. Empty fields
    are NULL, quoted or not; the text ``NULL`` stays text. Timestamps carry no
    zone and mean UTC. A value that does not fit its type fails the job.
    """
    options = {"header": True, "nullValue": "", "escape": '"', "mode": "FAILFAST"}
    header = spark.read.options(**options).csv(path).columns
    if differing := set(header).symmetric_difference(schema.names):
        sides = (f"{c} ({'declared only' if c in schema.names else 'file only'})" for c in differing)
        raise HeaderMismatch(f"header of {path} and its schema differ in: {', '.join(sorted(sides))}")
    # The names are right, so pin this order for every file of the path: a file
    # with its header in another order is refused instead of misread.
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    text = spark.read.options(**options, enforceSchema=False).schema(as_text).csv(path)
    return text.select(*[_typed(field, path) for field in schema])


def ingest(
    spark: SparkSession,
    src: str,
    sink: str,
    specs: Mapping[str, T.StructType] | None = None,
    tables: Iterable[str] | None = None,
    mode: str = "overwrite",
    dry_run: bool = False,
) -> dict[str, int]:
    """Load ``<src>/<table>.csv`` for each declared table; return row counts.

    Every table is parsed once, into files nobody reads yet; only when all of
    them parsed are they published. One bad file therefore leaves every target
    as it was. ``dry_run`` parses everything and writes nothing.
    """
    specs = dict(specs or {name: raw_schema(name) for name in RAW_TABLES})
    if tables is not None:
        tables = list(tables)
        by_name = {alias: name for name in specs for alias in (name, name.rpartition(".")[2])}
        strangers = sorted(set(tables) - set(by_name))
        if strangers:
            raise ValueError(f"tables without a declared layout: {', '.join(strangers)}")
        chosen = {by_name[t] for t in tables}
        specs = {name: schema for name, schema in specs.items() if name in chosen}

    frames = {
        name: read_typed_csv(spark, f"{src.rstrip('/')}/{name.split('.')[-1]}.csv", schema)
        for name, schema in specs.items()
    }
    if dry_run:
        return {name: _parsed_rows(df) for name, df in frames.items()}

    targets = {name: VersionedTable(spark, table_path(sink, name)) for name in frames}
    for target in targets.values():
        target.check_mode(mode)
    staged = together({name: partial(targets[name].stage, df) for name, df in frames.items()})
    for name, files in staged.items():
        targets[name].publish(files, mode=mode)
    return {name: files.rows for name, files in staged.items()}


def _parsed_rows(df: DataFrame) -> int:
    """Row count of a pass that evaluates every column (a bare count prunes them)."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format("noop").mode("overwrite").save()
    return seen.get["n"]
