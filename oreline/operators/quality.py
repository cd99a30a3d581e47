"""Data-quality checks.

A check returns its failing rows (or failing keys with their row counts) as a
DataFrame; no rows means it passes. ``summarize`` folds many checks into one
row each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.schemas import Contract


class ContractViolation(ValueError):
    """A table breaks its contract; nothing of it was published."""

    def __init__(self, table: str, problems: Sequence[str]):
        super().__init__(f"{table} breaks its contract: " + "; ".join(problems))
        self.table = table
        self.problems = list(problems)


# --- row and key checks ----------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) for many columns from a single scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot_counts(counts, columns)


def _unpivot_counts(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    return counts.unpivot([], list(columns), "column", "failures")


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Values that occur more than once, with ``n_records``; NULLs are ignored."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    present = df
    for c in columns:
        present = present.where(F.col(c).isNotNull())
    counted = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where("n_records > 1")


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with the ``n_records`` that carry them.

    The child is reduced to its distinct keys before it meets the parent, so a
    key that half of the rows share (the unknown member, say) weighs as one.
    """
    keys = (
        child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(pk).alias(fk))
    return keys.join(known, fk, "left_anti")


def rule(df: DataFrame, failing: Column, columns: Sequence[str]) -> DataFrame:
    """Custom rule: the rows for which ``failing`` is true."""
    return df.where(failing).select(*columns)


def active_mapping_violations(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product categories that do not map to exactly one active category row."""
    used = products.where(F.col("category_code").isNotNull()).select("category_code").distinct()
    active = (
        categories.where(F.col("effective_to").isNull())
        .groupBy("category_code")
        .agg(F.count(F.lit(1)).alias("active_rows"))
    )
    counted = used.join(active, "category_code", "left").select(
        "category_code", F.coalesce("active_rows", F.lit(0)).cast("bigint").alias("active_rows")
    )
    return counted.where("active_rows <> 1")


# --- freshness ---------------------------------------------------------------------


def freshness(
    df: DataFrame, column: str, warn_days: int, error_days: int, as_of: Column
) -> DataFrame:
    """One row: newest load time, age in seconds at ``as_of``, status.

    An empty table has no age and counts as an error.
    """
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    age = as_of - F.col("max_loaded_at")
    status = (
        F.when(age.isNull() | (age > F.make_dt_interval(F.lit(error_days))), "error")
        .when(age > F.make_dt_interval(F.lit(warn_days)), "warn")
        .otherwise("pass")
    )
    seconds = age.cast("interval second").cast("bigint")
    return newest.select("max_loaded_at", seconds.alias("age_seconds"), status.alias("status"))


# --- contracts -----------------------------------------------------------------------


def _schema_problems(schema: T.StructType, contract: Contract) -> list[tuple[str, str, str]]:
    """(column, violation, detail) rows that need no data to be found."""
    found = {f.name: f.dataType for f in schema}
    out = []
    for c in contract.columns:
        if c.name not in found:
            out.append((c.name, "missing_column", c.dtype.simpleString()))
        elif found[c.name] != c.dtype:
            detail = f"{found[c.name].simpleString()} instead of {c.dtype.simpleString()}"
            out.append((c.name, "wrong_type", detail))
    for name in found:
        if name not in contract.names:
            out.append((name, "unexpected_column", found[name].simpleString()))
    return out


def contract_problems(schema: T.StructType, contract: Contract) -> list[str]:
    return [f"{kind} {name} ({detail})" for name, kind, detail in _schema_problems(schema, contract)]


def contract_measures(contract: Contract) -> list[Column]:
    """Counts of rows that break a column's promise, for one aggregate pass."""
    out = []
    for c in contract.columns:
        if c.required:
            out.append(F.count_if(F.col(c.name).isNull()).alias(f"null in {c.name}"))
        if c.max_chars:
            too_long = F.length(F.col(c.name)) > c.max_chars
            out.append(F.count_if(too_long).alias(f"too long {c.name}"))
    return out


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """(table, column, violation, detail, failures) of a frame; empty when it conforms.

    ``failures`` counts rows, or is 1 for a violation of the schema itself.
    """
    schema_rows = [
        (contract.table, name, kind, detail, 1)
        for name, kind, detail in _schema_problems(df.schema, contract)
    ]
    out = df.sparkSession.createDataFrame(
        schema_rows, "table string, column string, violation string, detail string, failures bigint"
    )
    checks = {}
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        if c.required:
            checks[f"{c.name}|null|required"] = F.col(c.name).isNull()
        if c.max_chars and isinstance(df.schema[c.name].dataType, T.StringType):
            too_long = F.length(F.col(c.name)) > c.max_chars
            checks[f"{c.name}|too_long|more than {c.max_chars} characters"] = too_long
    if checks:
        counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in checks.items()])
        parts = F.split("column", "[|]")
        rows = _unpivot_counts(counts, list(checks)).where("failures > 0")
        out = out.unionByName(
            rows.select(
                F.lit(contract.table).alias("table"),
                parts[0].alias("column"),
                parts[1].alias("violation"),
                parts[2].alias("detail"),
                "failures",
            )
        )
    return out


# --- summary -------------------------------------------------------------------------


def summarize(
    tables: Mapping[str, DataFrame],
    not_null_columns: Mapping[str, Sequence[str]],
    unique_columns: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[tuple[str, str, str, str]] = (),
    rules: Mapping[tuple[str, str, str], Column] | None = None,
) -> DataFrame:
    """(check, table, column, failures, status), one row per check, in one job.

    Each table is scanned once: a row gives a (check, value) pair for each of its
    unique columns and a bare check for each column or rule that it fails. All pairs
    of all tables, counted before they move, share one shuffle, whatever the number
    of unique columns; a foreign key costs one of its distinct values. A table that
    a check names must be given: pass fewer checks to test fewer tables.
    """
    rules = dict(rules or {})
    named = {*not_null_columns, *unique_columns, *(table for _, table, _ in rules)}
    named |= {table for child, _, parent, _ in foreign_keys for table in (child, parent)}
    if named - set(tables):
        raise ValueError(f"checks name tables that are not given: {sorted(named - set(tables))}")
    labels: list[tuple[int, str, str, str]] = []
    pairs = None
    for name, df in tables.items():
        failing = [("not_null", c, F.col(c).isNull()) for c in not_null_columns.get(name, ())]
        failing += [(check, c, f) for (check, table, c), f in rules.items() if table == name]
        entries = []
        for check, column, fails in failing:
            entries.append(F.when(fails, _pair(len(labels))))
            labels.append((len(labels), check, name, column))
        for c in unique_columns.get(name, ()):
            number = isinstance(df.schema[c].dataType, T.LongType)
            pair = _pair(len(labels), **{"number" if number else "value": F.col(c)})
            entries.append(F.when(F.col(c).isNotNull(), pair))
            labels.append((len(labels), "unique", name, c))
        if entries:
            found = df.select(F.explode(F.array_compact(F.array(*entries))).alias("pair")).select("pair.*")
            pairs = found if pairs is None else pairs.unionByName(found)
    parts = []
    if pairs is not None:
        counted = pairs.groupBy("id", "value", "number").agg(F.count(F.lit(1)).alias("n"))
        bare = F.col("value").isNull() & F.col("number").isNull()
        failures = F.when(bare, F.col("n")).otherwise((F.col("n") > 1).cast("bigint"))
        counted = counted.groupBy("id").agg(F.sum(failures).alias("found"))
        spark = counted.sparkSession
        listed = spark.createDataFrame(labels, "id int, check string, table string, column string")
        parts.append(
            listed.join(counted, "id", "left").select(
                "check", "table", "column", F.coalesce("found", F.lit(0)).cast("bigint").alias("failures")
            )
        )
    for child, fk, parent, pk in foreign_keys:
        orphans = relationships(tables[child], fk, tables[parent], pk)
        failing_rows = orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures"))
        parts.append(_labelled(failing_rows, "relationships", child, fk))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return out.withColumn("status", status)


def _pair(check: int, value: Column | None = None, number: Column | None = None) -> Column:
    """A check's number and a value: a long as it is, which moves in fewer bytes, any
    other as text; a key's text tells its values apart."""
    value, number = (F.lit(None) if x is None else x for x in (value, number))
    return F.struct(
        F.lit(check).alias("id"), value.cast("string").alias("value"), number.cast("long").alias("number")
    )


def _labelled(failures: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.col("failures").cast("bigint").alias("failures"),
    )
