"""Expressions of the run-results log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.columns import ColumnLike, col, varchar

# Status words and the longest message the log keeps.
SUCCESS_STATUSES = ("success", "pass")
ERROR_STATUSES = ("error", "fail", "runtime error")
SKIPPED_STATUSES = ("skipped",)
MESSAGE_CHARS = 4000


def status_flags(status: ColumnLike) -> list[Column]:
    """Success, error and skipped flags; any other status sets none of them."""
    word = F.lower(col(status))
    known = {
        "is_success": SUCCESS_STATUSES,
        "is_error": ERROR_STATUSES,
        "is_skipped": SKIPPED_STATUSES,
    }
    return [
        F.coalesce(word.isin(*words), F.lit(False)).alias(flag)
        for flag, words in known.items()
    ]


def phase_timing() -> Column:
    """Struct (started_at, completed_at) of the execute phase, else of compile.

    The pair is chosen as a whole: a half-filled execute phase is not completed
    with the compile phase's other end.
    """

    def pair(phase: str) -> Column:
        return F.struct(
            F.col(f"{phase}_started_at").alias("started_at"),
            F.col(f"{phase}_completed_at").alias("completed_at"),
        )

    ran = F.col("execute_started_at").isNotNull() | F.col("execute_completed_at").isNotNull()
    return F.when(ran, pair("execute")).otherwise(pair("compile"))


def clean_result(df: DataFrame) -> DataFrame:
    """Default, round and cut the measures of a step result."""
    return df.withColumns(
        {
            "status": varchar(F.lower(F.col("status").cast("string")), 20),
            "execution_time": F.round(
                F.coalesce(F.col("execution_time"), F.lit(0)).cast("decimal(38,9)"), 3
            ).cast("decimal(18,3)"),
            "rows_affected": F.coalesce(F.col("rows_affected"), F.lit(0)).cast("bigint"),
            "failures": F.col("failures").cast("int"),
            "message": varchar(F.coalesce(F.col("message"), F.lit("")), MESSAGE_CHARS),
        }
    )
