"""Run-results log: who ran, when, with what outcome, as a two-table star."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions import (
    clean_result,
    phase_timing,
    status_flags,
    surrogate_key,
    utc_naive,
    varchar,
)
from oreline.operators.changes import scd1_seen
from oreline.operators.tables import VersionedTable
from oreline.schemas import RUN_LOG_CONTRACTS

# Targets that keep a log unless told otherwise.
LOGGED_TARGETS = ("accept", "prod")

# Log names of a result's node attributes.
NODE_NAMES = {
    "unique_id": "dk_dbt_node",
    "name": "node_name",
    "resource_type": "resource_type",
    "materialized": "materialization",
    "package_name": "node_package",
    "database": "node_database",
    "schema": "node_schema",
    "original_file_path": "node_path",
}

# A step result as the log takes it in.
RESULT_SCHEMA = """
    invocation_id string, unique_id string, name string, resource_type string,
    materialized string, package_name string, database string, schema string,
    original_file_path string, run_started_at timestamp_ntz, target_name string,
    command string, execute_started_at timestamp_ntz, execute_completed_at timestamp_ntz,
    compile_started_at timestamp_ntz, compile_completed_at timestamp_ntz,
    execution_time double, status string, rows_affected bigint, failures int,
    message string, logged_at timestamp_ntz
"""


def _cut_to_contract(df: DataFrame, table: str) -> DataFrame:
    return df.select(
        *[
            (varchar(c.name, c.max_chars) if c.max_chars else F.col(c.name).cast(c.dtype)).alias(c.name)
            for c in RUN_LOG_CONTRACTS[table].columns
        ]
    )


def _naive_utc(results: DataFrame) -> DataFrame:
    """Zoned timestamps become naive UTC ones; naive ones already are."""
    zoned = [f.name for f in results.schema if isinstance(f.dataType, T.TimestampType)]
    return results.withColumns({name: utc_naive(name) for name in zoned})


def observed_nodes(results: DataFrame) -> DataFrame:
    """The node of each result, as the dimension names it."""
    chars = {c.name: c.max_chars for c in RUN_LOG_CONTRACTS["dim_dbt_nodes"].columns}
    nodes = _naive_utc(results).select(
        *[varchar(source, chars[name]).alias(name) for source, name in NODE_NAMES.items()],
        F.col("logged_at").alias("observed_at"),
    )
    return nodes.withColumn("sk_dbt_node", surrogate_key("dk_dbt_node"))


def merge_nodes(dim: DataFrame, results: DataFrame) -> DataFrame:
    """The dimension after these results: attributes corrected, last seen moved."""
    return scd1_seen(dim, observed_nodes(results), "dk_dbt_node", "observed_at")


def run_facts(results: DataFrame) -> DataFrame:
    """One fact row per result; its key is hashed, so no lookup is needed."""
    rows = clean_result(_naive_utc(results)).withColumn("__timing", phase_timing())
    node_chars = RUN_LOG_CONTRACTS["dim_dbt_nodes"].columns[1].max_chars
    facts = rows.select(
        "invocation_id",
        surrogate_key(varchar("unique_id", node_chars)).alias("sk_dbt_node"),
        "run_started_at",
        "target_name",
        F.col("command").alias("dbt_command"),
        F.col("__timing.started_at").alias("execution_started_at"),
        F.col("__timing.completed_at").alias("execution_ended_at"),
        F.col("execution_time").alias("execution_seconds"),
        "status",
        *status_flags("status"),
        "rows_affected",
        "failures",
        "message",
        "logged_at",
    )
    return _cut_to_contract(facts, "fct_dbt_runs")


def log_results(
    spark: SparkSession,
    results: DataFrame,
    root: str,
    target_name: str,
    targets: Collection[str] = LOGGED_TARGETS,
) -> bool:
    """Merge results into the log below ``root``; False where the target keeps none.

    The tables are created on first use. The dimension is replaced before the
    facts are appended, without a transaction around both.
    """
    if target_name not in targets or results.isEmpty():
        return False
    nodes = VersionedTable(spark, f"{root}/dim_dbt_nodes")
    runs = VersionedTable(spark, f"{root}/fct_dbt_runs")
    nodes.ensure(RUN_LOG_CONTRACTS["dim_dbt_nodes"].schema)
    runs.ensure(RUN_LOG_CONTRACTS["fct_dbt_runs"].schema)
    nodes.write(merge_nodes(nodes.read(), results), contract=RUN_LOG_CONTRACTS["dim_dbt_nodes"])
    runs.write(run_facts(results), mode="append", contract=RUN_LOG_CONTRACTS["fct_dbt_runs"])
    return True


class RunRecorder:
    """Notes how each step of one run went, for ``log_results``.

    One row per table, however large the tables are. The clock is an argument so
    that a run can be repeated to the letter.
    """

    def __init__(
        self,
        invocation_id: str,
        target_name: str,
        project: str = "sales",
        database: str = "",
        command: str = "build",
        clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None),
    ):
        self.invocation_id = invocation_id
        self.target_name = target_name
        self.project = project
        self.database = database
        self.command = command
        self.clock = clock
        self.started = clock()
        self.steps: list[dict] = []

    @contextmanager
    def step(self, name: str, schema: str, materialized: str) -> Iterator[dict]:
        """Time one step; set ``rows_affected`` on the yielded note. Errors are noted and raised."""
        note = {"name": name, "schema": schema, "materialized": materialized}
        note |= {"status": "success", "started": self.clock()}
        try:
            yield note
        except Exception as e:
            note |= {"status": "error", "message": str(e)}
            raise
        finally:
            note["completed"] = self.clock()
            self.steps.append(note)

    def skip(self, name: str, schema: str, materialized: str) -> None:
        """Note a step that was not reached; a step already noted stays as it is."""
        if name not in {s["name"] for s in self.steps}:
            self.steps.append(
                {"name": name, "schema": schema, "materialized": materialized, "status": "skipped"}
            )

    def results(self, spark: SparkSession) -> DataFrame:
        logged_at = self.clock()
        rows = []
        for s in self.steps:
            started, completed = s.get("started"), s.get("completed")
            seconds = (completed - started).total_seconds() if started else 0.0
            rows.append(
                (
                    self.invocation_id, f"model.{self.project}.{s['name']}", s["name"], "model",
                    s["materialized"], self.project, self.database, s["schema"], None,
                    self.started, self.target_name, self.command, started, completed, None, None,
                    seconds, s["status"], s.get("rows_affected"), None, s.get("message"), logged_at,
                )
            )
        return spark.createDataFrame(rows, RESULT_SCHEMA)

    def test_results(self, tests: DataFrame) -> DataFrame:
        """Results of ``data_tests`` as rows of the log."""
        name = F.concat_ws("_", "check", "table", "column")
        values = {
            "invocation_id": F.lit(self.invocation_id),
            "unique_id": F.concat(F.lit(f"test.{self.project}."), name),
            "name": name,
            "resource_type": F.lit("test"),
            "package_name": F.lit(self.project),
            "database": F.lit(self.database),
            "run_started_at": F.lit(self.started).cast("timestamp_ntz"),
            "target_name": F.lit(self.target_name),
            "command": F.lit(self.command),
            "status": F.col("status"),
            "failures": F.col("failures"),
            "logged_at": F.lit(self.clock()).cast("timestamp_ntz"),
        }
        layout = tests.sparkSession.createDataFrame([], RESULT_SCHEMA).schema
        return tests.select(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout]
        )
