from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import demo
from oreline.functions import surrogate_key
from oreline.operators.quality import ContractViolation
from oreline.operators.tables import VersionedTable
from oreline.plans import runlog
from oreline.plans.warehouse import Warehouse
from oreline.sources import rows_df

T0 = dt.datetime(2026, 6, 1, 6)


def result(unique_id, status="success", at=T0, **other):
    values = {
        "invocation_id": "run",
        "unique_id": unique_id,
        "name": unique_id.split(".")[-1],
        "resource_type": "model",
        "materialized": "view",
        "package_name": "shop",
        "database": "db",
        "schema": "silver",
        "original_file_path": None,
        "run_started_at": at,
        "target_name": "prod",
        "command": "build",
        "execute_started_at": at,
        "execute_completed_at": at,
        "compile_started_at": None,
        "compile_completed_at": None,
        "execution_time": 1.23456,
        "status": status,
        "rows_affected": None,
        "failures": None,
        "message": None,
        "logged_at": at,
    }
    return tuple((values | other).values())


@pytest.fixture
def results(spark):
    return lambda *rows: rows_df(spark, rows, runlog.RESULT_SCHEMA)


def test_facts(spark, results):
    early, late = T0 - dt.timedelta(hours=1), T0 + dt.timedelta(hours=1)
    df = runlog.run_facts(
        results(
            result("m.a", "Success", message="x" * 5000, rows_affected=3),
            result("m.b", "error", failures=2),
            result(
                "m.c",
                "skipped",
                execute_started_at=None,
                execute_completed_at=None,
                compile_started_at=early,
                compile_completed_at=late,
                execution_time=None,
            ),
            result("m.d", "warn", execute_started_at=None, compile_started_at=early),
            result("m.e", "fail", execute_started_at=None, execute_completed_at=None),
        )
    )
    got = {r["execution_started_at"]: r for r in df.where("status = 'skipped'").collect()}
    assert got[early]["execution_ended_at"] == late
    assert got[early]["execution_seconds"] == Decimal("0.000")
    first = df.where("is_success").first()
    assert len(first["message"]) == 4000 and first["status"] == "success"
    assert first["execution_seconds"] == Decimal("1.235") and first["rows_affected"] == 3
    error = df.where("status = 'error'").first()
    assert (error["is_error"], error["failures"], error["message"], error["rows_affected"]) == (
        True,
        2,
        "",
        0,
    )
    # A half-filled execute phase is used as it is, not mixed with the compile phase.
    half = df.where("status = 'warn'").first()
    assert (half["execution_started_at"], half["execution_ended_at"]) == (None, T0)
    assert not (half["is_success"] or half["is_error"] or half["is_skipped"])
    none = df.where("status = 'fail'").first()
    assert none["execution_started_at"] is None and none["is_error"]


def test_zoned_timestamps_become_naive_utc(results):
    zoned = results(result("m.a")).withColumn(
        "run_started_at", F.expr("timestamp'2026-06-01 08:00:00+02:00'")
    )
    assert runlog.run_facts(zoned).first()["run_started_at"] == T0


def test_second_run_moves_last_seen_only(spark, results, folder):
    assert runlog.log_results(spark, results(result("m.a"), result("m.b")), folder, "prod")
    later = T0 + dt.timedelta(days=1)
    again = results(
        result("m.a", at=later, materialized="table"), result("m.b", at=later), result("m.c", at=later)
    )
    assert runlog.log_results(spark, again, folder, "prod")
    nodes = VersionedTable(spark, f"{folder}/dim_dbt_nodes").read()
    got = {r["dk_dbt_node"]: r for r in nodes.collect()}
    assert got["m.a"]["materialization"] == "table" and got["m.b"]["materialization"] == "view"
    assert (got["m.a"]["first_seen_at"], got["m.a"]["last_seen_at"]) == (T0, later)
    assert (got["m.c"]["first_seen_at"], got["m.c"]["last_seen_at"]) == (later, later)
    runs = VersionedTable(spark, f"{folder}/fct_dbt_runs").read()
    assert runs.count() == 5
    assert runs.join(nodes, "sk_dbt_node", "left_anti").isEmpty()
    keys = nodes.where(F.col("sk_dbt_node") != surrogate_key("dk_dbt_node"))
    assert keys.isEmpty()


def test_unobserved_node_is_untouched(spark, results, folder):
    runlog.log_results(spark, results(result("m.a"), result("m.b")), folder, "prod")
    runlog.log_results(spark, results(result("m.a", at=T0 + dt.timedelta(days=1))), folder, "prod")
    nodes = VersionedTable(spark, f"{folder}/dim_dbt_nodes").read()
    assert nodes.where("dk_dbt_node = 'm.b'").first()["last_seen_at"] == T0


def test_history_counts_as_if_applied_in_turn(spark, results):
    history = [
        result(f"m.{n}", at=T0 + dt.timedelta(days=d), schema=f"s{d}")
        for d, nodes in enumerate(["ab", "a", "bc"])
        for n in nodes
    ]
    empty = spark.createDataFrame([], runlog.RUN_LOG_CONTRACTS["dim_dbt_nodes"].schema)
    at_once = runlog.merge_nodes(empty, results(*history))
    in_turn = empty
    for day in range(3):
        in_turn = runlog.merge_nodes(
            in_turn, results(*[r for r in history if r[-1] == T0 + dt.timedelta(days=day)])
        )
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, in_turn.collect()))


def test_only_some_targets_log(spark, results, folder):
    assert not runlog.log_results(spark, results(result("m.a")), folder, "dev")
    assert not VersionedTable(spark, f"{folder}/dim_dbt_nodes").exists()
    assert runlog.log_results(spark, results(result("m.a")), folder, "dev", targets=["dev"])
    assert not runlog.log_results(spark, results(), folder, "prod")


def test_long_node_ids_are_cut_on_both_sides(spark, results, folder):
    runlog.log_results(spark, results(result("m." + "x" * 600)), folder, "prod")
    node = VersionedTable(spark, f"{folder}/dim_dbt_nodes").read().first()
    run = VersionedTable(spark, f"{folder}/fct_dbt_runs").read().first()
    assert len(node["dk_dbt_node"]) == 500 and node["sk_dbt_node"] == run["sk_dbt_node"]


def test_build_loads_tests_and_logs(spark, folder):
    raw, log = demo.Raw(spark), f"{folder}/log"
    warehouse = Warehouse(spark, f"{folder}/wh", buckets=1)
    tables, tests = warehouse.build(raw, "run-1", "prod", log)
    assert tables["fact_sales"].count() == 7 and tests.count() == 90
    runs = VersionedTable(spark, f"{log}/fct_dbt_runs")
    nodes = VersionedTable(spark, f"{log}/dim_dbt_nodes")
    assert runs.read().where("is_success").count() == 16 + 90
    named = runs.read().join(nodes.read(), "sk_dbt_node")
    assert named.where("node_name = 'fact_sales'").first()["rows_affected"] == 7
    assert named.where("resource_type = 'test' and failures <> 0").isEmpty()

    # A load that breaks a contract is logged as such, and raised.
    raw.row("raw_sales.raw_sales_orders", "S-11")[3] = ""
    with pytest.raises(ContractViolation):
        warehouse.build(raw, "run-2", "prod", log, full_refresh=True)
    second = runs.read().where("invocation_id = 'run-2'").join(nodes.read(), "sk_dbt_node")
    failed = second.where("is_error")
    assert {r["node_name"] for r in failed.collect()} == {"dim_date", "fact_sales"}
    assert "breaks its contract" in failed.first()["message"]
    assert second.count() == 16

    # Other targets keep no log.
    warehouse.build(demo.Raw(spark), "run-3", "dev", log, full_refresh=True)
    assert runs.read().where("invocation_id = 'run-3'").isEmpty()


def test_steps_not_reached_are_skipped(spark, folder):
    def source(name):
        if name == "raw_hr.raw_hr_sales_reps":
            raise OSError("no such table")
        return demo.Raw(spark)(name)

    log = f"{folder}/log"
    with pytest.raises(OSError):
        Warehouse(spark, f"{folder}/wh", buckets=1).build(source, "run-1", "prod", log)
    runs = VersionedTable(spark, f"{log}/fct_dbt_runs").read()
    assert runs.where("is_error").count() == 1
    assert runs.where("is_skipped").count() == 4 + 5
