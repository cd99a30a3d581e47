"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oreline.operators.dedup import latest_per_key
from oreline.operators.filters import newer_than
from oreline.operators.lookups import only_matching
from oreline.operators.tables import written
from oreline.plans import queries as registered
from oreline.plans import silver
from oreline.plans.queries import AS_OF
from oreline.plans.warehouse import Layers
from oreline.schemas import RAW_TABLES
from oreline.sources.trade import LAYOUT, TradeFiles

SF_DIR = "/root/testdata/sf0.001"
WRITING = {
    "upsert_merge", "upsert_by_period", "late_members", "incremental_orders", "dq_summary",
    "gold_write", "ingest_lines", "ingest_products", "stream_upsert", "runlog_dim", "runlog_fact",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - WRITING))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_layout_is_the_files_own(spark):
    for name, declared in LAYOUT.items():
        found = spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema
        assert found == spark.createDataFrame([], declared).schema, name


def test_only_used_columns_are_read(spark):
    text = plan(entry.queries()["watermark_value"](spark, SF_DIR))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in text
    assert "Window" not in text


@pytest.mark.parametrize("name", ["recent_slice", "watermark_filter"])
def test_time_filters_reach_the_scan_of_the_lines(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    scans = [l for l in text.splitlines() if "FileScan parquet" in l and "l_quantity" in l]
    assert scans and all(re.search(r"DataFilters: \[.*l_shipdate#\d+ >", l) for l in scans)


def test_dates_need_one_join(spark):
    text = plan(Layers(TradeFiles(spark, SF_DIR), "b")["dim_date"])
    assert len(re.findall(r"\w+Join\b", text)) == 1


def test_watermark_reaches_the_scan(spark, folder):
    lines = TradeFiles(spark, SF_DIR).order_lines()
    lines.write.parquet(f"{folder}/lines")
    stored = spark.read.parquet(f"{folder}/lines")
    text = plan(newer_than(stored, stored.where("quantity < 10"), "updated_at"))
    assert re.search(r"DataFilters: \[.*updated_at.*> Subquery", text)


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    lines = TradeFiles(spark, SF_DIR).table("lineitem")
    text = plan(latest_per_key(lines, ["l_orderkey"], ["l_shipdate"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert "Partial" in text[text.rindex("WindowGroupLimit") :]


def test_key_of_a_join_is_hashed_once(spark):
    text = plan(Layers(TradeFiles(spark, SF_DIR), "b")["fact_sales"])
    assert "isnotnull(cast(conv" not in text and "isnotnull(coalesce" not in text


def test_lines_move_for_numbering_products_and_orders_only(spark):
    """With small sides broadcast or not, the lines are exchanged three times at most."""
    text = plan(Layers(TradeFiles(spark, SF_DIR), "b")["ads_sales_order"])
    over_lines = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("sales_order_pk" in line for line in over_lines) == 2
    assert sum("l_orderkey" in line for line in over_lines) == 1


def test_gold_needs_no_shuffle(spark, folder):
    """From stored silver rows the fact is a filter and a projection, pushed to the scan."""
    layers = Layers(TradeFiles(spark, SF_DIR), "b")
    layers.built["ads_sales_order"] = written(layers["ads_sales_order"], f"{folder}/silver")
    text = plan(layers["fact_sales"])
    assert "Exchange" not in text
    assert re.search(r"PushedFilters: \[.*Not\(EqualTo\(status,CANCELLED\)\)", text)


def test_relationships_are_pre_aggregated(spark):
    """A parent too big to broadcast meets distinct keys, not all child rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()["dq_relationships"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.index("LeftAnti") < text.index("partial_count")


def test_hot_order_and_hot_customer(spark, folder):
    """A third of all lines in one order, of one customer, with no product: all kept."""
    files = TradeFiles(spark, SF_DIR)
    n = files.table("lineitem").count()
    hot = F.col("l_partkey") % 3 == 0
    lines = files.table("lineitem").withColumns(
        {
            "l_orderkey": F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("l_orderkey")),
            "l_partkey": F.when(hot, F.lit(-1).cast("bigint")).otherwise(F.col("l_partkey")),
        }
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")

    class Skewed(TradeFiles):
        def table(self, name):
            if name == "lineitem":
                return spark.read.schema(LAYOUT[name]).parquet(f"{folder}/lineitem.parquet")
            return super().table(name)

    layers = Layers(Skewed(spark, SF_DIR), "b")
    stg = layers["stg_order_lines"]
    assert stg.select("order_id", "line_id").distinct().count() == stg.count() == n
    # Numbering spreads the hot order over many small groups.
    groups = stg.where("order_id = '1'").groupBy(F.pmod("line_id", F.lit(16384))).count()
    assert groups.agg(F.max("count")).first()[0] < 40
    orders = layers["ads_sales_order"]
    assert orders.count() == n
    assert orders.where("product_pk = 0").count() == lines.where("l_partkey = -1").count()


def test_small_change_set_leaves_big_tables_in_place(spark, folder):
    """Big = above the broadcast limit. The changes are broadcast to it, never the reverse."""
    layers = Layers(TradeFiles(spark, SF_DIR), "b")
    orders = written(layers["stg_orders"], f"{folder}/orders")
    few = layers["stg_order_lines"].where("order_id = '6'").coalesce(1)
    lines = written(few, f"{folder}/lines")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10KB")
    try:
        joined = silver._lines(lines).join(silver._headers(orders), "sales_order_pk")
        text = plan(joined)
        assert "Exchange hashpartitioning" not in text and "BuildLeft" in text
        rows = written(joined.coalesce(1), f"{folder}/joined")
        text = plan(only_matching(orders, "customer_id", rows))
        assert "LeftSemi, BuildRight" in text
        assert text.count("Exchange hashpartitioning") == 1  # of the few wanted keys
        # The orders themselves are over the limit: joined as they are, they move.
        assert "SortMergeJoin" in plan(orders.join(orders.alias("again"), "sales_order_pk"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_raw_table_has_a_view(spark):
    files = TradeFiles(spark, SF_DIR)
    for name, columns in RAW_TABLES.items():
        assert files(name).columns == list(columns), name
    assert AS_OF
