"""Tables laid out by period, late members, co-located joins, footer statistics, one-shuffle checks."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oreline.operators import quality
from oreline.operators.changes import incremental
from oreline.operators.colocated import open_colocated, store_colocated
from oreline.operators.filters import _pushed_max, footer_max
from oreline.operators.tables import VersionedTable
from oreline.plans.warehouse import Layers, Warehouse, relink_orders
from oreline.sources import SourceCatalog, rows_df
from oreline.sources.trade import LAYOUT, TradeFiles

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "k bigint, at date, v string"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def frame(spark, *rows):
    return rows_df(spark, rows, SCHEMA)


def content(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def months(spark, folder):
    """Sixty months of ten days, in two buckets each."""
    table = VersionedTable(spark, f"{folder}/t", "k", 2, period="at")
    table.write(spark.range(600).selectExpr("id as k", "date_add(date'2020-01-01', int(id * 3)) as at", "'old' as v"))
    return table


def replaced(table, change):
    before = table.live().listed()
    change()
    return before, before - table.live().listed()


def test_recent_edits_rewrite_recent_directories(spark, months):
    delta = months.read().where("k >= 594").withColumn("v", F.lit("new"))
    before, gone = replaced(months, lambda: months.upsert(delta))
    assert len(before) > 100 and 0 < len(gone) < len(before) / 10
    assert months.read().count() == 600
    assert {r.k for r in months.read().where("v = 'new'").collect()} == set(range(594, 600))


def test_row_that_moves_to_another_period_is_replaced(spark, months):
    months.upsert(frame(spark, (5, day(1500), "moved"), (7, None, "undated")))
    rows = {r.k: (r.at, r.v) for r in months.read().where("k in (5, 7)").collect()}
    assert rows == {5: (day(1500), "moved"), 7: (None, "undated")}
    assert months.read().count() == 600
    months.upsert(frame(spark, (7, day(3), "dated")))
    assert months.read().where("k = 7").first().v == "dated" and months.read().count() == 600


def test_fixed_periods_look_at_their_own_only(spark, folder, monkeypatch):
    table = VersionedTable(spark, f"{folder}/t", "k", 1, period="at", grain="year", fixed_period=True)
    table.write(frame(spark, *[(k, day(k * 40), "old") for k in range(40)]))
    looked = []
    lies_in = VersionedTable._with_dir

    def spy(self, schema, key, dirs):
        looked.append(len(dirs))
        return lies_in(self, schema, key, dirs)

    monkeypatch.setattr(VersionedTable, "_with_dir", spy)
    table.upsert(frame(spark, (39, day(39 * 40), "new")))
    assert looked == [1] and len(table.live().dirs) == 5
    assert table.read().where("v = 'new'").count() == 1 and table.read().count() == 40


def test_rows_without_a_key_or_a_date(spark, months):
    for _ in range(2):
        months.upsert(frame(spark, (None, None, "x"), (None, day(0), "y"), (0, day(0), "new")))
    rows = [tuple(r) for r in months.read().where("k is null or k = 0").collect()]
    assert sorted(rows, key=str) == sorted(
        [(0, day(0), "new")] + [(None, None, "x"), (None, day(0), "y")] * 2, key=str
    )


def test_crash_of_an_upsert_leaves_the_old_table(spark, months, monkeypatch):
    before = content(months)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        months.upsert(frame(spark, (1, day(3), "x"), (9999, day(3), "x")))
    monkeypatch.undo()
    assert content(months) == before
    assert months.unreferenced()
    months.upsert(frame(spark, (1, day(3), "y")))
    assert months.read().where("v = 'y'").count() == 1


def test_layout_stays_with_the_table(spark, folder):
    made = VersionedTable(spark, f"{folder}/t", "k", 2, period="at", grain="year", watched={"k": 0})
    made.write(frame(spark, (1, day(0), "a"), (0, day(500), "b")))
    plain = VersionedTable(spark, f"{folder}/t")
    plain.write(frame(spark, (2, day(900), "c")), mode="append")
    plain.upsert(frame(spark, (1, day(0), "z")))
    assert {str(s).split("/")[0] for s in made.live().dirs} == {"2020", "2021", "2022"}
    assert content(made) == [(0, day(500), "b"), (1, day(0), "z"), (2, day(900), "c")]
    assert len(made.live().marked["k"]) == 1
    with pytest.raises(ValueError, match="grain"):
        VersionedTable(spark, f"{folder}/u", "k", period="at", grain="week")
    with pytest.raises(ValueError, match="key"):
        VersionedTable(spark, f"{folder}/u", period="at")


def test_watched_values_are_noted_when_written(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", "k", 1, period="at", grain="year", watched={"ref": 0})
    rows = lambda *r: rows_df(spark, r, "k bigint, at date, ref bigint")
    table.write(rows((1, day(0), 5), (2, day(400), 0), (3, day(800), None), (4, day(1200), 0)))
    assert len(table.live().marked["ref"]) == 2
    assert {r.k for r in table.read_marked("ref").collect()} == {2, 4}
    table.upsert(rows((2, day(400), 9)))
    assert {r.k for r in table.read_marked("ref").collect()} == {4}
    table.upsert(rows((5, day(0), 0)))
    assert {r.k for r in table.read_marked("ref").collect()} == {4, 5}
    table.write(rows((9, day(0), 1)))
    assert table.read_marked("ref").isEmpty()
    with pytest.raises(ValueError, match="watch"):
        table.read_marked("k")


def raw(spark, customers, products, reps):
    stamp = dt.datetime(2026, 1, 1)
    at = f"timestamp_ntz'{stamp}'"
    audit = f"{at} as updated_at, {at} as _loaded_at"
    one = lambda sql: spark.sql(f"select {sql}, {audit}")

    def union(sqls, like):
        out = one(like).where("false")
        for sql in sqls:
            out = out.unionByName(one(sql))
        return out

    customer = "'{0}' customer_id, 'n' full_name, 'e' email, 'be' country_code, 'c' city, " + f"{at} created_at"
    product = (
        "'{0}' product_id, 'n' product_name, 'x' category_code, cast(1 as decimal(18,2)) unit_price, "
        "date'2020-01-01' active_from, cast(null as date) active_to"
    )
    rep = "'{0}' sales_rep_id, 'n' sales_rep_name, 'r' region, 't' team_name, 'm' manager_name"
    order = (
        "'{0}' order_id, '{1}' customer_id, '{2}' sales_rep_id, date'{3}' order_date, '{4}' status, 'eur' currency_code"
    )
    line = (
        "'{0}' order_id, 1 line_id, '{1}' product_id, 2 quantity, cast(3 as decimal(18,2)) unit_price, "
        "cast(0 as decimal(18,2)) discount_amount"
    )
    category = (
        "'x' category_code, 'cat' category_name, 'grp' category_group, 1 is_budget_relevant, 'o' mdm_owner, "
        "date'2020-01-01' effective_from, cast(null as date) effective_to"
    )
    orders = [("A", "c1", "r1", "2024-05-01"), ("B", "c2", "r1", "2025-05-01"), ("C", "c1", "r2", "2026-05-01"), ("D", "none", "r1", "2026-06-01")]
    lines = [("A", "p1"), ("B", "p1"), ("C", "p2"), ("D", "p1")]

    def source(status):
        frames = {
            "raw_sales.raw_sales_customers": union([customer.format(c) for c in customers], customer.format("")),
            "raw_sales.raw_sales_products": union([product.format(p) for p in products], product.format("")),
            "raw_hr.raw_hr_sales_reps": union([rep.format(r) for r in reps], rep.format("")),
            "raw_sales.raw_sales_orders": union([order.format(*o, status) for o in orders], order.format("", "", "", "2020-01-01", "")),
            "raw_sales.raw_sales_order_lines": union([line.format(*x) for x in lines], line.format("", "")),
            "mdm.mdm_product_category_mapping": one(category),
        }
        return SourceCatalog(spark, frames=frames)

    return source


@pytest.mark.parametrize("grain", [None, "year"])
def test_a_run_relinks_members_that_arrive_late(spark, folder, grain):
    warehouse = Warehouse(spark, f"{folder}/wh", buckets=1, grain=grain)
    warehouse.run(raw(spark, ["c1"], ["p1"], ["r1"])("open"), "one")
    orders = warehouse.table("ads_sales_order")
    unknown = lambda: {
        r.order_id: [k for k in ("customer_pk", "product_pk", "sales_rep_pk") if r[k] == 0] for r in orders.read().collect()
    }
    assert unknown() == {"A": [], "B": ["customer_pk"], "C": ["product_pk", "sales_rep_pk"], "D": ["customer_pk"]}
    # The new members carry a later stamp, as a load would give them.
    later = raw(spark, ["c1", "c2"], ["p1", "p2"], ["r1", "r2"])("cancelled")
    bump = lambda name: later(name).withColumns({c: F.expr("timestamp_ntz'2026-02-01'") for c in ("updated_at",)})
    source = lambda name: bump(name) if "lines" not in name and "orders" not in name else later(name)
    warehouse.run(source, "two")
    assert unknown()["B"] == ["customer_pk"]  # by default they stay unknown
    mark = orders.greatest("order_line_updated_at")
    before = orders.live().listed()
    tables = warehouse.run(source, "three", relink=True)
    assert unknown() == {"A": [], "B": [], "C": [], "D": ["customer_pk"]}
    assert {r.status for r in orders.read().collect()} == {"OPEN"}  # nothing but the keys changed
    assert orders.greatest("order_line_updated_at") == mark and "order_line_updated_at" in orders.live().highest
    linked = tables["fact_sales"].where("product_key <> 0 and customer_key <> 0").count()
    assert linked == 3
    c = orders.read().where("order_id = 'C'").first()
    assert c.product_category_pk != 0
    if grain:  # order A had no unknown key: its year was not touched
        kept = [d for d in orders.live().listed() if "2024" in d]
        assert kept and set(kept) <= before
    version = orders.live().version
    warehouse.run(source, "four", relink=True)
    assert orders.live().version == version  # nothing left to relink


def test_relink_without_unknown_keys_reads_nothing(spark, folder, monkeypatch):
    table = VersionedTable(spark, f"{folder}/t", "k", watched={"customer_pk": 0})
    table.write(rows_df(spark, [(1, 5)], "k bigint, customer_pk bigint"))
    assert relink_orders(table, None, None, None, None, None) == 0


def test_colocated_tables_meet_without_an_exchange(spark, folder):
    layers = Layers(TradeFiles(spark, SF_DIR), "b")
    orders = store_colocated(layers["stg_orders"], f"{folder}/orders", "sales_order_pk", 4)
    lines = store_colocated(layers["stg_order_lines"], f"{folder}/lines", "sales_order_pk", 4)
    assert orders.schema.names == layers["stg_orders"].schema.names
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lines.select("sales_order_pk", "quantity").join(orders.select("sales_order_pk", "status"), "sales_order_pk")
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        again = open_colocated(spark, f"{folder}/orders", orders, "sales_order_pk", 4)
        assert "Exchange" not in plan(lines.join(again, "sales_order_pk"))
        assert joined.count() == lines.count()
        # With its lookups: the lines are moved for the products alone.
        text = plan(entry.queries()["colocated_orders"](spark, SF_DIR))
        moved = [x for x in text.splitlines() if "Exchange hashpartitioning(product_id" in x]
        headers = [x for x in text.splitlines() if "Exchange hashpartitioning(sales_order_pk" in x]
        assert len(headers) == 1 and len(moved) >= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_warehouse_with_colocated_bronze(spark, folder):
    files = TradeFiles(spark, SF_DIR)
    tables = Warehouse(spark, f"{folder}/wh", buckets=2).run(files, "b", colocated_buckets=4)
    got = tables["ads_sales_order"]
    want = Layers(files, "b")["ads_sales_order"]
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_maximum_comes_from_the_footers(spark, folder):
    lines = TradeFiles(spark, SF_DIR).table("lineitem")
    path = f"{SF_DIR}/lineitem.parquet"
    for column in ("l_shipdate", "l_orderkey", "l_linenumber"):
        found = footer_max(spark, [path], lines.schema, column)
        pushed = _pushed_max(spark, [path], lines.schema, column)
        assert "PushedAggregation: [MAX(" in plan(pushed)
        assert found.first()[0] == lines.agg(F.max(column)).first()[0]
    stamps = ["1969-12-31 23:59:59.999999", "0001-01-01 00:00:00", "2262-04-11 12:00:00.000001", None]
    for k, stamp in enumerate(stamps):
        rows = spark.sql(f"select 1 as a, cast({stamp and repr(stamp) or 'null'} as timestamp_ntz) as at")
        rows.write.parquet(f"{folder}/{k}")
        assert footer_max(spark, [f"{folder}/{k}"], rows.schema, "at").first()[0] == rows.first().at
    assert LAYOUT


def test_unknown_watermark_is_found_without_a_scan(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", "k")
    at = lambda *rows: rows_df(spark, rows, "k int, s string").selectExpr("k", "cast(s as timestamp_ntz) as at")
    table.write(at((1, "2026-01-05"), (2, "2026-01-04 10:00:00.5")))
    table.upsert(at((1, "2026-01-01")))
    assert "at" not in table.live().highest
    assert table.greatest("at") == "2026-01-04 10:00:00.5"
    assert incremental(table, at((3, "2026-01-04 10:00:00.5"), (4, "2026-01-04 10:00:01")), lambda x: x, "at") == 1
    assert {r.k for r in table.read().collect()} == {1, 2, 4}


def test_all_unique_columns_share_one_shuffle(spark):
    rows = rows_df(spark, [(1, "a", None), (2, "a", None), (2, "b", 5), (None, None, 5)], "x int, y string, z int")
    tables = {"t": rows, "u": rows.select("x")}
    got = quality.summarize(tables, {"t": ["x", "z"]}, {"t": ["x", "y", "z"], "u": ["x"]})
    text = plan(got)
    found = {(r["check"], r["table"], r["column"]): r["failures"] for r in got.collect()}
    assert found == {
        ("not_null", "t", "x"): 1, ("not_null", "t", "z"): 2, ("unique", "t", "x"): 1,
        ("unique", "t", "y"): 1, ("unique", "t", "z"): 1, ("unique", "u", "x"): 1,
    }
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+, value", text)) == 1
    assert len(re.findall(r"Generate explode", text)) == 2
