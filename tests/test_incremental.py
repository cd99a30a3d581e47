"""Loads of the whole warehouse, one after the other."""

from __future__ import annotations

from decimal import Decimal
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import demo
from oreline.operators.filters import newer_than
from oreline.operators.lookups import relink_unknown
from oreline.operators.quality import ContractViolation, relationships
from oreline.plans.warehouse import Layers, Warehouse, data_tests
from oreline.schemas import NOT_NULL, RAW_TABLES, RELATIONSHIPS, UNIQUE
from oreline.sources import SourceCatalog, ingest

LINES = "raw_sales.raw_sales_order_lines"
ORDERS = "raw_sales.raw_sales_orders"
PRODUCTS = "raw_sales.raw_sales_products"
CUSTOMERS = "raw_sales.raw_sales_customers"
CATEGORIES = "mdm.mdm_product_category_mapping"

# Status and net amount of each line.
LINES_SOLD = {
    ("S-11", 1): ("INVOICED", "57.00"),
    ("S-11", 2): ("INVOICED", "35.00"),
    ("S-11", 3): ("INVOICED", "19.98"),
    ("S-12", 1): ("INVOICED", "105.00"),
    ("S-13", 1): ("OPEN", "248.00"),
    ("S-14", 1): ("CANCELLED", "28.50"),
    ("S-14", 2): ("CANCELLED", "6.20"),
    ("S-15", 1): ("INVOICED", "45.00"),
    ("S-15", 2): ("INVOICED", "400.00"),
}
DATES = {
    (20251230, 2025, 4, 12, "December", 30, 1),
    (20260102, 2026, 1, 1, "January", 2, 1),
    (20260228, 2026, 1, 2, "February", 28, 9),
    (20260309, 2026, 1, 3, "March", 9, 11),
}


def line_key(order: str, line: int) -> int:
    return int.from_bytes(sha256(f"SALES-{order}-{line}".encode()).digest()[:7], "big")


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_demo_goldens(spark, folder):
    ingest(spark, demo.write_csvs(f"{folder}/csv"), f"{folder}/raw")
    source = SourceCatalog(spark, root=f"{folder}/raw")
    tables = Warehouse(spark, f"{folder}/wh", buckets=1).run(source, "run-1", keep_bronze=True)
    got = {
        (r["order_id"], r["line_id"]): (r["sales_order_line_pk"], r["status"], str(r["net_sales_amount"]))
        for r in tables["ads_sales_order"].collect()
    }
    assert got == {line: (line_key(*line), *sold) for line, sold in LINES_SOLD.items()}
    fact = tables["fact_sales"]
    assert fact.count() == 7
    assert fact.agg(F.sum("net_sales_amount")).first()[0] == Decimal("909.98")
    counts = {n: tables[n].count() for n in ("dim_customer", "dim_product", "dim_sales_rep", "dim_date")}
    assert counts == {"dim_customer": 6, "dim_product": 6, "dim_sales_rep": 3, "dim_date": 4}
    dates = tables["dim_date"].drop("date_value")
    assert {tuple(r) for r in dates.collect()} == DATES
    assert rows(tables["dim_customer"], "customer_id", "country_name") == {
        ("C71", "Belgium"),
        ("C72", "Other"),
        ("C73", "Netherlands"),
        ("C74", "France"),
        ("C75", "Belgium"),
        ("UNKNOWN", "Unknown"),
    }
    raw = {name.split(".")[-1]: source(name) for name in RAW_TABLES}
    results = data_tests({**raw, **tables}).collect()
    assert len(results) == 90
    assert {r["status"] for r in results} == {"pass"}


def test_declared_test_counts():
    assert sum(map(len, NOT_NULL.values())) == 55
    assert sum(map(len, UNIQUE.values())) == 29
    assert len(RELATIONSHIPS) == 4


def test_personal_data_is_tagged_in_every_layer(spark, folder):
    ingest(spark, demo.write_csvs(f"{folder}/csv"), f"{folder}/raw")
    source = SourceCatalog(spark, root=f"{folder}/raw")
    tables = Warehouse(spark, f"{folder}/wh", buckets=1).run(source, "run-1")
    raw = {name: source(name) for name in RAW_TABLES}
    tagged = {
        (name, f.name)
        for name, df in {**raw, **tables}.items()
        for f in df.schema
        if f.metadata.get("contains_pii")
    }
    people = [CUSTOMERS, "stg_customers", "ads_customer", "dim_customer"]
    reps = ["raw_hr.raw_hr_sales_reps", "stg_sales_reps", "ads_sales_rep", "dim_sales_rep"]
    assert tagged == {(t, c) for t in people for c in ("full_name", "email")} | {
        (t, c) for t in reps for c in ("sales_rep_name", "manager_name")
    }


def test_incremental_story(spark, folder):
    raw = demo.Raw(spark)
    warehouse = Warehouse(spark, f"{folder}/wh", buckets=2)

    def run(batch, **options):
        return warehouse.run(raw, batch, **options)

    def fact(tables):
        return {(r["order_number"], r["order_line_number"]): r for r in tables["fact_sales"].collect()}

    # 1: the first run equals a full build.
    tables = run("run-1")
    lazy = Layers(raw, "run-1")
    for name in ("ads_customer", "ads_product", "ads_sales_rep", "ads_sales_order", "fact_sales"):
        assert rows(tables[name], "*") == rows(lazy[name].select(tables[name].columns), "*"), name

    # 2: nothing changed, nothing is processed.
    versions = {n: warehouse.table(n).live().version for n in ("ads_sales_order", "ads_product")}
    before = rows(tables["ads_sales_order"], "*")
    tables = run("run-2")
    assert rows(tables["ads_sales_order"], "*") == before
    assert versions == {n: warehouse.table(n).live().version for n in versions}

    # 3 and 4: an edited line is replaced, a new one inserted, others keep their batch.
    edited = raw.line("S-11", "1")
    edited[3], edited[6] = "20", "2026-03-20T08:00:00"
    raw.rows[LINES].append(
        ["S-12", "2", "P300", "1", "4.75", "0.00", "2026-03-20T09:00:00", demo.LOADED]
    )
    # 8, first half: a line for a customer nobody knows yet.
    raw.rows[ORDERS].append(
        ["S-19", "C99", "R9", "2026-03-20", "OPEN", "EUR", "2026-03-20T09:00:00", demo.LOADED]
    )
    raw.rows[LINES].append(
        ["S-19", "1", "P399", "1", "10.00", "0.00", "2026-03-20T09:00:00", demo.LOADED]
    )
    tables = run("run-3")
    now = fact(tables)
    assert now["S-11", 1]["quantity"] == 20 and now["S-11", 1]["dbt_batch_id"] == "run-3"
    assert now["S-11", 2]["dbt_batch_id"] == "run-1"
    assert now["S-12", 2]["dbt_batch_id"] == "run-3"
    assert len(now) == 9
    orphan = now["S-19", 1]
    assert (orphan["customer_key"], orphan["product_key"], orphan["sales_rep_key"]) == (0, 0, 0)
    for child, fk, parent, pk in RELATIONSHIPS:
        assert relationships(tables[child], fk, tables[parent], pk).isEmpty()

    # 5: a status flip alone does not refresh the lines.
    raw.row(ORDERS, "S-15")[4] = "CANCELLED"
    raw.row(ORDERS, "S-15")[6] = "2026-03-21T08:00:00"
    # 6: a late line stamped at the watermark is never seen.
    raw.rows[LINES].append(
        ["S-13", "2", "P300", "1", "4.75", "0.00", "2026-03-20T09:00:00", demo.LOADED]
    )
    # 7: an edited category does not refresh its products.
    raw.row(CATEGORIES, "TEA")[1] = "Renamed"
    # 8: the customer arrives.
    raw.rows[CUSTOMERS].append(
        ["C99", "Late Lou", "lou@shop.test", "DE", "Trier", "2026-03-21T08:00:00", "2026-03-21T08:00:00", demo.LOADED]
    )
    # 9: a deleted source row stays in the target.
    raw.rows[LINES].remove(raw.line("S-12", "1"))
    tables = run("run-4")
    now = fact(tables)
    assert ("S-15", 1) in now and ("S-13", 2) not in now and ("S-12", 1) in now
    assert now["S-19", 1]["customer_key"] == 0
    assert ("Renamed",) not in rows(tables["dim_product"], "category_name")
    assert ("C99", "Other") in rows(tables["dim_customer"], "customer_id", "country_name")

    # 10: a full refresh resolves all of that.
    tables = run("run-5", full_refresh=True)
    now = fact(tables)
    assert ("S-15", 1) not in now and ("S-13", 2) in now and ("S-12", 1) not in now
    assert now["S-19", 1]["customer_key"] != 0
    assert ("Renamed",) in rows(tables["dim_product"], "category_name")


def _raw(source):
    return {name.split(".")[-1]: source(name) for name in RAW_TABLES}


def test_lookback_picks_up_late_rows(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2026-01-01'), (2, timestamp_ntz'2026-01-05'), "
        "(3, null) as t(id, at)"
    )
    target = df.where("id = 2")
    assert newer_than(df, target, "at").count() == 0
    assert rows(newer_than(df, target, "at", lookback_days=7), "id") == {(1,), (2,)}
    # An empty target: everything with a timestamp is new.
    assert rows(newer_than(df, df.where("false"), "at"), "id") == {(1,), (2,)}


def test_relink_unknown(spark):
    fact = spark.sql("select * from values (1, 'a', 0L), (2, 'b', 7L), (3, 'z', 0L) as t(id, nk, key)")
    dim = spark.sql("select * from values ('a', 5L), ('b', 6L) as t(nk, pk)")
    got = rows(relink_unknown(fact, "nk", dim, "key", "pk"), "id", "key")
    assert got == {(1, 5), (2, 7), (3, 0)}


def test_recent_slice_limits_the_lines_only(spark, folder):
    tables = Warehouse(spark, f"{folder}/wh", buckets=1).run(
        demo.Raw(spark), "run-1", recent_days=15, as_of="2026-03-11 00:00:00"
    )
    assert rows(tables["ads_sales_order"], "order_id") == {("S-13",), ("S-14",), ("S-15",)}
    assert tables["stg_orders"].count() == 6


def test_edge_rows(spark):
    raw = demo.Raw(spark)
    raw.rows[LINES] += [
        ["S-77", "1", "P300", "1", "1.00", "0.00", "2026-01-03T17:00:00", demo.LOADED],  # no header
        ["S-11", "4", "", "1", "1.00", "2.00", "2026-01-03T17:00:00", demo.LOADED],  # no product, negative
    ]
    raw.rows[ORDERS].append(
        ["S-18", "", "", "2026-03-20", "", "EURO", "2026-03-20T09:00:00", demo.LOADED]
    )
    raw.rows[LINES].append(
        ["S-18", "1", "P300", "1", "1.00", "0.00", "2026-03-20T09:00:00", demo.LOADED]
    )
    raw.row(PRODUCTS, "P303")[2] = "XXX"
    layers = Layers(raw, "b")
    silver = {(r["order_id"], r["line_id"]): r for r in layers["ads_sales_order"].collect()}
    assert ("S-77", 1) not in silver
    assert silver["S-11", 4]["product_pk"] == 0
    assert silver["S-11", 4]["net_sales_amount"] == Decimal("-1.00")
    no_status = silver["S-18", 1]
    assert no_status["status"] is None and no_status["customer_pk"] == 0
    assert no_status["currency_code"] == "EUR"
    assert "S-18" not in {r[0] for r in rows(layers["fact_sales"], "order_number")}
    unmapped = layers["ads_product"].where("product_id = 'P303'").first()
    assert (unmapped["product_category_pk"], unmapped["category_name"], unmapped["is_budget_relevant"]) == (
        0,
        "Unmapped",
        False,
    )
    tests = data_tests({**layers, **_raw(raw)}).where("status = 'fail'").collect()
    assert {(r["check"], r["table"], r["column"], r["failures"]) for r in tests} == {
        ("mapped_to_master_data", "ads_product", "product_category_pk", 1),
        ("non_negative", "fact_sales", "net_sales_amount", 1),
        ("not_null", "stg_orders", "customer_id", 1),
        ("not_null", "stg_orders", "sales_rep_id", 1),
    }


def test_missing_order_date_fails_the_build_and_keeps_gold(spark, folder):
    raw = demo.Raw(spark)
    warehouse = Warehouse(spark, f"{folder}/wh", buckets=1)
    warehouse.run(raw, "run-1")
    raw.row(ORDERS, "S-11")[3] = ""
    assert None in {r[0] for r in rows(Layers(raw, "b")["dim_date"], "date_value")}
    with pytest.raises(ContractViolation, match="date"):
        warehouse.run(raw, "run-2", full_refresh=True)
    assert warehouse.table("dim_date").read().count() == 4


def test_duplicate_natural_key_fans_out_and_is_reported(spark):
    raw = demo.Raw(spark)
    raw.rows[CUSTOMERS].append(list(raw.row(CUSTOMERS, "C71")))
    layers = Layers(raw, "b")
    assert layers["ads_sales_order"].count() == 9 + 5
    failed = data_tests({**layers, **_raw(raw)}).where("status = 'fail' and check = 'unique'")
    assert ("ads_customer", "customer_id", 1) in rows(failed, "table", "column", "failures")
