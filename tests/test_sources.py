from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

import demo
from oreline.operators.tables import TableExists
from oreline.schemas import RAW_TABLES, raw_schema
from oreline.sources import HeaderMismatch, SourceCatalog, ingest, read_typed_csv

FAILED_JOB = (PySparkException, Py4JJavaError)
SCHEMA = (
    T.StructType()
    .add("id", T.StringType())
    .add("n", T.IntegerType())
    .add("price", T.DecimalType(18, 2))
    .add("day", T.DateType())
    .add("at", T.TimestampNTZType())
)


def csv_file(folder: str, text: str, name: str = "t.csv") -> str:
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_types_order_and_nulls(spark, folder):
    path = csv_file(
        folder,
        "day,id,at,price,n\n"
        "2026-05-03,é1,2026-05-03T17:00:00.25,12.50,7\n"
        '"",NULL,,"",\n'
        '2026-05-04,"say ""hi"", all",2026-05-03 17:00,1,-1\n',
    )
    df = read_typed_csv(spark, path, SCHEMA)
    assert df.schema == SCHEMA
    assert [tuple(r) for r in df.collect()] == [
        ("é1", 7, Decimal("12.50"), dt.date(2026, 5, 3), dt.datetime(2026, 5, 3, 17, 0, 0, 250000)),
        ("NULL", None, None, None, None),
        ('say "hi", all', -1, Decimal("1.00"), dt.date(2026, 5, 4), dt.datetime(2026, 5, 3, 17)),
    ]


def test_all_blank_column_keeps_its_type(spark, folder):
    path = csv_file(folder, "id,n,price,day,at\na,,,,\n")
    assert read_typed_csv(spark, path, SCHEMA).schema == SCHEMA


def test_header_mismatch_names_both_sets(spark, folder):
    path = csv_file(folder, "id,n,price,day,other\na,1,1.00,2026-01-01,x\n")
    with pytest.raises(HeaderMismatch) as e:
        read_typed_csv(spark, path, SCHEMA)
    assert "at (declared only), other (file only)" in str(e.value)


def test_files_of_one_folder_must_agree(spark, folder):
    csv_file(folder, "id,n\na,1\n", "a.csv")
    csv_file(folder, "n,id\n1,a\n", "b.csv")
    with pytest.raises(FAILED_JOB):
        read_typed_csv(spark, folder, T.StructType.fromDDL("id string, n int")).collect()


@pytest.mark.parametrize(
    "column, value",
    [
        ("n", "1.5"),
        ("n", "NULL"),
        ("n", "99999999999"),
        ("price", "1.234"),
        ("price", "12345678901234567.00"),
        ("day", "2026"),
        ("day", "2026-13-01"),
        ("at", "2026-05-03T17:00:00Z"),
        ("at", "yesterday"),
    ],
)
def test_bad_value_fails_the_job(spark, folder, column, value):
    good = {"id": "a", "n": "1", "price": "1.00", "day": "2026-01-01", "at": "2026-01-01"}
    path = csv_file(folder, ",".join(good) + "\n" + ",".join({**good, column: value}.values()) + "\n")
    with pytest.raises(FAILED_JOB):
        read_typed_csv(spark, path, SCHEMA).collect()


def test_short_row_fails_the_job(spark, folder):
    with pytest.raises(FAILED_JOB):
        read_typed_csv(spark, csv_file(folder, "id,n,price,day,at\na,1\n"), SCHEMA).collect()


def test_ingest_all_tables(spark, folder):
    src, sink = demo.write_csvs(f"{folder}/csv"), f"{folder}/raw"
    counts = ingest(spark, src, sink)
    assert counts == {name: len(rows) for name, rows in demo.ROWS.items()}
    source = SourceCatalog(spark, root=sink)
    for name in RAW_TABLES:
        assert source(name).schema == raw_schema(name)
        assert source(name).count() == counts[name]
    # The default mode overwrites, so loading again changes nothing.
    assert ingest(spark, src, sink) == counts
    assert source("raw_hr.raw_hr_sales_reps").count() == 2


def test_ingest_modes(spark, folder):
    src, sink = demo.write_csvs(f"{folder}/csv"), f"{folder}/raw"
    reps = ["raw_hr_sales_reps"]
    ingest(spark, src, sink, tables=reps)
    ingest(spark, src, sink, tables=reps, mode="append")
    source = SourceCatalog(spark, root=sink)
    assert source("raw_hr.raw_hr_sales_reps").count() == 4
    with pytest.raises(TableExists):
        ingest(spark, src, sink, tables=reps, mode="error")
    with pytest.raises(ValueError):
        ingest(spark, src, sink, tables=reps, mode="sometimes")


def test_ingest_is_all_or_nothing(spark, folder):
    src, sink = demo.write_csvs(f"{folder}/csv"), f"{folder}/raw"
    with open(f"{src}/mdm_product_category_mapping.csv", "a") as f:
        f.write("BAD,x,x,yes,o,2025-01-01,,2026-01-20T10:00:00,2026-04-02T05:30:00\n")
    with pytest.raises(FAILED_JOB):
        ingest(spark, src, sink)
    assert not [d for d, _, files in os.walk(sink) if d.endswith("/live") and files]


def test_ingest_subset_and_dry_run(spark, folder):
    src, sink = demo.write_csvs(f"{folder}/csv"), f"{folder}/raw"
    assert ingest(spark, src, sink, tables=["raw_sales_orders"], dry_run=True) == {
        "raw_sales.raw_sales_orders": 6
    }
    assert not os.path.exists(sink)
    with pytest.raises(ValueError, match="no_such_table"):
        ingest(spark, src, sink, tables=["no_such_table"])
    with pytest.raises(FAILED_JOB):
        ingest(spark, f"{folder}/nowhere", sink)


def test_dry_run_evaluates_every_column(spark, folder):
    src = demo.write_csvs(f"{folder}/csv")
    with open(f"{src}/raw_sales_orders.csv", "a") as f:
        f.write("S-9,C71,R5,not a day,OPEN,EUR,2026-03-14T18:00:00,2026-04-02T05:30:00\n")
    with pytest.raises(FAILED_JOB):
        ingest(spark, src, f"{folder}/raw", dry_run=True)


def test_source_lookup(spark):
    frame = spark.range(1)
    source = SourceCatalog(spark, frames={"raw_hr.raw_hr_sales_reps": frame})
    assert source("raw_hr.raw_hr_sales_reps") is frame
    with pytest.raises(KeyError):
        source("raw_hr.payroll")
