from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from oreline import functions as fn
from oreline.sources import rows_df

# Known keys: parts and the key they must give.
KEYS = [
    (("sales", "CUST-001"), 27989048460738794),
    (("SALES", "cust-001"), 27989048460738794),
    (("sales", None), 57171978884798502),
    (("sales", "CUST-002"), 43773395107933830),
    (("sales", "PROD-004"), 66986153188829395),
    (("hr", "REP-03"), 13519354336048252),
    (("workbook_connect", "SRV"), 25244371217324060),
    (("sales", "ORD-1005"), 36884072021748123),
    (("sales", "ORD-1001", "1"), 52258909733966152),
    (("sales", "ORD-1005", "2"), 13574174140539005),
]


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("_"))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("parts, key", KEYS)
def test_surrogate_key_golden(spark, parts, key):
    assert one(spark, fn.surrogate_key(*[F.lit(p).cast("string") for p in parts])) == key


def test_surrogate_key_rules(spark):
    def key(*parts):
        return one(spark, fn.surrogate_key(*[F.lit(p).cast("string") for p in parts]))

    assert key("ab", "c") != key("a", "bc")
    assert key(None, "a") != key("", "a")
    assert key("a") == key("A")
    assert key(None) == key("_surrogate_key_null_") or key(None) >= 0
    assert 0 <= key("x", "y") < 2**56
    with pytest.raises(ValueError):
        fn.surrogate_key()


def test_surrogate_key_of_integers_and_unicode(spark):
    import hashlib

    def want(text):
        return int(hashlib.sha256(text.encode()).hexdigest()[:14], 16)

    df = rows_df(spark, [(7, "été"), (8, "日本")], "n int, s string")
    got = df.select(fn.surrogate_key("n", "s").alias("k")).collect()
    assert [r["k"] for r in got] == [want("7-ÉTÉ"), want("8-日本")]


def test_varchar_cuts(spark):
    assert one(spark, fn.varchar("s", 3), s="abcdef") == "abc"
    assert one(spark, fn.varchar("s", 3), s="ab") == "ab"
    assert one(spark, fn.varchar(F.lit(None).cast("string"), 3)) is None
    assert one(spark, fn.varchar("n", 2), n=1234) == "12"


def test_case_fold(spark):
    assert one(spark, fn.lower("s"), s="A@B.Com") == "a@b.com"
    assert one(spark, fn.upper("s"), s="be") == "BE"


def test_blank_to_date(spark):
    assert one(spark, fn.blank_to_date("s"), s="") is None
    assert one(spark, fn.blank_to_date("s"), s="2026-05-03") == dt.date(2026, 5, 3)
    with pytest.raises(PySparkException):
        one(spark, fn.blank_to_date("s"), s="soon")


def test_to_bit(spark):
    assert [one(spark, fn.to_bit("n"), n=n) for n in (0, 1, 2, -1)] == [False, True, True, True]


def test_map_values(spark):
    names = fn.map_values("c", {"BE": "Belgium", "NL": "Netherlands"}, "Other")
    assert one(spark, names, c="BE") == "Belgium"
    assert one(spark, names, c="be") == "Other"
    assert one(spark, fn.map_values(F.lit(None).cast("string"), {"BE": "Belgium"}, "Other")) == "Other"
    assert one(spark, fn.map_values("c", {}, "Other"), c="BE") == "Other"


def test_net_amount(spark):
    df = rows_df(
        spark,
        [(2, Decimal("1200.00"), Decimal("0.50")), (None, Decimal("1.00"), Decimal("0.00"))],
        "q int, p decimal(18,2), d decimal(18,2)",
    ).select(fn.net_amount("q", "p", "d").alias("net"))
    assert df.schema["net"].dataType.simpleString() == "decimal(18,2)"
    assert [r["net"] for r in df.collect()] == [Decimal("2399.50"), None]


def test_net_amount_overflow_raises(spark):
    huge = rows_df(
        spark,
        [(2_000_000_000, Decimal("9999999999999999.99"), Decimal(0))],
        "q int, p decimal(18,2), d decimal(18,2)",
    )
    with pytest.raises(PySparkException):
        huge.select(fn.net_amount("q", "p", "d")).collect()


def test_date_parts(spark):
    days = [dt.date(2026, 5, 3), dt.date(2026, 12, 31), dt.date(2027, 1, 1), None]
    df = rows_df(spark, [(d,) for d in days], "d date")
    got = df.select(fn.date_key("d").alias("key"), *fn.calendar_parts("d")).collect()
    assert tuple(got[0]) == (20260503, 2026, 2, 5, "May", 3, 18)
    assert tuple(got[1]) == (20261231, 2026, 4, 12, "December", 31, 53)
    assert tuple(got[2]) == (20270101, 2027, 1, 1, "January", 1, 53)
    assert tuple(got[3]) == (None,) * 7


def test_open_ended_and_typed_literals(spark):
    assert one(spark, fn.is_open_ended(F.lit(None).cast("date"))) is True
    assert one(spark, fn.is_open_ended("d"), d=dt.date(2026, 1, 1)) is False
    typed = spark.range(1).select(fn.typed_lit(None, "decimal(18,2)").alias("x"))
    assert typed.schema["x"].dataType.simpleString() == "decimal(18,2)"


def test_cast_columns_raises_on_bad_text(spark):
    df = rows_df(spark, [("1", "x")], "a string, b string")
    assert fn.cast_columns(df, {"a": "int"}).first()["a"] == 1
    with pytest.raises(PySparkException):
        fn.cast_columns(df, {"b": "int"}).collect()


def test_batch_id(spark):
    df = fn.with_batch_id(spark.range(1), "b" * 40)
    assert df.first()["dbt_batch_id"] == "b" * 36


def test_utc_naive(spark):
    wall = dt.datetime(2026, 7, 1, 12, 0)
    df = rows_df(spark, [(wall,)], "t timestamp_ntz")
    assert df.select(fn.utc_naive("t", "Europe/Brussels")).first()[0] == dt.datetime(2026, 7, 1, 10, 0)
    instant = spark.sql("select timestamp'2026-07-01 12:00:00+02:00' as t")
    assert instant.select(fn.utc_naive("t")).first()[0] == dt.datetime(2026, 7, 1, 10, 0)


@pytest.mark.parametrize(
    "status, flags",
    [
        ("success", (1, 0, 0)),
        ("PASS", (1, 0, 0)),
        ("error", (0, 1, 0)),
        ("fail", (0, 1, 0)),
        ("runtime error", (0, 1, 0)),
        ("skipped", (0, 0, 1)),
        ("warn", (0, 0, 0)),
        (None, (0, 0, 0)),
    ],
)
def test_status_flags(spark, status, flags):
    df = spark.range(1).select(F.lit(status).cast("string").alias("s")).select(*fn.status_flags("s"))
    assert tuple(int(v) for v in df.first()) == flags
