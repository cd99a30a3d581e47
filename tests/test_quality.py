"""Each check finds its planted defect, and nothing in sound data."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreline.operators import quality as q
from oreline.schemas import Contract
from oreline.sources import rows_df

CONTRACT = Contract.of("t", {"k": "bigint *", "v": "varchar(3)", "d": "date *"})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def parent(spark):
    return rows_df(spark, [(1, "a"), (2, "b"), (0, "unknown")], "k bigint, name string")


@pytest.fixture(scope="module")
def child(spark):
    return rows_df(
        spark, [(10, 1), (11, 1), (12, 9), (13, 9), (14, 0), (15, None)], "id bigint, fk bigint"
    )


def test_not_null(child):
    assert rows(q.not_null(child, "fk")) == [(15, None)]
    assert rows(q.null_counts(child, ["id", "fk"])) == [("fk", 1), ("id", 0)]


def test_unique(child):
    assert rows(q.unique(child, "fk")) == [(1, 2), (9, 2)]
    assert rows(q.unique(child, "id")) == []
    assert rows(q.unique(child, ["id", "fk"])) == []


def test_unique_ignores_nulls(spark):
    df = rows_df(spark, [(None,), (None,), (1,)], "k bigint")
    assert rows(q.unique(df, "k")) == []


def test_relationships(child, parent):
    assert rows(q.relationships(child, "fk", parent, "k")) == [(9, 2)]
    sound = child.where("fk is null or fk <> 9")
    assert rows(q.relationships(sound, "fk", parent, "k")) == []


def test_rule(child):
    assert rows(q.rule(child, F.col("fk") > 5, ["id"])) == [(12,), (13,)]


def test_active_mapping(spark):
    products = rows_df(
        spark, [("ONE",), ("ONE",), ("TWO",), ("ENDED",), ("NONE",), (None,)], "category_code string"
    )
    categories = rows_df(
        spark,
        [
            ("ONE", None),
            ("ONE", dt.date(2020, 1, 1)),
            ("TWO", None),
            ("TWO", None),
            ("ENDED", dt.date(2020, 1, 1)),
        ],
        "category_code string, effective_to date",
    )
    got = rows(q.active_mapping_violations(products, categories))
    assert got == [("ENDED", 0), ("NONE", 0), ("TWO", 2)]


@pytest.mark.parametrize(
    "age, status",
    [
        (dt.timedelta(days=7), "pass"),
        (dt.timedelta(days=7, seconds=1), "warn"),
        (dt.timedelta(days=30), "warn"),
        (dt.timedelta(days=30, seconds=1), "error"),
        (None, "error"),
    ],
)
def test_freshness_limits(spark, age, status):
    as_of = dt.datetime(2026, 6, 1)
    loaded = [] if age is None else [(as_of - age,), (as_of - dt.timedelta(days=99),)]
    df = rows_df(spark, loaded, "at timestamp_ntz")
    got = q.freshness(df, "at", 7, 30, F.lit(as_of).cast("timestamp_ntz")).first()
    assert got["status"] == status
    assert got["age_seconds"] == (None if age is None else int(age.total_seconds()))


def test_contract_check(spark):
    day = dt.date(2026, 1, 1)
    sound = rows_df(spark, [(1, "abc", day)], "k bigint, v string, d date")
    assert rows(q.check_contract(sound, CONTRACT)) == []
    broken = rows_df(
        spark, [(None, "abcd", 1), (2, "x", 1)], "k bigint, v string, extra int"
    )
    assert rows(q.check_contract(broken, CONTRACT)) == [
        ("t", "d", "missing_column", "date", 1),
        ("t", "extra", "unexpected_column", "int", 1),
        ("t", "k", "null", "required", 1),
        ("t", "v", "too_long", "more than 3 characters", 1),
    ]
    retyped = sound.withColumn("k", F.lit("1"))
    assert rows(q.check_contract(retyped, CONTRACT)) == [
        ("t", "k", "wrong_type", "string instead of bigint", 1)
    ]


def test_a_check_of_a_missing_table_is_an_error(child):
    with pytest.raises(ValueError, match="parent"):
        q.summarize({"child": child}, {"child": ["id"]}, {}, [("child", "fk", "parent", "k")])
    with pytest.raises(ValueError, match="other"):
        q.summarize({"child": child}, {"other": ["id"]}, {})


def test_summary(child, parent):
    got = q.summarize(
        {"child": child, "parent": parent},
        {"child": ["id", "fk"]},
        {"child": ["fk"], "parent": ["k"]},
        [("child", "fk", "parent", "k")],
        {("small", "child", "fk"): F.col("fk") > 5},
    )
    assert rows(got) == [
        ("not_null", "child", "fk", 1, "fail"),
        ("not_null", "child", "id", 0, "pass"),
        ("relationships", "child", "fk", 2, "fail"),
        ("small", "child", "fk", 2, "fail"),
        ("unique", "child", "fk", 2, "fail"),
        ("unique", "parent", "k", 0, "pass"),
    ]


def test_unknown_contract_type():
    with pytest.raises(ValueError):
        Contract.of("t", {"x": "geometry"})


def test_long_and_text_values_of_unique_columns_are_told_apart(spark):
    rows = [(1, "1", 1), (1, "2", 2), (None, None, None), (2, "2", 2)]
    df = spark.createDataFrame(rows, "n bigint, t string, i int")
    out = q.summarize({"x": df}, {"x": ["n"]}, {"x": ["n", "t", "i"]})
    got = {(r["check"], r["column"]): r["failures"] for r in out.collect()}
    assert got == {("not_null", "n"): 1, ("unique", "n"): 1, ("unique", "t"): 1, ("unique", "i"): 1}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # A long meets the shuffle as it is.
    assert "cast(n#" not in plan
