from __future__ import annotations

import pytest

from oreline.operators.changes import materialize, together
from oreline.operators.filters import max_value
from oreline.operators.lookups import enrich, lookup_key, only_matching, with_unknown_member
from oreline.operators.tables import VersionedTable
from oreline.sources import rows_df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_materialize_kinds(spark, folder):
    df = rows_df(spark, [(1,), (2,)], "k bigint")
    assert materialize(df, "view", view="numbers") == 0
    assert rows(spark.sql("select * from numbers")) == [(1,), (2,)]
    table = VersionedTable(spark, f"{folder}/t")
    assert materialize(df, "table", table) == 2
    assert rows(table.read()) == [(1,), (2,)]
    for kind in ("table", "incremental"):
        with pytest.raises(ValueError):
            materialize(df, kind)


def test_together_raises_after_all_have_ended():
    done = []

    def fail():
        raise RuntimeError("first")

    with pytest.raises(RuntimeError, match="first"):
        together({"a": fail, "b": lambda: done.append("b")})
    assert done == ["b"]
    assert together({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}


def test_lookup_and_enrich(spark):
    facts = rows_df(spark, [(1, "a"), (2, "z"), (3, None)], "id int, nk string")
    dim = rows_df(spark, [("a", 7, "x", None), ("b", 8, "y", True)], "nk string, pk bigint, v string, f boolean")
    found = lookup_key(facts, dim, "nk", {"pk": "key"}).select("id", "key")
    assert rows(found) == [(1, 7), (2, 0), (3, 0)]
    assert found.schema["key"].dataType.simpleString() == "bigint"
    more = enrich(facts, dim, "nk", {"v": "none", "f": False}, plain=("pk",)).select("id", "v", "f", "pk")
    assert rows(more) == [(1, "x", False, 7), (2, "none", False, None), (3, "none", False, None)]
    assert rows(only_matching(dim, "nk", facts).select("nk")) == [("a",)]


def test_unknown_member(spark):
    dim = rows_df(spark, [(5, "a", None)], "key bigint, name string, flag boolean")
    assert rows(with_unknown_member(dim, {"key": 0, "name": "Unknown"})) == [
        (0, "Unknown", None),
        (5, "a", None),
    ]
    assert with_unknown_member(dim, {"key": 0}).schema["key"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="colour"):
        with_unknown_member(dim, {"colour": "red"})


def test_max_of_nothing(spark):
    assert rows(max_value(rows_df(spark, [], "at timestamp_ntz"), "at")) == [(None,)]


def test_hot_key_of_a_lookup_is_split(spark):
    """Adaptive execution splits a key that fills a partition; nothing is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in settings if spark.conf.get(k, None)}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(300_000, numPartitions=8).selectExpr(
            "id", "case when id % 3 = 0 then 'hot' else cast(id as string) end as nk"
        )
        dim = spark.range(50_000).selectExpr("cast(id * 2 as string) as nk", "id + 1 as pk")
        found = lookup_key(facts, dim, "nk", {"pk": "key"})
        got = found.groupBy((found.key == 0).alias("unknown")).count()
        want = facts.join(dim, "nk", "left_semi").count()
        assert rows(got) == [(False, want), (True, 300_000 - want)]
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)
