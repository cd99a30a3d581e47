"""Writes in parts: the same table, the shuffle files of one part at a time."""

import os
import time

import pytest
from pyspark.sql import functions as F

from oreline.operators import tables
from oreline.operators.quality import ContractViolation
from oreline.operators.tables import FREE_SHUFFLES, VersionedTable, in_parts, written
from oreline.schemas import GOLD_CONTRACTS


@pytest.fixture
def in_small_parts(monkeypatch):
    monkeypatch.setattr(tables, "PART_BYTES", 1)


def _rows(spark, folder, n=400):
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"),
        (F.col("id") % 7).alias("order"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("t"),
    )
    return written(rows, f"{folder}/in")


def test_parts_hold_each_row_once(spark, folder, in_small_parts):
    df = _rows(spark, folder)
    parts = in_parts(df, "k")
    assert len(parts) == tables.MOST_PARTS
    got = [r for p in parts for r in p.collect()]
    assert sorted(map(str, got)) == sorted(map(str, df.collect()))
    assert in_parts(df, None) == [df]


def test_small_input_stays_whole(spark, folder):
    df = _rows(spark, folder)
    assert in_parts(df, "k") == [df]


def test_a_part_scans_its_share_of_both_sides_of_a_join(spark, folder, in_small_parts):
    df = _rows(spark, folder)
    joined = df.join(df.select("order", F.col("k").alias("other")), "order")
    plan = in_parts(joined, "order")[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pmod") == 2


def test_a_table_in_parts_is_the_table(spark, folder, in_small_parts):
    df = _rows(spark, folder)
    table = VersionedTable(spark, f"{folder}/t", "k", 3, watched={"order": 3})
    before = spark.conf.get(FREE_SHUFFLES, None)
    assert table.write(df, parts_by="order") == 400
    changes = df.where("k % 3 = 0").withColumn("order", F.lit(50).cast("long"))
    assert table.upsert(changes, parts_by="order") == changes.count()
    assert spark.conf.get(FREE_SHUFFLES, None) == before
    want = df.withColumn("order", F.when(F.expr("k % 3 = 0"), 50).otherwise(F.col("order")))
    assert sorted(map(str, table.read().collect())) == sorted(map(str, want.collect()))
    assert table.greatest("t") == "1970-01-01 00:06:39"
    marked = table.read_marked("order").where("order = 3")
    assert marked.count() == want.where("order = 3").count()


def test_a_broken_write_leaves_no_files_and_counts_all_parts(spark, folder, in_small_parts):
    contract = GOLD_CONTRACTS["dim_date"]
    types = {c.name: c.dtype for c in contract.columns}
    rows = written(spark.range(100).withColumn("part", F.col("id") % 9), f"{folder}/in")
    values = {c: F.lit(None) for c in types} | {"month_number": F.col("part")}
    df = rows.select(*[values[c].cast(t).alias(c) for c, t in types.items()])
    table = VersionedTable(spark, f"{folder}/t")
    with pytest.raises(ContractViolation, match="null in date_key: 100 row"):
        table.write(df, contract=contract, parts_by="month_number")
    assert not table.exists()
    assert not os.path.exists(f"{folder}/t/data") or not os.listdir(f"{folder}/t/data")


def test_shuffle_files_go_with_their_write(spark, folder):
    df = _rows(spark, folder, 20000).repartition(5, "order")
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = root.getAllFiles()
        names = [files.apply(k).getName() for k in range(files.size())]
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before = shuffles()
    VersionedTable(spark, f"{folder}/t", "k", 3).write(df)
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
