"""Every operator as a runnable query over a directory of trade files.

Each query takes ``(spark, sf_dir)`` and reads whole tables. Queries that
maintain tables write them to a fresh folder below ``spark.checkpoint.dir`` and
return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.functions import surrogate_key
from oreline.operators import files, quality
from oreline.operators.changes import incremental, materialize, together
from oreline.operators.colocated import store_colocated
from oreline.operators.dedup import latest_per_key
from oreline.operators.filters import footer_max, max_value, newer_than, recent_slice
from oreline.operators.lookups import lookup_key
from oreline.operators.tables import VersionedTable, work_dir
from oreline.plans import reports, runlog, silver
from oreline.plans.warehouse import (
    COLOCATED,
    SILVER_WATCHED,
    Layers,
    Warehouse,
    data_tests,
    relink_orders,
    source_freshness,
)
from oreline.schemas import GOLD_CONTRACTS, RAW_TABLES
from oreline.sources import SourceCatalog, ingest
from oreline.sources.catalog import table_path
from oreline.sources.trade import TradeFiles
from oreline.streaming import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

# Batch ids, watermark split and clock of the registered queries.
BATCH = "batch-0001"
NEXT_BATCH = "batch-0002"
SPLIT = "2000-01-01 00:00:00"
AS_OF = "2001-11-20 00:00:00"
RUN_SPLIT = "2024-01-16 00:00:00"
RECENT = "2001-11-01 00:00:00"
ORDER_BUCKETS = 8


def _layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(TradeFiles(spark, sf_dir), BATCH)


def _model(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _layers(spark, sf_dir)[name]

    return query


def _split() -> F.Column:
    return F.lit(SPLIT).cast("timestamp_ntz")


def _surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.nullif(F.lower("l_linestatus"), F.lit("o"))
    return TradeFiles(spark, sf_dir).table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        surrogate_key("l_returnflag").alias("one_part"),
        surrogate_key(F.lit("sales"), "l_orderkey").alias("two_parts"),
        surrogate_key(F.lit("sales"), "l_orderkey", "l_linenumber").alias("three_parts"),
        surrogate_key(F.lit("Sales"), missing, "l_partkey").alias("null_part"),
    )


def _key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against the mapped products only, so the others fall to key 0."""
    layers = _layers(spark, sf_dir)
    mapped = layers["ads_product"].where("product_category_pk <> 0")
    lines = layers["stg_order_lines"].select("sales_order_line_pk", "product_id")
    return lookup_key(lines, mapped, "product_id", {"product_pk": "product_key"})


def _watermark_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _layers(spark, sf_dir)["stg_order_lines"]
    return max_value(lines, "updated_at")


def _footer_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest ship date and the greatest order, from the statistics of the files."""
    lines = TradeFiles(spark, sf_dir).table("lineitem")
    days = footer_max(spark, [f"{sf_dir}/lineitem.parquet"], lines.schema, "l_shipdate")
    keys = footer_max(spark, [f"{sf_dir}/lineitem.parquet"], lines.schema, "l_orderkey")
    named = [x.toDF("value").select(F.lit(n).alias("column"), F.col("value").cast("string")) for n, x in (
        ("l_shipdate", days), ("l_orderkey", keys))]
    return named[0].union(named[1])


def _watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _layers(spark, sf_dir)["stg_order_lines"]
    return newer_than(lines, lines.where(F.col("updated_at") <= _split()), "updated_at")


def _recent_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_slice(_layers(spark, sf_dir)["stg_order_lines"], "updated_at", AS_OF, 30)


def _upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early lines, then a batch with the later ones and edits of some early ones."""
    lines = _layers(spark, sf_dir)["stg_order_lines"]
    early = F.col("updated_at") <= _split()
    edited = F.col("quantity") + F.when(early, 1).otherwise(0)
    batch = lines.where(~early | (F.col("quantity") >= 45)).withColumns(
        {"quantity": edited.cast("int"), "dbt_batch_id": F.lit(NEXT_BATCH)}
    )
    path = work_dir(spark)
    table = VersionedTable(spark, f"{path}/order_lines", key="sales_order_line_pk", buckets=8)
    table.write(lines.where(early))
    table.upsert(batch)
    return table.read()


def _incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; lines that arrive late, at or before the watermark, stay out."""
    layers = _layers(spark, sf_dir)
    others = [layers[n] for n in ("ads_customer", "ads_product", "ads_sales_rep")]
    orders, lines = layers["stg_orders"], layers["stg_order_lines"]
    arrived = (F.col("updated_at") <= _split()) & (F.col("quantity") != 50)
    path = work_dir(spark)
    table = VersionedTable(spark, f"{path}/ads_sales_order", "sales_order_line_pk", buckets=8)
    for seen in (lines.where(arrived), lines):
        incremental(
            table,
            seen,
            lambda rows: silver.sales_orders(orders, rows, *others),
            "updated_at",
            "order_line_updated_at",
            build_changes=lambda rows, folder: silver.changed_sales_orders(
                rows, orders, *others, folder
            ),
            parts_by="sales_order_pk",
        )
    return table.read()


def _upsert_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines laid out by year, then an edit of the recent ones and a late arrival."""
    lines = _layers(spark, sf_dir)["stg_order_lines"]
    late = F.col("quantity") == 50
    recent = F.col("updated_at") >= F.lit(RECENT).cast("timestamp_ntz")
    path = work_dir(spark)
    table = VersionedTable(
        spark, f"{path}/order_lines", "sales_order_line_pk", 2, period="updated_at", grain="year"
    )
    table.write(lines.where(~late))
    table.upsert(
        lines.where(recent | late).withColumns(
            {"quantity": (F.col("quantity") + 1).cast("int"), "dbt_batch_id": F.lit(NEXT_BATCH)}
        )
    )
    return table.read()


def _late_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines stored before some of their members arrived, linked to them later.

    The headers were edited in between, which must not show: their lines did not change.
    """
    layers = _layers(spark, sf_dir)
    orders, lines = layers["stg_orders"], layers["stg_order_lines"]
    members = [layers[n] for n in ("ads_customer", "ads_product", "ads_sales_rep")]
    there = ("country_name <> 'Netherlands'", "is_current", "region <> 'ASIA'")
    table = VersionedTable(
        spark,
        f"{work_dir(spark)}/ads_sales_order",
        "sales_order_line_pk",
        2,
        period="order_date",
        grain="year",
        watched=SILVER_WATCHED["ads_sales_order"],
    )
    early = [m.where(condition) for m, condition in zip(members, there)]
    table.write(silver.sales_orders(orders, lines, *early), parts_by="sales_order_pk")
    relink_orders(table, orders.withColumn("status", F.lit("EDITED")), lines, *members)
    return table.read()


def _colocated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines from headers and lines that were stored by order key."""
    layers = _layers(spark, sf_dir)
    path = work_dir(spark)
    orders, lines = together(
        {
            name: partial(store_colocated, layers[name], f"{path}/{name}", key, ORDER_BUCKETS)
            for name, key in COLOCATED.items()
        }
    ).values()
    members = [layers[n] for n in ("ads_customer", "ads_product", "ads_sales_rep")]
    return silver.sales_orders(orders, lines, *members, colocated=True)


def _gold_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written under its contract; a write that breaks it must not be seen."""
    fact, contract = _layers(spark, sf_dir)["fact_sales"], GOLD_CONTRACTS["fact_sales"]
    table = VersionedTable(spark, f"{work_dir(spark)}/fact_sales")
    materialize(fact, "table", table, contract=contract, parts_by="sales_order_key")
    has_discount = F.col("discount_amount") != 0
    broken = fact.withColumn("net_sales_amount", F.when(has_discount, F.col("net_sales_amount")))
    try:
        broken = broken.withColumn("order_status", F.lit("x" * 51))
        table.write(broken, contract=contract, parts_by="sales_order_key")
    except quality.ContractViolation:
        return table.read()
    raise AssertionError("a broken write was published")


def _landed(spark: SparkSession, sf_dir: str, name: str, blank: str) -> DataFrame:
    """A raw table as CSV with its columns in another order and blanks, ingested, read back."""
    path, short = work_dir(spark), name.split(".")[-1]
    raw = TradeFiles(spark, sf_dir)(name)
    # An empty text field is a blank either way, quoted or bare.
    turned = raw.select(*reversed(raw.columns)).withColumn(
        blank, F.when(F.col(blank).isNull(), "").otherwise(F.col(blank).cast("string"))
    )
    turned.write.options(header=True, emptyValue="").csv(f"{path}/csv/{short}.csv")
    ingest(spark, f"{path}/csv", f"{path}/raw", tables=[short])
    return SourceCatalog(spark, root=f"{path}/raw")(name)


def _ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "raw_sales.raw_sales_order_lines", "updated_at")


def _ingest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "raw_sales.raw_sales_products", "active_to")


def _stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, kept by a stream that is restarted between two
    arrivals of files, and once more after it forgot that its last batch was done."""
    columns = ["user_id", "ts", "event_id", "event_type", "value"]
    events = TradeFiles(spark, sf_dir).table("events").select(*columns)
    split = F.col("ts") < F.lit(RUN_SPLIT).cast("timestamp_ntz")
    path = work_dir(spark)
    table = VersionedTable(spark, f"{path}/latest", key="user_id", buckets=4)
    table.ensure(events.schema)

    def catch_up() -> None:
        arriving = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        running = stream_upsert(arriving, table, f"{path}/checkpoint", ["ts", "event_id"])
        running.awaitTermination()

    for arrived in (events.where(split), events.where(~split)):
        arrived.write.mode("append").parquet(f"{path}/in")
        catch_up()
    commits = f"{path}/checkpoint/commits"
    last = max(files.child_names(spark, commits), key=int)
    files.delete(spark, f"{commits}/{last}")
    catch_up()
    return table.read()


def _latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = TradeFiles(spark, sf_dir).table("lineitem")
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    ]
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        "l_shipdate",
    )


def _logged(spark: SparkSession, sf_dir: str) -> str:
    """A run log that two loads of the run history wrote; the first creates its tables."""
    results, path = TradeFiles(spark, sf_dir).run_results(), work_dir(spark)
    split = F.lit(RUN_SPLIT).cast("timestamp_ntz")
    for load in (F.col("run_started_at") < split, F.col("run_started_at") >= split):
        runlog.log_results(spark, results.where(load), path, "prod")
    return path


def _runlog_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node dimension after two logged loads."""
    return VersionedTable(spark, f"{_logged(spark, sf_dir)}/dim_dbt_nodes").read()


def _runlog_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run facts after two logged loads."""
    return VersionedTable(spark, f"{_logged(spark, sf_dir)}/fct_dbt_runs").read()


def _contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with one defect of each kind planted."""
    fact = _layers(spark, sf_dir)["fact_sales"]
    free_of_discount = F.col("discount_amount") == 0
    broken = (
        fact.drop("currency_code")
        .withColumn("quantity", F.col("quantity").cast("bigint"))
        .withColumn("loaded_by", F.lit("nobody"))
        .withColumn("net_sales_amount", F.when(~free_of_discount, F.col("net_sales_amount")))
        .withColumn(
            "order_status",
            F.when(F.col("order_status") == "OPEN", F.repeat("order_status", F.lit(13))).otherwise(
                F.col("order_status")
            ),
        )
    )
    return quality.check_contract(broken, GOLD_CONTRACTS["fact_sales"])


def _dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _layers(spark, sf_dir)["fact_sales"]
    planted = fact.withColumns(
        {
            "net_sales_amount": F.when(F.col("discount_amount") != 0, F.col("net_sales_amount")),
            "sales_rep_key": F.nullif("sales_rep_key", F.lit(0).cast("bigint")),
        }
    )
    return quality.null_counts(planted, ["net_sales_amount", "customer_key", "sales_rep_key"])


def _dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = TradeFiles(spark, sf_dir).table("lineitem")
    return quality.unique(lines, ["l_orderkey", "l_linenumber"])


def _dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts against a product dimension that lacks the unmapped products."""
    layers = _layers(spark, sf_dir)
    mapped = layers["dim_product"].where("category_name <> 'Unmapped'")
    return quality.relationships(layers["fact_sales"], "product_key", mapped, "product_key")


def _dq_unmapped_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _layers(spark, sf_dir)["ads_product"]
    unmapped = F.col("product_category_pk") == 0
    return quality.rule(products, unmapped, ["product_id", "category_code"])


def _dq_negative_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _layers(spark, sf_dir)["fact_sales"]
    lowered = (F.col("net_sales_amount") - 40000).cast("decimal(18,2)")
    planted = fact.withColumn("net_sales_amount", lowered)
    negative = F.col("net_sales_amount") < 0
    return quality.rule(planted, negative, ["sales_fact_key", "net_sales_amount"])


def _dq_active_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = _layers(spark, sf_dir)
    return quality.active_mapping_violations(stg["stg_products"], stg["stg_categories"])


def _dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All data tests over a warehouse that was just loaded."""
    files = TradeFiles(spark, sf_dir)
    landing = f"{work_dir(spark)}/raw"

    def land(name: str) -> DataFrame:
        table = VersionedTable(spark, table_path(landing, name))
        materialize(files(name), "table", table)
        return table.read()

    raw = together({name: partial(land, name) for name in RAW_TABLES})
    tables = Warehouse(spark, work_dir(spark)).run(raw.__getitem__, BATCH, keep_bronze=True)
    return data_tests({**{name.split(".")[-1]: df for name, df in raw.items()}, **tables})


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_freshness(TradeFiles(spark, sf_dir), AS_OF)


def sales_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship. The dates need few columns of the order lines, so they are not stored first."""
    return reports.sales_by_period(_layers(spark, sf_dir))


def _customer_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_recency(_layers(spark, sf_dir), AS_OF[:10])


MODELS = [
    "stg_customers",
    "stg_products",
    "stg_orders",
    "stg_order_lines",
    "stg_sales_reps",
    "stg_categories",
    "int_product",
    "ads_customer",
    "ads_product",
    "ads_sales_rep",
    "ads_sales_order",
    "dim_customer",
    "dim_product",
    "dim_sales_rep",
    "dim_date",
    "fact_sales",
]


def queries() -> dict[str, Query]:
    return {name: _model(name) for name in MODELS} | {
        "surrogate_key": _surrogate_key,
        "key_lookup": _key_lookup,
        "watermark_value": _watermark_value,
        "footer_watermark": _footer_watermark,
        "watermark_filter": _watermark_filter,
        "recent_slice": _recent_slice,
        "upsert_merge": _upsert_merge,
        "upsert_by_period": _upsert_by_period,
        "late_members": _late_members,
        "colocated_orders": _colocated_orders,
        "gold_write": _gold_write,
        "ingest_lines": _ingest_lines,
        "ingest_products": _ingest_products,
        "stream_upsert": _stream_upsert,
        "incremental_orders": _incremental_orders,
        "latest_per_key": _latest_per_key,
        "runlog_dim": _runlog_dim,
        "runlog_fact": _runlog_fact,
        "contract_check": _contract_check,
        "dq_not_null": _dq_not_null,
        "dq_unique": _dq_unique,
        "dq_relationships": _dq_relationships,
        "dq_unmapped_products": _dq_unmapped_products,
        "dq_negative_amounts": _dq_negative_amounts,
        "dq_active_mapping": _dq_active_mapping,
        "dq_summary": _dq_summary,
        "freshness": _freshness,
        "star_sales_by_period": sales_by_period,
        "customer_recency": _customer_recency,
    }
