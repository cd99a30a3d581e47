"""Extensions: two reports the star is made for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sales_by_period(star: Mapping[str, DataFrame]) -> DataFrame:
    """Net sales and lines by year, quarter, country and category group.

    The small dates come first and only the reported attributes of each
    dimension take part.
    """
    fact = star["fact_sales"].select(
        "customer_key", "product_key", "sales_rep_key", "order_date_key", "net_sales_amount"
    )
    dates = star["dim_date"].select(
        F.col("date_key").alias("order_date_key"), "calendar_year", "calendar_quarter"
    )
    products = star["dim_product"].select("product_key", "category_group")
    reps = star["dim_sales_rep"].select("sales_rep_key", "region")
    customers = star["dim_customer"].select("customer_key", "country_name")
    return (
        fact.join(dates, "order_date_key")
        .join(products, "product_key")
        .join(reps, "sales_rep_key")
        .join(customers, "customer_key")
        .groupBy("calendar_year", "calendar_quarter", "country_name", "category_group", "region")
        .agg(
            F.count(F.lit(1)).alias("order_lines"),
            F.sum("net_sales_amount").cast("decimal(28,2)").alias("net_sales_amount"),
        )
    )


def customer_recency(star: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """Per customer: first and last order, lines, net sales, days since at ``as_of``.

    The fact is reduced to one row per customer before it meets the dimension;
    customers without sales stay, with no dates and zero lines.
    """
    per_customer = (
        star["fact_sales"]
        .groupBy("customer_key")
        .agg(
            F.min("order_date_key").alias("first_key"),
            F.max("order_date_key").alias("last_key"),
            F.count(F.lit(1)).alias("order_lines"),
            F.sum("net_sales_amount").cast("decimal(28,2)").alias("net_sales_amount"),
        )
    )

    def day(key: str):
        return F.to_date(F.col(key).cast("string"), "yyyyMMdd")

    customers = star["dim_customer"].select("customer_key", "customer_id", "country_name")
    return customers.join(per_customer, "customer_key", "left").select(
        "customer_key",
        "customer_id",
        "country_name",
        day("first_key").alias("first_order_date"),
        day("last_key").alias("last_order_date"),
        F.coalesce("order_lines", F.lit(0)).cast("bigint").alias("order_lines"),
        F.coalesce("net_sales_amount", F.lit(0).cast("decimal(28,2)")).alias("net_sales_amount"),
        F.datediff(F.lit(as_of).cast("date"), day("last_key")).alias("days_since_last_order"),
    )
