"""Gold: the sales star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions import calendar_parts, date_key
from oreline.operators.lookups import with_unknown_member
from oreline.schemas import GOLD_CONTRACTS

# What the unknown members say, and the status facts leave out.
UNKNOWN_CUSTOMER = {
    "customer_key": 0,
    "customer_id": "UNKNOWN",
    "full_name": "Unknown customer",
    "country_name": "Unknown",
    "city": "Unknown",
}
UNKNOWN_PRODUCT = {
    "product_key": 0,
    "product_id": "UNKNOWN",
    "product_name": "Unknown product",
    "category_code": "UNKNOWN",
    "product_category_key": 0,
    "category_name": "Unknown",
    "category_group": "Unknown",
    "is_budget_relevant": False,
    "is_current": False,
}
UNKNOWN_SALES_REP = {
    "sales_rep_key": 0,
    "sales_rep_id": "UNKNOWN",
    "sales_rep_name": "Unknown sales rep",
    "region": "Unknown",
    "team_name": "Unknown",
    "manager_name": "Unknown",
}
CANCELLED = "CANCELLED"

# Gold names of silver columns.
FACT_NAMES = {
    "sales_order_line_pk": "sales_fact_key",
    "sales_order_pk": "sales_order_key",
    "customer_pk": "customer_key",
    "product_pk": "product_key",
    "sales_rep_pk": "sales_rep_key",
    "order_id": "order_number",
    "line_id": "order_line_number",
    "status": "order_status",
}


def _conformed(df: DataFrame, table: str, names: Mapping[str, str]) -> DataFrame:
    """Rename, then keep the contract's columns in the contract's order."""
    contract = GOLD_CONTRACTS[table]
    return df.withColumnsRenamed(dict(names)).select(*contract.names)


def dim_customer(ads_customer: DataFrame) -> DataFrame:
    members = _conformed(ads_customer, "dim_customer", {"customer_pk": "customer_key"})
    return with_unknown_member(members, UNKNOWN_CUSTOMER)


def dim_product(ads_product: DataFrame) -> DataFrame:
    names = {"product_pk": "product_key", "product_category_pk": "product_category_key"}
    return with_unknown_member(_conformed(ads_product, "dim_product", names), UNKNOWN_PRODUCT)


def dim_sales_rep(ads_sales_rep: DataFrame) -> DataFrame:
    members = _conformed(ads_sales_rep, "dim_sales_rep", {"sales_rep_pk": "sales_rep_key"})
    return with_unknown_member(members, UNKNOWN_SALES_REP)


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per date of the orders that have lines, cancelled ones included."""
    dates = orders.select(F.col("order_date").alias("date_value")).distinct()
    key = date_key("date_value").alias("date_key")
    return dates.select(key, "date_value", *calendar_parts("date_value"))


def fact_sales(ads_sales_order: DataFrame) -> DataFrame:
    """Order lines that are not cancelled; a line without a status is not a fact."""
    sold = ads_sales_order.where(F.col("status") != CANCELLED)
    return _conformed(sold, "fact_sales", FACT_NAMES)


# The star's tables: how each is built, and from which silver table.
STAR = {
    "dim_customer": (dim_customer, "ads_customer"),
    "dim_product": (dim_product, "ads_product"),
    "dim_sales_rep": (dim_sales_rep, "ads_sales_rep"),
    "dim_date": (dim_date, "ads_sales_order"),
    "fact_sales": (fact_sales, "ads_sales_order"),
}


def build_star(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four dimensions and the fact from the silver tables."""
    return {name: build(silver[source]) for name, (build, source) in STAR.items()}
