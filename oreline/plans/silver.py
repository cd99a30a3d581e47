"""Silver: conformed customers, products, reps and order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions import date_key, is_open_ended, map_values, net_amount, varchar
from oreline.operators import files
from oreline.operators.lookups import UNKNOWN_KEY, enrich, lookup_key, only_matching
from oreline.operators.tables import written_in_parts

# Country names by code, labels of an unmapped category.
COUNTRY_NAMES = {"BE": "Belgium", "NL": "Netherlands", "FR": "France"}
OTHER_COUNTRY = "Other"
UNMAPPED_CATEGORY = {
    "product_category_pk": 0,
    "category_name": "Unmapped",
    "category_group": "Unmapped",
    "is_budget_relevant": False,
}

SALES_ORDER_COLUMNS = [
    "sales_order_line_pk",
    "sales_order_pk",
    "order_id",
    "line_id",
    "order_date",
    "status",
    "currency_code",
    "quantity",
    "unit_price",
    "discount_amount",
    "source_loaded_at",
    "dbt_batch_id",
    "order_updated_at",
    "order_line_updated_at",
    "customer_pk",
    "product_pk",
    "product_category_pk",
    "sales_rep_pk",
    "order_date_key",
    "net_sales_amount",
]


def customers(stg_customers: DataFrame) -> DataFrame:
    name = varchar(map_values("country_code", COUNTRY_NAMES, OTHER_COUNTRY), 100)
    return stg_customers.withColumn("country_name", name)


def products_with_categories(stg_products: DataFrame, stg_categories: DataFrame) -> DataFrame:
    """Products with their master-data category; not temporal, matched by code."""
    joined = enrich(
        stg_products, stg_categories, "category_code", UNMAPPED_CATEGORY, plain=("mdm_owner",)
    )
    return joined.select(
        "product_pk",
        "product_id",
        "product_name",
        "category_code",
        "mdm_owner",
        "unit_price",
        "active_from",
        "active_to",
        "updated_at",
        "source_loaded_at",
        "dbt_batch_id",
        *UNMAPPED_CATEGORY,
    )


def products(int_product: DataFrame) -> DataFrame:
    return int_product.withColumn("is_current", is_open_ended("active_to"))


def sales_reps(stg_sales_reps: DataFrame) -> DataFrame:
    return stg_sales_reps


def _headers(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.select(
        "sales_order_pk",
        "order_id",
        "customer_id",
        "sales_rep_id",
        "order_date",
        "status",
        "currency_code",
        "source_loaded_at",
        F.col("updated_at").alias("order_updated_at"),
    )


def _lines(stg_order_lines: DataFrame) -> DataFrame:
    return stg_order_lines.select(
        "sales_order_line_pk",
        "sales_order_pk",
        "line_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_amount",
        "dbt_batch_id",
        F.col("updated_at").alias("order_line_updated_at"),
    )


def _with_customer_and_rep(rows: DataFrame, customers: DataFrame, reps: DataFrame) -> DataFrame:
    rows = lookup_key(rows, customers, "customer_id", "customer_pk")
    return lookup_key(rows, reps, "sales_rep_id", "sales_rep_pk")


def _with_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    keys = {"product_pk": "product_pk", "product_category_pk": "product_category_pk"}
    return lookup_key(rows, products, "product_id", keys)


def _measured(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "order_date_key": date_key("order_date"),
            "net_sales_amount": net_amount("quantity", "unit_price", "discount_amount"),
        }
    ).select(*SALES_ORDER_COLUMNS)


def sales_orders(
    stg_orders: DataFrame,
    stg_order_lines: DataFrame,
    ads_customer: DataFrame,
    ads_product: DataFrame,
    ads_sales_rep: DataFrame,
    colocated: bool = False,
) -> DataFrame:
    """All order lines with their header and dimension keys.

    Customer and rep are looked up per order header, before the headers meet
    their lines: the lines, the largest input, are then moved for the order join
    and, if the products are too many to broadcast, for the product lookup only.
    Lines that are stored by order key (``colocated``) meet their headers first,
    where they lie, and are moved for the product lookup at most.
    """
    headers = _with_customer_and_rep(_headers(stg_orders), ads_customer, ads_sales_rep)
    if colocated:
        together = _lines(stg_order_lines).join(headers, "sales_order_pk")
        return _measured(_with_product(together, ads_product))
    lines = _with_product(_lines(stg_order_lines), ads_product)
    return _measured(lines.join(headers, "sales_order_pk"))


def changed_sales_orders(
    changed_lines: DataFrame,
    stg_orders: DataFrame,
    ads_customer: DataFrame,
    ads_product: DataFrame,
    ads_sales_rep: DataFrame,
    folder: str,
) -> DataFrame:
    """``sales_orders`` for a small, already written set of changed lines.

    The change set meets the headers first and is written again, so that each
    big table is only scanned against the few keys the changes mention. ``folder``
    holds what is written until the result was used.
    """
    joined = _lines(changed_lines).join(_headers(stg_orders), "sales_order_pk")
    rows = written_in_parts(joined, f"{folder}/with_headers", "sales_order_pk")
    rows = _with_customer_and_rep(
        rows,
        only_matching(ads_customer, "customer_id", rows),
        only_matching(ads_sales_rep, "sales_rep_id", rows),
    )
    return _measured(_with_product(rows, only_matching(ads_product, "product_id", rows)))


# Keys of an order line that point to an unknown member until it arrives.
LATE_KEYS = ("customer_pk", "product_pk", "sales_rep_pk")


def late_members(
    unknown: DataFrame,
    stg_orders: DataFrame,
    stg_order_lines: DataFrame,
    ads_customer: DataFrame,
    ads_product: DataFrame,
    ads_sales_rep: DataFrame,
    folder: str,
) -> DataFrame:
    """Extension: stored order lines whose unknown members have arrived, with their keys.

    ``unknown`` are rows of the stored order lines, of which only those on an unknown
    key are looked at. Nothing but the keys changes: other edits of a header wait for
    its lines, as ever. The rows are written down first, so that the big tables are
    only scanned against what they mention; ``folder`` holds that until the result was
    used.
    """
    late = unknown.where(" or ".join(f"{key} = {UNKNOWN_KEY}" for key in LATE_KEYS))
    pk, order = "sales_order_line_pk", "sales_order_pk"
    rows = written_in_parts(late, f"{folder}/unknown", order)
    # A line's key tells its order's; named here so that parts by order take part of the lines.
    names = only_matching(stg_order_lines, pk, rows).select(pk, order, "product_id")
    headers = only_matching(stg_orders, order, rows).select(order, "customer_id", "sales_rep_id")
    joined = rows.join(names, [pk, order]).join(headers, order)
    named = written_in_parts(joined, f"{folder}/named", order)
    files.delete(rows.sparkSession, f"{folder}/unknown")
    lookups = {
        "customer_id": (ads_customer, {"customer_pk": "new_customer_pk"}),
        "sales_rep_id": (ads_sales_rep, {"sales_rep_pk": "new_sales_rep_pk"}),
        "product_id": (
            ads_product,
            {"product_pk": "new_product_pk", "product_category_pk": "new_product_category_pk"},
        ),
    }
    found = named
    for on, (members, keys) in lookups.items():
        found = lookup_key(found, only_matching(members, on, named), on, keys)
    arrived = {k: (F.col(k) == UNKNOWN_KEY) & (F.col(f"new_{k}") != UNKNOWN_KEY) for k in LATE_KEYS}
    taken = {**arrived, "product_category_pk": arrived["product_pk"]}
    # Which rows change is seen before their keys do.
    changed = found.where(arrived["customer_pk"] | arrived["product_pk"] | arrived["sales_rep_pk"])
    return changed.withColumns(
        {k: F.when(here, F.col(f"new_{k}")).otherwise(F.col(k)) for k, here in taken.items()}
    ).select(*SALES_ORDER_COLUMNS)
