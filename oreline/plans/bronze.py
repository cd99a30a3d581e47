"""Bronze: one typed, case-folded, keyed relation per raw table.

Each function is a single projection, so it fuses with whatever reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions import (
    blank_to_date,
    lower,
    surrogate_key,
    to_bit,
    upper,
    varchar,
    with_batch_id,
)
from oreline.schemas import KEY_TAGS, PII_COLUMNS, PII_TAG


def _key(source: str, *columns: str) -> Column:
    return surrogate_key(F.lit(KEY_TAGS[source]), *columns)


def _stamp(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(alias or name)


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)").alias(name)


def _cut(name: str, n: int, fold=None) -> Column:
    text = varchar(name, n)
    tag = PII_TAG if name in PII_COLUMNS else {}
    return (fold(text) if fold else text).alias(name, metadata=tag)


def _staged(raw: DataFrame, batch_id: str, *columns: Column) -> DataFrame:
    audit = [_stamp("updated_at"), _stamp("_loaded_at", "source_loaded_at")]
    return with_batch_id(raw.select(*columns, *audit), batch_id)


def customers(raw: DataFrame, batch_id: str) -> DataFrame:
    return _staged(
        raw,
        batch_id,
        _key("sales", "customer_id").alias("customer_pk"),
        _cut("customer_id", 50),
        _cut("full_name", 200),
        _cut("email", 320, lower),
        _cut("country_code", 2, upper),
        _cut("city", 100),
        _stamp("created_at"),
    )


def products(raw: DataFrame, batch_id: str) -> DataFrame:
    return _staged(
        raw,
        batch_id,
        _key("sales", "product_id").alias("product_pk"),
        _cut("product_id", 50),
        _cut("product_name", 200),
        _cut("category_code", 50, upper),
        _money("unit_price"),
        F.col("active_from").cast("string").cast("date").alias("active_from"),
        blank_to_date("active_to").alias("active_to"),
    )


def orders(raw: DataFrame, batch_id: str) -> DataFrame:
    return _staged(
        raw,
        batch_id,
        _key("sales", "order_id").alias("sales_order_pk"),
        _cut("order_id", 50),
        _cut("customer_id", 50),
        _cut("sales_rep_id", 50),
        F.col("order_date").cast("date").alias("order_date"),
        _cut("status", 50, upper),
        _cut("currency_code", 3, upper),
    )


def order_lines(raw: DataFrame, batch_id: str) -> DataFrame:
    return _staged(
        raw,
        batch_id,
        _key("sales", "order_id", "line_id").alias("sales_order_line_pk"),
        _key("sales", "order_id").alias("sales_order_pk"),
        _cut("order_id", 50),
        F.col("line_id").cast("int").alias("line_id"),
        _cut("product_id", 50),
        F.col("quantity").cast("int").alias("quantity"),
        _money("unit_price"),
        _money("discount_amount"),
    )


def sales_reps(raw: DataFrame, batch_id: str) -> DataFrame:
    return _staged(
        raw,
        batch_id,
        _key("hr", "sales_rep_id").alias("sales_rep_pk"),
        _cut("sales_rep_id", 50),
        _cut("sales_rep_name", 200),
        _cut("region", 100),
        _cut("team_name", 100),
        _cut("manager_name", 200),
    )


def categories(raw: DataFrame, batch_id: str) -> DataFrame:
    return _staged(
        raw,
        batch_id,
        _key("master_data", "category_code").alias("product_category_pk"),
        _cut("category_code", 50, upper),
        _cut("category_name", 200),
        _cut("category_group", 200),
        to_bit("is_budget_relevant").alias("is_budget_relevant"),
        _cut("mdm_owner", 200),
        F.col("effective_from").cast("string").cast("date").alias("effective_from"),
        blank_to_date("effective_to").alias("effective_to"),
    )
