"""Declared layouts: raw inputs, gold contracts, freshness limits, data tests.

Everything here is fixed data that results must agree with; the code that
interprets it lives in ``sources``, ``operators`` and ``plans``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: raw inputs ------------------------------------------------

RAW_TABLES: dict[str, dict[str, str]] = {
    "raw_sales.raw_sales_customers": {
        "customer_id": "string",
        "full_name": "string",
        "email": "string",
        "country_code": "string",
        "city": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        "_loaded_at": "timestamp_ntz",
    },
    "raw_sales.raw_sales_products": {
        "product_id": "string",
        "product_name": "string",
        "category_code": "string",
        "unit_price": "decimal(18,2)",
        "active_from": "date",
        "active_to": "date",
        "updated_at": "timestamp_ntz",
        "_loaded_at": "timestamp_ntz",
    },
    "raw_sales.raw_sales_orders": {
        "order_id": "string",
        "customer_id": "string",
        "sales_rep_id": "string",
        "order_date": "date",
        "status": "string",
        "currency_code": "string",
        "updated_at": "timestamp_ntz",
        "_loaded_at": "timestamp_ntz",
    },
    "raw_sales.raw_sales_order_lines": {
        "order_id": "string",
        "line_id": "int",
        "product_id": "string",
        "quantity": "int",
        "unit_price": "decimal(18,2)",
        "discount_amount": "decimal(18,2)",
        "updated_at": "timestamp_ntz",
        "_loaded_at": "timestamp_ntz",
    },
    "raw_hr.raw_hr_sales_reps": {
        "sales_rep_id": "string",
        "sales_rep_name": "string",
        "region": "string",
        "team_name": "string",
        "manager_name": "string",
        "updated_at": "timestamp_ntz",
        "_loaded_at": "timestamp_ntz",
    },
    "mdm.mdm_product_category_mapping": {
        "category_code": "string",
        "category_name": "string",
        "category_group": "string",
        "is_budget_relevant": "int",
        "mdm_owner": "string",
        "effective_from": "date",
        "effective_to": "date",
        "updated_at": "timestamp_ntz",
        "_loaded_at": "timestamp_ntz",
    },
}

# Days after which a source is late: (warn, error).
FRESHNESS_DAYS: dict[str, tuple[int, int]] = {
    "raw_sales.raw_sales_customers": (7, 30),
    "raw_sales.raw_sales_products": (7, 30),
    "raw_sales.raw_sales_orders": (7, 30),
    "raw_sales.raw_sales_order_lines": (7, 30),
    "raw_hr.raw_hr_sales_reps": (14, 60),
    "mdm.mdm_product_category_mapping": (30, 90),
}

# Columns that hold personal data; tagged in the schema of every layer.
PII_COLUMNS = ("full_name", "email", "sales_rep_name", "manager_name")
PII_TAG = {"contains_pii": True}

# First part of each source's surrogate keys.
KEY_TAGS: dict[str, str] = {
    "sales": "sales",
    "hr": "hr",
    "master_data": "workbook_connect",
}

# --- fixed values: gold contracts --------------------------------------------
# "*" after a type marks a required column.

GOLD_COLUMNS: dict[str, dict[str, str]] = {
    "dim_customer": {
        "customer_key": "bigint *",
        "customer_id": "varchar(50) *",
        "full_name": "varchar(200)",
        "email": "varchar(320)",
        "country_code": "varchar(2)",
        "country_name": "varchar(100)",
        "city": "varchar(100)",
        "created_at": "datetime2(6)",
        "updated_at": "datetime2(6)",
        "dbt_batch_id": "varchar(36)",
    },
    "dim_product": {
        "product_key": "bigint *",
        "product_id": "varchar(50) *",
        "product_name": "varchar(200)",
        "category_code": "varchar(50) *",
        "product_category_key": "bigint",
        "category_name": "varchar(200)",
        "category_group": "varchar(200)",
        "is_budget_relevant": "bit",
        "unit_price": "decimal(18,2)",
        "active_from": "date",
        "active_to": "date",
        "is_current": "bit",
        "updated_at": "datetime2(6)",
        "dbt_batch_id": "varchar(36)",
    },
    "dim_sales_rep": {
        "sales_rep_key": "bigint *",
        "sales_rep_id": "varchar(50) *",
        "sales_rep_name": "varchar(200)",
        "region": "varchar(100)",
        "team_name": "varchar(100)",
        "manager_name": "varchar(200)",
        "updated_at": "datetime2(6)",
        "dbt_batch_id": "varchar(36)",
    },
    "dim_date": {
        "date_key": "int *",
        "date_value": "date *",
        "calendar_year": "int",
        "calendar_quarter": "int",
        "month_number": "int",
        "month_name": "varchar(50)",
        "day_of_month": "int",
        "iso_week_number": "int",
    },
    "fact_sales": {
        "sales_fact_key": "bigint *",
        "sales_order_key": "bigint *",
        "customer_key": "bigint *",
        "product_key": "bigint *",
        "sales_rep_key": "bigint *",
        "order_date_key": "int *",
        "order_number": "varchar(50)",
        "order_line_number": "int",
        "order_status": "varchar(50)",
        "currency_code": "varchar(3)",
        "quantity": "int",
        "unit_price": "decimal(18,2)",
        "discount_amount": "decimal(18,2)",
        "net_sales_amount": "decimal(18,2) *",
        "order_updated_at": "datetime2(6)",
        "order_line_updated_at": "datetime2(6)",
        "dbt_batch_id": "varchar(36)",
    },
}

RUN_LOG_COLUMNS: dict[str, dict[str, str]] = {
    "dim_dbt_nodes": {
        "sk_dbt_node": "bigint *",
        "dk_dbt_node": "varchar(500) *",
        "node_name": "varchar(250)",
        "resource_type": "varchar(50)",
        "materialization": "varchar(50)",
        "node_package": "varchar(250)",
        "node_database": "varchar(128)",
        "node_schema": "varchar(128)",
        "node_path": "varchar(500)",
        "first_seen_at": "datetime2(6)",
        "last_seen_at": "datetime2(6)",
    },
    "fct_dbt_runs": {
        "invocation_id": "varchar(36) *",
        "sk_dbt_node": "bigint *",
        "run_started_at": "datetime2(6)",
        "target_name": "varchar(50)",
        "dbt_command": "varchar(50)",
        "execution_started_at": "datetime2(6)",
        "execution_ended_at": "datetime2(6)",
        "execution_seconds": "decimal(18,3)",
        "status": "varchar(20)",
        "is_success": "bit",
        "is_error": "bit",
        "is_skipped": "bit",
        "rows_affected": "bigint",
        "failures": "int",
        "message": "varchar(4000)",
        "logged_at": "datetime2(6)",
    },
}

# --- fixed values: which column of which table carries which test --------------

NOT_NULL: dict[str, list[str]] = {
    "raw_sales_customers": ["customer_id"],
    "raw_sales_products": ["product_id"],
    "raw_sales_orders": ["order_id"],
    "raw_sales_order_lines": ["order_id", "line_id"],
    "raw_hr_sales_reps": ["sales_rep_id"],
    "mdm_product_category_mapping": ["category_code"],
    "stg_customers": ["customer_pk", "customer_id"],
    "stg_products": ["product_pk", "product_id", "category_code"],
    "stg_orders": ["sales_order_pk", "order_id", "customer_id", "sales_rep_id"],
    "stg_order_lines": ["sales_order_line_pk", "sales_order_pk", "quantity"],
    "stg_sales_reps": ["sales_rep_pk", "sales_rep_id"],
    "stg_categories": ["product_category_pk", "category_code"],
    "int_product": ["product_pk", "product_id"],
    "ads_customer": ["customer_pk", "customer_id"],
    "ads_product": ["product_pk", "product_id", "category_code", "product_category_pk"],
    "ads_sales_rep": ["sales_rep_pk", "sales_rep_id"],
    "ads_sales_order": [
        "sales_order_line_pk",
        "sales_order_pk",
        "customer_pk",
        "product_pk",
        "sales_rep_pk",
        "net_sales_amount",
    ],
    "dim_customer": ["customer_key", "customer_id"],
    "dim_product": ["product_key", "product_id", "category_code"],
    "dim_sales_rep": ["sales_rep_key", "sales_rep_id"],
    "dim_date": ["date_key", "date_value"],
    "fact_sales": [
        "sales_fact_key",
        "sales_order_key",
        "customer_key",
        "product_key",
        "sales_rep_key",
        "order_date_key",
        "net_sales_amount",
    ],
}

UNIQUE: dict[str, list[str]] = {
    "raw_sales_customers": ["customer_id"],
    "raw_sales_products": ["product_id"],
    "raw_sales_orders": ["order_id"],
    "raw_hr_sales_reps": ["sales_rep_id"],
    "mdm_product_category_mapping": ["category_code"],
    "stg_customers": ["customer_pk", "customer_id"],
    "stg_products": ["product_pk", "product_id"],
    "stg_orders": ["sales_order_pk", "order_id"],
    "stg_order_lines": ["sales_order_line_pk"],
    "stg_sales_reps": ["sales_rep_pk", "sales_rep_id"],
    "stg_categories": ["product_category_pk", "category_code"],
    "int_product": ["product_pk"],
    "ads_customer": ["customer_pk", "customer_id"],
    "ads_product": ["product_pk", "product_id"],
    "ads_sales_rep": ["sales_rep_pk", "sales_rep_id"],
    "ads_sales_order": ["sales_order_line_pk"],
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_sales_rep": ["sales_rep_key"],
    "dim_date": ["date_key"],
    "fact_sales": ["sales_fact_key"],
}

# (child, foreign key, parent, parent key)
RELATIONSHIPS: list[tuple[str, str, str, str]] = [
    ("fact_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_sales", "product_key", "dim_product", "product_key"),
    ("fact_sales", "sales_rep_key", "dim_sales_rep", "sales_rep_key"),
    ("fact_sales", "order_date_key", "dim_date", "date_key"),
]

# --- interpretation ------------------------------------------------------------

_PLAIN_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "bit": T.BooleanType(),
    "date": T.DateType(),
}


def spark_type(declared: str) -> T.DataType:
    """Spark type of a declared column type; text lengths become metadata."""
    if declared in _PLAIN_TYPES:
        return _PLAIN_TYPES[declared]
    if declared.startswith("varchar"):
        return T.StringType()
    if declared.startswith("datetime2"):
        return T.TimestampNTZType()
    sized = re.fullmatch(r"decimal\((\d+),(\d+)\)", declared)
    if sized:
        return T.DecimalType(int(sized[1]), int(sized[2]))
    raise ValueError(f"unknown column type {declared!r}")


@dataclass(frozen=True)
class ContractColumn:
    name: str
    dtype: T.DataType
    required: bool = False
    max_chars: int | None = None
    pii: bool = False


@dataclass(frozen=True)
class Contract:
    """Names, types, required columns and text lengths a table promises."""

    table: str
    columns: tuple[ContractColumn, ...]

    @classmethod
    def of(cls, table: str, declared: dict[str, str]) -> Contract:
        out = []
        for name, text in declared.items():
            dtype, *marks = text.split()
            length = re.fullmatch(r"varchar\((\d+)\)", dtype)
            out.append(
                ContractColumn(
                    name,
                    spark_type(dtype),
                    required="*" in marks,
                    max_chars=int(length[1]) if length else None,
                    pii=name in PII_COLUMNS,
                )
            )
        return cls(table, tuple(out))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.dtype, True, PII_TAG if c.pii else {}) for c in self.columns]
        )


def raw_schema(table: str) -> T.StructType:
    declared = ", ".join(f"`{name}` {dtype}" for name, dtype in RAW_TABLES[table].items())
    fields = T.StructType.fromDDL(declared)
    for field in fields:
        field.metadata = dict(PII_TAG) if field.name in PII_COLUMNS else {}
    return fields


GOLD_CONTRACTS = {name: Contract.of(name, cols) for name, cols in GOLD_COLUMNS.items()}
RUN_LOG_CONTRACTS = {name: Contract.of(name, cols) for name, cols in RUN_LOG_COLUMNS.items()}
