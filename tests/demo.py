"""A small tea shop as raw data: nine lines of five orders, and an order without lines."""

from __future__ import annotations

import csv
import datetime as dt
import os
from decimal import Decimal

from oreline.schemas import RAW_TABLES, raw_schema

LOADED = "2026-04-02T05:30:00"

# Cases: codes in mixed case, a country without a name, an empty city, a customer
# and a product nobody orders, a product taken off sale, a year's last ISO week,
# two orders on one day, a cancelled order of two lines, a second currency.
ROWS: dict[str, list[list[str]]] = {
    "raw_sales.raw_sales_customers": [
        ["C71", "Noor Haddad", "NOOR@shop.test", "be", "Mechelen", "2023-11-02T07:45:00", "2026-03-02T07:45:00"],
        ["C72", "Ola Berg", "ola@shop.test", "LU", "Vianden", "2024-02-29T22:10:00", "2026-01-15T06:00:00"],
        ["C73", "Pim de Wit", "Pim.de.Wit@shop.test", "NL", "", "2024-06-30T00:00:00", "2026-03-05T16:25:00"],
        ["C74", "Quin Roux", "quin@shop.test", "Fr", "Arles", "2025-10-10T10:10:10", "2025-10-10T10:10:10"],
        ["C75", "Rae, the \"tea\" fan", "rae@shop.test", "BE", "Dinant", "2025-12-31T23:59:59", "2025-12-31T23:59:59"],
    ],
    "raw_sales.raw_sales_products": [
        ["P300", "Green tea", "TEA", "4.75", "2022-05-15", "", "2026-02-11T13:00:00"],
        ["P301", "Iron pot", "POT", "38.90", "2022-05-15", "", "2026-02-11T13:00:00"],
        ["P302", "Linen bag", "BAG", "9.99", "2023-09-01", "2026-03-31", "2026-03-20T08:30:00"],
        ["P303", "Smoked tea", "TEA", "6.20", "2024-01-20", "", "2026-02-11T13:00:00"],
        ["P304", "Glass pot", "POT", "21.00", "2026-03-01", "", "2026-02-27T17:45:00"],
    ],
    "raw_sales.raw_sales_orders": [
        ["S-11", "C71", "R5", "2025-12-30", "INVOICED", "EUR", "2025-12-30T15:20:00"],
        ["S-12", "C73", "R6", "2026-01-02", "invoiced", "EUR", "2026-01-02T09:05:00"],
        ["S-13", "C72", "R5", "2026-02-28", "OPEN", "USD", "2026-02-28T18:40:00"],
        ["S-14", "C74", "R6", "2026-02-28", "Cancelled", "EUR", "2026-03-01T08:00:00"],
        ["S-15", "C71", "R6", "2026-03-09", "INVOICED", "EUR", "2026-03-09T12:10:00"],
        ["S-16", "C74", "R5", "2026-03-10", "OPEN", "EUR", "2026-03-10T19:55:00"],
    ],
    "raw_sales.raw_sales_order_lines": [
        ["S-11", "1", "P300", "12", "4.75", "0.00", "2025-12-30T15:20:00"],
        ["S-11", "2", "P301", "1", "38.90", "3.90", "2025-12-30T15:21:00"],
        ["S-11", "3", "P302", "2", "9.99", "0.00", "2025-12-30T15:22:00"],
        ["S-12", "1", "P301", "3", "38.90", "11.70", "2026-01-02T09:05:00"],
        ["S-13", "1", "P303", "40", "6.20", "0.00", "2026-02-28T18:40:00"],
        ["S-14", "1", "P300", "6", "4.75", "0.00", "2026-02-28T20:00:00"],
        ["S-14", "2", "P303", "1", "6.20", "0.00", "2026-03-01T08:00:00"],
        ["S-15", "1", "P302", "5", "9.99", "4.95", "2026-03-09T12:10:00"],
        ["S-15", "2", "P300", "100", "4.75", "75.00", "2026-03-09T12:10:00"],
    ],
    "raw_hr.raw_hr_sales_reps": [
        ["R5", "Sol Vega", "Coast", "Counter", "Tess Umber", "2026-02-01T00:30:00"],
        ["R6", "Uma Lind", "Hills", "Market", "Tess Umber", "2026-03-01T00:30:00"],
    ],
    "mdm.mdm_product_category_mapping": [
        ["TEA", "Leaves", "Drinks", "1", "buyer@shop.test", "2022-01-01", "", "2026-01-31T12:00:00"],
        ["POT", "Pots", "Goods", "1", "buyer@shop.test", "2022-01-01", "", "2026-01-31T12:00:00"],
        ["BAG", "Bags", "Goods", "0", "maker@shop.test", "2023-08-01", "", "2026-01-31T12:00:00"],
    ],
}


def write_csvs(folder: str, rows: dict[str, list[list[str]]] | None = None) -> str:
    """Write the demo files with their header; every row gets the load time."""
    os.makedirs(folder, exist_ok=True)
    for name, data in (rows or ROWS).items():
        with open(f"{folder}/{name.split('.')[-1]}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(RAW_TABLES[name])
            out.writerows([*row, LOADED] for row in data)
    return folder


def _value(text: str | None, dtype: str):
    if text in ("", None):
        return None
    if dtype == "int":
        return int(text)
    if dtype.startswith("decimal"):
        return Decimal(text)
    if dtype == "date":
        return dt.date.fromisoformat(text)
    if dtype.startswith("timestamp"):
        return dt.datetime.fromisoformat(text)
    return text


class Raw:
    """Editable copy of the demo rows, readable as source frames."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {n: [[*r, LOADED] for r in data] for n, data in ROWS.items()}

    def __call__(self, name: str):
        types = list(RAW_TABLES[name].values())
        rows = [tuple(_value(v, t) for v, t in zip(r, types)) for r in self.rows[name]]
        return self.spark.createDataFrame(rows, raw_schema(name))

    def line(self, order: str, line: str) -> list[str]:
        lines = self.rows["raw_sales.raw_sales_order_lines"]
        return next(r for r in lines if r[0] == order and r[1] == line)

    def row(self, table: str, key: str) -> list[str]:
        return next(r for r in self.rows[table] if r[0] == key)
