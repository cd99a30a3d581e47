"""The whole warehouse: lazily as frames, or as tables that runs keep current."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators import quality
from oreline.operators.changes import incremental, materialize, together
from oreline.operators.colocated import store_colocated
from oreline.operators.filters import recent_slice
from oreline.operators.lookups import UNKNOWN_KEY
from oreline.operators.tables import VersionedTable, work_dir, written
from oreline.plans import bronze, gold, silver
from oreline.plans.runlog import LOGGED_TARGETS, RunRecorder, log_results
from oreline.schemas import (
    FRESHNESS_DAYS,
    GOLD_CONTRACTS,
    NOT_NULL,
    RAW_TABLES,
    RELATIONSHIPS,
    UNIQUE,
)

Source = Callable[[str], DataFrame]

# Raw table and builder of each bronze model.
BRONZE_MODELS = {
    "stg_customers": ("raw_sales.raw_sales_customers", bronze.customers),
    "stg_products": ("raw_sales.raw_sales_products", bronze.products),
    "stg_orders": ("raw_sales.raw_sales_orders", bronze.orders),
    "stg_order_lines": ("raw_sales.raw_sales_order_lines", bronze.order_lines),
    "stg_sales_reps": ("raw_hr.raw_hr_sales_reps", bronze.sales_reps),
    "stg_categories": ("mdm.mdm_product_category_mapping", bronze.categories),
}

# Merge key of each silver table.
SILVER_KEYS = {
    "ads_customer": "customer_pk",
    "ads_product": "product_pk",
    "ads_sales_rep": "sales_rep_pk",
    "ads_sales_order": "sales_order_line_pk",
}


# The date that lays out a silver table, and what its directories note.
SILVER_PERIODS = {"ads_sales_order": "order_date"}
SILVER_WATCHED = {"ads_sales_order": dict.fromkeys(silver.LATE_KEYS, UNKNOWN_KEY)}
# Bronze tables that are joined whole, and the key of that join.
COLOCATED = {"stg_orders": "sales_order_pk", "stg_order_lines": "sales_order_pk"}


class Layers(Mapping):
    """The whole warehouse as lazy relations, each built when it is asked for.

    ``recent_days`` limits the order lines, and nothing else, to the days before
    ``as_of``.
    """

    def __init__(
        self,
        source: Source,
        batch_id: str,
        recent_days: int | None = None,
        as_of: str | Column | None = None,
    ):
        self.source = source
        self.batch_id = batch_id
        self.recent = (recent_days, as_of)
        self.built: dict[str, DataFrame] = {}
        self.makers: dict[str, Callable[[], DataFrame]] = {
            **{name: partial(self._bronze, name) for name in BRONZE_MODELS},
            "int_product": lambda: silver.products_with_categories(
                self["stg_products"], self["stg_categories"]
            ),
            "ads_customer": lambda: silver.customers(self["stg_customers"]),
            "ads_product": lambda: silver.products(self["int_product"]),
            "ads_sales_rep": lambda: silver.sales_reps(self["stg_sales_reps"]),
            "ads_sales_order": lambda: silver.sales_orders(
                self["stg_orders"],
                self["stg_order_lines"],
                self["ads_customer"],
                self["ads_product"],
                self["ads_sales_rep"],
            ),
            **{name: partial(self._gold, name) for name in gold.STAR},
        }

    def _bronze(self, name: str) -> DataFrame:
        raw_name, build = BRONZE_MODELS[name]
        raw = self.source(raw_name)
        days, as_of = self.recent
        if name == "stg_order_lines" and days is not None:
            raw = recent_slice(raw, "updated_at", as_of, days)
        return build(raw, self.batch_id)

    def _gold(self, name: str) -> DataFrame:
        build, silver_name = gold.STAR[name]
        if name == "dim_date":
            # The dates of the order lines need nothing but the headers that have lines.
            lines = self["stg_order_lines"].select("order_id")
            return build(self["stg_orders"].join(lines, "order_id", "left_semi"))
        return build(self[silver_name])

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = self.makers[name]()
        return self.built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


class Warehouse:
    """Bronze, silver and gold tables below ``root``.

    ``buckets`` sets how finely silver tables are split for merging; size it so
    that a bucket of the order lines holds a few gigabytes. ``grain`` (day, month or
    year) lays the order lines out by order date as well, so that a change of recent
    lines rewrites recent directories only; a bucket is then one of a period. Both take
    effect when a table is first built or fully refreshed.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8, grain: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.grain = grain

    def table(self, name: str) -> VersionedTable:
        period = SILVER_PERIODS.get(name) if self.grain else None
        return VersionedTable(
            self.spark,
            f"{self.root}/{name}",
            SILVER_KEYS.get(name),
            self.buckets,
            period=period,
            grain=self.grain or "month",
            watched=SILVER_WATCHED.get(name),
        )

    def run(
        self,
        source: Source,
        batch_id: str,
        full_refresh: bool = False,
        recent_days: int | None = None,
        as_of: str | None = None,
        keep_bronze: bool = False,
        recorder: RunRecorder | None = None,
        lookback_days: int = 0,
        relink: bool = False,
        colocated_buckets: int = 0,
    ) -> dict[str, DataFrame]:
        """One load: refresh silver by what changed, rebuild gold, return all tables.

        Bronze relations stay views, except order headers; ``keep_bronze`` writes
        them all, which pays when they are read again (by the data tests, say).
        ``lookback_days`` re-reads that many days before each watermark for late rows.
        ``relink`` gives stored order lines the keys of members that arrived after them,
        looking only into directories that hold an unknown key. ``colocated_buckets``
        stores order headers and lines by order key in that many buckets, so that their
        join moves neither; that pays for full refreshes.
        A failed step stops the load; a ``recorder`` notes how every step went.
        """
        lazy = Layers(source, batch_id, recent_days, as_of)
        recorder = recorder or RunRecorder(batch_id, "")

        def bronze_table(name: str) -> DataFrame:
            if colocated_buckets and name in COLOCATED:
                path = f"{work_dir(self.spark)}/{name}"
                with recorder.step(name, "bronze", "table"):
                    return store_colocated(lazy[name], path, COLOCATED[name], colocated_buckets)
            stored = keep_bronze or name == "stg_orders"
            kind, target = ("table", self.table(name)) if stored else ("view", None)
            with recorder.step(name, "bronze", kind) as note:
                note["rows_affected"] = materialize(lazy[name], kind, target)
            return target.read() if stored else lazy[name]

        def silver_table(name: str, changes: DataFrame, build, stamp="updated_at", **how) -> DataFrame:
            target = self.table(name)
            with recorder.step(name, "silver", "incremental") as note:
                note["rows_affected"] = incremental(
                    target,
                    changes,
                    build,
                    "updated_at",
                    stamp,
                    full_refresh=full_refresh,
                    lookback_days=lookback_days,
                    **how,
                )
            return target.read()

        def gold_table(name: str, df: DataFrame) -> DataFrame:
            target = self.table(name)
            with recorder.step(name, "gold", "table") as note:
                contract = GOLD_CONTRACTS[name]
                note["rows_affected"] = materialize(df, "table", target, contract=contract)
            return target.read()

        try:
            tables = together({name: partial(bronze_table, name) for name in BRONZE_MODELS})
            with recorder.step("int_product", "silver", "view"):
                tables["int_product"] = silver.products_with_categories(
                    tables["stg_products"], tables["stg_categories"]
                )
            entities = {
                "ads_customer": (tables["stg_customers"], silver.customers),
                "ads_product": (tables["int_product"], silver.products),
                "ads_sales_rep": (tables["stg_sales_reps"], silver.sales_reps),
            }
            tables |= together({n: partial(silver_table, n, *how) for n, how in entities.items()})

            orders, others = tables["stg_orders"], [tables[name] for name in entities]
            tables["ads_sales_order"] = silver_table(
                "ads_sales_order",
                tables["stg_order_lines"],
                lambda lines: silver.sales_orders(
                    orders, lines, *others, colocated=colocated_buckets > 0
                ),
                "order_line_updated_at",
                build_changes=lambda lines, folder: silver.changed_sales_orders(
                    lines, orders, *others, folder
                ),
                parts_by="sales_order_pk",
            )
            if relink:
                with recorder.step("ads_sales_order_relinked", "silver", "incremental") as note:
                    lines = tables["stg_order_lines"]
                    note["rows_affected"] = self.relink(orders, lines, *others)
                tables["ads_sales_order"] = self.table("ads_sales_order").read()
            star = gold.build_star(tables)
            tables |= together({name: partial(gold_table, name, df) for name, df in star.items()})
        finally:
            for name in SILVER_KEYS:
                recorder.skip(name, "silver", "incremental")
            for name in gold.STAR:
                recorder.skip(name, "gold", "table")
        return tables

    def relink(self, orders: DataFrame, lines: DataFrame, *members: DataFrame) -> int:
        """Point stored order lines to customers, products and reps that arrived late.

        ``members`` are the silver tables of these three. Returns the lines relinked.
        """
        return relink_orders(self.table("ads_sales_order"), orders, lines, *members)

    def build(
        self,
        source: Source,
        batch_id: str,
        target_name: str,
        log_root: str | None = None,
        log_targets: Collection[str] = LOGGED_TARGETS,
        **options,
    ) -> tuple[dict[str, DataFrame], DataFrame]:
        """Load, test and log: (tables, data-test results).

        The log gets one row per table and per test, for a failed load too.
        """
        recorder = RunRecorder(batch_id, target_name, database=self.root)

        def log(results: DataFrame) -> None:
            if log_root:
                log_results(self.spark, results, log_root, target_name, log_targets)

        try:
            tables = self.run(source, batch_id, recorder=recorder, **options)
        except Exception:
            log(recorder.results(self.spark))
            raise
        raw = {name.split(".")[-1]: source(name) for name in RAW_TABLES}
        # Tested once: what is logged is what is returned.
        tests = written(data_tests({**raw, **tables}), f"{work_dir(self.spark)}/tests")
        log(recorder.results(self.spark).unionByName(recorder.test_results(tests)))
        return tables, tests


def relink_orders(
    table: VersionedTable, orders: DataFrame, lines: DataFrame, *members: DataFrame
) -> int:
    """Give order lines of ``table`` the keys of members that arrived after them."""
    if not any(table.live().marked.get(c) for c in silver.LATE_KEYS):
        return 0
    unknown = table.read_marked(*silver.LATE_KEYS)
    with table.work() as folder:
        found = silver.late_members(unknown, orders, lines, *members, folder)
        return table.upsert(found, keeps_times=True, parts_by="sales_order_pk")


def data_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared data test over the given tables, one result row each."""
    rules = {
        ("mapped_to_master_data", "ads_product", "product_category_pk"): (
            F.col("product_category_pk") == 0
        ),
        ("non_negative", "fact_sales", "net_sales_amount"): F.col("net_sales_amount") < 0,
    }
    return quality.summarize(tables, NOT_NULL, UNIQUE, RELATIONSHIPS, rules)


def source_freshness(source: Source, as_of: str) -> DataFrame:
    """Age and status of every raw table at ``as_of``."""
    now = F.lit(as_of).cast("timestamp_ntz")
    out = None
    for name, (warn, error) in FRESHNESS_DAYS.items():
        one = quality.freshness(source(name), "_loaded_at", warn, error, now)
        one = one.select(F.lit(name.split(".")[-1]).alias("source"), "*")
        out = one if out is None else out.unionByName(one)
    return out
