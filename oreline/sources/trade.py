"""The raw tables as views over an order-entry schema (orders, lineitem, ...).

Lets the whole warehouse run over ``<dir>/<table>.parquet`` files of that
well-known layout. Derived columns are picked so that they exercise the models:
mixed case, over-long codes, blank dates, unmapped categories, unmatched reps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of the files, so that opening one reads no footer first.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}

# How the views fill columns the files do not have.
STAMP_START = "2001-10-01 00:00:00"
CREATED_START = "1995-01-01 00:00:00"
STAMP_SPREAD_MINUTES = 525600
CURRENCY = "euros"
REP_NUMBERS = 110
UNMAPPED_TYPE = "PROMO"
CORE_TYPES = "'ECONOMY', 'STANDARD'"
MAPPING_STAMP = "2001-11-01 00:00:00"
LINE_DAY_START = "1990-01-01"
LINE_DAYS = 16384
LINE_REPEATS = 131072


def _minutes_after(start: str, key: str) -> str:
    minutes = f"cast(pmod({key}, {STAMP_SPREAD_MINUTES}) as int)"
    return f"timestamp_ntz'{start}' + make_dt_interval(0, 0, {minutes})"


def _stamps(key: str) -> list[str]:
    changed = _minutes_after(STAMP_START, key)
    return [f"{changed} as updated_at", f"{changed} + interval 1 hour as _loaded_at"]


class TradeFiles:
    """Raw-table frames over one directory of Parquet files.

    The columns are SQL text: these are views over files, not operators.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.makers: dict[str, Callable[[], DataFrame]] = {
            "raw_sales.raw_sales_customers": self.customers,
            "raw_sales.raw_sales_products": self.products,
            "raw_sales.raw_sales_orders": self.orders,
            "raw_sales.raw_sales_order_lines": self.order_lines,
            "raw_hr.raw_hr_sales_reps": self.sales_reps,
            "mdm.mdm_product_category_mapping": self.categories,
        }

    def __call__(self, name: str) -> DataFrame:
        """Raw table by the name it is declared under."""
        return self.makers[name]()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(LAYOUT[name]).parquet(f"{self.root}/{name}.parquet")

    def _one_per(self, table: str, key: str) -> DataFrame:
        """One row per key, visibly so: a reader of other columns then skips the join."""
        others = [c for c in self.table(table).columns if c != key]
        return self.table(table).groupBy(key).agg(*[F.max(c).alias(c) for c in others])

    def customers(self) -> DataFrame:
        placed = self.table("customer").withColumnRenamed("c_nationkey", "n_nationkey")
        nation = self._one_per("nation", "n_nationkey")
        return placed.join(nation, "n_nationkey", "left").selectExpr(
            "cast(c_custkey as string) as customer_id",
            "c_name as full_name",
            "replace(c_name, '#', '.') || '@Example.COM' as email",
            """case pmod(n_nationkey, 4) when 0 then 'be' when 1 then 'nl' when 2 then 'fr'
               else 'de' end as country_code""",
            "n_name as city",
            f"{_minutes_after(CREATED_START, 'c_custkey')} as created_at",
            *_stamps("c_custkey"),
        )

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "p_name as product_name",
            "lower(p_type) as category_code",
            "cast(p_retailprice as decimal(18,2)) as unit_price",
            "cast(date_add(date'1995-01-01', p_size) as string) as active_from",
            "case when pmod(p_size, 10) = 0 then '2001-12-31' else '' end as active_to",
            *_stamps("p_partkey"),
        )

    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as order_id",
            "cast(o_custkey as string) as customer_id",
            f"cast(pmod(o_orderkey, {REP_NUMBERS}) as string) as sales_rep_id",
            "cast(o_orderdate as date) as order_date",
            """case o_orderstatus when 'F' then 'invoiced' when 'O' then 'open'
               when 'P' then 'cancelled' else 'other' end as status""",
            f"'{CURRENCY}' as currency_code",
            "o_orderdate + interval 8 hours as updated_at",
            "o_orderdate + interval 1 day as _loaded_at",
        )

    def order_lines(self) -> DataFrame:
        """Order lines with a line number that is unique within the order.

        The files repeat line numbers within an order. Numbering each order from
        one would gather a whole order in one task, however large; numbering it
        per ship day gives a unique number without that, and lets a filter on the
        ship date reach the scan. There is room for 131,072 lines of an order and
        day, and for whole ship days from 1990 to 2034; others raise an error.
        """
        # Numbered before anything is derived, so the shuffle carries plain columns.
        numbered = self.table("lineitem").selectExpr(
            "*",
            """row_number() over (partition by l_orderkey, l_shipdate
                 order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                          l_discount, l_tax, l_returnflag, l_linestatus) - 1 as repeat""",
        )
        day = f"datediff(l_shipdate, date'{LINE_DAY_START}')"
        fits = f"""{day} between 0 and {LINE_DAYS - 1} and repeat < {LINE_REPEATS}
            and l_shipdate = cast(cast(l_shipdate as date) as timestamp_ntz)"""
        refused = f"""raise_error('order ' || l_orderkey || ': no line number for ship date '
            || l_shipdate || ' and line ' || repeat || ' of it')"""
        line_id = f"""case when l_shipdate is null or {fits}
            then cast(repeat * {LINE_DAYS}L + coalesce({day}, 0) as int)
            else cast({refused} as int) end as line_id"""
        price = "cast(l_extendedprice as decimal(18,2))"
        return numbered.selectExpr(
            "cast(l_orderkey as string) as order_id",
            line_id,
            "cast(l_partkey as string) as product_id",
            "cast(l_quantity as int) as quantity",
            f"{price} as unit_price",
            f"cast({price} * cast(l_discount as decimal(4,2)) as decimal(18,2)) as discount_amount",
            "l_shipdate as updated_at",
            "l_shipdate + interval 1 day as _loaded_at",
        )

    def sales_reps(self) -> DataFrame:
        placed = self.table("supplier").withColumnRenamed("s_nationkey", "n_nationkey")
        nation = self._one_per("nation", "n_nationkey")
        nation = nation.withColumnRenamed("n_regionkey", "r_regionkey")
        located = placed.join(nation, "n_nationkey", "left")
        region = self._one_per("region", "r_regionkey")
        return located.join(region, "r_regionkey", "left").selectExpr(
            "cast(s_suppkey as string) as sales_rep_id",
            "s_name as sales_rep_name",
            "r_name as region",
            "n_name as team_name",
            "'Manager of ' || n_name as manager_name",
            *_stamps("s_suppkey"),
        )

    def categories(self) -> DataFrame:
        """Mapping of every part type but one, which stays unmapped."""
        types = self.table("part").where(f"p_type <> '{UNMAPPED_TYPE}'").select("p_type")
        return types.distinct().selectExpr(
            "initcap(p_type) as category_code",
            "initcap(p_type) || ' parts' as category_name",
            f"case when p_type in ({CORE_TYPES}) then 'Core' else 'Sized' end as category_group",
            f"case when p_type in ({CORE_TYPES}) then 1 else 0 end as is_budget_relevant",
            "'owner@example.com' as mdm_owner",
            "'1995-01-01' as effective_from",
            "'' as effective_to",
            f"timestamp_ntz'{MAPPING_STAMP}' as updated_at",
            f"timestamp_ntz'{MAPPING_STAMP}' as _loaded_at",
        )

    def run_results(self) -> DataFrame:
        """Events read as step results: a node per type and user, a run per day."""
        named = self.table("events").selectExpr(
            "*",
            "event_type || '_' || user_id as node",
            "cast(cast(ts as date) as timestamp_ntz) as day",
            "pmod(dayofmonth(ts), 2) = 1 as odd_day",
            "event_type not in ('error', 'purchase') as ran",
            "event_type <> 'purchase' as compiled",
        )
        return named.selectExpr(
            "'run-' || cast(ts as date) as invocation_id",
            "'model.shop.' || node as unique_id",
            "node as name",
            "case when event_type = 'signup' then 'test' else 'model' end as resource_type",
            "case when odd_day then 'table' else 'view' end as materialized",
            "'shop' as package_name",
            "'warehouse' as database",
            "case when odd_day then 'gold' else 'silver' end as schema",
            "'models/' || node || '.sql' as original_file_path",
            "day as run_started_at",
            "'prod' as target_name",
            "'build' as command",
            "case when ran then ts end as execute_started_at",
            "case when ran then ts + interval 1 second end as execute_completed_at",
            "case when compiled then ts - interval 1 second end as compile_started_at",
            "case when compiled then ts end as compile_completed_at",
            "value as execution_time",
            """case event_type when 'view' then 'Success' when 'signup' then 'pass'
               when 'error' then 'error' when 'purchase' then 'skipped' when 'click' then 'warn'
               else 'unknown' end as status""",
            "case when event_type = 'view' then event_id end as rows_affected",
            "case when event_type = 'error' then 1 end as failures",
            "case when event_type = 'error' then repeat(props, 600) end as message",
            "day + interval 1 day as logged_at",
        )
