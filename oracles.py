"""DuckDB twins of the registered queries, over the same Parquet tables.

Written independently of the Spark code from the rules of each operator: plain
SQL put together from named common table expressions.
"""

from __future__ import annotations

from oreline.schemas import FRESHNESS_DAYS, NOT_NULL, RELATIONSHIPS, UNIQUE

BATCH = "batch-0001"
SPLIT = "2000-01-01 00:00:00"
AS_OF = "2001-11-20 00:00:00"
RECENT = "2001-11-01 00:00:00"


def key(*parts: str) -> str:
    texts = [f"coalesce(upper(cast({p} as varchar)), '_surrogate_key_null_')" for p in parts]
    return f"cast('0x' || substr(sha256({" || '-' || ".join(texts)}), 1, 14) as bigint)"


def day_key(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as integer)"


def minutes(start: str, k: str) -> str:
    return f"(timestamp '{start}' + to_minutes(cast({k} % 525600 as bigint)))"


AUDIT = f"updated_at, _loaded_at as source_loaded_at, '{BATCH}' as dbt_batch_id"

CTES: dict[str, str] = {
    "raw_customers": f"""
        select cast(c_custkey as varchar) as customer_id, c_name as full_name,
               replace(c_name, '#', '.') || '@Example.COM' as email,
               case c_nationkey % 4 when 0 then 'be' when 1 then 'nl' when 2 then 'fr' else 'de' end
                 as country_code,
               n_name as city,
               {minutes("1995-01-01 00:00:00", "c_custkey")} as created_at,
               {minutes("2001-10-01 00:00:00", "c_custkey")} as updated_at,
               {minutes("2001-10-01 01:00:00", "c_custkey")} as _loaded_at
        from customer left join nation on c_nationkey = n_nationkey""",
    "raw_products": f"""
        select cast(p_partkey as varchar) as product_id, p_name as product_name,
               lower(p_type) as category_code, cast(p_retailprice as decimal(18,2)) as unit_price,
               cast(date '1995-01-01' + p_size as varchar) as active_from,
               case when p_size % 10 = 0 then '2001-12-31' else '' end as active_to,
               {minutes("2001-10-01 00:00:00", "p_partkey")} as updated_at,
               {minutes("2001-10-01 01:00:00", "p_partkey")} as _loaded_at
        from part""",
    "raw_orders": """
        select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
               cast(o_orderkey % 110 as varchar) as sales_rep_id,
               cast(o_orderdate as date) as order_date,
               case o_orderstatus when 'F' then 'invoiced' when 'O' then 'open'
                    when 'P' then 'cancelled' else 'other' end as status,
               'euros' as currency_code,
               o_orderdate + interval 8 hour as updated_at,
               o_orderdate + interval 1 day as _loaded_at
        from orders""",
    "raw_lines": """
        select cast(l_orderkey as varchar) as order_id,
               cast((row_number() over (partition by l_orderkey, l_shipdate
                       order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                l_discount, l_tax, l_returnflag, l_linestatus) - 1) * 16384
                    + date_diff('day', date '1990-01-01', cast(l_shipdate as date)) as integer)
                 as line_id,
               cast(l_partkey as varchar) as product_id, cast(l_quantity as integer) as quantity,
               cast(l_extendedprice as decimal(18,2)) as unit_price,
               cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2))
                    as decimal(18,2)) as discount_amount,
               l_shipdate as updated_at, l_shipdate + interval 1 day as _loaded_at
        from lineitem""",
    "raw_reps": f"""
        select cast(s_suppkey as varchar) as sales_rep_id, s_name as sales_rep_name,
               r_name as region, n_name as team_name, 'Manager of ' || n_name as manager_name,
               {minutes("2001-10-01 00:00:00", "s_suppkey")} as updated_at,
               {minutes("2001-10-01 01:00:00", "s_suppkey")} as _loaded_at
        from supplier left join nation on s_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""",
    "raw_categories": """
        select upper(p_type[1]) || lower(p_type[2:]) as category_code,
               upper(p_type[1]) || lower(p_type[2:]) || ' parts' as category_name,
               case when p_type in ('ECONOMY', 'STANDARD') then 'Core' else 'Sized' end
                 as category_group,
               case when p_type in ('ECONOMY', 'STANDARD') then 1 else 0 end as is_budget_relevant,
               'owner@example.com' as mdm_owner, '1995-01-01' as effective_from,
               '' as effective_to, timestamp '2001-11-01' as updated_at,
               timestamp '2001-11-01' as _loaded_at
        from (select distinct p_type from part where p_type <> 'PROMO')""",
    "stg_customers": f"""
        select {key("'sales'", "customer_id")} as customer_pk, customer_id, full_name,
               lower(email) as email, upper(country_code) as country_code, city, created_at, {AUDIT}
        from raw_customers""",
    "stg_products": f"""
        select {key("'sales'", "product_id")} as product_pk, product_id, product_name,
               upper(category_code) as category_code, unit_price,
               cast(active_from as date) as active_from,
               cast(nullif(active_to, '') as date) as active_to, {AUDIT}
        from raw_products""",
    "stg_orders": f"""
        select {key("'sales'", "order_id")} as sales_order_pk, order_id, customer_id, sales_rep_id,
               order_date, upper(status) as status,
               upper(substr(currency_code, 1, 3)) as currency_code, {AUDIT}
        from raw_orders""",
    "stg_order_lines": f"""
        select {key("'sales'", "order_id", "line_id")} as sales_order_line_pk,
               {key("'sales'", "order_id")} as sales_order_pk, order_id, line_id, product_id,
               quantity, unit_price, discount_amount, {AUDIT}
        from raw_lines""",
    "stg_sales_reps": f"""
        select {key("'hr'", "sales_rep_id")} as sales_rep_pk, sales_rep_id, sales_rep_name, region,
               team_name, manager_name, {AUDIT}
        from raw_reps""",
    "stg_categories": f"""
        select {key("'workbook_connect'", "category_code")} as product_category_pk,
               upper(category_code) as category_code, category_name, category_group,
               is_budget_relevant <> 0 as is_budget_relevant, mdm_owner,
               cast(effective_from as date) as effective_from,
               cast(nullif(effective_to, '') as date) as effective_to, {AUDIT}
        from raw_categories""",
    "int_product": """
        select p.product_pk, p.product_id, p.product_name, p.category_code, c.mdm_owner,
               p.unit_price, p.active_from, p.active_to, p.updated_at, p.source_loaded_at,
               p.dbt_batch_id, coalesce(c.product_category_pk, 0) as product_category_pk,
               coalesce(c.category_name, 'Unmapped') as category_name,
               coalesce(c.category_group, 'Unmapped') as category_group,
               coalesce(c.is_budget_relevant, false) as is_budget_relevant
        from stg_products p left join stg_categories c using (category_code)""",
    "ads_customer": """
        select *, case country_code when 'BE' then 'Belgium' when 'NL' then 'Netherlands'
                  when 'FR' then 'France' else 'Other' end as country_name
        from stg_customers""",
    "ads_product": "select *, active_to is null as is_current from int_product",
    "ads_sales_rep": "select * from stg_sales_reps",
    "ads_sales_order": f"""
        select l.sales_order_line_pk, o.sales_order_pk, o.order_id, l.line_id, o.order_date,
               o.status, o.currency_code, l.quantity, l.unit_price, l.discount_amount,
               o.source_loaded_at, l.dbt_batch_id, o.updated_at as order_updated_at,
               l.updated_at as order_line_updated_at,
               coalesce(c.customer_pk, 0) as customer_pk,
               coalesce(p.product_pk, 0) as product_pk,
               coalesce(p.product_category_pk, 0) as product_category_pk,
               coalesce(r.sales_rep_pk, 0) as sales_rep_pk,
               {day_key("o.order_date")} as order_date_key,
               cast(l.quantity * l.unit_price - l.discount_amount as decimal(18,2))
                 as net_sales_amount
        from stg_order_lines l
        join stg_orders o on l.sales_order_pk = o.sales_order_pk
        left join ads_customer c on o.customer_id = c.customer_id
        left join ads_product p on l.product_id = p.product_id
        left join ads_sales_rep r on o.sales_rep_id = r.sales_rep_id""",
    "dim_customer": """
        select customer_pk as customer_key, customer_id, full_name, email, country_code,
               country_name, city, created_at, updated_at, dbt_batch_id
        from ads_customer
        union all
        select 0, 'UNKNOWN', 'Unknown customer', null, null, 'Unknown', 'Unknown', null, null,
               null""",
    "dim_product": """
        select product_pk as product_key, product_id, product_name, category_code,
               product_category_pk as product_category_key, category_name, category_group,
               is_budget_relevant, unit_price, active_from, active_to, is_current, updated_at,
               dbt_batch_id
        from ads_product
        union all
        select 0, 'UNKNOWN', 'Unknown product', 'UNKNOWN', 0, 'Unknown', 'Unknown', false, null,
               null, null, false, null, null""",
    "dim_sales_rep": """
        select sales_rep_pk as sales_rep_key, sales_rep_id, sales_rep_name, region, team_name,
               manager_name, updated_at, dbt_batch_id
        from ads_sales_rep
        union all
        select 0, 'UNKNOWN', 'Unknown sales rep', 'Unknown', 'Unknown', 'Unknown', null, null""",
    "dim_date": f"""
        select {day_key("order_date")} as date_key, order_date as date_value,
               cast(year(order_date) as integer) as calendar_year,
               cast(quarter(order_date) as integer) as calendar_quarter,
               cast(month(order_date) as integer) as month_number,
               strftime(order_date, '%B') as month_name,
               cast(day(order_date) as integer) as day_of_month,
               cast(weekofyear(order_date) as integer) as iso_week_number
        from (select distinct order_date from ads_sales_order)""",
    "fact_sales": """
        select sales_order_line_pk as sales_fact_key, sales_order_pk as sales_order_key,
               customer_pk as customer_key, product_pk as product_key,
               sales_rep_pk as sales_rep_key, order_date_key, order_id as order_number,
               line_id as order_line_number, status as order_status, currency_code, quantity,
               unit_price, discount_amount, net_sales_amount, order_updated_at,
               order_line_updated_at, dbt_batch_id
        from ads_sales_order where status <> 'CANCELLED'""",
    "results": """
        select 'run-' || strftime(ts, '%Y-%m-%d') as invocation_id,
               event_type || '_' || user_id as node, event_type, event_id, value, props, ts,
               date_trunc('day', ts) as day, extract(day from ts) % 2 = 1 as odd_day
        from events""",
}

# Which expressions each one reads, in an order that defines them before use.
_ORDER = list(CTES)


def with_ctes(body: str, *extra: tuple[str, str]) -> str:
    """``body`` with exactly the common table expressions it needs, transitively."""
    named = {**CTES, **dict(extra)}
    order = _ORDER + [name for name, _ in extra]
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(_words(todo.pop()))
        for name in order:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(named[name])
    parts = [f"{name} as ({named[name]})" for name in order if name in needed]
    return f"with {', '.join(parts)} {body}" if parts else body


def _words(sql: str) -> list[str]:
    return "".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split()


# --- single queries -----------------------------------------------------------------


def _surrogate_key() -> str:
    return f"""
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               cast(l_extendedprice as decimal(18,2)) as l_extendedprice,
               {key("l_returnflag")} as one_part,
               {key("'sales'", "l_orderkey")} as two_parts,
               {key("'sales'", "l_orderkey", "l_linenumber")} as three_parts,
               {key("'Sales'", "nullif(lower(l_linestatus), 'o')", "l_partkey")} as null_part
        from lineitem"""


def _key_lookup() -> str:
    return with_ctes("""
        select l.sales_order_line_pk, l.product_id, coalesce(p.product_pk, 0) as product_key
        from stg_order_lines l
        left join (select product_id, product_pk from ads_product where product_category_pk <> 0) p
          on l.product_id = p.product_id""")


def _upsert_merge() -> str:
    cols = (
        "sales_order_line_pk, sales_order_pk, order_id, line_id, product_id, unit_price, "
        "discount_amount, updated_at, source_loaded_at"
    )
    return with_ctes(f"""
        select {cols}, quantity, dbt_batch_id from stg_order_lines
        where updated_at <= timestamp '{SPLIT}' and quantity < 45
        union all
        select {cols}, quantity + 1 as quantity, 'batch-0002' as dbt_batch_id from stg_order_lines
        where updated_at <= timestamp '{SPLIT}' and quantity >= 45
        union all
        select {cols}, quantity, 'batch-0002' as dbt_batch_id from stg_order_lines
        where updated_at > timestamp '{SPLIT}'""")


def _upsert_by_period() -> str:
    cols = (
        "sales_order_line_pk, sales_order_pk, order_id, line_id, product_id, unit_price, "
        "discount_amount, updated_at, source_loaded_at"
    )
    edited = f"updated_at >= timestamp '{RECENT}' or quantity = 50"
    return with_ctes(f"""
        select {cols}, cast(quantity + case when {edited} then 1 else 0 end as integer) as quantity,
               case when {edited} then 'batch-0002' else '{BATCH}' end as dbt_batch_id
        from stg_order_lines""")


def _ingest_products() -> str:
    return with_ctes("""
        select product_id, product_name, category_code, unit_price,
               cast(active_from as date) as active_from,
               cast(nullif(active_to, '') as date) as active_to, updated_at, _loaded_at
        from raw_products""")


def _stream_upsert() -> str:
    return """
        select user_id, ts, event_id, event_type, value
        from (select *, row_number() over (partition by user_id order by ts desc, event_id desc)
                as place from events)
        where place = 1"""


def _incremental_orders() -> str:
    return with_ctes(f"""
        select * from ads_sales_order
        where order_line_updated_at > (
                select max(order_line_updated_at) from ads_sales_order
                where order_line_updated_at <= timestamp '{SPLIT}' and quantity <> 50)
           or (order_line_updated_at <= timestamp '{SPLIT}' and quantity <> 50)""")


def _latest_per_key() -> str:
    order = (
        "l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, "
        "l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc"
    )
    return f"""
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               cast(l_quantity as decimal(18,2)) as l_quantity,
               cast(l_extendedprice as decimal(18,2)) as l_extendedprice, l_shipdate
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                                           order by {order}) as rn from lineitem)
        where rn = 1"""


def _runlog_dim() -> str:
    path = "arg_max({}, day)"
    return with_ctes(f"""
        select {key("'model.shop.' || node")} as sk_dbt_node, 'model.shop.' || node as dk_dbt_node,
               node as node_name,
               {path.format("case when event_type = 'signup' then 'test' else 'model' end")}
                 as resource_type,
               {path.format("case when odd_day then 'table' else 'view' end")} as materialization,
               'shop' as node_package, 'warehouse' as node_database,
               {path.format("case when odd_day then 'gold' else 'silver' end")} as node_schema,
               'models/' || node || '.sql' as node_path,
               min(day) + interval 1 day as first_seen_at, max(day) + interval 1 day as last_seen_at
        from results group by node""")


def _runlog_fact() -> str:
    started = """case when event_type in ('view', 'signup', 'click') then ts
                      when event_type = 'error' then ts - interval 1 second end"""
    ended = """case when event_type in ('view', 'signup', 'click') then ts + interval 1 second
                    when event_type = 'error' then ts end"""
    return with_ctes(f"""
        select invocation_id, {key("'model.shop.' || node")} as sk_dbt_node,
               day as run_started_at, 'prod' as target_name, 'build' as dbt_command,
               {started} as execution_started_at, {ended} as execution_ended_at,
               cast(value as decimal(18,3)) as execution_seconds,
               case event_type when 'view' then 'success' when 'signup' then 'pass'
                    when 'error' then 'error' when 'purchase' then 'skipped'
                    when 'click' then 'warn' else 'unknown' end as status,
               event_type in ('view', 'signup') as is_success, event_type = 'error' as is_error,
               event_type = 'purchase' as is_skipped,
               case when event_type = 'view' then event_id else 0 end as rows_affected,
               case when event_type = 'error' then 1 end as failures,
               case when event_type = 'error' then substr(repeat(props, 600), 1, 4000)
                    else '' end as message,
               day + interval 1 day as logged_at
        from results""")


def _contract_check() -> str:
    def line(column: str, kind: str, detail: str, failures: str) -> str:
        return f"""select 'fact_sales' as "table", '{column}' as "column", '{kind}' as violation,
                          '{detail}' as detail, cast({failures} as bigint) as failures"""

    no_discount = "(select count(*) from fact_sales where discount_amount = 0)"
    is_open = "(select count(*) from fact_sales where order_status = 'OPEN')"
    found = [
        line("currency_code", "missing_column", "string", "1"),
        line("quantity", "wrong_type", "bigint instead of int", "1"),
        line("loaded_by", "unexpected_column", "string", "1"),
        line("net_sales_amount", "null", "required", no_discount),
        line("order_status", "too_long", "more than 50 characters", is_open),
    ]
    return with_ctes(f"select * from ({' union all '.join(found)}) where failures > 0")


def _dq_not_null() -> str:
    return with_ctes("""
        select 'net_sales_amount' as "column", count(*) as failures from fact_sales
          where discount_amount = 0
        union all select 'customer_key', 0
        union all select 'sales_rep_key', count(*) from fact_sales where sales_rep_key = 0""")


def _dq_relationships() -> str:
    return with_ctes("""
        select product_key, count(*) as n_records from fact_sales
        where product_key not in (select product_key from dim_product
                                  where category_name <> 'Unmapped')
        group by product_key""")


def _dq_active_mapping() -> str:
    return with_ctes("""
        select p.category_code, cast(coalesce(n, 0) as bigint) as active_rows
        from (select distinct category_code from stg_products) p
        left join (select category_code, count(*) as n from stg_categories
                   where effective_to is null group by category_code) using (category_code)
        where coalesce(n, 0) <> 1""")


RAW_TWINS = {
    "raw_sales_customers": "raw_customers",
    "raw_sales_products": "raw_products",
    "raw_sales_orders": "raw_orders",
    "raw_sales_order_lines": "raw_lines",
    "raw_hr_sales_reps": "raw_reps",
    "mdm_product_category_mapping": "raw_categories",
}


def _dq_summary() -> str:
    def line(check: str, table: str, column: str, count: str) -> str:
        return f"""select '{check}' as "check", '{table}' as "table", '{column}' as "column",
                          cast(({count}) as bigint) as failures"""

    lines = []
    for table, columns in NOT_NULL.items():
        for c in columns:
            twin = RAW_TWINS.get(table, table)
            lines.append(
                line("not_null", table, c, f"select count(*) from {twin} where {c} is null")
            )
    for table, columns in UNIQUE.items():
        for c in columns:
            twin = RAW_TWINS.get(table, table)
            doubled = f"select {c} from {twin} where {c} is not null group by 1 having count(*) > 1"
            lines.append(line("unique", table, c, f"select count(*) from ({doubled})"))
    for child, fk, parent, pk in RELATIONSHIPS:
        orphans = f"""select count(*) from {child} where {fk} is not null
                      and {fk} not in (select {pk} from {parent})"""
        lines.append(line("relationships", child, fk, orphans))
    lines.append(
        line(
            "mapped_to_master_data",
            "ads_product",
            "product_category_pk",
            "select count(*) from ads_product where product_category_pk = 0",
        )
    )
    lines.append(
        line(
            "non_negative",
            "fact_sales",
            "net_sales_amount",
            "select count(*) from fact_sales where net_sales_amount < 0",
        )
    )
    all_lines = " union all ".join(lines)
    return with_ctes(
        f"""select *, case when failures = 0 then 'pass' else 'fail' end as status
            from ({all_lines})"""
    )


def _freshness() -> str:
    lines = []
    for table, (warn, error) in FRESHNESS_DAYS.items():
        name = table.split(".")[-1]
        lines.append(f"""
            select '{name}' as source, newest as max_loaded_at,
                   date_diff('second', newest, timestamp '{AS_OF}') as age_seconds,
                   case when newest is null or timestamp '{AS_OF}' - newest > interval {error} day
                          then 'error'
                        when timestamp '{AS_OF}' - newest > interval {warn} day then 'warn'
                        else 'pass' end as status
            from (select max(_loaded_at) as newest from {RAW_TWINS[name]})""")
    return with_ctes(" union all ".join(lines))


def _sales_by_period() -> str:
    return with_ctes("""
        select calendar_year, calendar_quarter, country_name, category_group, region,
               count(*) as order_lines,
               cast(sum(net_sales_amount) as decimal(28,2)) as net_sales_amount
        from fact_sales f
        join dim_date d on f.order_date_key = d.date_key
        join dim_product p on f.product_key = p.product_key
        join dim_sales_rep r on f.sales_rep_key = r.sales_rep_key
        join dim_customer c on f.customer_key = c.customer_key
        group by all""")


def _customer_recency() -> str:
    return with_ctes(f"""
        select c.customer_key, c.customer_id, c.country_name,
               min(d.date_value) as first_order_date, max(d.date_value) as last_order_date,
               count(f.sales_fact_key) as order_lines,
               cast(coalesce(sum(f.net_sales_amount), 0) as decimal(28,2)) as net_sales_amount,
               cast(date_diff('day', max(d.date_value), date '{AS_OF[:10]}') as integer)
                 as days_since_last_order
        from dim_customer c
        left join fact_sales f on c.customer_key = f.customer_key
        left join dim_date d on f.order_date_key = d.date_key
        group by 1, 2, 3""")


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


def oracle_sql() -> dict[str, str]:
    models = {name: with_ctes(f"select * from {name}") for name in MODELS}
    return models | {
        "surrogate_key": _surrogate_key(),
        "key_lookup": _key_lookup(),
        "watermark_value": with_ctes(
            "select max(updated_at) as max_updated_at from stg_order_lines"
        ),
        "footer_watermark": """
            select 'l_shipdate' as "column", cast(max(l_shipdate) as varchar) as value from lineitem
            union all select 'l_orderkey', cast(max(l_orderkey) as varchar) from lineitem""",
        "watermark_filter": with_ctes(
            f"select * from stg_order_lines where updated_at > timestamp '{SPLIT}'"
        ),
        "recent_slice": with_ctes(
            f"""select * from stg_order_lines
                where updated_at >= timestamp '{AS_OF}' - interval 30 day"""
        ),
        "upsert_merge": _upsert_merge(),
        "upsert_by_period": _upsert_by_period(),
        "late_members": with_ctes("select * from ads_sales_order"),
        "colocated_orders": with_ctes("select * from ads_sales_order"),
        "gold_write": with_ctes("select * from fact_sales"),
        "ingest_lines": with_ctes("select * from raw_lines"),
        "ingest_products": _ingest_products(),
        "stream_upsert": _stream_upsert(),
        "incremental_orders": _incremental_orders(),
        "latest_per_key": _latest_per_key(),
        "runlog_dim": _runlog_dim(),
        "runlog_fact": _runlog_fact(),
        "contract_check": _contract_check(),
        "dq_not_null": _dq_not_null(),
        "dq_unique": """
            select l_orderkey, l_linenumber, count(*) as n_records from lineitem
            group by 1, 2 having count(*) > 1""",
        "dq_relationships": _dq_relationships(),
        "dq_unmapped_products": with_ctes(
            "select product_id, category_code from ads_product where product_category_pk = 0"
        ),
        "dq_negative_amounts": with_ctes("""
            select sales_fact_key, cast(net_sales_amount - 40000 as decimal(18,2))
                     as net_sales_amount
            from fact_sales where net_sales_amount - 40000 < 0"""),
        "dq_active_mapping": _dq_active_mapping(),
        "dq_summary": _dq_summary(),
        "freshness": _freshness(),
        "star_sales_by_period": _sales_by_period(),
        "customer_recency": _customer_recency(),
    }
