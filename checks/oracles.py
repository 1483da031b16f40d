"""The same results in SQL, written from the feeds' definitions alone."""

from __future__ import annotations

from checks.inputs import ORDERS_PER_DOCUMENT

_PROFIT = (
    "cast(round(cast(l_extendedprice as decimal(12,2)) "
    "* (1 - cast(l_discount as decimal(4,2))), 2) as decimal(38,2))"
)

_SALES = f"""
    select l_linenumber as row_id, l_orderkey as order_id, o_orderdate as order_date,
           o_custkey as customer_id, l_partkey as product_id, {_PROFIT} as profit,
           l_returnflag = 'R' as returned
    from lineitem join orders on l_orderkey = o_orderkey
"""

_CATEGORISED = f"""
    select s.*, coalesce(p_type, 'unknown') as category,
           coalesce(p_brand, 'unknown') as sub_category
    from ({_SALES}) s left join part on product_id = p_partkey
"""

_KPI = f"""
    select cast(year(order_date) as integer) as order_year, category, sub_category,
           customer_id, cast(sum(profit) as decimal(38,2)) as total_profit
    from ({_CATEGORISED}) group by 1, 2, 3, 4
"""


def _report(*keys: str) -> str:
    by = ", ".join(keys)
    return (
        f"select {by}, cast(sum(total_profit) as decimal(38,2)) as total_profit "
        f"from ({_KPI}) group by {by} order by {by}"
    )


_ALL_REPORTS = f"""
    select order_year, category, customer_id,
           cast(sum(total_profit) as decimal(38,2)) as total_profit,
           case when grouping(order_year) = 1 then 'by_customer'
                when grouping(category) = 0 then 'by_year_category'
                when grouping(customer_id) = 0 then 'by_year_customer'
                else 'by_year' end as report
    from ({_KPI})
    group by grouping sets ((order_year), (order_year, category),
                            (order_year, customer_id), (customer_id))
"""

_ENRICHED = """
    select row_id, order_id, cast(order_date as date) as order_date, customer_id,
           product_id, profit,
           coalesce(nullif(p_type, 'PROMO'), 'unknown') as category,
           coalesce(p_brand, 'unknown') as sub_category,
           c_name as customer_name, n_name as country
    from ({sales}) s
    left join (select * from part where p_size <= 45) p on product_id = p_partkey
    left join (select * from customer left join nation on c_nationkey = n_nationkey
               where c_acctbal >= 0) c on customer_id = c_custkey
"""

_DIRTY = """
    select cast(c_custkey as varchar) as customer_id,
           c_mktsegment || ' ~{2}  ' || n_name || '_#7 ' || c_name as customer_name,
           ' ' || lower(c_mktsegment) || '.' || c_custkey || '+news<1>@mail. shop-4.org,' as email,
           case when c_acctbal < 0 then '~/' || (c_custkey % 800 + 200)
                else '+' || (c_nationkey + 100) || ' / ' || (c_custkey % 800 + 200) || '-'
                     || (c_custkey % 9000 + 1000) || ' (ext. ' || c_nationkey || ')' end as phone,
           cast(null as varchar) as city, cast(c_nationkey as varchar) as postal
    from customer left join nation on c_nationkey = n_nationkey
"""


def _letters(column: str) -> str:
    kept = rf"regexp_replace({column}, '[^a-zA-Z\s]', '', 'g')"
    return rf"trim(regexp_replace({kept}, '\s+', ' ', 'g'))"


def _address(column: str) -> str:
    return rf"regexp_replace({column}, '[^\w\.\@\+\-]', '', 'g')"


def _digits(column: str) -> str:
    return rf"regexp_replace({column}, '\D', '', 'g')"


_CLEAN_CUSTOMER = f"""
    select customer_id, {_letters('customer_name')} as customer_name,
           {_address('email')} as email,
           case when length({_digits('phone')}) >= 10 then {_digits('phone')} end as phone
    from ({_DIRTY})
"""

_LOADS = "select event_id, user_id, value, cast(ts as date) as load_ts from events"
_LATEST = """
    select event_id, ts, user_id, event_type, value, props from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n
        from events) where n = 1
"""

_MERGED = """
    with target as (
        select p_partkey as product_id, p_type as category, p_brand as sub_category,
               p_size as version
        from part where p_type <> 'ECONOMY'),
    source as (
        select p_partkey as product_id, lower(p_type) as category, p_brand as sub_category,
               25 as version
        from part where p_brand not in ('Brand#1', 'Brand#2', 'Brand#3'))
    select coalesce(t.product_id, s.product_id) as product_id,
           case when t.product_id is null or s.version >= t.version
                then s.category else t.category end as category,
           case when t.product_id is null or s.version >= t.version
                then s.sub_category else t.sub_category end as sub_category,
           cast(case when t.product_id is null or s.version >= t.version
                then s.version else t.version end as integer) as version
    from target t full outer join source s on t.product_id = s.product_id
"""

_GOOD_PART = "p_type <> 'PROMO' and p_size <> 50"
_ORDER_COLUMNS = (
    "o_orderkey as row_id, 'O-' || o_orderkey as order_id, "
    "cast(o_custkey as varchar) as customer_id, {price} as price, o_orderpriority as ship_mode"
)
_ORDERS = _ORDER_COLUMNS.format(price="o_totalprice")
_DOCUMENTS = f"""
    select *, document_p > document_f as broken from (
        select *, o_orderkey // {ORDERS_PER_DOCUMENT} as document,
               count(*) filter (o_orderstatus = 'P') over by_document as document_p,
               count(*) filter (o_orderstatus = 'F') over by_document as document_f
        from orders
        window by_document as (partition by o_orderkey // {ORDERS_PER_DOCUMENT}))
"""

_END_TO_END = f"""
    select cast(row_id as bigint) as row_id, cast(order_id as varchar) as order_id,
           cast(order_date as date) as order_date,
           cast(s.customer_id as varchar) as customer_id,
           cast(product_id as varchar) as product_id, profit,
           coalesce(p_type, 'unknown') as category,
           coalesce(p_brand, 'unknown') as sub_category,
           c.customer_name, c.country
    from ({_SALES}) s
    left join (select * from part where {_GOOD_PART}) p on product_id = p_partkey
    left join (select d.customer_name, d.customer_id, n_name as country
               from ({_CLEAN_CUSTOMER}) d
               join customer on d.customer_id = cast(c_custkey as varchar)
               join nation on c_nationkey = n_nationkey) c
           on cast(s.customer_id as varchar) = c.customer_id
"""

_DELIVERED = f"""
    select d.customer_id, d.customer_name, d.phone,
           case when c_acctbal < 0 then 'new ' || n_name else n_name end as country,
           case when c_acctbal < 0 then date '2024-02-01' else date '2024-01-01' end as loaded
    from ({_CLEAN_CUSTOMER}) d
    join customer on d.customer_id = cast(c_custkey as varchar)
    join nation on c_nationkey = n_nationkey
"""

_TWO_DELIVERIES = f"""
    select cast(row_id as bigint) as row_id, cast(order_id as varchar) as order_id,
           cast(order_date as date) as order_date,
           cast(s.customer_id as varchar) as customer_id,
           cast(product_id as varchar) as product_id, profit,
           case when p_type is null then 'unknown'
                when order_id % 5 = 0 and p_brand in ('Brand#1', 'Brand#2') then 'new ' || p_type
                else p_type end as category,
           coalesce(p_brand, 'unknown') as sub_category, c.customer_name,
           case when order_id % 5 = 0 and c.balance < 0 then 'new ' || c.country
                else c.country end as country,
           case when order_id % 5 = 0 then date '2024-02-01' else date '2024-01-01' end as load_ts
    from ({_SALES}) s
    left join (select * from part where {_GOOD_PART}) p on product_id = p_partkey
    left join (select d.customer_name, d.customer_id, n_name as country, c_acctbal as balance
               from ({_CLEAN_CUSTOMER}) d
               join customer on d.customer_id = cast(c_custkey as varchar)
               join nation on c_nationkey = n_nationkey) c
           on cast(s.customer_id as varchar) = c.customer_id
"""

_LATEST_VERSIONS = f"""
    select cast(row_id as bigint) as row_id, cast(order_id as varchar) as order_id, order_date,
           cast(customer_id as varchar) as customer_id, coalesce(p_type, 'unknown') as category,
           coalesce(p_brand, 'unknown') as sub_category, profit
    from ({_SALES}) s
    left join (select * from part where {_GOOD_PART}) p on product_id = p_partkey
    where not (returned and order_id // {ORDERS_PER_DOCUMENT} % 2 = 0)
"""


def _all_reports(orders: str) -> str:
    return f"""
        select cast(order_year as integer) as order_year, category, customer_id,
               cast(sum(profit) as decimal(38,2)) as total_profit,
               case when grouping(order_year) = 1 then 'by_customer'
                    when grouping(category) = 0 then 'by_year_category'
                    when grouping(customer_id) = 0 then 'by_year_customer'
                    else 'by_year' end as report
        from (select *, year(order_date) as order_year from ({orders}))
        group by grouping sets ((order_year), (order_year, category),
                                (order_year, customer_id), (customer_id))"""


_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

ORACLES: dict[str, str] = {
    "kpi_agg": _KPI,
    "profit_by_year": _report("order_year"),
    "profit_by_year_category": _report("order_year", "category"),
    "profit_by_year_customer": _report("order_year", "customer_id"),
    "profit_by_customer": _report("customer_id"),
    "profit_all_reports": _ALL_REPORTS,
    "profit_from_view": _report("order_year", "category"),
    "order_enrich": _ENRICHED.format(sales=_SALES),
    "order_enrich_measured": _ENRICHED.format(sales=_SALES),
    "order_enrich_split": _ENRICHED.format(
        sales=f"""select * replace (case when returned then 1 else customer_id end as customer_id,
                                    case when returned then product_id end as product_id)
                  from ({_SALES})"""
    ),
    "order_enrich_bucketed": _ENRICHED.format(
        sales=f"""select * replace (case when returned then 1 else customer_id end as customer_id)
                  from ({_SALES})"""
    ),
    "clean_customer": _CLEAN_CUSTOMER,
    "clean_text": f"""
        select doc_id, {_letters('text')} as letters, {_address('text')} as address_characters,
               {_digits('text')} as digits from documents""",
    "snake_headers": """
        select o_orderkey as order_key, o_custkey as customer_id,
               o_orderstatus as "order-status", o_totalprice as total_price from orders""",
    "parse_dates": """
        select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end
               as order_date,
               cast(case when o_orderstatus <> 'P' then year(o_orderdate) end as integer)
               as order_year
        from orders""",
    "latest_per_key": _LATEST,
    "latest_per_key_max": _LATEST,
    "distinct_rows": "select distinct l_partkey, l_returnflag, l_linestatus from lineitem",
    "latest_batch": f"""
        select * from ({_LOADS}) where load_ts = (select max(load_ts) from ({_LOADS}))""",
    "newer_than_watermark": f"""
        select * from ({_LOADS}) where load_ts >
            (select max(load_ts) from ({_LOADS}) where load_ts <= date '2024-01-20')""",
    "watermark_inclusive": f"""
        select * from ({_LOADS}) where load_ts >=
            (select max(load_ts) from ({_LOADS}) where load_ts <= date '2024-01-20')""",
    "newer_than_nothing": _LOADS,
    "money_of_products": """
        select l_orderkey, l_linenumber,
               cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)), 2)
                    as decimal(38,2)) as discounted,
               cast(round(cast(l_quantity as decimal(12,0)) * cast('0.005' as decimal(4,3)), 2)
                    as decimal(38,2)) as halves
        from lineitem""",
    "reports_in_order": f"""
        select order_year, category, total_profit,
               row_number() over (order by order_year nulls first, category) as place
        from (select cast(case when not returned then year(order_date) end as integer) as order_year,
                     category, cast(sum(profit) as decimal(38,2)) as total_profit
              from ({_CATEGORISED}) group by 1, 2)""",
    "files_modified_since": """
        with files as (select 'file:/events/' || event_id as file_path, date_trunc('second', ts) as t
                       from events)
        select 'events' as object, file_path from files
        where t > (select max(t) from files where t < timestamp '2024-01-16 00:00:00')
        union all select 'others', file_path from files""",
    "ledger_entries": """
        select 'file:/events/' || event_id as file_path,
               strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as modified,
               'base' as planned_as
        from events
        union all select 'file:/local', '2024-01-01 00:00:00', 'loca'""",
    "products_of_two_files": """
        select cast(p_partkey as varchar) as product_id, greatest(p_type, reverse(p_type)) as category,
               p_brand as sub_category, date '2024-01-01' as loaded
        from part""",
    "customers_merged": _DELIVERED,
    "customers_rebuilt": _DELIVERED,
    "end_to_end_two_deliveries": _TWO_DELIVERIES,
    "reports_after_two_deliveries": _all_reports(_TWO_DELIVERIES),
    "orders_of_latest_versions": f"select row_id, order_id, category, profit from ({_LATEST_VERSIONS})",
    "reports_of_latest_versions": _all_reports(_LATEST_VERSIONS),
    "load_time_of_products": f"""
        select cast(p_partkey as varchar) as product_id, true as within_load, true as as_marked
        from part where {_GOOD_PART}""",
    "landing_counts": f"""
        select 'products' as flow, count(*) as n_rows, count(*) filter (not ({_GOOD_PART})) as n_malformed
        from part
        union all
        select 'orders', count(*), count(*) filter (o_orderstatus = 'P') from orders""",
    "rows_by_planned_file": """
        select true as planned, count(*) as n_rows, count(distinct o_orderkey) as n_orders from orders""",
    "merge_upsert": _MERGED,
    "merge_upsert_bucketed": _MERGED,
    "csv_clean": f"""
        select cast(p_partkey as varchar) as product_id, p_type as category,
               p_brand as sub_category, p_name as product_name, 'S' || p_size as state,
               p_retailprice as price_per_product
        from part where {_GOOD_PART}""",
    "csv_quarantine": f"""
        select cast(p_partkey as varchar) as product_id, p_type as category,
               p_brand as sub_category, p_name as product_name, 'S' || p_size as state,
               p_partkey || ',' || p_type || ',' || p_brand || ',' || p_name || ',S' || p_size
               || case when p_type = 'PROMO' then ',' || p_retailprice || ',left over' else '' end
               as raw_text
        from part where not ({_GOOD_PART})""",
    "json_documents_clean": f"select {_ORDERS} from ({_DOCUMENTS}) where not broken",
    "json_documents_quarantine": f"""
        select count(distinct document) as n_rows from ({_DOCUMENTS}) where broken""",
    "json_elements_clean": f"select {_ORDERS} from orders where o_orderstatus <> 'P'",
    # A set-aside element is written anew: names in order, numbers without trailing zeros.
    "json_elements_quarantine": f"""
        select {_ORDER_COLUMNS.format(price='cast(null as double)')},
               '{{"Customer ID":"' || o_custkey || '","Discount":0,"Order Date":"' || day
               || '","Order ID":"O-' || o_orderkey || '","Price":"n/a","Product ID":"P","Profit":'
               || regexp_replace(cast(o_totalprice as varchar), '[.]0$', '') || ',"Quantity":1,"Row ID":' || o_orderkey || ',"Ship Date":"' || day
               || '","Ship Mode":"' || o_orderpriority || '"}}' as raw_text
        from (select *, strftime(o_orderdate, '%-d/%-m/%Y') as day from orders) where o_orderstatus = 'P'""",
    "json_lines_clean": f"select {_ORDERS} from orders where o_orderstatus <> 'P'",
    "json_lines_quarantine": f"""
        select {_ORDER_COLUMNS.format(price='cast(null as double)')}
        from orders where o_orderstatus = 'P'""",
    "workbook_rows": f"""
        select customer_id, customer_name, email, phone, city, postal from ({_DIRTY})""",
    "file_ledger_new_files": """
        select event_id, user_id, event_type, value from events
        where ts >= timestamp '2024-01-16 00:00:00'""",
    "stream_ingest_orders": f"select {_ORDERS} from orders",
    "stream_orders_once": f"""
        select {_ORDERS}, cast(case when o_orderstatus = 'P' then 2 else 1 end as integer) as came_on
        from orders""",
    "stream_upsert_customers": """
        select c_custkey as customer_id, c_name as customer_name,
               case when c_acctbal < 0 then lower(c_mktsegment) else c_mktsegment end as segment,
               cast(case when c_acctbal < 0 then 2 else 1 end as integer) as version
        from customer""",
    "append_table": "select o_orderkey, o_orderstatus, o_totalprice from orders",
    "overwrite_table": """
        select o_orderkey, lower(o_orderstatus) as o_orderstatus, o_totalprice from orders""",
    "view_of_table": "select o_orderstatus, count(*) as n_orders from orders group by 1",
    "temp_view_scan": """
        select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'""",
    "batch_guards": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, count(*) = 0 as is_empty from {name} "
        f"union all select '{name} below zero', 0, true"
        for name in _TABLES
    ),
    "end_to_end_profit": f"""
        select cast(year(order_date) as integer) as order_year, category,
               cast(sum(profit) as decimal(38,2)) as total_profit
        from ({_END_TO_END}) group by 1, 2 order by 1, 2""",
    "end_to_end_orders": _END_TO_END,
}
ORACLES["order_enrich_salted"] = ORACLES["order_enrich_split"]
