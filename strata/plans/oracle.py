"""DuckDB SQL equal to each registered query (the correctness oracle).

Written independently of the Spark code: plain window functions and joins
over the same tables, with outputs cast to the same types.
"""

from __future__ import annotations

from strata.plans.queries import (
    AS_OF, AS_OF_2, DAYS_FROM, DRIVER_TABLES, HWM_MARK, RUN_END, RUN_ID, SNAPSHOT_CUT,
)
from strata.specs import NA_TOKENS, PIPELINE_NAME

_ITEMS = """
items_v as (
  select * exclude (rn) from (
    select *, row_number() over (partition by l_orderkey, l_linenumber
                                 order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) rn
    from lineitem where l_orderkey is not null and l_linenumber is not null) x
  where rn = 1),
oi as (
  select l_orderkey order_id, l_linenumber order_item_id, l_partkey product_id, l_suppkey seller_id,
         cast(l_extendedprice as decimal(18,2)) price,
         cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(18,2)) freight_value,
         l_shipdate shipping_limit_date
  from items_v),
pm as (
  select l_orderkey order_id, l_linenumber payment_sequential,
         cast(cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)))
              as decimal(18,2)) payment_value
  from items_v),
pay as (
  select order_id, cast(coalesce(sum(payment_value), 0) as decimal(28,2)) total_payment,
         count(payment_sequential) payment_count
  from pm group by order_id)"""

_BD = _ITEMS + f""",
o as (select o_orderkey order_id, o_custkey customer_id, o_orderstatus order_status,
             o_orderdate order_purchase_timestamp from orders),
c as (select c_custkey customer_id, c_custkey customer_unique_id, n_name customer_city
      from customer left join nation on c_nationkey = n_nationkey),
p as (select p_partkey product_id, p_type product_category_name, p_brand product_brand,
             p_size product_size from part),
s as (select s_suppkey seller_id, n_name seller_city from supplier left join nation on s_nationkey = n_nationkey),
tr as (select * from (values ('ECONOMY','cat_economy'),('SMALL','cat_small'),('STANDARD','cat_standard'))
       t(product_category_name, product_category_name_english)),
og as (
  select o.*, c.customer_unique_id, c.customer_city,
         case when c.customer_unique_id is not null and o.order_purchase_timestamp is not null then
           cast(dense_rank() over (partition by c.customer_unique_id
                                   order by o.order_purchase_timestamp asc nulls last) as integer)
         end customer_order_number
  from o left join c on o.customer_id = c.customer_id),
bd as (
  select og.*, oi.order_item_id, oi.product_id, oi.seller_id, oi.price, oi.freight_value,
         oi.shipping_limit_date, pay.total_payment, pay.payment_count,
         p.product_category_name, p.product_brand, p.product_size, s.seller_city,
         tr.product_category_name_english,
         cast(year(og.order_purchase_timestamp) as integer) order_year,
         cast(month(og.order_purchase_timestamp) as integer) order_month,
         cast(floor((epoch_us(oi.shipping_limit_date) - epoch_us(og.order_purchase_timestamp))
                    / 86400000000.0) as bigint) delivery_days,
         cast(coalesce(oi.price, 0) + coalesce(oi.freight_value, 0) as decimal(18,2)) item_total,
         TIMESTAMP '{AS_OF}' transformation_timestamp
  from og
  left join oi on og.order_id = oi.order_id
  left join pay on og.order_id = pay.order_id
  left join p on oi.product_id = p.product_id
  left join s on oi.seller_id = s.seller_id
  left join tr on p.product_category_name = tr.product_category_name)"""

_CS = _BD + """,
cs0 as (
  select customer_unique_id, customer_city, count(distinct order_id) total_orders,
         count(order_item_id) total_items,
         cast(coalesce(sum(item_total), 0) as decimal(28,2)) total_spent
  from bd where customer_unique_id is not null and customer_city is not null
  group by customer_unique_id, customer_city),
cs as (select *, cast(dense_rank() over (order by total_spent desc) as integer) customer_rank from cs0)"""

_EV_TEXT = """
ev as (
  select event_id, cast(user_id as varchar) user_id, event_type,
         json_extract_string(props, '$.k') k,
         case when event_type = 'error' then 'not a date'
              when event_type = 'purchase' then strftime(ts, '%Y-%m-%d')
              when event_type = 'signup' then strftime(ts, '%Y-%m-%dT%H:%M:%S')
              else strftime(ts, '%Y-%m-%d %H:%M:%S') end ts_text,
         case when event_type = 'error' then 'bad'
              when event_type = 'view' then ' ' || printf('%.2f', value) || ' '
              when event_type = 'signup' then printf('%.2f', value) || 'd'
              else printf('%.2f', value) end value_text
  from events)"""

_LI_FLAGS = """
lf as (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) rn,
         (l_orderkey is null or l_linenumber is null) nk
  from lineitem)"""

_CUST_SNAP = f"""
cc as (select c_custkey customer_id, c_custkey customer_unique_id, c_name customer_name,
              c_mktsegment customer_segment, n_name customer_city
       from customer left join nation on c_nationkey = n_nationkey),
a_old as (select o_custkey customer_id, max(o_orderdate) last_order_date, count(*) orders_in_batch
          from orders where o_orderdate <= TIMESTAMP '{SNAPSHOT_CUT}' group by o_custkey),
a_new as (select o_custkey customer_id, max(o_orderdate) last_order_date, count(*) orders_in_batch
          from orders where o_orderdate > TIMESTAMP '{SNAPSHOT_CUT}' group by o_custkey),
s_old as (select cc.customer_id, customer_unique_id, customer_name, customer_segment, customer_city,
                 last_order_date, orders_in_batch from a_old join cc on a_old.customer_id = cc.customer_id),
s_new as (select cc.customer_id, customer_unique_id, customer_name, customer_segment, customer_city,
                 last_order_date, orders_in_batch from a_new join cc on a_new.customer_id = cc.customer_id)"""

_PROD_SNAP = f"""
pp as (select p_partkey product_id, p_type product_category_name, p_brand product_brand,
              p_size product_size from part),
b_old as (select l_partkey product_id, min(l_suppkey) main_seller from lineitem
          where l_shipdate <= TIMESTAMP '{SNAPSHOT_CUT}' group by l_partkey),
b_new as (select l_partkey product_id, min(l_suppkey) main_seller from lineitem
          where l_shipdate > TIMESTAMP '{SNAPSHOT_CUT}' group by l_partkey),
p_old as (select pp.*, main_seller from b_old join pp on b_old.product_id = pp.product_id),
p_new as (select pp.*, main_seller from b_new join pp on b_new.product_id = pp.product_id),
h1 as (select *, TIMESTAMP '{AS_OF}' effective_from, cast(null as timestamp) effective_to,
              true is_current from p_old)"""

_STAGES = "\nunion all\n".join(
    f"""select 'validate_{name}' task_id,
       case when sum(case when rn > 1 or nk then 1 else 0 end) > 0 then 'failed' else 'success' end state
from (select row_number() over (partition by {', '.join(keys)} order by {', '.join(order)}) rn,
             ({' or '.join(k + ' is null' for k in keys)}) nk from {name}) t"""
    for name, keys, order in (
        ("customer", ["c_custkey"], ["c_custkey"]),
        ("orders", ["o_orderkey"], ["o_orderkey"]),
        ("lineitem", ["l_orderkey", "l_linenumber"],
         ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]),
        ("part", ["p_partkey"], ["p_partkey"]),
        ("supplier", ["s_suppkey"], ["s_suppkey"]),
    ))


def oracle_queries() -> dict[str, str]:
    q = {}
    q["S_HWM"] = f"select * from orders where o_orderdate > TIMESTAMP '{HWM_MARK}'"
    q["S_MAX"] = (f"select coalesce(max(o_orderdate), TIMESTAMP '{HWM_MARK}') last_order_timestamp "
                  f"from orders where o_orderdate > TIMESTAMP '{HWM_MARK}'")
    q["V1"] = f"with {_LI_FLAGS} select * exclude (rn, nk) from lf where not nk and rn = 1"
    q["V2"] = (f"with {_LI_FLAGS} select * exclude (rn, nk), "
               "case when nk then 'null_key' else 'duplicate_key' end reject_reason "
               "from lf where nk or rn > 1")
    q["V3"] = """
with ev as (select event_id, event_type,
                   case when event_type = 'error' then null else event_id end event_key from events),
f as (select *, row_number() over (partition by event_key order by event_id) rn from ev)
select event_id, event_type, event_key,
       case when event_key is null then 'null_key' else 'duplicate_key' end reject_reason
from f where event_key is null or rn > 1"""
    q["U1"] = f"with {_EV_TEXT} select distinct user_id, event_type, k from ev"
    q["X2"] = (f"with {_EV_TEXT} select event_id, ts_text, "
               "coalesce(try_strptime(ts_text, '%Y-%m-%d %H:%M:%S'), try_strptime(ts_text, '%Y-%m-%d')) ts "
               "from ev")
    q["X3"] = (f"with {_EV_TEXT} select event_id, value_text, "
               "case when regexp_matches(value_text, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') "
               "or regexp_matches(value_text, '^\\s*[+-]?(?i)(inf|infinity|nan)\\s*$') "
               "then try_cast(trim(value_text) as double) end value from ev")
    q["X4"] = """
select o_orderkey, o_custkey, o_orderstatus,
       coalesce(case when o_orderstatus = 'O' then null else o_totalprice end, 0.0) o_totalprice,
       case when o_orderpriority = '1-URGENT' then null else o_orderdate end o_orderdate,
       coalesce(case when o_orderstatus = 'F' then null else o_orderpriority end, 'Unknown') o_orderpriority
from orders"""
    q["X8"] = (f"select event_id, ts, cast(floor((epoch_us(ts) - epoch_us(TIMESTAMP '{DAYS_FROM}')) "
               "/ 86400000000.0) as bigint) delta_days from events")
    q["P1"] = "select *, 3 dropped_columns from orders"
    q["S13"] = "select 'orders.parquet' source_file, count(*) row_count, count(*) stamped from orders"
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)
    q["S1"] = q["T1"] = "select " + ", ".join(
        f"case when {c}::varchar not in ({tokens}) then {c}::varchar end {c}"
        for c in ("conv_id", "turn", "role", "text")) + " from conversations"
    q["S8"] = f"""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') o_orderdate,
       case when o_orderdate <= TIMESTAMP '{SNAPSHOT_CUT}' then 'b_0' else
         (select 'b_' || strftime(max(o_orderdate), '%Y%m%d%H%M%S') from orders
          where o_orderdate <= TIMESTAMP '{SNAPSHOT_CUT}') end load_batch
from orders"""
    q["A1"] = f"with {_ITEMS} select * from pay"
    q["B1"] = f"with {_BD} select * from bd"
    q["J5"] = """
select p_partkey product_id, p_type product_category_name, tr.product_category_name_english
from part left join (values ('ECONOMY','cat_economy'),('SMALL','cat_small'),('STANDARD','cat_standard'))
  tr(product_category_name, product_category_name_english) on p_type = tr.product_category_name"""
    q["J7"] = (f"with {_PROD_SNAP} select * from p_new "
               "where product_id not in (select product_id from h1 where is_current)")
    q["W1"] = """
with li as (select l_orderkey, l_linenumber,
                   case when l_returnflag = 'A' then null else l_suppkey end seller_key,
                   case when l_returnflag = 'R' then null else l_shipdate end ship_ts from lineitem)
select *, case when seller_key is not null and ship_ts is not null then
            cast(dense_rank() over (partition by seller_key order by ship_ts asc nulls last) as integer)
          end ship_number
from li"""
    q["W2"] = ("select c_custkey, c_acctbal, cast(dense_rank() over (order by c_acctbal desc) as integer) "
               "acctbal_rank from customer")
    q["G1"] = f"with {_CS} select * from cs"
    q["G2"] = f"""with {_BD}
select product_id, product_category_name_english, count(distinct order_id) total_orders,
       count(order_item_id) total_units, cast(coalesce(sum(price), 0) as decimal(28,2)) total_sales
from bd where product_id is not null and product_category_name_english is not null
group by product_id, product_category_name_english"""
    q["G3"] = f"""with {_BD}
select order_year, order_month, count(distinct order_id) total_orders,
       count(distinct customer_unique_id) total_customers,
       cast(coalesce(sum(item_total), 0) as decimal(28,2)) total_revenue
from bd where order_year is not null and order_month is not null
group by order_year, order_month"""
    q["G4"] = f"""with {_BD}
select seller_id, seller_city, count(distinct order_id) total_orders,
       count(order_item_id) total_items, cast(coalesce(sum(price), 0) as decimal(28,2)) total_sales
from bd where seller_id is not null and seller_city is not null
group by seller_id, seller_city"""
    q["O1"] = (f"with {_CS} select * from cs "
               "order by customer_rank, customer_unique_id, customer_city limit 10")
    q["D1"] = (f"with {_CUST_SNAP} select * from s_new union all "
               "select * from s_old where customer_id not in (select customer_id from s_new)")
    q["D2"] = f"""with {_PROD_SNAP},
chg as (select n.product_id from p_new n join h1 o on n.product_id = o.product_id
        where o.product_category_name is distinct from n.product_category_name
           or o.product_size is distinct from n.product_size
           or o.main_seller is distinct from n.main_seller)
select product_id, product_category_name, product_brand, product_size, main_seller, effective_from,
       case when product_id in (select product_id from chg) then TIMESTAMP '{AS_OF_2}' else effective_to end
         effective_to,
       product_id not in (select product_id from chg) is_current
from h1
union all
select *, TIMESTAMP '{AS_OF_2}' effective_from, cast(null as timestamp) effective_to, true is_current
from p_new
where product_id in (select product_id from chg) or product_id not in (select product_id from h1)"""
    q["D2_commits"] = q["D2"]
    q["T3"] = "select o_orderkey, o_custkey, o_orderdate from orders"
    q["T4_scd1"] = """select o_custkey, o_orderkey, o_orderpriority, o_orderdate from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""
    q["T4_scd2"] = """with o as (select * from orders qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1),
p as (select *, row_number() over w as i, lag(o_orderpriority) over w as before from o window w as (partition by o_custkey order by o_orderdate)),
v as (select * from p where i = 1 or before is distinct from o_orderpriority)
select o_custkey, o_orderkey, o_orderpriority, o_orderdate as effective_from, lead(o_orderdate) over w as effective_to,
       lead(o_orderdate) over w is null as is_current
from v window w as (partition by o_custkey order by o_orderdate)"""
    q["C2"] = f"""with {_LI_FLAGS}
select count(*) original_rows,
       cast(sum(case when not nk and rn = 1 then 1 else 0 end) as bigint) valid_rows,
       cast(sum(case when nk or rn > 1 then 1 else 0 end) as bigint) rejected_rows,
       cast(sum(case when nk then 1 else 0 end) as bigint) null_key_rows,
       cast(sum(case when not nk and rn > 1 then 1 else 0 end) as bigint) duplicate_key_rows
from lf"""
    q["C3"] = "\nunion all\n".join(
        f"select '{t}' dataset_name, 'testdata' layer, '{t}.parquet' file_name, 'parquet' file_format, "
        f"count(*) record_count, TIMESTAMP '{AS_OF}' updated_at from {t}"
        for t in DRIVER_TABLES)
    q["C4"] = f"""with st as ({_STAGES}),
f as (select list_sort(list(task_id) filter (where state in ('failed', 'upstream_failed'))) names from st)
select '{RUN_ID}' run_id, '{PIPELINE_NAME}' pipeline_name,
       strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%dT%H:%M:%S') start_time,
       strftime(TIMESTAMP '{RUN_END}', '%Y-%m-%dT%H:%M:%S') end_time,
       case when len(names) > 0 then 'FAILED' else 'SUCCESS' end status,
       round(epoch_ms(TIMESTAMP '{RUN_END}') / 1000.0 - epoch_ms(TIMESTAMP '{AS_OF}') / 1000.0, 2)
         execution_seconds,
       case when len(names) > 0 then 'Failed tasks: ' || array_to_string(names, ', ') else '' end
         error_message
from f"""
    q["W1_pieces"] = q["W1"]
    for name, cols in _MONEY.items():
        casts = ", ".join(f"cast({c} as double) as {c}" for c in cols)
        q[name] = f"select * replace ({casts}) from ({q[name]}) m"
    return q


# Money columns handed over as DOUBLE (computed as DECIMAL).
_MONEY = {
    "A1": ["total_payment"],
    "B1": ["price", "freight_value", "total_payment", "item_total"],
    "G1": ["total_spent"], "O1": ["total_spent"],
    "G2": ["total_sales"], "G3": ["total_revenue"], "G4": ["total_sales"],
}
