"""The registered queries in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

import re

BASE = """
customers as (
  select c_custkey customer_id, c_name first_name, c_mktsegment last_name,
         concat(c_name, '@example.org') email,
         date '1995-01-01' + to_months(cast(c_custkey % 24 as int)) registration_date
  from customer),
shop_orders as (
  select o_orderkey order_id, o_custkey customer_id, o_orderdate order_date,
         case when o_orderkey % 10 = 0 then 'cancelled' when o_orderstatus = 'F' then 'delivered'
              when o_orderstatus = 'O' then 'shipped' else 'processing' end status,
         cast(o_totalprice as decimal(12,2)) total_amount
  from orders),
priced as (
  select l_orderkey * 1000 + row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
           l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) item_id,
         l_orderkey order_id, cast(l_partkey as varchar) product_id, p_name product_name,
         cast(l_quantity as int) quantity, cast(p_retailprice as decimal(10,2)) unit_price,
         cast(l_discount as decimal(5,2)) discount, l_returnflag
  from lineitem join part on l_partkey = p_partkey),
items as (
  select item_id, order_id, product_id, product_name, quantity, unit_price, discount,
         cast(quantity * unit_price * (1 - discount) as decimal(18,4)) line_total
  from priced),
order_log as (
  select order_id, customer_id, order_date, status, total_amount, 'c' op,
         1704067200000 + 1000 * order_id ts_ms, 4 * order_id lsn, false is_deleted
  from shop_orders
  union all
  select order_id, customer_id, order_date, status, cast(total_amount + 1 as decimal(12,2)), 'u',
         1704067200000 + 1000 * order_id + case when order_id % 9 = 0 then 0 else 5 end,
         4 * order_id + 1, false
  from shop_orders where order_id % 3 = 0
  union all
  select order_id, customer_id, order_date, status, total_amount, 'd',
         1704067200000 + 1000 * order_id + 9, 4 * order_id + 2, true
  from shop_orders where order_id % 11 = 0),
item_log as (
  select item_id, order_id, product_id, product_name, quantity, unit_price, discount, 'c' op,
         1704067200000 + 1000 * order_id ts_ms, 4 * item_id lsn, false is_deleted
  from priced
  union all
  select item_id, order_id, product_id, product_name, quantity + 1, unit_price, discount, 'u',
         1704067200000 + 1000 * order_id + case when item_id % 15 = 0 then 0 else 5 end, 4 * item_id + 1, false
  from priced where item_id % 5 = 0
  union all
  select item_id, order_id, product_id, product_name, quantity, unit_price, discount, 'd',
         1704067200000 + 1000 * order_id + 9, 4 * item_id + 2, true
  from priced where l_returnflag = 'R'),
customer_log as (
  select customer_id, 'r' op, 1704067200000 ts_ms, customer_id lsn, false is_deleted
  from customers),
live_orders as (
  select * exclude (rn) from (
    select *, row_number() over (partition by order_id order by ts_ms desc, lsn desc) rn
    from order_log) where rn = 1 and not is_deleted),
live_items as (
  select * exclude (rn) from (
    select *, row_number() over (partition by item_id order by ts_ms desc, lsn desc) rn
    from item_log) where rn = 1 and not is_deleted),
live_order_products as (
  select * exclude (rn) from (
    select *, row_number() over (partition by order_id, product_id
                                 order by ts_ms desc, lsn desc) rn
    from item_log) where rn = 1 and not is_deleted)
"""


def _with(body: str, *more: str) -> str:
    return "with " + ",\n".join([BASE.strip(), *more]) + "\n" + body


def _period_body(keys: str, names: str, where: str = "") -> str:
    return f"""
select {keys}, cast(sum(line_total) as double) total_sales,
       count(distinct order_id) order_count,
       cast(sum(line_total) as double) / count(*) avg_order_value,
       cast(sum(line_total) as double) / count(distinct order_id) avg_per_order
from shop_orders join items using (order_id) {where}
group by {names}"""


def _period(keys: str, names: str, where: str = "") -> str:
    return _with(_period_body(keys, names, where))


DAILY = _period("cast(order_date as date) order_date", "cast(order_date as date)")
MONTH = "strftime(order_date, '%Y-%m')"

RFM = """
measures as (
  select customer_id,
         cast(date_diff('day', max(order_date), (select max(order_date) from shop_orders)) as int)
           recency,
         count(order_id) frequency, sum(total_amount) spent
  from shop_orders where status <> 'cancelled' group by customer_id),
scores as (
  select customer_id, recency, frequency, cast(spent as double) monetary,
         case when recency <= 30 then 3 when recency <= 90 then 2 else 1 end r_score,
         case when frequency >= 5 then 3 when frequency >= 2 then 2 else 1 end f_score,
         case when spent >= 500 then 3 when spent >= 100 then 2 else 1 end m_score
  from measures),
rfm as (
  select s.*, 100 * r_score + 10 * f_score + m_score rfm_score,
         first_name, last_name, email
  from scores s join customers using (customer_id))"""

LADDER = """
case when rfm_score >= 321 then 'Champions' when rfm_score >= 311 then 'Loyal Customers'
     when rfm_score >= 131 then 'Potential Loyalists' when rfm_score >= 121 then 'New Customers'
     when rfm_score >= 221 then 'At Risk Customers' when rfm_score >= 211 then 'Can''t Lose Them'
     else 'Lost Customers' end"""
REACHABLE = """
case when rfm_score >= 321 then 'Champions' when rfm_score >= 311 then 'Loyal Customers'
     when rfm_score >= 221 then 'At Risk Customers' when rfm_score >= 211 then 'Can''t Lose Them'
     when rfm_score >= 131 then 'Potential Loyalists' when rfm_score >= 121 then 'New Customers'
     else 'Lost Customers' end"""

PERFORMANCE = """
select product_id, product_name, cast(sum(quantity) as bigint) total_units_sold,
       cast(sum(line_total) as double) total_revenue,
       cast(sum(discount) as double) / count(discount) avg_discount,
       count(distinct order_id) order_count
from items group by product_id, product_name"""

AFFINITY = """
select a.product_id product_a_id, a.product_name product_a_name,
       b.product_id product_b_id, b.product_name product_b_name, count(*) "count"
from (select distinct order_id, product_id, product_name from items) a
join (select distinct order_id, product_id, product_name from items) b
  on a.order_id = b.order_id and a.product_id < b.product_id
group by all"""

LIVE_ORDERS = _with("""
select order_id, customer_id, cast(order_date as date) order_date, status,
       cast(total_amount as double) total_amount, op, lsn
from live_orders""")


def _profile(log: str, entity: str) -> str:
    return f"""
select '{entity}' entity, 'row_count' metric, cast(0 as bigint) place, count(*) "value" from {log}
union all select '{entity}', 'op:' || op, 0, count(*) from {log} group by op
union all select '{entity}', 'deleted:' || cast(is_deleted as varchar), 0, count(*)
          from {log} group by is_deleted
union all select '{entity}', 'distinct_ops', 0, count(distinct op) from {log}
union all select '{entity}', 'distinct_keys', 0, count(*) from {entity}_versions where rn = 1
union all select '{entity}', 'latest_count', 0, count(*) from {entity}_versions where rn = 1
union all select '{entity}', 'active_count', 0, count(*) from {entity}_versions
          where rn = 1 and not is_deleted
union all select '{entity}', 'version:' || rn, rn, count(*) from {entity}_versions group by rn"""


def _versions(log: str, entity: str, key: str) -> str:
    return f"""{entity}_versions as (
  select *, row_number() over (partition by {key} order by ts_ms desc, lsn desc) rn from {log})"""


def _rules(entity: str, source: str, rules: dict[str, str]) -> str:
    return "\nunion all ".join(
        f"select '{entity}' entity, '{rule}' rule, count(*) violations from {source} where {broken}"
        for rule, broken in rules.items()
    )


def _repeated(entity: str, source: str, columns: str) -> str:
    return f"""
select '{entity}' entity, '{columns}' "columns", count(*) repeated_values,
       cast(coalesce(sum(n), 0) as bigint) rows_affected
from (select count(*) n from {source} group by {columns} having count(*) > 1)"""


def _lengths(**longest: int) -> dict[str, str]:
    return {f"{name} at most {n} characters": f"length({name}) > {n}" for name, n in longest.items()}


def _long(key: str, n: int, length: int, name: str) -> str:
    return f"case when {key} % {n} = 0 then repeat('x', {length + 1}) else repeat('x', {length}) end {name}"


FAULTY = f"""
faulty_customers as (
  select case when c_custkey % 47 = 0 then null else c_custkey end customer_id,
         case when c_custkey % 31 = 0 then null when c_custkey % 37 = 0 then repeat('x', 51) else repeat('x', 50) end first_name,
         case when c_custkey % 41 = 0 then null when c_custkey % 29 = 0 then repeat('x', 51) else repeat('x', 50) end last_name,
         case when c_custkey % 11 = 0 then null when c_custkey % 43 = 0 then repeat('x', 101)
              when c_custkey % 13 = 0 then concat('shared', c_custkey % 26, '@example.org')
              else concat(c_name, '@example.org') end email,
         {_long("c_custkey", 17, 20, "phone")}, {_long("c_custkey", 19, 200, "address")},
         {_long("c_custkey", 23, 50, "city")}, {_long("c_custkey", 27, 50, "state")},
         {_long("c_custkey", 33, 20, "zip_code")}
  from customer),
faulty_orders as (
  select case when order_id % 101 = 0 then null else order_id end order_id,
         case when order_id % 89 = 0 then customer_id + 1000000000000 else customer_id end customer_id,
         case when order_id % 7 = 0 then 'unknown' when order_id % 59 = 0 then repeat('x', 21) else status end status,
         case when order_id % 53 = 0 then null else total_amount end total_amount,
         {_long("order_id", 61, 50, "payment_method")}, {_long("order_id", 67, 200, "shipping_address")},
         {_long("order_id", 71, 50, "shipping_city")}, {_long("order_id", 73, 50, "shipping_state")},
         {_long("order_id", 79, 20, "shipping_zip")}
  from (select * from shop_orders)),
faulty_items as (
  select case when item_id % 103 = 0 then null else item_id end item_id,
         case when item_id % 107 = 0 then null when item_id % 109 = 0 then repeat('x', 101) else product_name end product_name,
         case when item_id % 137 = 0 then repeat('x', 51) else product_id end product_id,
         case when item_id % 113 = 0 then null when item_id % 127 = 0 then 0 else quantity end quantity,
         case when item_id % 131 = 0 then null else unit_price end unit_price
  from (select * from items))"""

DAMAGED = """
damaged as (
  select order_id, kind,
         case when kind = 1 then 'tombstone' when kind in (2, 3) then 'unreadable' when kind = 4 then 'missing key'
              when kind = 5 then 'missing operation' when kind in (6, 9) then 'bad numeric'
              when kind = 12 then 'unknown operation' else 'bad value' end reject_reason,
         case kind
           when 2 then 'not json'
           when 3 then '{"payload":null}'
           when 4 then '{"payload":{' || op || tail
           when 5 then start || tail
           when 6 then start || '"total_amount":"AAAAAAAAAAAB",' || op || tail
           when 7 then start || '"total_amount":"!!!",' || op || tail
           when 8 then start || '"total_amount":1234,' || op || tail
           when 9 then start || '"total_amount":"",' || op || tail
           when 10 then start || '"customer_id":"abc",' || op || tail
           when 11 then start || '"customer_id":99999999999999999999,' || op || tail
           when 12 then start || '"__op":"x",' || tail
         end event_text
  from (select o_orderkey order_id, o_orderkey % 13 kind, '{"payload":{"order_id":' || o_orderkey || ',' start,
          '"__op":"c",' op, '"__lsn":1,"__source_ts_ms":1704067200000}}' tail from orders))"""


def _on_live_rows(sql: str) -> str:
    """The SQL of a report, over the folded logs instead of the tables."""
    return re.sub(r"\bitems\b", "job_items", re.sub(r"\bshop_orders\b", "job_orders", sql))


def _tall(name: str, keys: str, measures: str, body: str) -> str:
    row_key = ", ".join(f'cast("{k}" as varchar)' for k in keys.split())
    return "\nunion all ".join(
        f"""select '{name}' table_name, concat_ws('|', {row_key}) row_key, '{m}' measure, cast("{m}" as double) "value"
from ({_on_live_rows(body)})"""
        for m in measures.split()
    )


SALES_MEASURES = "total_sales order_count avg_order_value avg_per_order"
WEEK = 'cast(weekofyear(order_date) as int) as "week"'
JOB_TABLES = _with(
    "\nunion all ".join([
        _tall("daily_sales", "order_date", SALES_MEASURES,
              _period_body("cast(order_date as date) order_date", "cast(order_date as date)")),
        _tall("weekly_sales", "year week", SALES_MEASURES,
              _period_body(f'cast(year(order_date) as int) as "year", {WEEK}', "year(order_date), weekofyear(order_date)")),
        _tall("weekly_sales_iso", "iso_year week", SALES_MEASURES,
              _period_body(f"cast(isoyear(order_date) as int) iso_year, {WEEK}",
                           "isoyear(order_date), weekofyear(order_date)")),
        _tall("monthly_sales", "year_month", SALES_MEASURES, _period_body(f"{MONTH} year_month", MONTH)),
        _tall("sales_by_status", "status", "order_count total_amount",
              "select status, count(order_id) order_count, sum(total_amount) total_amount from shop_orders group by status"),
        _tall("customer_cohorts", "registration_cohort order_month", "active_customers total_spent", """
select strftime(registration_date, '%Y-%m') registration_cohort, strftime(order_date, '%Y-%m') order_month,
       count(distinct customer_id) active_customers, sum(total_amount) total_spent
from shop_orders join customers using (customer_id) group by 1, 2"""),
        _tall("customer_rfm", "customer_id segment first_name last_name email",
              "recency frequency monetary r_score f_score m_score rfm_score", f"select *, {LADDER} segment from rfm"),
        _tall("customer_segments", "segment", "customer_count",
              f"select {LADDER} segment, count(*) customer_count from rfm group by 1"),
        _tall("product_performance", "product_id product_name",
              "total_units_sold total_revenue avg_discount order_count", PERFORMANCE),
        _tall("product_affinity", "product_a_id product_a_name product_b_id product_b_name", "count", AFFINITY),
        *[_tall("change_log_profile", "entity metric", "place value", _profile(log, entity)) for log, entity in
          (("order_log", "orders"), ("item_log", "order_items"), ("customer_log", "customers"))],
    ]),
    """job_orders as (select order_id, customer_id, order_date, status, total_amount from live_orders),
job_items as (
  select item_id, order_id, product_id, product_name, quantity, unit_price, discount,
         cast(quantity * unit_price * (1 - discount) as decimal(18,4)) line_total
  from live_items)""",
    _on_live_rows(RFM),
    _versions("order_log", "orders", "order_id"),
    _versions("item_log", "order_items", "item_id"),
    _versions("customer_log", "customers", "customer_id"),
)

ORACLE: dict[str, str] = {
    "daily_sales": DAILY,
    "weekly_sales": _period(
        'cast(year(order_date) as int) as "year", cast(weekofyear(order_date) as int) as "week"',
        "year(order_date), weekofyear(order_date)",
    ),
    "weekly_sales_iso": _period(
        'cast(isoyear(order_date) as int) iso_year, cast(weekofyear(order_date) as int) as "week"',
        "isoyear(order_date), weekofyear(order_date)",
    ),
    "monthly_sales": _period(f"{MONTH} year_month", MONTH),
    "monthly_sales_without_cancelled": _period(
        f"{MONTH} year_month", MONTH, "where status <> 'cancelled'"
    ),
    "sales_by_status": _with("""
select status, count(order_id) order_count, cast(sum(total_amount) as double) total_amount
from shop_orders group by status"""),
    "customer_cohorts": _with("""
select strftime(registration_date, '%Y-%m') registration_cohort,
       strftime(order_date, '%Y-%m') order_month,
       count(distinct customer_id) active_customers, cast(sum(total_amount) as double) total_spent
from shop_orders join customers using (customer_id) group by 1, 2"""),
    "customer_rfm": _with(f"select *, {LADDER} segment from rfm", RFM),
    "customer_segments": _with(
        f"select {LADDER} segment, count(*) customer_count from rfm group by 1", RFM
    ),
    "customer_segments_reachable": _with(
        f"select {REACHABLE} segment, count(*) customer_count from rfm group by 1", RFM
    ),
    "product_performance": _with(PERFORMANCE),
    "top_products": _with(
        f"{PERFORMANCE} order by total_revenue desc, product_id, product_name limit 10"
    ),
    "product_affinity": _with(AFFINITY),
    "product_affinity_by_customer": _with("""
select product_a_id, product_a_name, count(*) partners, cast(sum("count") as bigint) customers from (
  select product_a_id, product_a_name, "count" from bought_together
  union all select product_b_id, product_b_name, "count" from bought_together
) group by 1, 2""", f"""bought_together as ({
        AFFINITY.replace("order_id", "customer_id").replace("from items", "from items join shop_orders using (order_id)")})"""),
    "top_product_pairs": _with(
        f"select * from ({AFFINITY}) order by \"count\" desc, product_a_id, product_a_name, "
        "product_b_id, product_b_name limit 10"
    ),
    "current_orders": LIVE_ORDERS,
    "current_order_items": _with("""
select item_id, order_id, product_id, quantity, cast(discount as double) discount, lsn
from live_items"""),
    "current_order_items_composite": _with("""
select item_id, order_id, product_id, quantity, cast(discount as double) discount, lsn
from live_order_products"""),
    "change_log_profile": _with(
        "\nunion all ".join([
            _profile("order_log", "orders"),
            _profile("item_log", "order_items"),
            _profile("customer_log", "customers"),
            _profile("order_log", "orders_by_customer"),
        ]),
        _versions("order_log", "orders_by_customer", "customer_id"),
        _versions("order_log", "orders", "order_id"),
        _versions("item_log", "order_items", "order_id, product_id"),
        _versions("customer_log", "customers", "customer_id"),
    ),
    "decode_change_events": _with("""
select order_id, customer_id, cast(order_date as date) order_date, status,
       cast(total_amount as double) total_amount, op, lsn, ts_ms changed_at_ms, is_deleted,
       cast(null as varchar) reject_reason
from order_log"""),
    "decode_order_item_events": _with("""
select item_id, product_id, product_name, quantity, cast(unit_price as double) unit_price,
       cast(discount as double) discount, lsn, is_deleted
from item_log"""),
    "quarantined_events": f"""
with {DAMAGED}
select reject_reason, event_text, count(*) events from damaged where kind > 0 group by 1, 2""",
    "incremental_since": _with("""
select op, count(*) changes, max(ts_ms) next_mark from order_log
where ts_ms > (select sum(ts_ms) // count(*) from order_log) group by op"""),
    "incremental_checkpoint_run": LIVE_ORDERS,
    "incremental_by_source_time": LIVE_ORDERS,
    "stream_ingest_orders": _with("""
select order_id, op, lsn, ts_ms source_ts_ms, is_deleted from order_log"""),
    "stream_ingest_metrics": _with("""
select 'customers' entity, count(*) total_rows_written, cast(0 as bigint) total_rows_rejected
from customers
union all
select 'orders', count(*) filter (order_id % 13 = 0), count(*) filter (order_id % 13 <> 0)
from shop_orders
union all
select 'order_items', count(*), 0 from item_log"""),
    "stream_ingest_new_checkpoint": LIVE_ORDERS,
    "stream_rejected_events": f"""
with {DAMAGED}
select reject_reason, count(*) events, max(order_id) last_offset from damaged where kind > 0 group by 1""",
    "results_roundtrip": DAILY,
    "batch_job_tables": JOB_TABLES,
    "batch_job_daily_sales": _with("""
select cast(order_date as date) order_date, cast(sum(line_total) as double) total_sales,
       count(distinct order_id) order_count,
       cast(sum(line_total) as double) / count(*) avg_order_value,
       cast(sum(line_total) as double) / count(distinct order_id) avg_per_order
from live_orders
join (select order_id, cast(quantity * unit_price * (1 - discount) as decimal(18,4)) line_total
      from live_items) using (order_id)
group by 1"""),
    "audit_constraints": _with("\nunion all ".join([
        _rules("customers", "faulty_customers", {
            "customer_id not null": "customer_id is null",
            "first_name not null": "first_name is null",
            "last_name not null": "last_name is null",
            "email not null": "email is null",
            **_lengths(first_name=50, last_name=50, email=100, phone=20, address=200, city=50, state=50, zip_code=20),
        }),
        _rules("orders", "faulty_orders", {
            "order_id not null": "order_id is null",
            "total_amount not null": "total_amount is null",
            **_lengths(status=20, payment_method=50, shipping_address=200, shipping_city=50, shipping_state=50,
                       shipping_zip=20),
            "status in domain":
                "status not in ('pending','processing','shipped','delivered','cancelled')",
        }),
        _rules("order_items", "faulty_items", {
            "item_id not null": "item_id is null",
            "product_name not null": "product_name is null",
            "quantity not null": "quantity is null",
            "unit_price not null": "unit_price is null",
            **_lengths(product_name=100, product_id=50),
            "quantity positive": "quantity <= 0",
        }),
    ]), FAULTY),
    "audit_foreign_keys": _with("""
select 'orders.customer_id -> customers.customer_id' relation,
       count(distinct customer_id) orphan_keys, count(*) orphan_rows
from faulty_orders o
where customer_id is not null
  and not exists (select 1 from customers c where c.customer_id = o.customer_id)
union all
select 'order_items.order_id -> orders.order_id', count(distinct order_id), count(*)
from items i where not exists (select 1 from live_orders o where o.order_id = i.order_id)""", FAULTY),
    "audit_uniqueness": _with("\nunion all ".join([
        _repeated("customers", "customers", "customer_id"),
        _repeated("customers", "(select * from faulty_customers where email is not null)", "email"),
        _repeated("orders", "shop_orders", "order_id"),
        _repeated("order_items", "items", "item_id"),
        _repeated("order_items", "items", "order_id, product_id"),
    ]), FAULTY),
    "audit_order_totals": _with("""
select order_id, cast(total_amount as double) total_amount, cast(expected as double) lines_total,
       cast(total_amount - expected as double) difference
from (select order_id, expected + case when order_id % 6 = 0 then 1 else 0 end total_amount, expected from (
  select order_id, cast(round_even(coalesce(s, 0), 2) as decimal(18,2)) expected
  from shop_orders left join (select order_id, sum(line_total) s from items group by order_id) using (order_id)))
where total_amount <> expected"""),
}
