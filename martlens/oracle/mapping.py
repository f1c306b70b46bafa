"""Retail mapping from the provided tables, as SQL CTEs (text of FIXTURES.md),
plus the base views.  Runs unchanged on DuckDB."""

MAPPING = r"""
r_customers AS (
 select c_custkey as customer_id,
 case when c_custkey%97=5 then null when c_custkey%89=3 then 'not-an-email-'||cast(c_custkey as string) when c_custkey%53=0 then 'shared'||cast(c_custkey%5 as string)||'@example.com' when c_custkey%61=0 then ' Shared1@Example.com ' else 'user'||cast(c_custkey as string)||'@example.com' end as email,
 'First'||cast(c_custkey as string) as first_name, c_name as last_name,
 DATE '1995-01-01' + cast((c_custkey*37)%2400 as int) as signup_date,
 case when c_custkey%101=7 then null else n_name end as country,
 case c_mktsegment when 'AUTOMOBILE' then 'Gold' when 'BUILDING' then 'Silver' when 'FURNITURE' then null else 'Bronze' end as customer_tier
 from customer join nation on c_nationkey=n_nationkey
),
r_products AS (
 select p_partkey as product_id, p_name as product_name, p_type as category, case when p_partkey%180=0 then null else p_brand end as subcategory,
 cast(case when p_partkey%50=9 then floor(p_retailprice)+25 else floor(p_retailprice*(40+p_partkey%40)/100) end as int) as unit_cost,
 cast(floor(p_retailprice) as int) as selling_price, DATE '1995-01-01' + cast((p_partkey*53)%2400 as int) as launch_date, p_partkey%10<>0 as is_active from part
),
r_order_items AS (
 select order_item_id, order_id, case when order_item_id%983=0 then 9000000 when pk%40=0 then pk+1 else pk end as product_id,
 cast(case when order_item_id%977=0 then 0 else qty end as int) as quantity, cast(floor(ext/qty) as int) as unit_price,
 cast(case when order_item_id%41=0 then null when order_item_id%991=0 then 130 else round(disc*100) end as int) as discount_percent
 from (select l_orderkey as order_id, l_partkey as pk, l_quantity as qty, l_extendedprice as ext, l_discount as disc,
  row_number() over (order by l_orderkey,l_linenumber,l_partkey,l_suppkey,l_quantity,l_extendedprice,l_discount,l_tax,l_shipdate) as order_item_id from lineitem) x
),
r_orders AS (
 select o_orderkey as order_id,
 case when o_orderkey%211=0 then null when o_orderkey%223=0 then 9000000+o_orderkey when o_custkey%25=0 then o_custkey+1 else o_custkey end as customer_id,
 case when o_orderkey%997=1 then null else cast(o_orderdate as date) end as order_date,
 case o_orderstatus when 'F' then 'Delivered' when 'O' then 'Pending' else 'Shipped' end as order_status,
 case o_orderkey%4 when 0 then 'UPI' when 1 then 'Card' when 2 then 'COD' else 'NetBanking' end as payment_method,
 n_name as shipping_country,
 case when o_orderkey%301=0 then null else cast(floor(o_totalprice) as int) end as total_amount,
 cast(case when o_orderkey%19=4 then null when o_orderkey%17=3 then net+1 else net end as decimal(18,2)) as final_total
 from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
 left join (select order_id as nid, cast(round(sum(quantity*unit_price*(100-coalesce(discount_percent,0)))/100.0,2) as decimal(18,2)) as net from r_order_items group by order_id) t on nid=o_orderkey
),
r_inventory AS (
 select p_partkey*2+w as inventory_id, p_partkey as product_id, case w when 0 then 'North' else 'South' end as warehouse_location, case when p_partkey%70=11 then -8 else cast((p_partkey*7919+w*31)%60 as int)-6 end as stock_quantity, TIMESTAMP '2001-07-01 00:00:00' as last_updated
 from part cross join (select 0 as w union all select 1 as w) ws where p_partkey%60<>0
),
r_customer_reviews AS (
 select order_item_id as review_id, product_id, case when order_item_id%5=0 then customer_id+7 else customer_id end as customer_id,
 cast(case when order_item_id%403=0 then 7 else 1+order_item_id%5 end as int) as rating, case when order_item_id%11=0 then null else 'review text' end as review_text, order_date+10 as review_date, order_item_id%3<>0 as is_verified_purchase
 from (select i.order_item_id,i.product_id,o.customer_id,o.order_date from r_order_items i join r_orders o on i.order_id=o.order_id where i.order_item_id%13=0) x
),
r_promotions AS (
 select n_nationkey+1 as promotion_id, 'PROMO'||cast(n_nationkey as string) as promotion_code, case when n_nationkey%2=0 then 'percentage' else 'fixed_amount' end as discount_type, 5+n_nationkey%20 as discount_value,
 DATE '1995-01-01'+ cast(n_nationkey*80 as int) as start_date, DATE '1995-01-01'+ cast(n_nationkey*80+60 as int) as end_date, 50+n_nationkey as max_uses, case when n_nationkey%6=1 then 90 else 20 end as times_used from nation
),
r_promotion_usage AS (
 select o_orderkey*2 as usage_id, cast(1+o_orderkey%30 as int) as promotion_id, o_orderkey as order_id, true as discount_applied, cast(o_orderdate as date) as used_date from orders where o_orderkey%7=0
 union all select o_orderkey*2+1, cast(1+(o_orderkey+11)%30 as int), o_orderkey, true, cast(o_orderdate as date) from orders where o_orderkey%35=0
),
r_dq_issues AS (
 select event_id as id, 'check_'||cast(user_id%7 as string) as check_name, case event_id%4 when 0 then 'HIGH' when 1 then 'High' when 2 then 'MEDIUM' else 'CRITICAL' end as severity, event_id%50 as row_count, cast(event_id as string) as sample_ids, 'detail '||cast(event_id%3 as string) as details, ts as detected_at from events where event_type='error'
),
r_data_fix_audit AS (
 select event_id as audit_id, 'check_'||cast(user_id%7 as string) as check_name, ts as fix_date, 'SYSTEM_AUTO_HEAL' as fixed_by from events where event_type='signup' and user_id%7<3
)
"""

# Base views (semantic layer). net_amount = q*p*(1 - d/100) kept exact as
# hundredths * 0.01 so sums are exact decimals.
VIEWS = r"""
v_orders AS (
 select order_id, customer_id, order_date, cast(date_trunc('month', order_date) as date) as order_month,
  order_status, payment_method, shipping_country, final_total from r_orders
),
v_items AS (
 select order_item_id, order_id, product_id, quantity, unit_price, discount_percent,
  cast(cast(quantity as bigint)*unit_price*(100-discount_percent) as decimal(20,0)) * 0.01 as net_amount
 from r_order_items
),
v_products AS (
 select product_id, product_name, category, subcategory, unit_cost, selling_price, launch_date, is_active from r_products
),
v_customers AS (
 select customer_id, signup_date, country, customer_tier from r_customers
),
v_reviews AS (
 select product_id, customer_id, rating, review_date from r_customer_reviews where is_verified_purchase = true
),
v_inventory AS (
 select product_id, cast(sum(stock_quantity) as bigint) as current_stock, max(last_updated) as last_updated
 from r_inventory group by product_id
)
"""


def with_prefix(body: str) -> str:
    """``body`` is either a bare SELECT or extra CTEs ``name AS (...), ... SELECT``.

    Extra CTEs are written ``, name AS (...)`` — starting with a comma."""
    body = body.strip()
    if body.startswith(","):
        return "WITH " + MAPPING.strip() + ",\n" + VIEWS.strip() + "\n" + body
    return "WITH " + MAPPING.strip() + ",\n" + VIEWS.strip() + "\n" + body


def R(expr: str, n: int) -> str:
    """ROUND half away from zero on a ratio, same rule as functions.exprs.rnd."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS DOUBLE) AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def DIV(num: str, den: str) -> str:
    """num / NULLIF(den, 0) in double."""
    return f"(CAST(({num}) AS DOUBLE) / NULLIF(CAST(({den}) AS DOUBLE), 0))"
