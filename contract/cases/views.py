"""Views and business queries."""

from contract.mapping import AS_OF, mean, money, pct, sql
from contract.registry import case
from tillgrain.plans import kpis, queries as q, views as v

DAY = f"date '{AS_OF}'"

# ---- views

case("VW1_monthly_revenue", v.monthly_revenue, sql(f"""
select month as month_start, cast(extract(year from month) as int) as year, cast(extract(month from month) as int) as month,
  n as total_orders, {money('rc')} as total_revenue, {money('pc')} as total_profit, cast(units as bigint) as units_sold,
  {mean('rc', 'n')} as avg_order_value from by_month""", "by_month"))

case("VW2_sales_summary", v.sales_summary, sql(f"""
select count(distinct order_id) as total_orders, {money('sum(rc)')} as total_revenue, {money('sum(pc)')} as total_profit,
  {pct('sum(pc)', 'sum(rc)')} as profit_margin_pct, {mean('sum(rc)', 'count(*)')} as avg_order_value,
  count(distinct customer_id) as active_customers, cast(sum(quantity) as bigint) as units_sold from sold""", "sold"))

case("VW3_customer_summary", lambda s: v.customer_summary(s, AS_OF), sql(f"""
select c.customer_id, customer_name, region, customer_segment, customer_status, coalesce(n,0) as total_orders,
  {money('coalesce(rc,0)')} as total_revenue, {money('coalesce(pc,0)')} as total_profit, first_day as first_purchase_date,
  last_day as last_purchase_date, cast({DAY}-last_day as int) as days_since_last_purchase
from customers c left join cust k on k.customer_id=c.customer_id""", "customers", "cust"))

case("VW4_product_summary", v.product_summary, sql(f"""
select p.product_id, product_name, category, sub_category, count(o.order_id) as total_orders,
  cast(coalesce(sum(o.quantity),0) as bigint) as units_sold, {money('coalesce(sum(rc),0)')} as total_revenue,
  {money('coalesce(sum(pc),0)')} as total_profit, {pct('coalesce(sum(pc),0)', 'sum(rc)')} as profit_margin_pct,
  cast(coalesce(sum(r.n),0) as bigint) as return_count, {mean('sum(dt)*100', 'count(dt)', 10000)} as avg_discount_pct
from products p left join sold o on o.product_id=p.product_id left join ret_order r on r.order_id=o.order_id
group by p.product_id, product_name, category, sub_category""", "products", "sold", "ret_order"))

case("VW5_region_summary", v.region_summary, sql(f"""
select region, count(distinct c.customer_id) as customer_count, count(o.order_id) as total_orders,
  {money('coalesce(sum(rc),0)')} as total_revenue, {money('coalesce(sum(pc),0)')} as total_profit,
  {pct('coalesce(sum(pc),0)', 'sum(rc)')} as profit_margin_pct
from customers c left join sold o on o.customer_id=c.customer_id group by region""", "customers", "sold"))

case("VW6_salesperson_summary", v.salesperson_summary, sql(f"""
select e.employee_id, employee_name, region, department, cast(target_amount as double) as annual_target,
  coalesce(n,0) as total_orders, {money('coalesce(rc,0)')} as total_revenue, {money('coalesce(pc,0)')} as total_profit,
  coalesce(buyers,0) as customer_count, {pct('coalesce(rc,0)', 'target_amount*100')} as target_achievement_pct
from employees e left join emp k on k.employee_id=e.employee_id""", "employees", "emp"))

_BASE = (("customers", "cust"), f"""
select customer_id, customer_name, cast({DAY}-last_day as int) as recency_days, n as frequency, rc as mc
from cust join customers using (customer_id)""")
_SCORED = (("base",), """
select *, cast(ntile(5) over (order by recency_days desc, customer_id) as int) as r_score,
  cast(ntile(5) over (order by frequency, customer_id) as int) as f_score,
  cast(ntile(5) over (order by mc, customer_id) as int) as m_score from base""")
# The segments and their scores, in the order in which they are tried.
SEGMENT = """case when r_score>=4 and f_score>=4 and m_score>=4 then 'Champions' when r_score>=3 and f_score>=3 then 'Loyal Customers'
  when r_score>=4 and f_score<=2 then 'New Customers' when r_score>=3 and f_score<=3 and m_score>=3 then 'Potential Loyalists'
  when r_score<=2 and f_score>=4 and m_score>=4 then 'Can''t Lose Them' when r_score<=2 and f_score>=3 then 'At Risk'
  when r_score<=2 and f_score<=2 and m_score<=2 then 'Lost Customers' else 'Hibernating' end"""
SEGMENTED = {"base": _BASE, "scored": _SCORED,
             "seg": (("scored",), f"select *, r_score+f_score+m_score as rfm_score, {SEGMENT} as segment from scored")}

case("VW7_rfm_base", lambda s: v.rfm_base(s, AS_OF), sql(
    f"select customer_id, customer_name, recency_days, frequency, {money('mc')} as monetary from base", base=_BASE))

case("VW8_rfm_segments", lambda s: v.rfm_segments(s, AS_OF), sql(f"""
select customer_id, customer_name, recency_days, frequency, {money('mc')} as monetary, r_score, f_score, m_score,
  cast(rfm_score as int) as rfm_score, segment from seg""", **SEGMENTED))

case("VW9_customer_churn", v.customer_churn, sql("""
select customer_id, customer_name, region, customer_segment, cast(churn_probability as double) as churn_probability,
  churn_prediction, risk_level from churn join customers using (customer_id)""", "churn", "customers"))

# ---- business queries

case("BQ01_top_customers", q.top_customers, sql(f"""
select customer_id, customer_name, {money('rc')} as total_revenue from cust join customers using (customer_id)
order by rc desc, customer_id limit 10""", "cust", "customers"))
case("BQ02_top_products", q.top_products, sql(f"""
select product_id, product_name, {money('rc')} as total_revenue from prod join products using (product_id)
order by rc desc, product_id limit 10""", "prod", "products"))
_REVENUE_BY_MONTH = sql(f"select month, {money('rc')} as revenue from by_month", "by_month")
case("BQ03_monthly_revenue", q.revenue_by_month, _REVENUE_BY_MONTH)
case("BQ04_monthly_profit", q.profit_by_month,
     sql(f"select month, {money('pc')} as profit from by_month", "by_month"))
case("BQ05_yearly_growth", q.yearly_growth, sql(f"""
select yr, {money('rc')} as revenue, {money('pr')} as prev_year_revenue, {pct('rc-pr', 'pr')} as yoy_growth_pct
from (select *, lag(rc) over (order by yr) as pr from (select y as yr, sum(rc) as rc from sold group by y))""", "sold"))
case("BQ06_monthly_growth", q.monthly_growth, sql(f"""
select month, {money('rc')} as revenue, {money('pr')} as prev_month_revenue, {pct('rc-pr', 'pr')} as mom_growth_pct
from (select *, lag(rc) over (order by month) as pr from by_month)""", "by_month"))
case("BQ07_region_ranking", q.region_ranking, sql(f"""
select region, {money('rc')} as revenue, cast(rank() over (order by rc desc) as int) as region_rank from by_region""", "by_region"))
case("BQ08_salesperson_ranking", q.salesperson_ranking, sql(f"""
select employee_id, employee_name, {money('rc')} as revenue, cast(dense_rank() over (order by rc desc) as int) as sales_rank
from emp join employees using (employee_id)""", "emp", "employees"))
_ACTIVE = (("sold",), """
select *, lag(m) over (partition by customer_id order by m) as before from (select distinct customer_id, m from sold)""")
case("BQ09_retention", q.retention, sql("""
select m as month, count(*) filter (where before = m - interval 1 month) as retained_customers, count(*) as total_active_customers
from active group by m""", active=_ACTIVE))
case("BQ10_repeat_customers", q.repeat_customers,
     sql("select customer_id, n as order_count from cust where n > 1", "cust"))
case("BQ11_order_value_by_segment", q.order_value_by_segment, sql(f"""
select customer_segment, {mean('sum(rc)', 'count(*)')} as avg_order_value from sold join customers using (customer_id)
group by customer_segment""", "sold", "customers"))
case("BQ12_running_revenue", q.running_revenue, sql(f"""
select month, {money('rc')} as revenue, {money('sum(rc) over (order by month rows unbounded preceding)')} as running_total
from by_month""", "by_month"))
case("BQ13_region_share", q.region_share, sql(f"""
select region, {money('rc')} as revenue, {pct('rc', 'sum(rc) over ()')} as pct_of_total from by_region""", "by_region"))
case("BQ14_product_margins", q.product_margins, sql(f"""
select product_id, product_name, {money('rc')} as revenue, {money('pc')} as profit, {pct('pc', 'rc')} as margin_pct
from prod join products using (product_id)""", "prod", "products"))
case("BQ15_declining_customers", lambda s: q.declining_customers(s, AS_OF), sql(f"""
select coalesce(r.customer_id,p.customer_id) as customer_id, {money('coalesce(r.c,0)')} as rev_recent, {money('coalesce(p.c,0)')} as rev_prior
from (select customer_id, sum(rc) as c from sold where order_date >= {DAY} - interval 3 month group by customer_id) r
full join (select customer_id, sum(rc) as c from sold where order_date >= {DAY} - interval 6 month and order_date < {DAY} - interval 3 month
  group by customer_id) p on r.customer_id=p.customer_id
where coalesce(r.c,0) < coalesce(p.c,0)""", "sold"))
case("BQ16_lapsed_customers", lambda s: q.lapsed_customers(s, AS_OF), sql(f"""
select c.customer_id, customer_name, last_day as last_purchase from customers c left join cust k on k.customer_id=c.customer_id
where last_day is null or last_day < {DAY} - interval 90 day""", "customers", "cust"))
case("BQ17_target_achievement", lambda s: q.target_achievement(s, AS_OF), sql(f"""
select e.employee_id, employee_name, {money('tc')} as annual_target, {money('coalesce(c,0)')} as actual_revenue,
  {pct('coalesce(c,0)', 'tc')} as achievement_pct
from employees e join (select employee_id, sum(cast(target_amount*100 as bigint)) as tc from targets where year = 2001 group by employee_id) t
  on t.employee_id=e.employee_id
left join (select employee_id, sum(rc) as c from sold where y = 2001 group by employee_id) o on o.employee_id=e.employee_id""",
    "employees", "targets", "sold"))
case("BQ18_top_products_per_region", q.top_products_per_region, sql(f"""
select region, product_name, {money('c')} as revenue from (
  select region, product_name, sum(rc) as c, row_number() over (partition by region order by sum(rc) desc, product_name) as rn
  from sold join customers using (customer_id) join products using (product_id) group by region, product_name) where rn <= 5""",
    "sold", "customers", "products"))
_CATEGORIES = sql(f"select category, {money('rc')} as revenue, {money('pc')} as profit from by_category", "by_category")
case("BQ19_category_totals", q.category_totals, _CATEGORIES)
case("BQ20_quarterly", q.quarterly, sql(f"""
select y as year, cast(extract(quarter from order_date) as int) as quarter, {money('sum(rc)')} as revenue, {money('sum(pc)')} as profit
from sold group by 1, 2""", "sold"))
case("BQ21_lifetime_value", q.lifetime_value, sql(f"""
select customer_id, {money('rc')} as lifetime_revenue, {money('pc')} as lifetime_profit, n as total_orders from cust""", "cust"))
case("BQ22_first_and_repeat", q.first_and_repeat, sql(f"""
select case when k = 1 then 'First Purchase' else 'Repeat Purchase' end as purchase_type, {money('sum(rc)')} as revenue, count(*) as orders
from (select rc, row_number() over (partition by customer_id order by order_date, order_id) as k from sold) group by 1""", "sold"))
_RATE = f"""
select product_id, product_name, total_orders, cast(total_returns as bigint) as total_returns,
  {pct('total_returns', 'total_orders')} as return_rate_pct from rate join products using (product_id)"""
case("BQ23_return_rates", q.return_rates, sql(_RATE, "rate", "products"))
case("BQ24_discount_impact", q.discount_impact, sql("""
select case when dt = 0 then '0%' when dt <= 1000 then '1-10%' when dt <= 2000 then '11-20%' else '20%+' end as discount_band,
  round(avg(cast(pc as double)/rc)*100,2) as avg_margin_pct, count(*) as orders from sold where rc > 0 group by 1""", "sold"))
case("BQ25_high_value_customers", q.high_value_customers, sql(f"""
select customer_id, {money('rc')} as revenue from (
  select customer_id, rc, ntile(20) over (order by rc desc, customer_id) as b from cust) where b = 1""", "cust"))
case("BQ26_at_risk_customers", lambda s: q.at_risk_customers(s, AS_OF), sql(f"""
select customer_id, customer_name, recency_days, frequency, {money('mc')} as monetary, segment from seg
where segment in ('At Risk','Can''t Lose Them')""", **SEGMENTED))
case("BQ27_revenue_concentration", q.revenue_concentration, sql(f"""
select quintile, {money('c')} as revenue, {pct('c', 'sum(c) over ()')} as pct_of_total from (
  select quintile, sum(rc) as c from (select rc, cast(ntile(5) over (order by rc desc, customer_id) as int) as quintile from cust)
  group by quintile)""", "cust"))
case("BQ28_salesperson_months", q.salesperson_months, sql(f"""
select employee_id, m as month, {money('c')} as revenue, {money('lag(c) over (partition by employee_id order by m)')} as prev_month_revenue
from (select employee_id, m, sum(rc) as c from sold group by employee_id, m)""", "sold"))
case("BQ29_region_margins", q.region_margins,
     sql(f"select region, {pct('pc', 'rc')} as margin_pct from by_region", "by_region"))
case("BQ30_forecast_input", q.forecast_input, _REVENUE_BY_MONTH)
ACQUIRED = sql("""
select cast(date_trunc('month', acquisition_date) as date) as month, count(*) as new_customers from customers group by 1""", "customers")
case("BQ31_acquisition_by_month", q.acquisition_by_month, ACQUIRED)
case("BQ32_most_discounted", q.most_discounted, sql(f"""
select product_id, product_name, d as avg_discount_pct from (
  select product_id, {mean('sum(dt)*100', 'count(*)', 10000)} as d from orders_x group by product_id) join products using (product_id)
order by d desc, product_id limit 10""", "orders_x", "products"))

# ---- indicators

case("K01_headline", kpis.headline, sql(f"""
select {money('sum(rc)')} as total_revenue, {money('sum(pc)')} as total_profit, {pct('sum(pc)', 'sum(rc)')} as profit_margin_pct,
  count(distinct order_id) as total_orders, count(distinct customer_id) as active_customers from sold""", "sold"))
case("K02_average_order_value", kpis.average_order_value,
     sql(f"select {mean('sum(rc)', 'count(*)')} as avg_order_value from sold", "sold"))
case("K03_average_profit", kpis.average_profit,
     sql(f"select {mean('sum(pc)', 'count(*)')} as avg_profit_per_order from sold", "sold"))
case("K04_retention_rate", kpis.retention_rate, sql(f"""
select c.m as month, count(distinct c.customer_id) as active_customers, count(distinct p.customer_id) as retained_from_prior_month,
  {pct('count(distinct p.customer_id)', 'count(distinct c.customer_id)')} as retention_rate_pct
from (select distinct customer_id, m from sold) c
left join (select distinct customer_id, m from sold) p on p.customer_id=c.customer_id and p.m = c.m - interval 1 month
group by c.m""", "sold"))
case("K05_churn_rate", kpis.churn_rate, sql(f"""
select {pct('count(*) filter (where churn_prediction = 1)', 'count(*)')} as churn_rate_pct from churn""", "churn"))
case("K06_average_lifetime_value", kpis.average_lifetime_value,
     sql(f"select {mean('sum(rc)', 'count(*)')} as avg_customer_lifetime_value from cust", "cust"))
case("K07_target_achievement", lambda s: kpis.target_achievement(s, AS_OF), sql(f"""
select {money('sum(tc)')} as total_target, {money('sum(coalesce(c,0))')} as total_actual, {pct('sum(coalesce(c,0))', 'sum(tc)')} as achievement_pct
from (select employee_id, year, month, sum(cast(target_amount*100 as bigint)) as tc from targets where year = 2001 group by all) t
left join (select employee_id, y, cast(extract(month from order_date) as int) as mo, sum(rc) as c from sold group by all) o
  on o.employee_id=t.employee_id and o.y=t.year and o.mo=t.month""", "targets", "sold"))
case("K08_best_selling_product", kpis.best_selling_product, sql("""
select product_id, product_name, cast(units as bigint) as units_sold from prod join products using (product_id)
order by units desc, product_id limit 1""", "prod", "products"))
case("K09_highest_revenue_product", kpis.highest_revenue_product, sql(f"""
select product_id, product_name, {money('rc')} as revenue from prod join products using (product_id) order by rc desc, product_id limit 1""",
    "prod", "products"))
case("K10_highest_profit_product", kpis.highest_profit_product, sql(f"""
select product_id, product_name, {money('pc')} as profit from prod join products using (product_id) order by pc desc, product_id limit 1""",
    "prod", "products"))
case("K11_lowest_margin_product", kpis.lowest_margin_product, sql(f"""
select product_id, product_name, {pct('pc', 'rc')} as margin_pct from prod join products using (product_id) where rc > 0
order by margin_pct, product_id limit 1""", "prod", "products"))
