"""Report pages, insights, measures and the values pages derive."""

from pyspark.sql import functions as F

from contract.cases.views import ACQUIRED, SEGMENTED
from contract.mapping import AS_OF, mean, money, pct, sql, text1
from contract.registry import case
from tillgrain.operators import rfm
from tillgrain.operators.scope import (Filters, enriched_orders, equals_if_given, page_info,
                                       page_of, scoped_orders)
from tillgrain.plans import blocks as b, client as u, insights as i, measures as m

DAY = f"date '{AS_OF}'"

# A narrow filter that touches every dimension, and its SQL over the joined rows.
NARROW = Filters(date_from="1996-02-10", date_to="2000-11-20", region="ASIA",
                 customer_segment="MACHINERY", category="PROMO")
NARROW_SQL = ("order_date between date '1996-02-10' and date '2000-11-20' and c.region='ASIA' "
              "and customer_segment='MACHINERY' and category='PROMO'")
PERSON = Filters(salesperson="Supplier#000000007", date_from="1997-01-01")
JOINED = (("sold", "customers", "products", "employees"), """
select o.*, c.region, c.customer_segment, c.customer_status, c.customer_name, p.category, p.product_name, e.employee_name
from sold o join customers c using (customer_id) join products p using (product_id) join employees e using (employee_id)""")


def joined(where: str) -> dict:
    return {"o": (("sold", "customers", "products", "employees"), f"""
select o.*, c.region, c.customer_segment, p.category, p.product_name, e.employee_name, e.region as home
from sold o join customers c using (customer_id) join products p using (product_id) join employees e using (employee_id)
where {where}""")}


ALL, FEW = joined("true"), joined(NARROW_SQL)
ONE = joined("employee_name='Supplier#000000007' and order_date >= date '1997-01-01'")

# ---- filters, search, pages

case("F01_filters", lambda s: scoped_orders(s, NARROW).select("order_id", "revenue"),
     sql(f"select order_id, {money('rc')} as revenue from o", **FEW))
case("F01_filter_salesperson", lambda s: scoped_orders(s, PERSON).select("order_id", "order_date"),
     sql("select order_id, order_date from o", **ONE))
case("F02_enriched_orders", lambda s: enriched_orders(
    s, columns=["order_id", "revenue", "customer_name", "region", "category", "employee_name"]),
    sql(f"""select order_id, {money('rc')} as revenue, customer_name, region, category, employee_name from j""", j=JOINED))
case("F03_search", lambda s: b.matching_customers(s, search="r#0000007").select("customer_id", "customer_name"),
     sql("""select customer_id, customer_name from customers where customer_name ilike '%r#0000007%'
or cast(customer_id as varchar) ilike '%r#0000007%'""", "customers"))
case("F04_page", lambda s: page_of(b.customer_list(s), [F.desc("total_revenue"), F.asc("customer_id")], 3, 40)
     .select("customer_id", "total_revenue"),
     sql(f"""select c.customer_id, {money('coalesce(rc,0)')} as total_revenue from customers c left join cust k on k.customer_id=c.customer_id
order by coalesce(rc,0) desc, c.customer_id limit 40 offset 80""", "customers", "cust"))
case("F05_equality_filter", lambda s: equals_if_given(s.churn, "risk_level", "High").select("customer_id", "risk_level"),
     sql("select customer_id, risk_level from churn where risk_level='High'", "churn"))
case("F06_page_count", lambda s: page_info(s.customers, 2, 40), sql("""
select 2 as page, 40 as page_size, count(*) as total_rows, cast(greatest(1, ceil(count(*)/40.0)) as int) as page_count from customers""",
    "customers"))

# ---- dashboard

_KPIS = f"""
select count(distinct order_id) as total_orders, {money('coalesce(sum(rc),0)')} as total_revenue, {money('coalesce(sum(pc),0)')} as total_profit,
  {pct('coalesce(sum(pc),0)', 'sum(rc)')} as profit_margin_pct, count(distinct customer_id) as active_customers from o"""
case("A01_dashboard_kpis", b.dashboard_kpis, sql(_KPIS, **ALL))
case("A01_dashboard_kpis_filtered", lambda s: b.dashboard_kpis(s, NARROW), sql(_KPIS, **FEW))


def _trailing(source: str) -> str:
    return f"""(select sum(rc) filter (where order_date > d - interval 12 month) as t,
  sum(rc) filter (where order_date <= d - interval 12 month and order_date > d - interval 24 month) as p
  from {source}, (select max(order_date) as d from {source}))"""


_GROWTH = f"select {pct('t-p', 'p')} as yoy_growth_pct from {_trailing('o')}"
case("A02_dashboard_growth", b.dashboard_growth, sql(_GROWTH, **ALL))
case("A02_dashboard_growth_filtered", lambda s: b.dashboard_growth(s, NARROW), sql(_GROWTH, **FEW))
_TREND = f"select m as month, {money('sum(rc)')} as revenue, {money('sum(pc)')} as profit from o group by m"
case("A03_revenue_trend", b.revenue_trend, sql(_TREND, **ALL))
case("A03_revenue_trend_salesperson", lambda s: b.revenue_trend(s, PERSON), sql(_TREND, **ONE))
_REGIONS = f"select region, {money('sum(rc)')} as revenue from o group by region"
case("A04_revenue_by_region", b.revenue_by_region, sql(_REGIONS, **ALL))
case("A04_revenue_by_region_salesperson", lambda s: b.revenue_by_region(s, PERSON), sql(_REGIONS, **ONE))
case("A05_revenue_by_category", b.revenue_by_category,
     sql(f"select category, {money('sum(rc)')} as revenue from o group by category", **ALL))
_TOP = f"select product_name, {money('sum(rc)')} as revenue from o group by product_name order by sum(rc) desc, product_name limit 10"
case("A06_top_product_names", b.top_product_names, sql(_TOP, **ALL))
case("A06_top_product_names_filtered", lambda s: b.top_product_names(s, NARROW), sql(_TOP, **FEW))
case("A07_buyers_by_segment", b.buyers_by_segment, sql(
    "select customer_segment, count(distinct customer_id) as customer_count from o group by customer_segment", **ALL))

# ---- sales

case("A08_sales_trend", b.sales_trend, sql(
    f"select m as month, {money('sum(rc)')} as revenue, count(distinct order_id) as orders from o group by m", **ALL))
_ATTAINED = f"""select e.employee_id, employee_name, region, {money('coalesce(tc,0)')} as target_amount,
  {money('coalesce(rc,0)')} as actual_revenue, {pct('coalesce(rc,0)', 'tc')} as achievement_pct
from employees e left join plan t on t.employee_id=e.employee_id left join emp k on k.employee_id=e.employee_id"""
case("A09_target_vs_actual", b.target_vs_actual, sql(_ATTAINED, "employees", "plan", "emp"))
_RANKED = f"""select employee_id, employee_name, home as region, {money('sum(rc)')} as revenue,
  cast(rank() over (order by sum(rc) desc) as int) as rank from o group by employee_id, employee_name, home"""
case("A10_salesperson_ranking", b.salesperson_ranking, sql(_RANKED, **ALL))
case("A10_salesperson_ranking_filtered", lambda s: b.salesperson_ranking(s, NARROW), sql(_RANKED, **FEW))
case("A11_region_ranking", b.region_ranking, sql(
    f"select region, {money('sum(rc)')} as revenue, cast(rank() over (order by sum(rc) desc) as int) as rank from o group by region", **ALL))

# ---- customers

case("A12_customer_counts", b.customer_counts, sql("""
select (select count(*) from customers) as total_customers, (select count(*) from customers where customer_status='Active') as active_customers,
  (select count(distinct customer_id) from sold) as purchasing_customers""", "customers", "sold"))
_NEW = """select count(*) filter (where k = 1) as new_customer_orders, count(*) filter (where k > 1) as returning_customer_orders
from (select row_number() over (partition by customer_id order by order_date, order_id) as k from sold)"""
case("A13_new_and_returning", b.new_and_returning, sql(_NEW, "sold"))
case("A14_customer_growth", b.customer_growth, ACQUIRED)
case("A15_segment_sizes", lambda s: b.segment_sizes(s, AS_OF),
     sql("select segment, count(*) as count from seg group by segment", **SEGMENTED))
case("A16_customer_table", lambda s: b.customer_table(s, search="%0_1", filters=Filters(region="EUROPE"), page=1, page_size=50),
     sql(f"""select c.customer_id, customer_name, region, customer_segment, customer_status, {money('coalesce(rc,0)')} as total_revenue,
  coalesce(n,0) as total_orders, last_day as last_purchase_date from customers c left join cust k on k.customer_id=c.customer_id
where region='EUROPE' and (customer_name ilike '%%0_1%' or cast(c.customer_id as varchar) ilike '%%0_1%')
order by coalesce(rc,0) desc, c.customer_id limit 50""", "customers", "cust"))

# ---- products

_PRODUCTS = (("prod", "products"), f"""
select product_id, product_name, category, sub_category, rc, {money('rc')} as revenue, {money('pc')} as profit,
  {pct('pc', 'rc')} as margin_pct, cast(units as bigint) as units_sold from prod join products using (product_id)""")
_SHOWN = "product_id, product_name, category, sub_category, revenue, profit, margin_pct, units_sold"
case("A17_product_performance", b.product_performance, sql(f"select {_SHOWN} from listed", listed=_PRODUCTS))
for _key, _measure, _best, _order in (
        ("A18_top_10_products", "revenue", True, "rc desc, product_id"),
        ("A18_bottom_10_products", "revenue", False, "rc, product_id desc"),
        ("A18_highest_margin_products", "margin_pct", True, "coalesce(margin_pct,0) desc, product_id"),
        ("A18_lowest_margin_products", "margin_pct", False, "coalesce(margin_pct,0), product_id desc")):
    case(_key, lambda s, measure=_measure, best=_best: b.best_and_worst(b.product_performance(s), measure, best),
         sql(f"select {_SHOWN} from listed order by {_order} limit 10", listed=_PRODUCTS))
case("A19_category_performance", b.category_performance,
     sql(f"select category, {money('sum(rc)')} as revenue, {money('sum(pc)')} as profit from o group by category", **ALL))
_RETURNED = f"{pct('total_returns', 'total_orders')}"
case("A20_most_returned", b.most_returned, sql(f"""
select product_id, product_name, total_orders, cast(total_returns as bigint) as total_returns, {_RETURNED} as return_rate_pct
from rate join products using (product_id) order by {_RETURNED} desc, product_id limit 10""", "rate", "products"))

# ---- regions

_TOTALS = f"""select region, count(distinct customer_id) as customer_count, count(order_id) as total_orders, {money('sum(rc)')} as total_revenue,
  {money('sum(pc)')} as total_profit, {pct('sum(pc)', 'sum(rc)')} as profit_margin_pct from o group by region"""
case("A21_region_totals", b.region_totals, sql(_TOTALS, **ALL))
case("A21_region_totals_salesperson", lambda s: b.region_totals(s, PERSON), sql(_TOTALS, **ONE))
_REGION_TREND = f"""select region, m as month, {money('c')} as revenue, {money('lag(c) over (partition by region order by m)')} as prev_month_revenue
from (select region, m, sum(rc) as c from o group by region, m)"""
case("A22_region_trend", b.region_trend, sql(_REGION_TREND, **ALL))
case("A22_region_trend_salesperson", lambda s: b.region_trend(s, PERSON), sql(_REGION_TREND, **ONE))

# ---- employees

_CARD = (("employees", "plan", "emp"), f"""
select e.employee_id, employee_name, department, region, joining_date, cast(target_amount as double) as annual_target,
  {money('coalesce(tc,0)')} as total_target_full_period, {money('coalesce(rc,0)')} as total_revenue, {money('coalesce(pc,0)')} as total_profit,
  coalesce(n,0) as total_orders, coalesce(buyers,0) as customer_count, {pct('coalesce(rc,0)', 'tc')} as target_achievement_pct
from employees e left join plan t on t.employee_id=e.employee_id left join emp k on k.employee_id=e.employee_id""")
# The tiers and their limits, from the top down.
_TIER = """case when target_achievement_pct is null then 'No Data' when target_achievement_pct >= 110 then 'Top Performer'
  when target_achievement_pct >= 90 then 'Strong Performer' when target_achievement_pct >= 70 then 'Average Performer' else 'Needs Improvement' end"""
case("A23_scorecard", b.scorecard, sql("select * from card", card=_CARD))
case("A24_performance_tier", b.tiered_scorecard, sql(f"select *, {_TIER} as performance_tier from card", card=_CARD))
case("A25_tier_counts", b.tier_counts,
     sql(f"select {_TIER} as performance_tier, count(*) as count from card group by 1", card=_CARD))

# ---- churn

_RISK = f"select risk_level, count(*) as count, {mean('sum(ct)', 'count(*)', 100000, 4)} as avg_probability from churn group by risk_level"
case("A26_risk_summary", b.risk_summary, sql(_RISK, "churn"))
case("A27_churn_overall", b.churn_overall,
     sql(f"select {mean('sum(ct)', 'count(*)', 100000, 4)} as avg_churn_probability from churn", "churn"))
_CHURN_LIST = f"""
select h.customer_id, c.customer_name, region, {money('coalesce(rc,0)')} as revenue, coalesce(n,0) as orders, last_day as last_purchase,
  s.segment as rfm_segment, cast(churn_probability as double) as churn_probability, risk_level
from churn h join customers c on c.customer_id=h.customer_id left join cust k on k.customer_id=h.customer_id
left join seg s on s.customer_id=h.customer_id"""
case("A28_churn_list", lambda s: b.churn_list(s, as_of=AS_OF), sql(_CHURN_LIST, "churn", "customers", "cust", **SEGMENTED))
case("A28_churn_table", lambda s: b.churn_table(s, "High", 2, 25, AS_OF),
     sql(_CHURN_LIST + " where risk_level='High' order by ct desc, h.customer_id limit 25 offset 25", "churn", "customers", "cust", **SEGMENTED))



def _after_first(star):
    """The second page, sought from the last row of the first."""
    star = rfm.scored(star)
    last = b.churn_table_after(star, None, "High", 25, AS_OF).collect()[-1].asDict()
    return b.churn_table_after(star, last, "High", 25, AS_OF)


case("A28_churn_table_sought", _after_first,
     sql(_CHURN_LIST + " where risk_level='High' order by ct desc, h.customer_id limit 25 offset 25", "churn", "customers", "cust", **SEGMENTED))

# ---- segments

case("A29_segment_profile", lambda s: b.segment_profile(rfm.ntile_segments(s, AS_OF)), sql(f"""
select segment, count(*) as count, {mean('sum(mc)', 'count(*)')} as avg_monetary, {mean('sum(frequency)', 'count(*)', 1)} as avg_frequency,
  {mean('sum(recency_days)', 'count(*)', 1, 1)} as avg_recency_days from seg group by segment""", **SEGMENTED))
_MEMBERS = f"""select customer_id, customer_name, recency_days, frequency, {money('mc')} as monetary, r_score, f_score, m_score,
  cast(rfm_score as int) as rfm_score, segment from seg"""
case("A30_segment_members", lambda s: b.segment_members(rfm.ntile_segments(s, AS_OF), "Champions"),
     sql(_MEMBERS + " where segment='Champions'", **SEGMENTED))
case("A30_segment_table", lambda s: b.segment_table(rfm.ntile_segments(s, AS_OF), None, 2, 30),
     sql(_MEMBERS + " order by seg.rfm_score desc, customer_id limit 30 offset 30", **SEGMENTED))

# ---- insights

_HIGH = f"cast({pct('count(*) filter (where high)', 'count(*)', 1)} as decimal(20,1))"
I = {
    1: (f"""select 1 as insight_id, 'Revenue' as category, concat('Revenue ', case when g >= 0 then 'increased ' else 'decreased ' end,
  cast(abs(g) as decimal(20,1)), '% over the trailing 12 months compared to the prior 12-month period.') as text, g as value
from (select {pct('t-p', 'p', 1)} as g from {_trailing('sold')}) where g is not null""", ("sold",)),
    2: (f"""select 2 as insight_id, 'Regional' as category, concat('The ', region, ' region generates the highest revenue at ₹',
  format('{{:,}}', cast((rc+50)//100 as bigint)), '.') as text, {money('rc')} as value from by_region order by rc desc, region limit 1""", ("by_region",)),
    3: (f"""select 3 as insight_id, 'Product' as category, concat(category, ' has the highest revenue but a below-average profit margin of ',
  cast(cast(g as decimal(20,2)) as varchar), '% versus a ', cast(cast(round(a,1) as decimal(20,1)) as varchar), '% average across categories.') as text, g as value
from (select category, g, avg(g) over () as a, row_number() over (order by rc desc, category) as k
  from (select category, rc, {pct('pc', 'rc')} as g from by_category)) where k = 1 and g < a""", ("by_category",)),
    4: (f"""select 4 as insight_id, 'Customer' as category, concat(cast(s as varchar), '% of customers are classified as high churn risk based on the churn prediction model.') as text,
  cast(s as double) as value from (select {_HIGH} as s from (select risk_level='High' as high from churn)) where s is not null""", ("churn",)),
    5: (f"""select 5 as insight_id, 'Customer' as category, concat('The top 10 customers contribute ', cast(s as varchar), '% of total revenue.') as text, cast(s as double) as value
from (select cast({pct('sum(rc) filter (where k <= 10)', 'sum(rc)', 1)} as decimal(20,1)) as s
  from (select rc, row_number() over (order by rc desc, customer_id) as k from cust)) where s is not null""", ("cust",)),
    6: ("""select 6 as insight_id, 'Pricing' as category, concat('Orders discounted above 15% carry an average margin of ', cast(h as varchar), '%, ',
  cast(d as varchar), ' percentage points lower than orders discounted 15% or less.') as text, cast(d as double) as value
from (select h, cast(round(l-h,1) as decimal(20,1)) as d from (
  select cast(round(avg(cast(pc as double)/rc) filter (where dt > 1500)*100,2) as decimal(20,2)) as h,
    cast(round(avg(cast(pc as double)/rc) filter (where dt <= 1500)*100,2) as decimal(20,2)) as l from sold where rc > 0)) where d > 0""", ("sold",)),
    7: (f"""select 7 as insight_id, 'Sales' as category, concat(cast(s as varchar), '% of salespeople are meeting or exceeding their annual sales target.') as text,
  cast(s as double) as value from (select {_HIGH} as s from (
    select coalesce({pct('coalesce(rc,0)', 'target_amount*100')} >= 100, false) as high from employees e left join emp k on k.employee_id=e.employee_id))
where s is not null""", ("employees", "emp")),
    8: (f"""select 8 as insight_id, 'Product' as category, concat(product_name, ' has the highest return rate at ', cast(s as varchar),
  '% among frequently ordered products.') as text, cast(s as double) as value
from (select product_name, cast({pct('sum(total_returns)', 'sum(total_orders)', 1)} as decimal(20,1)) as s, sum(total_returns)/sum(total_orders) as r
  from rate join products using (product_id) group by product_name having sum(total_orders) > 20 order by r desc, product_name limit 1)
where r > 0""", ("rate", "products")),
}
for _n, (_make, _name) in enumerate(((i.revenue_change, "revenue_change"), (i.leading_region, "leading_region"),
                                     (i.thin_margin_category, "thin_margin_category"), (i.churn_share, "churn_share"),
                                     (i.top_customer_share, "top_customer_share"), (i.discount_effect, "discount_effect"),
                                     (i.targets_met, "targets_met"), (i.most_returned_name, "most_returned_name")), 1):
    case(f"I{_n}_{_name}", _make, sql(I[_n][0], *I[_n][1]))
case("I_all_insights", i.all_insights, sql("\nunion all ".join(f"select * from ({body})" for body, _ in I.values()),
                                           *[t for _, names in I.values() for t in names]))

# ---- measures

_GROUP = "region"
for _id, _name, _expr in (
        ("M01", "total_revenue", money("sum(rc)")), ("M02", "total_profit", money("sum(pc)")),
        ("M04", "total_orders", "count(distinct order_id)")):
    case(f"{_id}_{_name}", lambda s, name=_name: m.measure(s, name, ["region", "category"]),
         sql(f"select region, category, {_expr} as {_name} from o group by region, category", **ALL))
case("M03_profit_margin_pct", lambda s: m.measure(s, "profit_margin_pct", ["category"]), sql(
    f"select category, coalesce({pct('sum(pc)', 'sum(rc)', 6)}, 0) as profit_margin_pct from o group by category", **ALL))
case("M05_total_customers", lambda s: m.total_customers(s, ["region"]), sql(
    "select region, count(distinct customer_id) as total_customers from customers group by region", "customers"))
case("M06_average_order_value", lambda s: m.measure(s, "average_order_value", ["region"]), sql(
    f"select region, {mean('sum(rc)', 'count(distinct order_id)', 100, 6)} as average_order_value from o group by region", **ALL))
# Every month of the calendar in which the month itself or the earlier one has revenue.
_SHIFT = """(select s.month, a.rc, p.rc as pr from (select distinct cast(date_trunc('month', date) as date) as month from calendar) s
  left join by_month a on a.month = s.month left join by_month p on p.month = s.month - interval {} month
  where a.rc is not null or p.rc is not null)"""
case("M07_revenue_growth_yoy", m.year_on_year_growth, sql(
    f"select month, coalesce({pct('coalesce(rc,0)-pr', 'pr', 6)}, 0) as revenue_growth_yoy from {_SHIFT.format(12)}",
    "by_month", "calendar"))
case("M08_yoy_revenue", m.year_ago_revenue, sql(
    f"select month, {money('rc')} as revenue, {money('pr')} as yoy_revenue from {_SHIFT.format(12)}", "by_month", "calendar"))
case("M09_mom_revenue", m.month_ago_revenue, sql(
    f"select month, {money('rc')} as revenue, {money('pr')} as mom_revenue from {_SHIFT.format(1)}", "by_month", "calendar"))
case("M10_target_achievement", m.target_achievement, sql(f"""
select e.employee_id, coalesce({pct('rc', 'tc', 6)}, 0) as target_achievement_pct from employees e
left join plan t on t.employee_id=e.employee_id left join emp k on k.employee_id=e.employee_id""", "employees", "plan", "emp"))
case("M11_customer_retention", m.customer_retention, sql(f"""
select a.m as month, {pct('count(distinct p.customer_id)', 'count(distinct a.customer_id)', 6)} as customer_retention_pct
from sold a left join (select distinct customer_id, m from sold) p on p.customer_id=a.customer_id and p.m = a.m - interval 1 month
group by a.m""", "sold"))
case("M12_customer_churn", m.customer_churn, sql(
    f"select {pct('count(*) filter (where churn_prediction=1)', 'count(*)', 6)} as customer_churn_pct from churn", "churn"))
case("M13_revenue_per_customer", lambda s: m.revenue_per_customer(s, ["region"]), sql(f"""
select region, {mean('coalesce(sum(rc),0)', 'count(*)', 100, 6)} as revenue_per_customer
from customers c left join cust k on k.customer_id=c.customer_id group by region""", "customers", "cust"))
case("M08_yoy_revenue_by_category", lambda s: m.year_ago_revenue(s, ["category"]), sql(f"""
select k.category, k.month, {money('a.c')} as revenue, {money('p.c')} as yoy_revenue from (
  select distinct category, cast(date_trunc('month', date) as date) as month from (select distinct category from g) cross join calendar) k
left join g a on a.category=k.category and a.month=k.month
left join g p on p.category=k.category and p.month = k.month - interval 12 month
where a.c is not null or p.c is not null""", "calendar", g=(("sold", "products"), """
select category, m as month, sum(rc) as c from sold join products using (product_id) group by category, m""")))
case("M10_target_achievement_by_region", lambda s: m.target_achievement(s, ["region"]), sql(f"""
select region, coalesce({pct('sum(rc)', 'sum(tc)', 6)}, 0) as target_achievement_pct from employees e
left join plan t on t.employee_id=e.employee_id left join emp k on k.employee_id=e.employee_id group by region""", "employees", "plan", "emp"))
case("M11_customer_retention_by_region", lambda s: m.customer_retention(s, ["region"]), sql(f"""
select a.region, a.m as month, {pct('count(distinct p.customer_id)', 'count(distinct a.customer_id)', 6)} as customer_retention_pct
from (select * from sold join customers using (customer_id)) a left join (select distinct customer_id, m from sold) p
  on p.customer_id=a.customer_id and p.m = a.m - interval 1 month group by a.region, a.m""", "sold", "customers"))
case("M12_customer_churn_by_segment", lambda s: m.customer_churn(s, ["customer_segment"]), sql(f"""
select customer_segment, {pct('count(*) filter (where churn_prediction=1)', 'count(*)', 6)} as customer_churn_pct
from churn join customers using (customer_id) group by customer_segment""", "churn", "customers"))
# Grouping by columns of several tables, and by those that don't narrow customers.
case("M01_total_revenue_by_staff_region_and_year", lambda s: m.measure(s, "total_revenue", ["employees.region", "year"]), sql(f"""
select e.region as employees_region, y as year, {money('sum(rc)')} as total_revenue from sold join employees e using (employee_id) group by 1, 2""",
    "sold", "employees"))
case("M06_average_order_value_filtered", lambda s: m.measure(s, "average_order_value", ["payment_method", "category"], NARROW), sql(
    f"select payment_method, category, {mean('sum(rc)', 'count(*)', 100, 6)} as average_order_value from o group by 1, 2", **FEW))
case("M05_total_customers_by_category", lambda s: m.total_customers(s, ["category"]), sql(
    "select category, (select count(*) from customers) as total_customers from (select distinct category from products)", "customers", "products"))
case("M05_total_customers_by_region_and_year", lambda s: m.total_customers(s, ["region", "year"]), sql("""
select region, year, n as total_customers from (select region, count(*) as n from customers group by 1) cross join
  (select distinct cast(extract(year from date) as int) as year from calendar)""", "customers", "calendar"))
case("M13_revenue_per_customer_by_category", lambda s: m.revenue_per_customer(s, ["category"]), sql(f"""
select category, coalesce({mean('rc', '(select count(*) from customers)', 100, 6)}, 0) as revenue_per_customer
from (select distinct category from products) left join by_category using (category)""", "customers", "products", "by_category"))
case("M13_revenue_per_customer_by_region_and_category", lambda s: m.revenue_per_customer(s, ["region", "category"]), sql(f"""
select region, category, coalesce({mean('rc', 'n', 100, 6)}, 0) as revenue_per_customer
from (select region, count(*) as n from customers group by 1) cross join (select distinct category from products)
left join (select region, category, sum(rc) as rc from o group by 1, 2) using (region, category)""", "customers", "products", **ALL))


def _shift_by(grain: str, back: int, group: str = "") -> str:
    """Revenue of each period's calendar months, and of the same months moved back."""
    g, on = (f"{group}, ", f" and a.{group} is not distinct from k.{group}") if group else ("", "")
    keys = f"(select distinct {group} from o) cross join months" if group else "months"
    sums = f"(select {g}m, sum(rc) as rc from o group by all)"
    return f"""select {f'k.{group} as {group}, ' if group else ''}cast(date_trunc('{grain}', k.month) as date) as {grain},
  sum(a.rc) as rc, sum(p.rc) as pr from (select * from {keys}) k
left join {sums} a on a.m = k.month{on}
left join {sums} p on p.m = k.month - interval {back} month{on.replace('a.', 'p.')}
group by all having sum(a.rc) is not null or sum(p.rc) is not null"""


_MONTHS = {"months": (("calendar",), "select distinct cast(date_trunc('month', date) as date) as month from calendar")}
for _grain in ("quarter", "year"):
    case(f"M07_revenue_growth_yoy_by_{_grain}", lambda s, grain=_grain: m.year_on_year_growth(s, grain=grain), sql(f"""
select {_grain}, coalesce({pct('coalesce(rc,0)-pr', 'pr', 6)}, 0) as revenue_growth_yoy from ({_shift_by(_grain, 12)})""", **ALL, **_MONTHS))
    case(f"M08_yoy_revenue_by_{_grain}_and_category", lambda s, grain=_grain: m.year_ago_revenue(s, ["category"], grain=grain), sql(f"""
select category, {_grain}, {money('rc')} as revenue, {money('pr')} as yoy_revenue from ({_shift_by(_grain, 12, 'category')})""", **ALL, **_MONTHS))
    case(f"M09_mom_revenue_by_{_grain}", lambda s, grain=_grain: m.month_ago_revenue(s, grain=grain), sql(f"""
select {_grain}, {money('rc')} as revenue, {money('pr')} as mom_revenue from ({_shift_by(_grain, 1)})""", **ALL, **_MONTHS))
case("M11_customer_retention_by_category", lambda s: m.customer_retention(s, ["category"]), sql(f"""
select a.category, a.m as month, {pct('count(distinct p.customer_id)', 'count(distinct a.customer_id)', 6)} as customer_retention_pct
from o a left join (select distinct category, customer_id, m from o) p
  on p.customer_id=a.customer_id and p.category=a.category and p.m = a.m - interval 1 month group by 1, 2""", **ALL))
case("M14_order_month_label", lambda s: m.with_order_month(s.orders).groupBy("order_month_label").agg(
    F.count(F.lit(1)).alias("orders")), sql(
    "select strftime(order_date, '%b %Y') as order_month_label, count(*) as orders from orders_x group by 1", "orders_x"))
case("M15_margin_band", lambda s: m.with_margin_band(s.products).select("product_id", "margin_band"), sql("""
select product_id, case when selling_price = 0 then 'Low Margin' when (selling_price-unit_cost)*100 >= selling_price*40 then 'High Margin'
  when (selling_price-unit_cost)*100 >= selling_price*20 then 'Medium Margin' else 'Low Margin' end as margin_band from products""", "products"))

# ---- values pages derive

_REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# The query takes the regions from the data; SQL has to name them.
case("U01_region_pivot", u.region_pivot, sql(
    "select m as month, " + ", ".join(
        "cast(sum(rc) filter (where region='" + r + "') as double)/100 as \"" + r + "\"" for r in _REGION_NAMES)
    + " from o group by m", **ALL))
case("U03_repeat_order_share", u.repeat_order_share, sql(
    f"select {pct('count(*) filter (where k > 1)', 'count(*)')} as repeat_order_pct from (select row_number() over "
    "(partition by customer_id order by order_date, order_id) as k from sold)", "sold"))
case("U04_attainment", u.attainment, sql(f"""
select employee_id, employee_name, achievement_pct, case when achievement_pct >= 100 then 'Top Performer'
  when achievement_pct >= 80 then 'Strong Performer' when achievement_pct >= 60 then 'Average Performer' else 'Needs Improvement' end as tier
from ({_ATTAINED})""", "employees", "plan", "emp"))
case("U05_risk_counts", u.risk_counts, sql("""
select count(*) as total, count(*) filter (where risk_level='High') as high, count(*) filter (where risk_level='Medium') as medium,
  count(*) filter (where risk_level='Low') as low from churn""", "churn"))
case("U06_leading_salespeople", u.leading_salespeople,
     sql(_RANKED + " order by sum(rc) desc, employee_id limit 15", **ALL))
case("U06_leading_products", u.leading_products,
     sql(f"select {_SHOWN} from listed order by rc desc, product_id limit 200", listed=_PRODUCTS))
