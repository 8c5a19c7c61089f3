"""The star tables as DuckDB CTEs over the raw views, and small SQL text helpers.

Amounts come as whole cents (rc, cc, pc) and discounts as ten-thousandths (dt), so the oracles
compute with integers, apart from the engine's decimals.
"""

from __future__ import annotations

AS_OF = "2001-08-02"

_CENTS = "cast(round(l_extendedprice*100) as bigint)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "orders_f": ((), f"""
select concat('ORD-',l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey,'-',{_CENTS}) as order_id,
  cast(o_orderdate as date) as order_date, o_custkey as customer_id, l_partkey as product_id, l_suppkey as employee_id,
  cast(l_quantity as int) as quantity, cast(cast(({_CENTS} - {_CENTS} % cast(l_quantity as bigint)) / cast(l_quantity as bigint) as bigint) * cast(0.01 as decimal(3,2)) as decimal(12,2)) as unit_price,
  cast(cast(l_discount as decimal(5,2))*2.5 as decimal(5,4)) as discount,
  cast(round(cast(l_extendedprice as decimal(14,2))*(1-cast(cast(l_discount as decimal(5,2))*2.5 as decimal(5,4))),2) as decimal(14,2)) as revenue,
  cast(round(cast(l_extendedprice as decimal(14,2))*cast(0.45+0.01*(l_partkey%41) as decimal(4,2)),2) as decimal(14,2)) as cost,
  case l_linenumber%3 when 0 then 'Card' when 1 then 'UPI' else 'Wallet' end as payment_method,
  case when o_orderstatus='P' and l_linenumber=1 then 'Cancelled' when l_returnflag='R' and l_linenumber<=2 then 'Returned' else 'Completed' end as order_status,
  l_orderkey, l_linenumber
  from lineitem join orders on l_orderkey=o_orderkey"""),
    "orders_x": (("orders_f",), """
select order_id,order_date,customer_id,product_id,employee_id,quantity,unit_price,discount,revenue,cost,
  cast(revenue-cost as decimal(14,2)) as profit,payment_method,order_status,
  cast(revenue*100 as bigint) as rc, cast(cost*100 as bigint) as cc, cast(revenue*100 as bigint)-cast(cost*100 as bigint) as pc,
  cast(discount*10000 as bigint) as dt, cast(date_trunc('month',order_date) as date) as m,
  cast(extract(year from order_date) as int) as y from orders_f"""),
    "sold": (("orders_x",), "select * from orders_x where order_status <> 'Cancelled'"),
    "returns": (("orders_f",), """
select concat('RET-',substring(order_id,5)) as return_id, order_id, order_date + cast(1+(l_orderkey+l_linenumber)%20 as int) as return_date,
  case (l_orderkey%3) when 0 then 'Defective Product' when 1 then 'Changed Mind' else 'Late Delivery' end as return_reason, revenue as refund_amount from orders_f where order_status='Returned'"""),
    "customers": ((), """
select c_custkey as customer_id, c_name as customer_name, lower(concat(replace(c_name,'#','.'),'@example.com')) as email, n_name as city, n_name as state, r_name as region,
  c_mktsegment as customer_segment, date '1995-01-01' + cast(c_custkey*37%2400 as int) as acquisition_date, case when c_acctbal<0 then 'Inactive' else 'Active' end as customer_status
  from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey"""),
    "products": ((), """
select p_partkey as product_id, concat(p_name,' ',p_partkey) as product_name, p_type as category, p_brand as sub_category,
  cast(round(cast(p_retailprice as decimal(12,2))*cast(0.45+0.01*(p_partkey%41) as decimal(4,2)),2) as decimal(12,2)) as unit_cost, cast(p_retailprice as decimal(12,2)) as selling_price,
  concat('SUP-',p_partkey%20) as supplier, case when p_partkey%12=0 then 'Discontinued' else 'Active' end as product_status from part"""),
    "employees": ((), """
select s_suppkey as employee_id, s_name as employee_name, case s_suppkey%4 when 0 then 'Sales' when 1 then 'Key Accounts' when 2 then 'Field Sales' else 'Inside Sales' end as department,
  r_name as region, date '1995-01-01' + cast(s_suppkey*53%2000 as int) as joining_date, cast(3200000+(s_suppkey*7919%1000)*2100 as decimal(14,2)) as target_amount
  from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey"""),
    "months": ((), """
select distinct cast(extract(year from o_orderdate) as int) as year, cast(extract(month from o_orderdate) as int) as month from orders"""),
    "targets": (("employees", "months"), """
select employee_id, month, year, cast(round(target_amount*(85+(employee_id*31+year*12+month)%31)/1200,2) as decimal(14,2)) as target_amount from employees cross join months"""),
    "churn": ((), """
select c_custkey as customer_id, cast(cast((c_custkey*7919)%100000 as decimal(10,0))/100000 as decimal(6,5)) as churn_probability, (c_custkey*7919)%100000 as ct,
  case when (c_custkey*7919)%100000>=50000 then 1 else 0 end as churn_prediction,
  case when (c_custkey*7919)%100000<=33000 then 'Low' when (c_custkey*7919)%100000<=66000 then 'Medium' else 'High' end as risk_level from customer"""),
    "calendar": ((), """
select unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day))::date as date from orders"""),
    "ret_order": (("returns",), "select order_id, count(return_id) as n from returns group by order_id"),
    # One row per buying customer, one per salesperson, and so on.
    "cust": (("sold",), """
select customer_id, sum(rc) as rc, sum(pc) as pc, count(*) as n, min(order_date) as first_day, max(order_date) as last_day from sold group by customer_id"""),
    "emp": (("sold",), """
select employee_id, sum(rc) as rc, sum(pc) as pc, count(*) as n, count(distinct customer_id) as buyers from sold group by employee_id"""),
    "prod": (("sold",), """
select product_id, sum(rc) as rc, sum(pc) as pc, count(*) as n, sum(quantity) as units, sum(dt) as dt from sold group by product_id"""),
    "by_month": (("sold",), """
select m as month, sum(rc) as rc, sum(pc) as pc, count(*) as n, sum(quantity) as units from sold group by m"""),
    "plan": (("targets",), """
select employee_id, sum(cast(target_amount*100 as bigint)) as tc from targets group by employee_id"""),
    "by_region": (("sold", "customers"), """
select region, sum(rc) as rc, sum(pc) as pc, count(*) as n, count(distinct customer_id) as buyers from sold join customers using (customer_id) group by region"""),
    "by_category": (("sold", "products"), """
select category, sum(rc) as rc, sum(pc) as pc from sold join products using (product_id) group by category"""),
    "rate": (("orders_x", "ret_order"), """
select product_id, count(*) as total_orders, coalesce(sum(r.n),0) as total_returns from orders_x o left join ret_order r on r.order_id=o.order_id group by product_id"""),
}


def _needed(names: tuple[str, ...], extra: dict[str, tuple[tuple[str, ...], str]]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        for parent in {**CTES, **extra}[name][0]:
            visit(parent)
        if name not in done:
            done.append(name)

    for name in names:
        visit(name)
    return done


def sql(body: str, *names: str, **extra: tuple[tuple[str, ...], str]) -> str:
    """``body`` with the CTEs it names, and theirs, in front. ``extra`` adds CTEs of its own."""
    known = {**CTES, **extra}
    listed = _needed((*names, *extra), extra)
    return "with " + ",\n".join(f"{n} as ({known[n][1]})" for n in listed) + "\n" + body


def money(cents: str) -> str:
    return f"cast({cents} as double)/100"


def pct(part: str, whole: str, places: int = 2) -> str:
    """part/whole in percent, half away from zero, null on zero; whole must not be negative."""
    scale = 100 * 10 ** places
    p, w = f"cast({part} as hugeint)", f"cast({whole} as hugeint)"
    return (f"case when {w}=0 then null else cast((case when {p}<0 then -1 else 1 end)*"
            f"((abs({p})*{2 * scale}+{w})//(2*{w})) as double)/{10 ** places} end")


def mean(total: str, count: str, units: int = 100, places: int = 2) -> str:
    """Mean of ``total`` given in 1/units, half away from zero."""
    shift = 10 ** places
    t, c = f"cast({total} as hugeint)", f"(cast({count} as hugeint)*{units})"
    return (f"case when {c}=0 then null else cast((case when {t}<0 then -1 else 1 end)*"
            f"((abs({t})*{2 * shift}+{c})//(2*{c})) as double)/{shift} end")


def text1(tenths: str) -> str:
    """A non-negative number of tenths as text with one decimal."""
    return f"concat(cast(({tenths})//10 as varchar),'.',cast(({tenths})%10 as varchar))"


def digest(table: str, source: str, columns: list[str]) -> str:
    """The SQL of ``registry.digest``."""
    cells = ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in columns)
    return (f"select '{table}' as table_name, count(*) as row_count, cast(coalesce(sum("
            f"cast('0x' || left(md5(concat_ws('|', {cells})), 8) as bigint)), 0) as bigint) as digest from {source}")
