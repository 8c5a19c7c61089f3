"""Sources, cleaning, quality rules and the load job."""

from pyspark.sql import functions as F

from contract.cases.blocks import _PRODUCTS, _RISK, _SHOWN
from contract.feed import ARRIVAL, append_records, delivered, write_csv
from contract.mapping import digest as digest_sql, money, sql
from contract.registry import case, digest, raw_case
from tillgrain.functions.dates import order_calendar
from tillgrain.model import SCHEMAS, SOURCE_TABLES
from tillgrain.operators import clean, quality
from tillgrain.plans import blocks
from tillgrain.plans.etl import rows_removed, run_load
from tillgrain.session import drop_folder, pin, scratch_path
from tillgrain.sources import flatfiles, warehouse
from tillgrain.sources.linestar import star_from_lines
from tillgrain.sources.star import Star

# ---- the raw delivery in SQL

_NUMBER = "concat('ORD-',l_orderkey,'-',l_linenumber)"


def _raw_orders(day: str) -> tuple:
    return (("orders_f",), f"""
select order_id as arrival, {_NUMBER} as order_id, {day} as order_date, customer_id, product_id, employee_id, quantity-3 as quantity, unit_price,
  cast(discount*5 as decimal(5,4)) as discount, cast(revenue-2000 as decimal(14,2)) as revenue, cost, revenue as profit,
  nullif(payment_method,'Wallet') as payment_method, order_status from orders_f""")


FEED = {
    "raw_orders": _raw_orders("cast(order_date as varchar)"),
    "raw_returns": (("returns", "orders_f"), f"""
select r.order_id as arrival, concat('RET-',substring({_NUMBER},5)) as return_id, {_NUMBER} as order_id, return_date, return_reason, refund_amount
from returns r join orders_f f on f.order_id=r.order_id"""),
    "raw_customers": (("customers",), """
select * replace (concat('  ',customer_name,' ') as customer_name, upper(email) as email), 1 as arrival from customers where customer_status='Active'
union all select *, 2 as arrival from customers where customer_status='Active'"""),
    "raw_products": (("products",), """
select * replace (cast(selling_price*0.3335 as decimal(20,6)) as unit_cost), 1 as arrival from products where product_status='Active'"""),
    "raw_employees": (("employees",), "select *, 1 as arrival from employees where department <> 'Sales'"),
    "raw_targets": (("targets",), """
select *, 1 as arrival from targets union all select employee_id, month, year, cast(target_amount+1 as decimal(14,2)), 2 from targets"""),
}


def _first(name: str, key: str, extra: str = "*") -> tuple:
    return ((name,), f"select {extra} from {name} qualify row_number() over (partition by {key} order by arrival) = 1")


CLEAN = {
    **FEED,
    "c1": _first("raw_customers", "customer_id"), "p1": _first("raw_products", "product_id"),
    "e1": _first("raw_employees", "employee_id"), "o1": _first("raw_orders", "order_id"),
    "o2": (("o1", "c1", "p1", "e1"), """
select o1.* from o1 where exists (from c1 where c1.customer_id=o1.customer_id) and exists (from p1 where p1.product_id=o1.product_id)
  and exists (from e1 where e1.employee_id=o1.employee_id)"""),
    "o3": (("o2",), "select * replace (revenue-cost as profit) from o2 where quantity > 0 and revenue >= 0 and cost >= 0"),
    "r1": _first("raw_returns", "return_id"),
    "r2": (("r1", "o3"), "select * from r1 where order_id in (select order_id from o3)"),
    "t1": _first("raw_targets", "employee_id, month, year"),
    "t2": (("t1", "e1"), "select * from t1 where employee_id in (select employee_id from e1)"),
}

# ---- cleaning

_KEYS = (("customers", "customer_id", "c1"), ("products", "product_id", "p1"), ("employees", "employee_id", "e1"),
         ("orders", "order_id", "o1"), ("returns", "return_id", "r1"))
for _table, _key, _cte in _KEYS:
    raw_case(f"T01_first_{_table}", lambda spark, folder, table=_table, key=_key: clean.keep_first(
        delivered(spark, folder)[table], [key], ARRIVAL).select(key, F.col("arrival").cast("string").alias("arrival")),
        sql(f"select {_key}, cast(arrival as varchar) as arrival from {_cte}", **CLEAN))
raw_case("T02_first_targets", lambda spark, folder: clean.keep_first(
    delivered(spark, folder)["targets"], ["employee_id", "month", "year"], ARRIVAL).drop("arrival"),
    sql("select employee_id, month, year, cast(target_amount as double) as target_amount from t1", **CLEAN))
raw_case("T03_dates", lambda spark, folder: clean.clean_orders(
    **_dimensions(spark, folder), raw=delivered(spark, folder)["orders"], sequence=ARRIVAL).select("order_id", "order_date"),
    sql("select order_id, cast(order_date as date) as order_date from o3", **CLEAN))


def _dimensions(spark, folder):
    raw = delivered(spark, folder)
    return {"customers": clean.clean_customers(raw["customers"], ARRIVAL),
            "products": clean.clean_products(raw["products"], ARRIVAL),
            "employees": clean.clean_employees(raw["employees"], ARRIVAL)}


raw_case("T04_names", lambda spark, folder: _dimensions(spark, folder)["customers"].select(
    "customer_id", "customer_name", "email", "acquisition_date"),
    sql("select customer_id, trim(customer_name) as customer_name, lower(email) as email, acquisition_date from c1", **CLEAN))
raw_case("T05_prices", lambda spark, folder: _dimensions(spark, folder)["products"].select("product_id", "unit_cost", "selling_price"),
         sql("""select product_id, cast(cast(round(unit_cost,2) as decimal(12,2)) as double) as unit_cost,
cast(selling_price as double) as selling_price from p1""", **CLEAN))


def _known(spark, folder):
    rows = clean.keep_first(delivered(spark, folder)["orders"], ["order_id"], ARRIVAL)
    dims = _dimensions(spark, folder)
    for table, key in (("customers", "customer_id"), ("products", "product_id"), ("employees", "employee_id")):
        rows = clean.only_known(rows, key, dims[table])
    return rows


raw_case("T06_known_references", lambda spark, folder: _known(spark, folder).select("order_id", "arrival"),
         sql("select order_id, arrival from o2", **CLEAN))
raw_case("T07_sound_amounts", lambda spark, folder: clean.sound_amounts(delivered(spark, folder)["orders"]).select("arrival"),
         sql("select arrival from raw_orders where quantity > 0 and revenue >= 0 and cost >= 0", **FEED))
raw_case("T08_profit", lambda spark, folder: clean.with_profit(delivered(spark, folder)["orders"]).select("arrival", "profit"),
         sql("select arrival, cast(revenue-cost as double) as profit from raw_orders", **FEED))
raw_case("T09_returns_of_kept_orders", lambda spark, folder: clean.clean_all(
    delivered(spark, folder), ARRIVAL)["returns"].select("return_id", "order_id", "return_date"),
    sql("select return_id, order_id, return_date from r2", **CLEAN))
raw_case("T10_targets_of_known_employees", lambda spark, folder: clean.clean_all(delivered(spark, folder), ARRIVAL)["targets"],
         sql("select employee_id, month, year, cast(target_amount as double) as target_amount from t2", **CLEAN))


def _removals(spark, folder):
    raw = delivered(spark, folder)
    return rows_removed(spark, raw, ARRIVAL)


raw_case("T11_rows_removed", _removals, sql("\nunion all ".join(
    f"select '{t}' as table_name, (select count(*) from {a}) as rows_before, (select count(*) from {b}) as rows_after, "
    f"(select count(*) from {a}) - (select count(*) from {b}) as rows_removed"
    for t, a, b in (("date_dimension", "calendar", "calendar"), ("customers", "raw_customers", "c1"), ("products", "raw_products", "p1"),
                    ("employees", "raw_employees", "e1"), ("orders", "raw_orders", "o3"), ("returns", "raw_returns", "r2"),
                    ("targets", "raw_targets", "t2"))), "calendar", **CLEAN))
case("T12_calendar", lambda s: order_calendar(s.orders), sql("""
select date, cast(extract(day from date) as int) as day, cast(extract(month from date) as int) as month, strftime(date,'%B') as month_name,
  cast(extract(quarter from date) as int) as quarter, cast(extract(year from date) as int) as year, cast(extract(week from date) as int) as week,
  strftime(date,'%A') as weekday, cast(extract(year from date) + case when extract(month from date) >= 4 then 1 else 0 end as int) as fiscal_year
from calendar""", "calendar"))

_SOURCES = {"date_dimension": "days", "customers": "customers", "products": "products", "employees": "employees",
            "orders": "orders_x", "returns": "returns", "targets": "targets"}
_DAYS = (("calendar",), """
select date, cast(extract(day from date) as int) as day, cast(extract(month from date) as int) as month, strftime(date,'%B') as month_name,
  cast(extract(quarter from date) as int) as quarter, cast(extract(year from date) as int) as year, cast(extract(week from date) as int) as week,
  strftime(date,'%A') as weekday, cast(extract(year from date) + case when extract(month from date) >= 4 then 1 else 0 end as int) as fiscal_year
from calendar""")
_STAR = ("customers", "products", "employees", "orders_x", "returns", "targets")
# Every value of all seven tables.
_DIGESTS = sql("\nunion all ".join(digest_sql(t, c, SCHEMAS[t].names) for t, c in _SOURCES.items()), *_STAR, days=_DAYS)


def _digests(star):
    return quality.stacked([digest(t, getattr(star, t), SCHEMAS[t].names) for t in SOURCE_TABLES])


def _load(spark, folder):
    home = scratch_path(spark, "load")
    write_csv(star_from_lines(spark, folder), f"{home}/delivered")
    run_load(spark, f"{home}/delivered", f"{home}/warehouse", f"{home}/reports")
    # A second load publishes a new version over the first.
    return _digests(run_load(spark, f"{home}/delivered", f"{home}/warehouse", f"{home}/reports"))


raw_case("T13_load", _load, _DIGESTS)


def _refused(spark, folder):
    """What stops loads of files with one bad row each: after each, the version before is still read."""
    home, star = scratch_path(spark, "refused"), star_from_lines(spark, folder)
    warehouse.store_all({t: star.tables()[t] for t in SOURCE_TABLES}, f"{home}/warehouse")
    # What is delivered is read back from what is stored, not joined once more for each delivery.
    stored = warehouse.open_star(spark, f"{home}/warehouse")
    star = Star(**{t: getattr(stored, t).select(SCHEMAS[t].names) for t in SOURCE_TABLES})
    one = star.orders.agg(F.min("order_id")).first()[0]
    harm = {"orders": lambda df: df.withColumn("order_status", F.when(F.col("order_id") == one, "Pending").otherwise(F.col("order_status"))),
            "targets": lambda df: df.withColumn("month", F.when(F.col("month") == 12, 13).otherwise(F.col("month")))}
    lines = []
    for table, change in harm.items():
        tables = star.tables()
        tables[table] = change(tables[table])
        write_csv(Star(**{t: tables[t] for t in SOURCE_TABLES}), f"{home}/{table}")
        try:
            run_load(spark, f"{home}/{table}", f"{home}/warehouse")
            said = "loaded"
        except quality.ConstraintViolation as stop:
            said = str(stop)
        drop_folder(spark, f"{home}/{table}")  # of two deliveries only one takes disk
        kept = warehouse.open_star(spark, f"{home}/warehouse")
        lines.append(getattr(kept, table).agg(F.lit(said).alias("said"), F.count(F.lit(1)).alias("rows_kept")))
    return quality.stacked(lines)


raw_case("T13_refused_loads", _refused, sql("""
select 'broken constraints: orders: order_status is Completed, Returned or Cancelled (1 rows)' as said, count(*) as rows_kept from orders_x
union all select concat('broken constraints: targets: month between 1 and 12 (', count(*) filter (where month=12), ' rows)'), count(*) from targets""",
    "orders_x", "targets"))

# ---- quality

BAD_ORDERS = {**FEED, "raw_orders": _raw_orders(
    "case when order_status='Cancelled' then 'unknown' else cast(order_date as varchar) end")}
_EARLY = "2001-01-01"


def _feed(spark, folder):
    return {t: df.drop("arrival") for t, df in delivered(spark, folder, bad_dates=True).items()}


def _graded(counts: str) -> str:
    share = "case when total=0 then 0 else cast((failed*2000000+total)//(2*total) as double)/10000 end"
    return f"""select rule as "Rule", cast(total as bigint) as "Total Records", cast(failed as bigint) as "Failed Records",
  cast(share as double) as "Failure Percentage", case when share=0 then 'PASS' when share<1 then 'WARN' else 'FAIL' end as "Status"
from (select *, {share} as share from ({counts}))"""


def _missing(table: str, source: str, columns: list[str]) -> str:
    cells = "+".join(f"(case when {c} is null then 1 else 0 end)" for c in columns)
    return f"select 'Missing values in {table}' as rule, count(*)*{len(columns)} as total, coalesce(sum({cells}),0) as failed from {source}"


def _twice(rule: str, source: str, key: str) -> str:
    return f"select '{rule}' as rule, count(*) as total, count(*)-count(distinct {key}) as failed from {source}"


def _where(rule: str, source: str, condition: str) -> str:
    return f"select '{rule}' as rule, count(*) as total, count(*) filter (where {condition}) as failed from {source}"


def _lost(key: str, source: str, parent: str) -> str:
    return _where(f"Invalid {key} references", f"(select o.{key}, x.k from {source} o left join (select distinct {key} as k from {parent}) x on x.k=o.{key})",
                  "k is null")


def _all(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


_COLUMNS = {
    "customers": ["customer_id", "customer_name", "email", "city", "state", "region", "customer_segment", "acquisition_date", "customer_status"],
    "products": ["product_id", "product_name", "category", "sub_category", "unit_cost", "selling_price", "supplier", "product_status"],
    "employees": ["employee_id", "employee_name", "department", "region", "joining_date", "target_amount"],
    "orders": ["order_id", "order_date", "customer_id", "product_id", "employee_id", "quantity", "unit_price", "discount", "revenue", "cost",
               "profit", "payment_method", "order_status"]}


def _rules(prefix: str, orders: str) -> dict[str, list[str]]:
    """The rules in SQL over tables named with a prefix."""
    src = {t: f"{prefix}{t}" for t in _COLUMNS} | {"orders": orders}
    o = src["orders"]
    return {
        "missing": [_missing(t, src[t], _COLUMNS[t]) for t in ("customers", "products", "employees")],
        "repeated": [_twice(f"Duplicate {k}", src[t], k) for t, k in
                     (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id"))],
        "rows": [_where("Invalid order dates", o, "try_cast(order_date as date) is null"),
                 _where("Order dates in the future", o, f"try_cast(order_date as date) > date '{_EARLY}'"),
                 _where("Negative or zero quantity", o, "quantity <= 0"), _where("Negative revenue", o, "revenue < 0"),
                 _where("Negative cost", o, "cost < 0"),
                 _where("Incorrect profit calculation (profit != revenue - cost)", o, "profit is distinct from revenue-cost"),
                 _where("Discount outside [0,1] range", o, "discount < 0 or discount > 1"),
                 _missing("orders", o, _COLUMNS["orders"])],
        "unknown": [_lost(k, o, src[t]) for t, k in
                    (("customers", "customer_id"), ("products", "product_id"), ("employees", "employee_id"))],
        "extreme": [_where("Extreme revenue outliers (>99.5th pct)", o,
                           f"cast(revenue as double) > (select quantile_cont(cast(revenue as double), 0.995) from {o})")]}


_RAW, _TIDY = _rules("raw_", "raw_orders"), _rules("", "orders_x")



def _judged(orders):
    return quality.judged_orders(orders, quality.order_rules(orders, _EARLY))


def _outliers(orders):
    return quality.judged_orders(orders, quality.outlier_rule(orders))


raw_case("V01_V03_missing_values", lambda spark, folder: quality.graded(quality.stacked(
    [quality.missing_values(t, _feed(spark, folder)[t]) for t in ("customers", "products", "employees")])),
    sql(_graded(_all(_RAW["missing"])), **BAD_ORDERS))
raw_case("V05_V07_repeated_keys", lambda spark, folder: quality.graded(quality.stacked(
    [quality.repeated_keys(f"Duplicate {k}", _feed(spark, folder)[t], [k]) for t, k in
     (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id"))])),
    sql(_graded(_all(_RAW["repeated"])), **BAD_ORDERS))
raw_case("V04_V08_V12_V17_V18_order_rules", lambda spark, folder: quality.graded(
    _judged(_feed(spark, folder)["orders"])), sql(_graded(_all(_RAW["rows"])), **BAD_ORDERS))


def _unknown(spark, folder):
    raw = _feed(spark, folder)
    return quality.graded(quality.stacked([
        quality.unknown_references(f"Invalid {k} references", raw["orders"], k, raw[t], k) for t, k in
        (("customers", "customer_id"), ("products", "product_id"), ("employees", "employee_id"))]))


raw_case("V13_V15_unknown_references", _unknown, sql(_graded(_all(_RAW["unknown"])), **BAD_ORDERS))
raw_case("V16_extreme_revenue", lambda spark, folder: quality.graded(_outliers(_feed(spark, folder)["orders"])),
         sql(_graded(_all(_RAW["extreme"])), **BAD_ORDERS))
raw_case("V_report_raw", lambda spark, folder: quality.quality_report(_feed(spark, folder), _EARLY),
         sql(_graded(_all(sum(_RAW.values(), []))), **BAD_ORDERS))
case("V_report_clean", lambda s: quality.quality_report(s.tables(), _EARLY),
     sql(_graded(_all(sum(_TIDY.values(), []))), "customers", "products", "employees", "orders_x"))
_SUMMARY = """select count(*) as total_rules, count(*) filter (where "Status"='PASS') as passed, count(*) filter (where "Status"='WARN') as warnings,
  count(*) filter (where "Status"='FAIL') as failed from ({})"""
raw_case("V19_quality_summary", lambda spark, folder: quality.quality_summary(quality.quality_report(_feed(spark, folder), _EARLY)),
         sql(_SUMMARY.format(_graded(_all(sum(_RAW.values(), [])))), **BAD_ORDERS))


def _gate_verdict(spark, folder):
    """What the gate raises for the raw delivery."""
    report = pin(quality.quality_report(_feed(spark, folder), _EARLY))
    try:
        quality.gate(report)
        verdict = ""
    except quality.QualityGate as stop:
        verdict = str(stop)
    return report.agg(F.lit(verdict).alias("verdict"), F.count_if(F.col("Status") == "FAIL").alias("failing"))


raw_case("V20_gate", _gate_verdict, sql(
    f"""select concat('failing rules: ', string_agg("Rule", '; ' order by "Rule")) as verdict, count(*) as failing
from ({_graded(_all(sum(_RAW.values(), [])))}) where "Status"='FAIL'""", **BAD_ORDERS))


def _constraints(spark, folder):
    raw = {t: df.drop("arrival") for t, df in delivered(spark, folder).items()}
    raw["date_dimension"] = raw["date_dimension"].withColumn("date", F.col("date").cast("date"))
    raw["orders"] = raw["orders"].withColumn("order_date", F.col("order_date").cast("date"))
    return quality.constraint_report(raw)


def _constraint_sql() -> str:
    src = {"date_dimension": "cal", **{t: f"raw_{t}" for t in ("customers", "products", "employees", "orders", "returns", "targets")}}
    columns = {**_COLUMNS, "date_dimension": ["date", "day", "month", "month_name", "quarter", "year", "week", "weekday", "fiscal_year"],
               "returns": ["return_id", "order_id", "return_date", "return_reason", "refund_amount"],
               "targets": ["employee_id", "month", "year", "target_amount"]}
    checks = {
        "customers": {"customer_status is Active or Inactive": "customer_status in ('Active','Inactive')"},
        "products": {"unit_cost >= 0": "unit_cost >= 0", "selling_price >= 0": "selling_price >= 0",
                     "product_status is Active or Discontinued": "product_status in ('Active','Discontinued')"},
        "employees": {"target_amount >= 0": "target_amount >= 0"},
        "orders": {"quantity > 0": "quantity > 0", "unit_price >= 0": "unit_price >= 0", "discount between 0 and 1": "discount between 0 and 1",
                   "revenue >= 0": "revenue >= 0", "cost >= 0": "cost >= 0",
                   "order_status is Completed, Returned or Cancelled": "order_status in ('Completed','Returned','Cancelled')"},
        "returns": {"refund_amount >= 0": "refund_amount >= 0"},
        "targets": {"month between 1 and 12": "month between 1 and 12", "target_amount >= 0": "target_amount >= 0"}}
    keys = {"date_dimension": "date", "customers": "customer_id", "products": "product_id", "employees": "employee_id", "orders": "order_id",
            "returns": "return_id", "targets": "employee_id, month, year"}
    parents = (("orders", "order_date", "date_dimension", "date"), ("orders", "customer_id", "customers", "customer_id"),
               ("orders", "product_id", "products", "product_id"), ("orders", "employee_id", "employees", "employee_id"),
               ("returns", "order_id", "orders", "order_id"), ("targets", "employee_id", "employees", "employee_id"))
    parts = [_where(f"{t}.{c} is filled", src[t], f"{c} is null") for t in src for c in columns[t]]
    parts += [_where(f"{t}: {n}", src[t], f"not ({c})") for t in checks for n, c in checks[t].items()]
    parts += [f"select '{t}: ({k}) is unique' as rule, (select count(*) from {src[t]}) as total, "
              f"(select count(*) from {src[t]}) - (select count(*) from (select distinct {k} from {src[t]})) as failed" for t, k in keys.items()]
    parts += [_where(f"{t}.{c} exists in {p}", src[t], f"cast({c} as varchar) not in (select cast({pc} as varchar) from {src[p]})")
              for t, c, p, pc in parents]
    return _graded(_all(parts))


_CAL = (("calendar",), """select date, 1 as day, 1 as month, '' as month_name, 1 as quarter, 1 as year, 1 as week, '' as weekday, 1 as fiscal_year from calendar""")
raw_case("V21_constraints", _constraints, sql(_constraint_sql(), cal=_CAL, **FEED))

# ---- sources and sinks


def _quoted(star):
    """The star with quotes, commas and blanks inside of the customers' names."""
    tables = star.tables()
    tables["customers"] = tables["customers"].withColumn("customer_name", F.concat(
        "customer_name", F.lit(' "'), "customer_segment", F.lit('", '), "region"))
    return Star(**{t: tables[t] for t in SOURCE_TABLES})


def _csv_files(spark, folder):
    home = scratch_path(spark, "delivered")
    write_csv(_quoted(star_from_lines(spark, folder)), home)
    read = flatfiles.read_all_delivered(spark, home)
    return quality.stacked([digest(t, read[t], SCHEMAS[t].names) for t in SOURCE_TABLES])


raw_case("S01_delivered_files", _csv_files, sql("\nunion all ".join(
    digest_sql(t, "quoted" if t == "customers" else c, SCHEMAS[t].names) for t, c in _SOURCES.items()), *_STAR, days=_DAYS,
    quoted=(("customers",), """
select * replace (concat(customer_name,' "',customer_segment,'", ',region) as customer_name) from customers""")))


def _broken_records(spark, folder):
    """Order lines with a field too few, set aside by a load; the rest is loaded."""
    home, star = scratch_path(spark, "broken"), star_from_lines(spark, folder)
    write_csv(star, f"{home}/in")
    short = star.returns.select(F.concat_ws(",", F.concat(F.lit("X"), F.substring("return_id", 2, 99)), "order_id",
                                            F.col("return_date").cast("string"), "return_reason").alias("value"))
    append_records(short, "returns", f"{home}/in")
    loaded = run_load(spark, f"{home}/in", f"{home}/warehouse", quarantine=f"{home}/aside")
    aside = spark.read.parquet(f"{home}/aside/broken_records")
    return quality.stacked([
        digest("broken", aside, ["table_name", "record"]), digest("returns", loaded.returns, SCHEMAS["returns"].names)])


raw_case("S01_broken_records", _broken_records, sql(digest_sql("broken", "broken", ["table_name", "record"]) + "\nunion all "
    + digest_sql("returns", "returns", SCHEMAS["returns"].names), "returns", broken=(("returns",), """
select 'returns' as table_name, concat_ws(',', concat('X',substring(return_id,2)), order_id, cast(return_date as varchar), return_reason) as record
from returns""")))


def _slashed_dates(spark, folder):
    """Files with dates of other forms, the same in a whole column."""
    home, tables = scratch_path(spark, "dates"), star_from_lines(spark, folder).tables()
    for t, column, form in (("orders", "order_date", "MM/dd/yyyy"), ("customers", "acquisition_date", "dd.MM.yyyy"),
                            ("returns", "return_date", "yyyyMMdd")):
        tables[t] = tables[t].withColumn(column, F.date_format(column, form))
    write_csv(Star(**{t: tables[t] for t in SOURCE_TABLES}), f"{home}/in")
    return _digests(run_load(spark, f"{home}/in", f"{home}/warehouse"))


raw_case("T03_date_forms", _slashed_dates, _DIGESTS)


def _report_back(spark, folder):
    home = scratch_path(spark, "reports")
    warehouse.write_report(blocks.risk_summary(star_from_lines(spark, folder)), home, "risk")
    return warehouse.read_report(spark, home, "risk", "risk_level string, count bigint, avg_probability double", "the test")


raw_case("S02_report_read_back", _report_back, sql(_RISK, "churn"))


def _stored(spark, folder):
    home = scratch_path(spark, "warehouse")
    tables = star_from_lines(spark, folder).tables()
    warehouse.store_all({t: tables[t] for t in SOURCE_TABLES}, home)
    return home


raw_case("S03_full_refresh", lambda spark, folder: _digests(warehouse.open_star(spark, _stored(spark, folder))), _DIGESTS)
raw_case("S03_loaded_counts", lambda spark, folder: warehouse.loaded_counts(spark, _stored(spark, folder)),
         f"select table_name, row_count from ({_DIGESTS})")
raw_case("S04_stored_fact", lambda spark, folder: warehouse.open_star(spark, _stored(spark, folder)).orders.where(
    "order_status <> 'Cancelled'").select("customer_id", "order_date", "revenue"),
    sql(f"select customer_id, order_date, {money('rc')} as revenue from sold", "sold"))


def _predictions(spark, folder):
    home, star = scratch_path(spark, "predictions"), star_from_lines(spark, folder)
    for _ in range(2):  # the second run replaces the first
        warehouse.store_table(star.churn, home, warehouse.PREDICTIONS)
    return warehouse.load_table(spark, home, warehouse.PREDICTIONS)


raw_case("S06_predictions_replaced", _predictions, sql("""
select customer_id, cast(churn_probability as double) as churn_probability, churn_prediction, risk_level from churn""", "churn"))


def _export(spark, folder):
    home = scratch_path(spark, "export")
    listed = blocks.product_performance(star_from_lines(spark, folder))
    flatfiles.export_csv(listed, home)
    return spark.read.schema(listed.schema).option("header", True).csv(home)


raw_case("S07_export", _export, sql(f"select {_SHOWN} from listed", listed=_PRODUCTS))


def _quality_page(spark, folder):
    home = scratch_path(spark, "reports")
    report = quality.quality_report(star_from_lines(spark, folder).tables(), _EARLY)
    warehouse.write_report(report, home, "data_quality_report")
    return blocks.data_quality(spark, home)["summary"]


raw_case("A32_data_quality_page", _quality_page, sql(
    _SUMMARY.format(_graded(_all(sum(_TIDY.values(), [])))), "customers", "products", "employees", "orders_x"))
