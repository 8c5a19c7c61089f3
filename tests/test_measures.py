"""Grouping by any column, periods, and retention by bits of months."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, d, make_star, order, rows
from tillgrain.operators.context import UnknownColumn, resolved
from tillgrain.operators.scope import Filters
from tillgrain.plans import measures
from tillgrain.sources.star import Star


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(11)
    orders = [order(f"O{i}", f"{rng.choice([2015, 2016, 2020, 2021])}-{rng.randint(1, 12):02d}-"
                             f"{rng.randint(1, 28):02d}", f"C{rng.randint(1, 6)}",
                    product=rng.choice(["P1", "P2"]), employee=rng.choice(["E1", "E2"]),
                    revenue=f"{rng.randint(1, 90)}.00", status=rng.choice(["Completed"] * 9 + ["Cancelled"]))
              for i in range(400)]
    made = make_star(spark, orders, customers=[(f"C{i}", "North" if i % 2 else None, "X")
                                               for i in range(1, 8)])
    calendar = spark.sql("select explode(sequence(date'2015-01-01', date'2021-12-31')) as date")
    from tillgrain.functions.dates import calendar_columns
    return Star(**{**made.tables(), "date_dimension": calendar.select(*calendar_columns())})


def test_owners_of_columns():
    got = [(g.table, g.column, g.name) for g in resolved(
        ["region", "employees.region", "category", "quarter", "order_status", "customer_id"])]
    assert got == [("customers", "region", "region"), ("employees", "region", "employees_region"),
                   ("products", "category", "category"), ("date_dimension", "quarter", "quarter"),
                   ("orders", "order_status", "order_status"), ("customers", "customer_id", "customer_id")]
    for wrong in ("colour", "products.region", "nowhere.region"):
        with pytest.raises(UnknownColumn):
            resolved([wrong])


@pytest.mark.parametrize("by_columns", [[], ["region"], ["category"], ["region", "category"],
                                        ["customer_id"], ["employee_name"]])
def test_retention_follows_distinct_months(star, by_columns):
    """Months far apart, over the ends of words of bits, with groups without a name."""
    months = (star.orders.where("order_status <> 'Cancelled'")
              .join(star.customers, "customer_id").join(star.products, "product_id")
              .join(star.employees.select("employee_id", "employee_name"), "employee_id")
              .select(*by_columns, *([] if "customer_id" in by_columns else ["customer_id"]),
                      F.trunc("order_date", "MM").alias("month")).distinct().collect())
    seen = {tuple(r) for r in months}
    groups = {}
    for r in months:
        key = tuple(r[c] for c in by_columns)
        before = d(f"{r['month'].year - (r['month'].month == 1)}-{(r['month'].month - 2) % 12 + 1:02d}-01")
        stayed = (*tuple(r)[:-1], before) in seen
        all_, kept = groups.get((*key, r["month"]), (0, 0))
        groups[(*key, r["month"])] = all_ + 1, kept + stayed
    got = {tuple(r)[:-1]: float(r["customer_retention_pct"])
           for r in measures.customer_retention(star, by_columns).collect()}
    assert got == {k: round(100 * kept / all_, 6) for k, (all_, kept) in groups.items()}


def test_retention_over_the_end_of_a_word(spark):
    """62 months fill a word: every two neighbouring months count, wherever words end."""
    months = [f"{2010 + n // 12}-{n % 12 + 1:02d}-15" for n in range(140)]
    star = make_star(spark, [order(f"O{n}", day, "C1") for n, day in enumerate(months)])
    got = rows(measures.customer_retention(star))
    assert len(got) == 140
    assert [float(r["customer_retention_pct"]) for r in got] == [0.0] + [100.0] * 139


def test_retention_reads_the_fact_once_and_needs_no_window(star):
    plan = measures.customer_retention(star, ["category"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    for line in plan.splitlines():
        if "Join" in line:
            assert "customer_id" not in line


def test_columns_of_other_tables_leave_the_customers_whole(star):
    got = by(measures.total_customers(star, ["category"]), "category")
    assert {k: r["total_customers"] for k, r in got.items()} == {"Tools": 7, "Toys": 7}
    both = {(r["region"], r["category"]): r["total_customers"]
            for r in rows(measures.total_customers(star, ["region", "category"]))}
    assert both == {(r, c): n for r, n in (("North", 4), (None, 3)) for c in ("Tools", "Toys")}
    narrow = rows(measures.total_customers(star, ["category"], Filters(region="North", category="Toys")))
    assert [(r["category"], r["total_customers"]) for r in narrow] == [("Toys", 4)]


def test_revenue_per_customer_by_category(star):
    revenue = by(measures.measure(star, "total_revenue", ["category"]), "category")
    got = by(measures.revenue_per_customer(star, ["category"]), "category")
    for category, r in got.items():
        assert float(r["revenue_per_customer"]) == pytest.approx(
            float(revenue[category]["total_revenue"]) / 7, abs=1e-6)


@pytest.mark.parametrize("grain,months", [("quarter", 3), ("year", 12)])
def test_periods_are_moved_month_by_month(star, grain, months):
    single = {r["month"]: r["total_revenue"] for r in rows(star.orders.where(
        "order_status <> 'Cancelled'").groupBy(F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("revenue").alias("total_revenue")))}

    def total(period, back):
        start = period.year * 12 + period.month - 1 - back
        found = [single[m] for n in range(months)
                 if (m := d(f"{(start + n) // 12}-{(start + n) % 12 + 1:02d}-01")) in single]
        return sum(found) if found else None

    for name, back, measure in (("yoy_revenue", 12, measures.year_ago_revenue),
                                ("mom_revenue", 1, measures.month_ago_revenue)):
        got = rows(measure(star, grain=grain))
        assert got
        for r in got:
            assert (r["revenue"], r[name]) == (total(r[grain], 0), total(r[grain], back))


def test_the_grain_is_no_group(star):
    with pytest.raises(ValueError, match="month is the grain"):
        measures.year_ago_revenue(star, ["month"])


def test_sums_meet_dimensions_at_key_grain(star):
    plan = measures.measure(star, "total_revenue", ["region"], Filters(category="Toys"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    joins = [n for n, line in enumerate(text.splitlines()) if "Join" in line]
    sums = [n for n, line in enumerate(text.splitlines()) if "Aggregate" in line]
    assert joins and max(joins) < max(sums)  # an aggregate stands below every join
