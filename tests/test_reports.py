"""Edge cases the generated tables do not reach."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, d, make_star, order, rows
from tillgrain.functions.ratios import pct, per
from tillgrain.operators import rfm
from tillgrain.operators.rollup import by_attribute, sold
from tillgrain.operators.scope import (
    Filters, Order, matches, page_after, page_info, page_of, scoped_orders)
from tillgrain.plans import blocks, client, insights, kpis, measures, queries, views
from tillgrain.session import scratch_path
from tillgrain.sources import linestar
from tillgrain.sources.star import Star

M = Decimal


@pytest.fixture(scope="module")
def star(spark):
    return make_star(spark, [
        order("O1", "2024-01-10", "C1", revenue="100.00", cost="60.00"),
        order("O2", "2024-02-10", "C1", revenue="50.00", cost="60.00", discount="0.2"),
        order("O3", "2024-04-10", "C1", product="P2", revenue="0.00", cost="0.00"),
        order("O4", "2024-02-11", "C2", employee="E2", revenue="70.00", cost="20.00"),
        order("O5", "2024-02-12", "C3", revenue="999.00", status="Cancelled"),
        order("O6", "2024-02-13", "C2", revenue="30.00", cost="10.00", status="Returned"),
    ], returns=[("R1", "O6", "2024-02-20"), ("R2", "O6", "2024-02-21"), ("R3", "O5", "2024-02-22")],
        targets=[("E1", 1, 2024, "100.00"), ("E1", 2, 2024, "100.00")],
        churn=[("C1", "0.90000", 1, "High"), ("C2", "0.10000", 0, "Low")])


def test_customers_without_revenue_stay_in_the_summary(star):
    got = by(views.customer_summary(star, "2024-05-01"), "customer_id")
    assert got["C3"]["total_orders"] == 0
    assert got["C3"]["total_revenue"] == 0
    assert got["C3"]["last_purchase_date"] is None
    assert got["C3"]["days_since_last_purchase"] is None
    assert got["C1"]["days_since_last_purchase"] == 21


def test_two_returns_do_not_double_revenue(star):
    got = by(views.product_summary(star), "product_id")["P1"]
    assert got["total_revenue"] == M("250.00")
    assert got["return_count"] == 2  # the cancelled order's return does not count here
    rate = by(queries.return_rates(star), "product_id")["P1"]
    assert (rate["total_orders"], rate["total_returns"]) == (5, 3)


def test_zero_revenue_has_no_margin(star):
    assert by(views.product_summary(star), "product_id")["P2"]["profit_margin_pct"] is None
    assert by(measures.measure(star, "profit_margin_pct", ["category"]), "category")[
        "Toys"]["profit_margin_pct"] == 0


def test_monthly_growth_reaches_over_gaps_but_the_calendar_shift_does_not(star):
    lag = by(queries.monthly_growth(star), "month")
    assert lag[d("2024-04-01")]["prev_month_revenue"] == M("150.00")
    shift = by(measures.month_ago_revenue(star), "month")
    assert shift[d("2024-04-01")]["mom_revenue"] is None
    assert shift[d("2024-02-01")]["mom_revenue"] == M("100.00")


def test_retention(star):
    got = by(kpis.retention_rate(star), "month")[d("2024-02-01")]
    assert (got["active_customers"], got["retained_from_prior_month"]) == (2, 1)
    assert got["retention_rate_pct"] == M("50.00")


def test_new_and_returning_add_up(star):
    got = rows(blocks.new_and_returning(star))[0]
    assert got == {"new_customer_orders": 2, "returning_customer_orders": 3}
    assert sold(star.orders).count() == 5


def test_targets_do_not_fan_out(star):
    got = by(queries.target_achievement(star, "2024-12-31"), "employee_id")
    assert set(got) == {"E1"}
    assert got["E1"]["annual_target"] == M("200.00")
    assert got["E1"]["actual_revenue"] == M("180.00")
    assert got["E1"]["achievement_pct"] == M("90.00")


def test_tiers(star):
    got = by(blocks.tiered_scorecard(star), "employee_id")
    assert got["E1"]["performance_tier"] == "Strong Performer"
    assert got["E2"]["performance_tier"] == "No Data"
    assert [r["performance_tier"] for r in rows(blocks.tier_counts(star))] == [
        "Strong Performer", "No Data"]
    assert by(client.attainment(star), "employee_id")["E2"]["tier"] == "Needs Improvement"


def test_filters_narrow(star):
    everything = rows(blocks.dashboard_kpis(star))[0]
    north = rows(blocks.dashboard_kpis(star, Filters(region="North")))[0]
    assert north["total_revenue"] == M("150.00") <= everything["total_revenue"] == M("250.00")
    both_ends = Filters(date_from="2024-02-10", date_to="2024-02-11")
    assert scoped_orders(star, both_ends).count() == 2
    assert scoped_orders(star, Filters(region="", salesperson="")).count() == 5
    assert scoped_orders(star, Filters(salesperson="Eve", category="Tools")).count() == 1


def test_nothing_matches(star):
    got = rows(blocks.dashboard_kpis(star, Filters(region="Nowhere")))[0]
    assert got["total_orders"] == 0 and got["total_revenue"] == 0
    assert got["profit_margin_pct"] is None
    assert rows(blocks.dashboard_growth(star, Filters(region="Nowhere"))) == [
        {"yoy_growth_pct": None}]


def test_reversed_dates_are_refused():
    with pytest.raises(ValueError):
        Filters(date_from="2025-01-01", date_to="2024-01-01")


@pytest.mark.parametrize("page,size", [(0, 5), (1, 0), (1, 201)])
def test_bad_pages_are_refused(star, page, size):
    with pytest.raises(ValueError):
        page_of(star.customers, [F.col("customer_id")], page, size)


def test_sought_pages_equal_numbered_ones(spark):
    df = spark.range(100).selectExpr("id as k", "if(id % 9 = 0, null, id % 4) as v")
    order = [Order("v", descending=True), Order("k")]
    last = None
    for page in range(1, 17):
        near = rows(page_of(df, [o.sort() for o in order], page, 7))
        assert rows(page_after(df, order, last, 7)) == near
        last = near[-1] if near else None
    assert near == []


def test_pages_by_number(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r["k"] for r in rows(page_of(df, [F.desc("k")], 4, 7))] == list(range(78, 71, -1))
    assert rows(page_info(df, 4, 7)) == [
        {"page": 4, "page_size": 7, "total_rows": 100, "page_count": 15}]


def test_page_count_of_nothing(spark):
    assert rows(page_info(spark.range(0)))[0]["page_count"] == 1


def test_search_is_case_blind_and_keeps_wildcards(star):
    found = star.customers.where(matches("name c_", "customer_name", "customer_id"))
    assert found.count() == 3
    assert star.customers.where(matches("c2", "customer_name", "customer_id")).count() == 1


def test_both_ways_to_an_attribute_agree(spark, star):
    args = (sold(star.orders), star.customers, "customer_id", ["region"],
            ["revenue", "orders", "first_purchase"])
    month = F.trunc("order_date", "MM").alias("month")
    looked_up = sorted(map(str, rows(by_attribute(*args, extra=[month]))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, rows(by_attribute(*args, extra=[month])))) == looked_up
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insights_follow_their_conditions(star):
    got = by(insights.all_insights(star), "insight_id")
    assert 1 not in got  # no revenue twelve months earlier
    assert got[4]["text"].startswith("50.0% of customers")
    assert got[2]["text"] == "The North region generates the highest revenue at ₹150."
    assert got[6]["value"] > 0
    assert 8 not in got  # no product name with more than 20 orders


def test_discount_insight_comes_from_the_shared_sums(spark):
    """Orders without a discount class, without revenue, or cancelled count in neither mean."""
    star = make_star(spark, [
        order("O1", "2024-01-10", "C1", revenue="100.00", cost="90.00", discount="0.2"),
        order("O2", "2024-01-11", "C1", revenue="100.00", cost="60.00", discount="0.15"),
        order("O3", "2024-01-11", "C2", revenue="50.00", cost="15.00"),
        order("O4", "2024-01-12", "C2", revenue="0.00", cost="5.00", discount="0.3"),
        order("O5", "2024-01-12", "C2", revenue="80.00", cost="1.00", discount="0.3", status="Cancelled")])
    grains = insights.Grains(star)
    nothing = make_star(spark, [])
    want = rows(insights.discount_effect(star))
    assert want and rows(insights.discount_effect(nothing, grains)) == want
    assert want[0]["value"] == 45.0 and " 10.00%" in want[0]["text"]
    assert rows(insights.discount_effect(star, insights.Grains(nothing))) == []


def test_returns_meet_only_heads_of_lines_that_may_be_returned(spark):
    """The same returns as by the status of all lines; the other lines are left out before the join."""
    home = scratch_path(spark, "lines")
    day = "timestamp_ntz'1996-02-03 00:00:00'"
    spark.sql(f"""select id as o_orderkey, id as o_custkey, if(id = 2, 'P', 'F') as o_orderstatus, 1D as o_totalprice,
        {day} as o_orderdate, '1-URGENT' as o_orderpriority from range(1, 5)""").write.parquet(f"{home}/orders.parquet")
    spark.sql(f"""select id as l_orderkey, n as l_partkey, n as l_suppkey, cast(n as int) as l_linenumber,
        2D as l_quantity, 100D as l_extendedprice, 0.04D as l_discount, 0D as l_tax,
        case when n = 2 then 'N' when id = 4 then null else 'R' end as l_returnflag, 'O' as l_linestatus,
        {day} as l_shipdate from range(1, 6) lateral view explode(array(1L, 1L, 2L, 3L, null)) as n
        """).write.parquet(f"{home}/lineitem.parquet")
    found = linestar.returns(spark, home)
    plain = linestar.returned_lines(linestar.order_lines(spark, home))
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, plain.collect())) and [r[1][:8] for r in got] == ["ORD-1-1-"] * 2 + ["ORD-3-1-"] * 2
    shown = found._jdf.queryExecution().optimizedPlan().toString()
    below = shown[shown.index("Join Inner"):].split("\n")[1:]
    assert any("Filter" in line and "<= 2)" in line for line in below), shown


def test_thin_margin_insight(spark):
    thin = make_star(spark, [
        order("O1", "2024-01-10", "C1", revenue="100.00", cost="90.00"),
        order("O2", "2024-01-10", "C1", product="P2", revenue="50.00", cost="10.00")])
    got = rows(insights.thin_margin_category(thin))
    assert got[0]["text"] == ("Tools has the highest revenue but a below-average profit margin of "
                              "10.00% versus a 45.0% average across categories.")


def test_revenue_change_wording(spark):
    falling = make_star(spark, [order("O1", "2023-01-10", "C1", revenue="200.00"),
                                order("O2", "2024-01-10", "C1", revenue="150.00")])
    assert rows(insights.revenue_change(falling))[0]["text"].startswith("Revenue decreased 25.0%")


def test_empty_star(spark):
    nothing = make_star(spark, [], churn=[])
    assert rows(kpis.churn_rate(nothing)) == [{"churn_rate_pct": None}]
    assert queries.first_and_repeat(nothing).count() == 0
    assert [r["insight_id"] for r in rows(insights.all_insights(nothing))] == [7]
    assert rows(kpis.average_order_value(nothing)) == [{"avg_order_value": None}]
    assert queries.revenue_concentration(nothing).count() == 0
    assert views.rfm_segments(nothing, "2024-05-01").count() == 0


def test_few_products_overlap_in_best_and_worst(star):
    listed = blocks.product_performance(star)
    best = [r["product_id"] for r in rows(blocks.best_and_worst(listed, "revenue", True))]
    worst = [r["product_id"] for r in rows(blocks.best_and_worst(listed, "revenue", False))]
    assert best == worst == ["P1", "P2"]


def test_views_are_registered(spark, star):
    names = views.register_views(spark, star, "2024-05-01")
    assert len(names) == 9
    got = spark.sql("select sum(total_revenue) as r from vw_region_summary").first()["r"]
    assert got == M("250.00")


def test_shares_sum_to_a_hundred(star):
    total = sum(r["pct_of_total"] for r in rows(queries.region_share(star)))
    assert abs(total - 100) < M("0.05")


def test_mean_rounds_halves_up(spark):
    tie = make_star(spark, [order("O1", "2024-01-10", "C1", revenue="0.01"),
                            order("O2", "2024-01-10", "C1", revenue="0.02")])
    assert rows(kpis.average_order_value(tie)) == [{"avg_order_value": M("0.02")}]


def test_quotients_are_rounded_once(spark):
    near_tie = spark.createDataFrame([(M("123449999996.00"), M("1000000000000.00"))],
                                     "part decimal(34,2), whole decimal(34,2)")
    got = near_tie.select(pct(F.col("part"), F.col("whole")).alias("up"),
                          pct(-F.col("part"), F.col("whole")).alias("down"),
                          per(F.lit(1), F.lit(8)).alias("tie"),
                          per(F.lit(1), F.lit(0)).alias("nothing")).first()
    assert tuple(got) == (M("12.34"), M("-12.34"), M("0.13"), None)


def test_growth_keeps_months_and_groups_without_revenue_or_name(spark):
    sold_in = make_star(spark, [order("O1", "2023-01-10", "C1"), order("O2", "2023-02-10", "C1"),
                                order("O3", "2024-01-10", "C2")],
                        customers=[("C1", None, "X"), ("C2", "South", "X")])
    calendar = spark.sql("select explode(sequence(date'2023-01-01', date'2024-03-31')) as date")
    tables = {**sold_in.tables(), "date_dimension": calendar}
    got = {(r["region"], str(r["month"])[:7]): (r["revenue"], r["yoy_revenue"])
           for r in rows(measures.year_ago_revenue(Star(**tables), ["region"]))}
    hundred = M("100.00")
    assert got == {(None, "2023-01"): (hundred, None), (None, "2023-02"): (hundred, None),
                   (None, "2024-01"): (None, hundred), (None, "2024-02"): (None, hundred),
                   ("South", "2024-01"): (hundred, None)}
    kept = {(r["region"], str(r["month"])[:7]): r["customer_retention_pct"]
            for r in rows(measures.customer_retention(Star(**tables), ["region"]))}
    assert kept[(None, "2023-02")] == 100 and kept[(None, "2023-01")] == 0


def test_churn_pages_share_their_scores(spark):
    plain = make_star(spark, [order("O1", "2024-01-10", "C1", revenue="100.00"), order("O2", "2024-02-10", "C1", revenue="50.00")],
                      churn=[("C1", "0.90000", 1, "High"), ("C2", "0.80000", 1, "High")])
    scored = rfm.scored(plain)
    assert rfm.scored(scored) is scored
    got = by(blocks.churn_table_after(scored, None, "High", 25, "2024-03-01"), "customer_id")
    assert (got["C1"]["revenue"], got["C1"]["orders"], got["C2"]["orders"]) == (M("150.00"), 2, 0)
    assert got["C2"]["rfm_segment"] is None
