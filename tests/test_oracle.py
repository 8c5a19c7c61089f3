"""Queries against their SQL oracles, value by value, on the smallest tables.

By default a selection that takes in every module runs; ORACLES=all runs every key. The full check on
larger tables is ``python -m contract.compare``.
"""

import os

import pytest

from contract.cases import load
from contract.compare import connect, differences
from contract.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
load()

SELECTION = """VW3_customer_summary VW4_product_summary VW6_salesperson_summary VW8_rfm_segments
BQ01_top_customers BQ06_monthly_growth BQ08_salesperson_ranking BQ09_retention BQ15_declining_customers
BQ17_target_achievement BQ18_top_products_per_region BQ22_first_and_repeat BQ24_discount_impact
BQ27_revenue_concentration K04_retention_rate K07_target_achievement F01_filters F04_page
A01_dashboard_kpis_filtered A02_dashboard_growth A16_customer_table A18_lowest_margin_products
A22_region_trend A25_tier_counts A28_churn_table I_all_insights M07_revenue_growth_yoy
M11_customer_retention U01_region_pivot T01_first_orders T09_returns_of_kept_orders T12_calendar
V_report_raw V21_constraints S01_delivered_files R04_quantile_segments C01_features
C04_stratified_split C09_metrics P01_daily_series_by_region A28_churn_table_sought
M05_total_customers_by_category M08_yoy_revenue_by_quarter_and_category M11_customer_retention_by_category
M13_revenue_per_customer_by_region_and_category R03_rank_scores S03_full_refresh T03_date_forms
P03_state_for_given_weights P04_bands_for_given_weights P05_backtest_for_given_weights
P07_summary_of_given_results C06_chance_from_weights C07_forest_from_nodes C08_boosting_from_nodes""".split()
KEYS = sorted(ORACLES) if os.environ.get("ORACLES") == "all" else SELECTION


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    _, message = differences(duck, QUERIES[key], ORACLES[key], spark, FOLDER)
    assert message == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
