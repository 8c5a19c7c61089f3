"""Headline timings: load the star once, then run reports over the stored tables.

Prints one JSON line. Folder and cores come from BENCH_SF_DIR and BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillgrain.model import SOURCE_TABLES  # noqa: E402
from tillgrain.operators import churn, forecast, quality, rfm  # noqa: E402
from tillgrain.operators.scope import Filters  # noqa: E402
from tillgrain.plans import blocks, insights, kpis, measures, queries, views  # noqa: E402
from tillgrain.session import build_session  # noqa: E402
from tillgrain.sources.linestar import star_from_lines  # noqa: E402
from tillgrain.sources.warehouse import PREDICTIONS, open_star, store_all  # noqa: E402

AS_OF = "2001-08-02"
NARROW = Filters(date_from="1998-01-01", date_to="1999-12-31", region="ASIA")

QUERIES = {
    "monthly_revenue": views.monthly_revenue,
    "sales_summary": views.sales_summary,
    "customer_summary": lambda s: views.customer_summary(s, AS_OF),
    "product_summary": views.product_summary,
    "region_summary": views.region_summary,
    "salesperson_summary": views.salesperson_summary,
    "rfm_ntile_segments": lambda s: rfm.ntile_segments(s, AS_OF),
    "rfm_quantile_segments": rfm.quantile_segments,
    "top_customers": queries.top_customers,
    "yearly_growth": queries.yearly_growth,
    "salesperson_ranking": queries.salesperson_ranking,
    "retention": queries.retention,
    "declining_customers": lambda s: queries.declining_customers(s, AS_OF),
    "top_products_per_region": queries.top_products_per_region,
    "first_and_repeat": queries.first_and_repeat,
    "return_rates": queries.return_rates,
    "discount_impact": queries.discount_impact,
    "revenue_concentration": queries.revenue_concentration,
    "salesperson_months": queries.salesperson_months,
    "headline_kpis": kpis.headline,
    "retention_rate": kpis.retention_rate,
    "target_achievement": lambda s: kpis.target_achievement(s, AS_OF),
    "dashboard_kpis_filtered": lambda s: blocks.dashboard_kpis(s, NARROW),
    "dashboard_growth": blocks.dashboard_growth,
    "region_trend": blocks.region_trend,
    "scorecard": blocks.tiered_scorecard,
    "churn_list": lambda s: blocks.churn_list(s, as_of=AS_OF),
    "insights": insights.all_insights,
    "customer_retention_measure": measures.customer_retention,
    "quality_report": lambda s: quality.quality_report(s.tables(), AS_OF),
    "churn_features": churn.training_set,
    "daily_forecast_by_region": lambda s: forecast.daily_forecast(
        forecast.daily_series(s, "region")),
}


def run(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.default.parallelism": cpus,
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    home = tempfile.mkdtemp(prefix="bench-")

    def load() -> None:
        tables = star_from_lines(spark, folder).tables()
        store_all({t: tables[t] for t in (*SOURCE_TABLES, PREDICTIONS)}, home)

    times = {"load": run(load)}
    for name, query in QUERIES.items():
        if not wanted or name in wanted:
            times[name] = run(lambda: drain(query(open_star(spark, home))))
    spark.stop()
    shutil.rmtree(home, ignore_errors=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder)[2:]}))


if __name__ == "__main__":
    main()
