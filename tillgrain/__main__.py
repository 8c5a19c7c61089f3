"""Jobs from the command line: python -m tillgrain <job> --warehouse ... --reports ..."""

from __future__ import annotations

import argparse

from tillgrain.plans import etl, jobs
from tillgrain.session import build_session, clear_scratch
from tillgrain.sources.warehouse import open_star

JOBS = {
    "validate": lambda spark, a: etl.judge_delivered(
        spark, a.delivered, a.reports, a.as_of, a.multi_line).show(50, False),
    "load": lambda spark, a: etl.run_load(spark, a.delivered, a.warehouse, a.reports, a.as_of,
                                          a.multi_line, a.quarantine),
    "segments": lambda spark, a: jobs.run_segments(open_star(spark, a.warehouse), a.reports).show(),
    "churn": lambda spark, a: jobs.run_churn(open_star(spark, a.warehouse), a.warehouse, a.reports),
    "forecast": lambda spark, a: jobs.run_forecast(open_star(spark, a.warehouse), a.reports),
    "evaluate": lambda spark, a: jobs.run_evaluation(spark, a.reports).show(50, False),
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillgrain")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--delivered", default="data/delivered")
    parser.add_argument("--warehouse", default="data/warehouse")
    parser.add_argument("--reports", default="data/reports")
    parser.add_argument("--as-of", default=None, help="day to count from; today if not given")
    parser.add_argument("--multi-line", action="store_true",
                        help="delivered files hold line breaks inside of quotes")
    parser.add_argument("--quarantine", default=None,
                        help="folder for records with a wrong number of fields; without it they stop a load")
    parser.add_argument("--master", default=None)
    arguments = parser.parse_args()
    spark = build_session(f"tillgrain-{arguments.job}", arguments.master)
    try:
        JOBS[arguments.job](spark, arguments)
    finally:
        clear_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()
