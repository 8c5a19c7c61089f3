"""The scoring jobs: each computes its reports and stores them for the pages to read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.operators import churn, forecast, rfm
from tillgrain.plans.blocks import FORECAST_REPORTS
from tillgrain.session import pin
from tillgrain.sources.star import Star
from tillgrain.sources.warehouse import PREDICTIONS, read_report, store_table, write_report

COMPARISON_SCHEMA = "model string, " + ", ".join(f"{m} double" for m in churn.METRICS)


def run_segments(star: Star, reports: str) -> DataFrame:
    """Quantile segments, written in full; returns their sizes."""
    segments = pin(rfm.quantile_segments(star))
    write_report(segments, reports, "rfm_segments")
    return rfm.segment_sizes(segments)


def run_churn(star: Star, warehouse: str, reports: str) -> Star:
    """Train, compare, score everyone, and replace the predictions table."""
    trained, predictions = churn.run_churn(star)
    predictions = pin(predictions)
    write_report(trained.comparison.select("model", *churn.METRICS).coalesce(1), reports,
                 "churn_model_comparison")
    write_report(predictions, reports, PREDICTIONS)
    store_table(predictions, warehouse, PREDICTIONS)
    return star.with_predictions(predictions)


def run_forecast(star: Star, reports: str) -> None:
    """The total series: backtest, 30 days, 3 and 6 months, and the actuals. Each report has at
    most a few hundred rows."""
    daily = pin(forecast.daily_series(star))
    months = pin(forecast.monthly_forecast(daily, 6))
    outputs = {
        "forecast_backtest_metrics": forecast.backtest(daily).drop("series"),
        "forecast_next_30_days":
            forecast.daily_forecast(daily, 30).orderBy("step").drop("series", "step"),
        "forecast_next_6_months": months.orderBy("step").drop("series", "step"),
        "forecast_next_3_months":
            months.where("step <= 3").orderBy("step").drop("series", "step"),
        "actual_monthly_revenue": forecast.actual_monthly(daily).drop("series").orderBy("month")}
    for name, df in outputs.items():
        write_report(df.coalesce(1), reports, name)


def evaluation_summary(spark: SparkSession, reports: str) -> DataFrame:
    """Model comparison and backtest errors in one long report."""
    models = read_report(spark, reports, "churn_model_comparison", COMPARISON_SCHEMA,
                         "the churn job")
    errors = read_report(spark, reports, "forecast_backtest_metrics",
                         FORECAST_REPORTS["forecast_backtest_metrics"], "the forecast job")
    return as_long(models, "churn model comparison", "model").unionByName(
        as_long(errors.withColumn("model", F.lit("Holt-Winters")),
                "forecast backtest (30-day holdout)", "model"))


SUMMARY = "model_evaluation_summary"
SUMMARY_SCHEMA = "section string, subject string, metric string, value double"


def run_evaluation(spark: SparkSession, reports: str) -> DataFrame:
    """Store the summary beside the reports that it is made of, and read it back."""
    write_report(evaluation_summary(spark, reports).coalesce(1), reports, SUMMARY)
    return read_report(spark, reports, SUMMARY, SUMMARY_SCHEMA, "the evaluation job")


def as_long(df: DataFrame, section: str, subject: str) -> DataFrame:
    values = [c for c in df.columns if c != subject]
    return (df.unpivot([subject], values, "metric", "value")
            .select(F.lit(section).alias("section"), F.col(subject).alias("subject"), "metric",
                    F.col("value").cast("double").alias("value")))
