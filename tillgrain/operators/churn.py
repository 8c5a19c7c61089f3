"""Churn: features up to a cutoff, a label from what follows, three models, and scores."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from tillgrain.functions.labels import risk_level
from tillgrain.operators.ordering import with_row_number, with_running_sums
from tillgrain.operators.rollup import returns_per_order, sold
from tillgrain.session import pin
from tillgrain.sources.star import Star

LABEL_WINDOW_DAYS = 120
TEST_SHARE = 0.25
SEED = 42
FEATURES = ["frequency", "total_spend", "avg_order_value", "avg_discount", "return_rate",
            "customer_tenure_days_at_cutoff"]
MODELS = ("Logistic Regression", "Random Forest", "Gradient Boosting")
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


def remembered(star: Star) -> Star:
    """The star with its history: what features need of each order that counts, and the order's number
    of returns. Features of any day, and the last day, are sums over it, so the orders are joined and
    met with their returns once."""
    if star.history is not None:
        return star
    rows = sold(star.orders).select("order_id", "customer_id", "order_date", "revenue", "discount")
    counted = rows.join(returns_per_order(star.returns), "order_id", "left")
    return star.with_history(pin(counted.drop("order_id")))


def last_order_day(star: Star) -> dt.date:
    rows = sold(star.orders) if star.history is None else star.history
    day = rows.agg(F.max("order_date")).first()[0]
    if day is None:
        raise ValueError("there are no orders to learn from")
    return day


def features_as_of(star: Star, cutoff: dt.date) -> DataFrame:
    """Per customer with an order up to the cutoff: behaviour up to then, and whether the customer
    bought again after it. One pass over the history yields both sides of the cutoff."""
    orders = remembered(star).history
    day, until = F.col("order_date"), F.lit(cutoff)
    seen = day <= until

    def before(column: str) -> Column:
        return F.when(seen, F.col(column))

    per_customer = orders.groupBy("customer_id").agg(
        F.count_if(seen).alias("frequency"),
        F.sum(before("revenue")).cast("double").alias("total_spend"),
        F.count(before("revenue")).alias("_revenues"),
        F.sum(before("discount")).cast("double").alias("_discounts"),
        F.count(before("discount")).alias("_discounted"),
        F.min(before("order_date")).alias("_first"),
        F.max(before("order_date")).alias("_last"),
        F.sum(before("return_count")).alias("return_count"),
        F.count_if(~seen).alias("_later")).where("frequency > 0")
    zero = F.lit(0.0)
    counted = F.when(F.col("customer_id").isNull(), 0).otherwise(F.coalesce(F.col("return_count"), F.lit(0)))
    return per_customer.select(
        "customer_id", "frequency",
        F.coalesce(F.col("total_spend"), zero).alias("total_spend"),
        F.coalesce(F.col("total_spend") / F.nullif(F.col("_revenues"), F.lit(0)), zero)
        .alias("avg_order_value"),
        F.coalesce(F.col("_discounts") / F.nullif(F.col("_discounted"), F.lit(0)), zero)
        .alias("avg_discount"),
        counted.alias("return_count"),
        (counted / F.col("frequency")).alias("return_rate"),
        F.date_diff(until, F.col("_first")).alias("customer_tenure_days_at_cutoff"),
        F.date_diff(until, F.col("_last")).alias("days_since_last_purchase"),
        (F.col("_later") == 0).cast("int").alias("is_churned"))


def training_set(star: Star, window_days: int = LABEL_WINDOW_DAYS) -> DataFrame:
    """Customers seen by the cutoff; churned means no order in the days after it."""
    star = remembered(star)
    cutoff = last_order_day(star) - dt.timedelta(days=window_days)
    return features_as_of(star, cutoff).select("customer_id", *FEATURES, "is_churned")


def scoring_set(star: Star) -> DataFrame:
    """Every buying customer as of the last order day. The days since the last purchase are shown,
    but no model uses them."""
    star = remembered(star)
    return features_as_of(star, last_order_day(star)).select(
        "customer_id", *FEATURES, "days_since_last_purchase")


def stratified_split(features: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED,
                     slices: int | None = None) -> DataFrame:
    """Add ``is_test``: exact class shares, decided by a hash of customer and seed.

    The same customers fall on the same side however the frame is partitioned. Only the two class
    sizes reach the driver. The features are pinned, since both the sizes and the order need them.
    """
    features = pin(features)
    key = F.md5(F.concat(F.col("customer_id").cast("string"), F.lit(f":{seed}")))
    sizes = {r["is_churned"]: r["n"] for r in
             features.groupBy("is_churned").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        raise ValueError(f"both classes are needed to train, got {sorted(sizes)}")
    total = sizes[0] + sizes[1]
    tests = math.ceil(test_share * total)
    churned_tests = math.floor(tests * sizes[1] / total + 0.5)
    numbered = with_row_number(features.withColumn("_key", key),
                               [F.asc("is_churned"), F.asc("_key"), F.asc("customer_id")],
                               "_rn", slices=slices)
    loyal = F.col("is_churned") == 0
    picked = F.when(loyal, F.col("_rn") <= tests - churned_tests).otherwise(
        F.col("_rn") - sizes[0] <= churned_tests)
    return numbered.withColumn("is_test", picked).drop("_rn", "_key")


def _stages(rows: int) -> dict[str, list]:
    """The three models. C = 1 in a sum-of-losses objective is 1/n in Spark's mean-of-losses one."""
    shared = {"labelCol": "is_churned"}
    return {
        "Logistic Regression": [
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
            LogisticRegression(featuresCol="scaled", maxIter=1000, regParam=1.0 / rows,
                               standardization=False, **shared)],
        "Random Forest": [RandomForestClassifier(featuresCol="raw", numTrees=200, maxDepth=8,
                                                 seed=SEED, **shared)],
        "Gradient Boosting": [GBTClassifier(featuresCol="raw", maxIter=150, maxDepth=3,
                                            seed=SEED, **shared)],
    }


def fit(train: DataFrame, name: str) -> PipelineModel:
    """A fitted model. What a forest's tasks hand on has the size of its nodes whatever their rows, so the
    rows are dealt to as many tasks as run at once, and to no more."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="raw")
    dealt = train.coalesce(train.sparkSession.sparkContext.defaultParallelism)
    return Pipeline(stages=[assembler, *_stages(train.count())[name]]).fit(dealt)


def fit_all(train: DataFrame, names: tuple[str, ...] = MODELS) -> dict[str, PipelineModel]:
    """The models, fitted side by side: a boosted model's rounds are hundreds of short jobs that leave
    most cores to the others."""
    with ThreadPool(len(names)) as pool:
        fitted = pool.map(inheritable_thread_target(train.sparkSession)(lambda name: fit(train, name)), names)
    return dict(zip(names, fitted))


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The features with ``probability`` of churn and ``prediction`` (0 or 1)."""
    scored = model.transform(features)
    chance = vector_to_array("probability").getItem(1)
    return scored.select(*features.columns, chance.alias("churn_chance")).withColumn(
        "predicted", (F.col("churn_chance") >= 0.5).cast("int"))


def confusion(predicted: DataFrame, label: str = "is_churned", guess: str = "predicted"
              ) -> DataFrame:
    yes, hit = F.col(label) == 1, F.col(guess) == 1
    return predicted.agg(
        F.count_if(~yes & ~hit).alias("tn"), F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"), F.count_if(yes & hit).alias("tp"))


def rank_auc(predicted: DataFrame, label: str = "is_churned", chance: str = "churn_chance",
             slices: int | None = None) -> DataFrame:
    """Area under the ROC curve by the rank sum, ties at their mean rank; null with one class.

    Ranks are taken over distinct scores in slices, so no task sees all scores.
    """
    scores = predicted.groupBy(F.col(chance).alias("score")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positive"))
    upto = with_running_sums(scores, [F.asc("score")], {"upto": F.col("rows")}, slices=slices)
    # Twice the mean rank, to stay with integers.
    doubled = 2 * F.col("upto") - F.col("rows") + 1
    wide = "decimal(38,0)"
    sums = upto.agg(
        F.sum((F.col("positive").cast("decimal(19,0)") * doubled.cast("decimal(19,0)"))
              .cast(wide)).alias("ranks"),
        F.sum("positive").cast("decimal(19,0)").alias("p"),
        F.sum(F.col("rows") - F.col("positive")).cast("decimal(19,0)").alias("q"))
    above = (F.col("ranks") - (F.col("p") * (F.col("p") + 1)).cast(wide)).cast("double")
    pairs = F.nullif((2 * F.col("p") * F.col("q")).cast("double"), F.lit(0.0))
    return sums.select((above / pairs).alias("roc_auc"))


def evaluate(predicted: DataFrame, label: str = "is_churned", guess: str = "predicted",
             chance: str = "churn_chance") -> DataFrame:
    """One row of metrics; a ratio without a denominator is zero."""
    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part.cast("double") / F.nullif(whole, F.lit(0)), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    counts = confusion(predicted, label, guess).withColumn("_one", F.lit(1))
    area = rank_auc(predicted, label, chance).withColumn("_one", F.lit(1))
    return counts.join(area, "_one").select(
        share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"), "roc_auc", "tn", "fp", "fn", "tp")


@dataclass
class Trained:
    models: dict[str, PipelineModel]
    comparison: DataFrame
    best: str

    @property
    def best_model(self) -> PipelineModel:
        return self.models[self.best]


def compare(models: dict[str, PipelineModel], test: DataFrame) -> Trained:
    """Measure fitted models on held-out customers; the highest AUC wins. Three rows of metrics reach
    the driver."""
    rows = [{"model": name, **evaluate(pin(predict(model, test))).first().asDict()}
            for name, model in models.items()]
    columns = "model string, " + ", ".join(f"{m} double" for m in METRICS) + \
        ", tn bigint, fp bigint, fn bigint, tp bigint"
    comparison = test.sparkSession.createDataFrame(
        [tuple(r[c] for c in ("model", *METRICS, "tn", "fp", "fn", "tp")) for r in rows], columns)
    best = max(rows, key=lambda r: (r["roc_auc"] is not None, r["roc_auc"]))["model"]
    return Trained(models, comparison, best)


def train_and_select(features: DataFrame, names: tuple[str, ...] = MODELS) -> Trained:
    """Fit on three quarters, measure on the rest."""
    split = pin(stratified_split(features))
    train, test = split.where("not is_test"), split.where("is_test")
    return compare(fit_all(train, names), test)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The predictions table. The call is made on the raw chance, the band on the rounded one."""
    chance = F.round("churn_chance", 5)
    return predict(model, features).select(
        "customer_id", chance.cast("decimal(6,5)").alias("churn_probability"),
        F.col("predicted").alias("churn_prediction"), risk_level(chance).alias("risk_level"))


def run_churn(star: Star) -> tuple[Trained, DataFrame]:
    star = remembered(star)
    trained = train_and_select(training_set(star))
    return trained, score(trained.best_model, scoring_set(star))


def standardised(train: DataFrame, features: DataFrame) -> DataFrame:
    """The features as the logistic model sees them: centred and scaled by the training rows. The
    scale is the sample deviation, a constant factor away from the population's."""
    fitted = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="raw"),
                              StandardScaler(inputCol="raw", outputCol="scaled", withMean=True,
                                             withStd=True)]).fit(train)
    values = fitted.transform(features).withColumn("_v", vector_to_array("scaled"))
    return values.select("customer_id", *[F.col("_v").getItem(i).alias(name)
                                          for i, name in enumerate(FEATURES)])
