"""Linear classifiers over array columns: fitted by Spark ML, applied from plain numbers."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf


#: Samples are bounded; so many tasks read one, in every step of a fit.
SAMPLE_TASKS = 6


@dataclass(frozen=True)
class Linear:
    """Chance of the label: the logistic function of weights * x + bias."""

    weights: tuple[float, ...]
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ np.array(self.weights) + self.bias, -30, 30)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(rows: DataFrame, features: str, label: str, width: int, penalty: float = 1e-3,
        rounds: int = 20, scaled: bool = True) -> Linear:
    """Logistic regression on an array column of the given width. With one class or none, the smoothed share of the
    label is the chance of every row."""
    counts = {float(r[label]): r["count"] for r in rows.groupBy(label).count().collect()}
    if len(counts) < 2 or not width:
        share = (counts.get(1.0, 0) + 0.5) / (sum(counts.values()) + 1)
        return Linear((0.0,) * width, log(share / (1 - share)))
    ready = rows.select(array_to_vector(F.col(features)).alias("features"),
                        F.col(label).cast("double").alias("label"))
    model = LogisticRegression(regParam=penalty, maxIter=rounds, tol=1e-4,
                               standardization=scaled).fit(ready)
    return Linear(tuple(map(float, model.coefficients)), float(model.intercept))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def margin_of(model: Linear, features: str | Column, once: bool = False) -> Column:
    """The margin of every row; with ``once`` a column that Spark does not work out again where it is used."""
    @arrow_udf("double")
    def apply(x: pa.Array) -> pa.Array:
        return pa.array(model.margin(matrix(x)) if len(x) else [], pa.float64())

    return (apply.asNondeterministic() if once else apply)(features)


