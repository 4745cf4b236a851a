"""Linear model of the review score."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.sources.schema import REVIEWS, ReviewColumns


@dataclass(frozen=True)
class SatisfactionModel:
    """Weights of the features and the intercept, as numbers and as a table, and the error on the test rows."""

    weights: dict[str, float]
    intercept: float
    coefficients: DataFrame
    metrics: DataFrame

    def predict(self) -> Column:
        """The score that the model expects, from the features of a row."""
        terms = (F.col(name).cast("double") * weight for name, weight in self.weights.items())
        return sum(terms, F.lit(self.intercept))


def feature_names(cols: ReviewColumns = REVIEWS) -> list[str]:
    return [
        cols.entity_score,
        cols.entity_reviews,
        cols.negative_words,
        cols.positive_words,
        cols.history,
        cols.additional_scores,
    ]


def moments(rows: DataFrame, names: list[str], side: str) -> dict[bool, tuple[int, np.ndarray, np.ndarray]]:
    """Count, means and covariances (of the population) of the columns, for each value of ``side``.

    One hash aggregate; two rows of some forty numbers reach the driver.
    """
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    rows = rows.groupBy(side).agg(
        F.count("*").alias("n"),
        *(F.avg(name).alias(f"m{i}") for i, name in enumerate(names)),
        *(F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs),
    )
    out = {}
    for row in rows.collect():
        covariance = np.zeros((len(names),) * 2)
        for i, j in pairs:
            covariance[i, j] = covariance[j, i] = row[f"c{i}_{j}"]
        out[row[side]] = row["n"], np.array([row[f"m{i}"] for i in range(len(names))]), covariance
    return out


def satisfaction_regression(
    df: DataFrame, in_training: Column | None = None, cols: ReviewColumns = REVIEWS
) -> SatisfactionModel:
    """Least-squares model of the review score on six numeric features.

    ``in_training`` tells the training rows (four fifths) from the test rows and
    should hash a stable key; by default it hashes the numbers themselves, so
    equal rows fall on the same side. Either way the split does not depend on how
    the table is partitioned. The reviews are read once and never kept: both
    sides are folded to their second moments, which are all that the fit, RMSE
    and R2 on the test rows need. Features that don't vary have weight 0. An empty
    training side is an error; without test rows the metrics are NULL.
    """
    features = feature_names(cols)
    if in_training is None:
        in_training = F.pmod(F.xxhash64(*features, cols.score), F.lit(10)) < 8
    numbers = [*features, cols.score]
    rows = df.select(
        *[F.col(c).cast("double").alias(c) for c in numbers],
        F.coalesce(in_training, F.lit(False)).alias("in_training"),
    ).dropna(subset=numbers)
    sides = moments(rows, numbers, "in_training")
    if True not in sides:
        raise ValueError("no review to learn from")
    _, mean, covariance = sides[True]
    scale = np.sqrt(np.diag(covariance)[:-1])
    varies = scale > 1e-12 * np.maximum(np.abs(mean[:-1]), 1e-300)
    unit = np.where(varies, scale, 1.0)
    inner, outer = covariance[:-1, :-1] / np.outer(unit, unit), covariance[:-1, -1] / unit
    weights = np.zeros(len(features))
    weights[varies] = np.linalg.lstsq(inner[np.ix_(varies, varies)], outer[varies], rcond=None)[0] / unit[varies]
    intercept = float(mean[-1] - weights @ mean[:-1])

    spark = df.sparkSession
    named = dict(zip(features, map(float, weights), strict=True))
    coefficients = spark.createDataFrame(
        [*named.items(), ("Intercept", intercept)],
        T.StructType([T.StructField("Feature", T.StringType()), T.StructField("Coefficient", T.DoubleType())]),
    )
    n, rmse, r2 = 0, None, None
    if False in sides:
        n, mean, covariance = sides[False]
        apart = np.append(-weights, 1.0)  # the error of a row as a weighted sum of its numbers
        square = float(apart @ covariance @ apart + (apart @ mean - intercept) ** 2)
        rmse = square**0.5
        r2 = 1 - square / covariance[-1, -1] if covariance[-1, -1] > 0 else None
    metrics = spark.createDataFrame([(n, rmse, r2 if r2 is None else float(r2))], "Test_Rows long, RMSE double, R2 double")
    return SatisfactionModel(named, intercept, coefficients, metrics)
