"""The risk model: train, score, evaluate, rank."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.functions import constants as c
from wardflow.operators.features import LABEL

FEATURES = tuple(sorted(c.METRIC_NAMES))
_VECTOR = "features"


@dataclass(frozen=True)
class RiskWeights:
    """A weight per feature and the intercept."""

    coefficients: tuple[float, ...]
    intercept: float

    def margin(self, features: Sequence[str]) -> Column:
        """The log odds, as a column; adding up in a fixed order."""
        total = F.lit(self.intercept)
        for name, weight in zip(features, self.coefficients):
            total = total + F.col(name) * F.lit(weight)
        return total


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def assemble(labelled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR).transform(labelled)


def train_risk_model(
    train: DataFrame, features: Sequence[str] = FEATURES, *, c_inverse: float = 1.0, max_iter: int = 1000
) -> RiskWeights:
    """Logistic regression with an L2 penalty of strength 1 / ``c_inverse`` on raw features.

    Spark averages the loss over rows where the usual formulation sums it, so the penalty is divided
    by the number of training rows. Its optimiser stops where the loss hardly changes, which on raw features leaves
    weights right to two or three digits; Newton steps take them to the optimum. This trains at once: it counts the
    rows, then iterates.
    """
    rows = train.count()
    if rows == 0:
        raise ValueError("no training rows")
    estimator = LogisticRegression(
        featuresCol=_VECTOR,
        labelCol=LABEL,
        maxIter=max_iter,
        standardization=False,
        regParam=1.0 / (c_inverse * rows),
        elasticNetParam=0.0,
        tol=1e-8,
    )
    fitted = estimator.fit(assemble(train, features))
    return refined(train, RiskWeights(tuple(map(float, fitted.coefficients)), float(fitted.intercept)), features, c_inverse)


def _slopes(train: DataFrame, at: np.ndarray, features: Sequence[str], c_inverse: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the penalised loss, from one aggregate; the intercept comes first."""
    weights = RiskWeights(tuple(at[1:].tolist()), float(at[0]))
    x = [F.lit(1.0), *(F.col(name) for name in features)]
    rows = train.withColumn("_p", _probability(weights.margin(features)))
    p, spread, pairs = F.col("_p"), F.col("_p") * (1.0 - F.col("_p")), np.triu_indices(len(x))
    firsts = [F.sum((p - F.col(LABEL)) * v) for v in x]
    sums = np.array(rows.agg(*firsts, *(F.sum(spread * x[i] * x[j]) for i, j in zip(*pairs))).first(), float)
    curve = np.zeros((len(x), len(x)))
    curve[pairs] = sums[len(x) :]
    penalty = np.diag([0.0] + [1.0 / c_inverse] * len(features))
    return sums[: len(x)] + penalty @ at, curve + np.triu(curve, 1).T + penalty


def refined(
    train: DataFrame, weights: RiskWeights, features: Sequence[str] = FEATURES, c_inverse: float = 1.0, rounds: int = 30
) -> RiskWeights:
    """``weights`` after Newton steps, each halved until the slope falls; a pass over ``train`` per step."""
    at = np.array([weights.intercept, *weights.coefficients])
    if not np.isfinite(at).all():  # one class only: nothing to refine
        return weights
    slope, curve = _slopes(train, at, features, c_inverse)
    for _ in range(rounds):
        step = np.linalg.lstsq(curve, slope, rcond=None)[0]
        new = at - step
        there = _slopes(train, new, features, c_inverse)
        while np.abs(there[0]).max() > np.abs(slope).max() and np.abs(step).max() > 1e-9:
            step /= 2
            new = at - step
            there = _slopes(train, new, features, c_inverse)
        if np.abs(there[0]).max() >= np.abs(slope).max():
            break
        at, (slope, curve) = new, there
        if np.abs(step).max() < 1e-10:
            break
    return RiskWeights(tuple(at[1:].tolist()), float(at[0]))


def score_patients(model: RiskWeights, labelled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add the predicted probability of high risk, the log odds and the predicted class."""
    scored = labelled.withColumn("rawPrediction", model.margin(features))
    scored = scored.withColumn("predicted_risk", _probability(F.col("rawPrediction")))
    return scored.withColumn("prediction", (F.col("predicted_risk") > 0.5).cast("double"))


def accuracy(scored: DataFrame) -> float | None:
    right = (F.col("prediction") == F.col(LABEL).cast("double")).cast("double")
    return scored.agg(F.avg(right)).first()[0]


def roc_auc(scored: DataFrame, score: str = "rawPrediction") -> float | None:
    """Area under the exact ROC curve of ``score``; None when only one class is present.

    ``score`` is the model's raw prediction or any double column. Spark sorts the scores over all
    tasks and keeps every threshold (numBins=0), where its default would bin them.
    """
    if scored.agg(F.countDistinct(LABEL)).first()[0] < 2:
        return None
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=LABEL, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored)


def model_metrics(
    model: RiskWeights, train: DataFrame, test: DataFrame, features: Sequence[str] = FEATURES
) -> DataFrame:
    """One row: ROC-AUC on the test rows, and the accuracy on both sides."""
    scored = score_patients(model, test, features)
    row = (roc_auc(scored), accuracy(score_patients(model, train, features)), accuracy(scored))
    return train.sparkSession.createDataFrame([row], "auc double, train_accuracy double, test_accuracy double")


def roc_curve(scored: DataFrame, score: str, ranges: int = 256) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct ``score``: the rates when it and all higher ones count as positive.

    The distinct scores are dealt to ``ranges`` ranges bounded by their sketched quantiles. Counts run inside each
    range, from the sum of the ranges before it, so no task sees them all. A side without rows has null rates; rows
    without a score come last, as one threshold.
    """
    counts = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(LABEL)).cast("long").alias("positive"), F.sum(1 - F.col(LABEL)).cast("long").alias("negative")
    )
    shares = [i / ranges for i in range(1, ranges)]
    bounds = counts.agg(F.percentile_approx("threshold", shares, 10 * ranges)).scalar()
    # Bounds above the score, so the ranges go from the highest scores down.
    above = F.size(F.filter("bounds", lambda bound: bound > F.col("threshold")))
    part = F.when(F.col("threshold").isNull(), ranges).otherwise(above)
    ranged = counts.withColumn("bounds", bounds).withColumn("part", part).drop("bounds")
    sums = ranged.groupBy("part").agg(F.sum("positive").alias("p"), F.sum("negative").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(
        "part",
        F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.sum("p").over(everything).alias("p_all"),
        F.sum("n").over(everything).alias("n_all"),
    )
    inside = Window.partitionBy("part").orderBy(F.desc_nulls_last("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumns({"p": F.sum("positive").over(inside), "n": F.sum("negative").over(inside)})
    rate = lambda c: F.try_divide(F.col(f"{c}_before") + F.col(c), F.col(f"{c}_all"))
    return running.join(sums, "part").select("threshold", rate("n").alias("fpr"), rate("p").alias("tpr"))


def roc_points(
    model: RiskWeights, test: DataFrame, features: Sequence[str] = FEATURES, *, digits: int | None = None
) -> DataFrame:
    """False and true positive rates at every threshold, from (0, 0) on; with ``digits``, at every rounded risk."""
    scored = score_patients(model, test, features)
    if digits is not None:
        scored = scored.withColumn("predicted_risk", F.round("predicted_risk", digits))
    curve = roc_curve(scored, "predicted_risk").select("fpr", "tpr")
    start = test.sparkSession.createDataFrame([(0.0, 0.0)], "fpr double, tpr double")
    return start.unionByName(curve)


def model_coefficients(
    spark, model: RiskWeights, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Coefficient per feature, ascending."""
    rows = [(name, float(w)) for name, w in zip(features, model.coefficients)]
    return spark.createDataFrame(rows, "feature string, coefficient double").orderBy("coefficient")


def risk_ranking(scored: DataFrame) -> DataFrame:
    """All patients by predicted risk, highest first."""
    return scored.select(
        "patient_id", "predicted_risk", F.col(LABEL).alias("actual_high_risk")
    ).orderBy(F.col("predicted_risk").desc(), F.col("patient_id").asc())


def top_risk(ranking: DataFrame, n: int = 10) -> DataFrame:
    return ranking.orderBy(F.col("predicted_risk").desc(), F.col("patient_id").asc()).limit(n)
