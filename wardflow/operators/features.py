"""Per-patient features, the median label, and the train/test split."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wardflow.functions import constants as c
from wardflow.operators.alerts import active_alerts
from wardflow.operators.profiles import known_patients
from wardflow.operators.ranking import exact_cut, exact_median
from wardflow.operators.vitals import since

LABEL = "high_risk"
MOST_METRICS = 500
_SPLIT_SPACE = 16**13


def wide_means(
    vitals: DataFrame, *, metrics: Sequence[str] | None = None, fill: float | None = 0.0
) -> DataFrame:
    """Mean per patient and metric, one column per metric in name order; missing means ``fill``.

    Without ``metrics`` every metric that was sent has its column; finding their names is one aggregate, run when this
    is called. More than ``MOST_METRICS`` names are an error: a column each would be a plan without bound, and so many
    are damaged names rather than metrics.

    Conditional averages need one exchange of one partial row per patient and map task, whereas a
    pivot aggregates twice.
    """
    if metrics is None:
        sent = vitals.where(F.col("metric_name").isNotNull()).select("metric_name").distinct()
        metrics = [row["metric_name"] for row in sent.limit(MOST_METRICS + 1).collect()]
        if len(metrics) > MOST_METRICS:
            raise ValueError(f"more than {MOST_METRICS} metric names were sent; name the wanted ones")
    usable = F.when(~F.isnan("value"), F.col("value"))
    means = [F.avg(F.when(F.col("metric_name") == m, usable)).alias(m) for m in sorted(metrics)]
    wide = vitals.filter(F.col("metric_name").isin(*metrics)).groupBy("patient_id").agg(*means)
    return wide if fill is None else wide.na.fill(fill, sorted(metrics))


def patient_features(
    vitals: DataFrame,
    as_of: datetime | str,
    *,
    profiles: DataFrame | None = None,
    hours: int = 24,
    metrics: Sequence[str] | None = None,
    fill: float | None = 0.0,
) -> DataFrame:
    """Features of the last ``hours``, of known patients when ``profiles`` is given.

    The restriction to known patients follows the aggregation: the same rows, with one row per
    patient in the join.
    """
    wide = wide_means(since(vitals, as_of, hours * 60), metrics=metrics, fill=fill)
    return wide if profiles is None else known_patients(wide, profiles)


def label_column(features: DataFrame) -> str:
    """heart_rate, or the first metric in name order without it."""
    metrics = sorted(m for m in features.columns if m not in ("patient_id", LABEL))
    return "heart_rate" if "heart_rate" in metrics else metrics[0]


def label_high_risk(features: DataFrame, *, approx: bool = False) -> DataFrame:
    """1 where the label metric exceeds its median over all patients, else 0.

    The median is exact; ``approx`` takes the quantile sketch alone and saves a pass.
    """
    column = label_column(features)
    if approx:
        median = features.agg(F.percentile_approx(column, 0.5, 10_000).alias("median"))
    else:
        median = exact_median(features, column)
    return features.withColumn(LABEL, (F.col(column) > median.scalar()).cast("int"))


def label_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(LABEL).agg(F.count("*").alias("patients"))


def load_counts(
    vitals: DataFrame, alerts: DataFrame, profiles: DataFrame, as_of: datetime | str, *, hours: int = 24
) -> DataFrame:
    """Vitals and active alerts of known patients inside the window, counted, as two rows."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        per_patient = since(rows, as_of, hours * 60).groupBy("patient_id").agg(F.count("*").alias("n"))
        total = known_patients(per_patient, profiles).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("loaded"))
        return total.select(F.lit(name).alias("source"), F.col("loaded").cast("long").alias("loaded"))

    return counted(vitals, "vitals").unionByName(counted(active_alerts(alerts), "alerts"))


def split(
    df: DataFrame, train_share: float = 0.7, seed: int = 42, *, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the patient id.

    A patient stays on its side however the data is partitioned and whenever it is recomputed; no
    sort or shuffle is needed. The share is met approximately, or with ``exact`` to the row (14 and
    6 of 20), for one more pass that finds the hash to cut at.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("patient_id")), 256)
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")  # 52 bits: exact as a double
    cut = F.lit(float(round(train_share * _SPLIT_SPACE)))
    if exact:
        largest = exact_cut(df.select(number.alias("number")), "number", train_share).scalar()
        cut = F.coalesce(largest, F.lit(-1.0)) + 1.0
    return df.filter(number < cut), df.filter(number >= cut)
