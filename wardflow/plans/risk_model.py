"""Build features, train the risk model and rank all patients."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from wardflow.operators import features as ft, model as ml
from wardflow.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class RiskModel:
    model: ml.RiskWeights
    labelled: DataFrame
    train: DataFrame
    test: DataFrame
    features: tuple[str, ...]

    def ranking(self) -> DataFrame:
        return ml.risk_ranking(ml.score_patients(self.model, self.labelled, self.features))

    def metrics(self) -> DataFrame:
        return ml.model_metrics(self.model, self.train, self.test, self.features)

    def roc(self, digits: int | None = None) -> DataFrame:
        return ml.roc_points(self.model, self.test, self.features, digits=digits)

    def coefficients(self) -> DataFrame:
        return ml.model_coefficients(self.labelled.sparkSession, self.model, self.features)


def labelled_features(vitals: DataFrame, profiles: DataFrame, as_of: datetime | str) -> DataFrame:
    """The last day's features of known patients with their label, checkpointed.

    That is one row per patient. The median, the optimiser's passes and the evaluations all read
    this table rather than the vitals, and it survives lost executors.
    """
    ensure_checkpoint_dir(vitals.sparkSession)
    features = ft.patient_features(vitals, as_of, profiles=profiles).checkpoint()
    return ft.label_high_risk(features).checkpoint()


def fit_risk_model(
    vitals: DataFrame, profiles: DataFrame, as_of: datetime | str, *, train_share: float = 0.7, seed: int = 42
) -> RiskModel:
    """Train on a part of the patients; the result ranks and evaluates on demand."""
    labelled = labelled_features(vitals, profiles, as_of)
    # A row per patient; the cut between the sides is found once, not in every pass of the training.
    train, test = (side.checkpoint() for side in ft.split(labelled, train_share, seed, exact=True))
    features = tuple(sorted(c for c in labelled.columns if c not in ("patient_id", ft.LABEL)))
    return RiskModel(ml.train_risk_model(train, features), labelled, train, test, features)
