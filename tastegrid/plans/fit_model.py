"""Training rows -> split -> weight -> trained network."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tastegrid.config import DomainConfig
from tastegrid.operators import split as S
from tastegrid.operators import training as T


def fit_model(
    matrix: DataFrame, feature_names: list[str], domain: DomainConfig, **options
) -> tuple[T.Model | None, list[tuple]]:
    """Split, weigh and train. ``matrix`` should be a stored table: it is read repeatedly."""
    weight = S.positive_weight(matrix).first()[0] if domain.weighted_loss else 1.0
    parts = S.stratified_split(matrix, domain.validation_share)
    return T.train(parts, feature_names, domain, pos_weight=weight, **options)
