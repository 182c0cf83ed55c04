"""Labelled table to split, imputed and scaled features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from eventwin.operators import checks
from eventwin.operators.clean import feature_columns
from eventwin.operators.engineer import engineer_features
from eventwin.operators.prep import Preprocessor, fit_preprocessor
from eventwin.operators.split import assign_split
from eventwin.sources.sinks import staged


@dataclass(frozen=True)
class ModelMatrix:
    raw: DataFrame  # engineered features in their units, with split
    matrix: DataFrame  # keys, split, year, label and prepared features
    features: list[str]
    preprocessor: Preprocessor
    report: DataFrame
    leaks: DataFrame


def build_features(labelled: DataFrame, *, keys: Sequence[str] = ("activityID",), label: str = "label_storm",
                   scale: bool = True, train_end: int = 2020, val_year: int = 2021, test_start: int = 2022,
                   type_levels: Sequence[str] | None = None, clip_fit_on: str | None = None) -> ModelMatrix:
    """Feature table, split by year, prepared with numbers learned from the training rows.

    Two things are collected on the way: the category levels (unless given) and the per-column fit.
    The engineered table is staged, as fitting, checking and training all read it.
    """
    carried = [k for k in keys if k in labelled.columns]
    engineered = engineer_features(labelled, keep=carried, type_levels=type_levels, clip_fit_on=clip_fit_on)
    split = staged(assign_split(engineered, train_end=train_end, val_year=val_year, test_start=test_start), "features")
    inputs = feature_columns(split, label=label, metadata=("startTime", "year", "kp_max_h72", "split"), keys=carried)
    fitted = fit_preprocessor(split.where("split = 'train'"), inputs, scale=scale)
    matrix = fitted.transform(split, keep=[*carried, "split", "year", label])
    features = fitted.feature_names
    return ModelMatrix(split, matrix, features, fitted, checks.check_splits(matrix, features, label=label),
                       checks.leaky_names(matrix, features))
