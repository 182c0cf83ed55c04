"""Train the classifiers, compare them, evaluate the best on the test rows, explain it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from eventwin.operators import attribution, models
from eventwin.operators.metrics import evaluate_threshold_rule

# Features that may measure the storm itself.
DISTURBANCE_FEATURES = tuple(f"omni_w24_72_{s}_{c}" for c in ("SYM_H", "AE") for s in ("mean", "min", "max", "std"))
BZ_LIMIT, V_LIMIT = -8.0, 450.0


def threshold_baseline(raw: DataFrame, *, split: str = "validation", label: str = "label_storm",
                       digits: int | None = 4) -> DataFrame:
    """Score row of the two-condition rule on features in their units."""
    return evaluate_threshold_rule(raw.where(f"split = '{split}'"), {"omni_w24_72_min_Bz_gsm": BZ_LIMIT},
                                   {"omni_w24_72_mean_V": V_LIMIT}, label=label, split=split, digits=digits)


def train_all(matrix: DataFrame, features: Sequence[str], *, label: str = "label_storm", forest: Mapping | None = None,
              boosted: Mapping | None = None) -> dict[str, PipelineModel]:
    """The three classifiers, fitted on the training rows."""
    train = matrix.where("split = 'train'")
    return {
        "logistic_regression": models.fit_logistic(train, features, label),
        "random_forest": models.fit_forest(train, features, label, **(forest or {})),
        "boosted_trees": models.fit_boosted(train, features, label, **(boosted or {})),
    }


def save_models(fitted: Mapping[str, PipelineModel], folder: str) -> None:
    for name, model in fitted.items():
        model.write().overwrite().save(f"{folder}/{name}")


def load_models(folder: str, names: Sequence[str] = ("logistic_regression", "random_forest", "boosted_trees")
                ) -> dict[str, PipelineModel]:
    return {name: PipelineModel.load(f"{folder}/{name}") for name in names}


def compare_on_validation(fitted: Mapping[str, PipelineModel], matrix: DataFrame, *, baseline: DataFrame | None = None,
                          label: str = "label_storm", digits: int | None = 4) -> DataFrame:
    return models.compare_models(fitted, matrix.where("split = 'validation'"), label=label, baseline=baseline,
                                 digits=digits)


def evaluate_on_test(model: PipelineModel, matrix: DataFrame, features: Sequence[str], *,
                     dropped: Sequence[str] = DISTURBANCE_FEATURES, label: str = "label_storm",
                     boosted: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """(scores with and without the disturbance features, their comparison) on the test rows."""
    return models.ablation(
        matrix.where("split = 'train'"), matrix.where("split = 'test'"), features, dropped,
        lambda train, kept: models.fit_boosted(train, kept, label, **(boosted or {})), full_model=model, label=label)


def explain(model: PipelineModel, matrix: DataFrame, features: Sequence[str], *, keep: Sequence[str] = ()
            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(per-row attributions, ranked importance, rank check of the magnetic and velocity features) on training rows."""
    rows = attribution.tree_attribution(matrix.where("split = 'train'"), model, features, keep)
    ranked = attribution.importance(rows, features)
    ranks = attribution.best_rank(ranked, "Bz_gsm").unionByName(attribution.best_rank(ranked, "mean_V", 10))
    return rows, ranked, ranks
