"""Classifiers on Spark ML with weights for unequal classes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from eventwin.operators.boosting import BoostedTrees, bin_rows, grow_trees
from eventwin.operators.metrics import compare_variants, evaluate, union_scores
from eventwin.operators.scan import _q, _text
from eventwin.sources.sinks import staged

WEIGHT = "_weight"


def class_sizes(train: DataFrame, label: str = "label_storm") -> tuple[int, int]:
    """(negatives, positives)"""
    row = train.agg(F.expr(f"count_if(`{label}` = 0) as n0"), F.expr(f"count_if(`{label}` = 1) as n1")).first()
    if not row["n0"] or not row["n1"]:
        raise ValueError("training rows need both classes")
    return row["n0"], row["n1"]


def _weighted(train: DataFrame, features: Sequence[str], label: str, w0: float, w1: float
              ) -> tuple[VectorAssembler, DataFrame]:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = train.selectExpr(*_q(features), f"cast(`{label}` as double) as _label",
                            f"if(`{label}` = 1, {w1!r}D, {w0!r}D) as {WEIGHT}")
    return assembler, assembler.transform(rows).select("features", "_label", WEIGHT)


def _fit(estimator, train: DataFrame, features: Sequence[str], label: str, w0: float, w1: float) -> PipelineModel:
    assembler, rows = _weighted(train, features, label, w0, w1)
    estimator.setLabelCol("_label").setWeightCol(WEIGHT).setFeaturesCol("features")
    fitted = PipelineModel([assembler, estimator.fit(rows)])
    #: weights of a negative and a positive row in this fit; not saved with the model
    fitted.class_weights = w0, w1
    return fitted


def fit_logistic(train: DataFrame, features: Sequence[str], label: str = "label_storm", *, c: float = 0.1,
                 max_iter: int = 2000) -> PipelineModel:
    """L2-regularised logistic regression with balanced classes; `c` is the inverse penalty on the summed loss."""
    n0, n1 = class_sizes(train, label)
    n = n0 + n1  # balanced weights add up to the number of rows
    estimator = LogisticRegression(maxIter=max_iter, regParam=1.0 / (c * n), elasticNetParam=0.0,
                                   standardization=False, tol=1e-8)
    return _fit(estimator, train, features, label, n / (2 * n0), n / (2 * n1))


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "label_storm", *, trees: int = 500,
               depth: int = 8, min_leaf: int = 10, bins: int = 128, seed: int = 42) -> PipelineModel:
    """Random forest with balanced classes."""
    n0, n1 = class_sizes(train, label)
    n = n0 + n1
    estimator = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, maxBins=bins,
                                       featureSubsetStrategy="sqrt", seed=seed)
    return _fit(estimator, train, features, label, n / (2 * n0), n / (2 * n1))


def fit_boosted(train: DataFrame, features: Sequence[str], label: str = "label_storm", *, rounds: int = 500,
                depth: int = 4, step: float = 0.05, rows: float = 0.8, columns: float = 0.8,
                positive_weight: float | None = None, bins: int = 128, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees; positives weigh negatives / positives unless given."""
    if positive_weight is None:
        n0, n1 = class_sizes(train, label)
        positive_weight = n0 / n1
    estimator = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=rows, maxBins=bins,
                              featureSubsetStrategy=str(columns), seed=seed)
    return _fit(estimator, train, features, label, 1.0, float(positive_weight))


def predict(model: PipelineModel | BoostedTrees, df: DataFrame) -> DataFrame:
    """`df` plus `score`, the probability of class 1, and `prediction`, 1 from a score above 0.5."""
    if isinstance(model, BoostedTrees):
        return model.predict(df)
    scored = model.transform(df)
    return scored.select(*_q(df.columns), vector_to_array("probability")[1].alias("score"),
                         F.col("prediction").cast("int").alias("prediction"))


def score_model(model: PipelineModel, df: DataFrame, name: str, *, label: str = "label_storm", split: str = "split",
                digits: int | None = None) -> DataFrame:
    """The model's row of the score table for every split in `df`. Predictions are made once and staged."""
    rows = predict(model, df).selectExpr(f"{_text(name)} as model", f"`{split}` as split", f"`{label}` as label",
                                         "prediction", "score")
    return evaluate(staged(rows, "predictions"), digits=digits)


def compare_models(models: Mapping[str, PipelineModel], df: DataFrame, *, label: str = "label_storm",
                   split: str = "split", baseline: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """Score rows of all models, after the baseline's if there is one."""
    rows = [score_model(m, df, name, label=label, split=split, digits=digits) for name, m in models.items()]
    return union_scores(*([baseline] if baseline is not None else []), *rows)


def ablation(train: DataFrame, test: DataFrame, features: Sequence[str], dropped: Sequence[str],
             fit: Callable[[DataFrame, list[str]], PipelineModel], *, full_model: PipelineModel | None = None,
             label: str = "label_storm", split: str = "split") -> tuple[DataFrame, DataFrame]:
    """(score rows of the full and the reduced model, their comparison).

    The reduced model is fitted again without `dropped`; the full one only if it is not given.
    """
    kept = [c for c in features if c not in set(dropped)]
    full = full_model or fit(train, list(features))
    scores = compare_models({"full": full, "reduced": fit(train, kept)}, test, label=label, split=split)
    return scores, compare_variants(scores, "full", "reduced")


def group_ablation(train: DataFrame, test: DataFrame, features: Sequence[str], groups: Mapping[str, Sequence[str]], *,
                   label: str = "label_storm", split: str = "split", key: str | None = None, positive_weight: float | None = None,
                   bins: int = 254, at_once: int = 4, **trees) -> tuple[DataFrame, DataFrame, dict[str, BoostedTrees]]:
    """(score rows, comparison, models) of second-order trees on all `features` and without each group of them.

    Models are named `full` and `without <group>`; the comparison has a row (feature_group, metric, full, reduced, delta) per group and
    metric. Training rows are binned and stored once; the fits hide the group's features and up to `at_once` of them run side
    by side, so that the jobs of one fill the executors while another picks its splits. All fits draw the same rows.
    A group without any of the features has the full model's scores; one with all of them is an error.
    """
    kept = {"full": list(features)} | {f"without {g}": [c for c in features if c not in set(members)] for g, members in groups.items()}
    if empty := [name for name, names in kept.items() if not names]:
        raise ValueError(f"no features are left in {empty}")
    binned = bin_rows(train, features, label, positive_weight=positive_weight, bins=bins, key=key)
    rows = staged(test, "ablation-test")

    def fitted(name: str) -> tuple[BoostedTrees, DataFrame]:
        model = grow_trees(binned, kept[name], **trees)
        return model, score_model(model, rows, name, label=label, split=split)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        tasks = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fitted), name) for name in kept}
        found = {name: task.result() for name, task in tasks.items()}
    scores = union_scores(*[rows for _, rows in found.values()])
    compared = [compare_variants(scores, "full", f"without {g}").withColumn("feature_group", F.lit(g)) for g in groups]
    wanted = ("feature_group", "metric", "full", "reduced", "delta")
    return scores, union_scores(*compared).select(*wanted) if compared else None, {name: model for name, (model, _) in found.items()}
