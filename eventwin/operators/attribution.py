"""How much each feature moves a model's output, per row and on average.

Linear models: weight times distance from the mean, a plain expression. Tree ensembles: exact
Shapley values with path-dependent expectations (`operators.trees`).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F, types as T

from eventwin.operators.boosting import BoostedTrees
from eventwin.operators.scan import _q, _text
from eventwin.operators.trees import Tree, shapley_values
from eventwin.session import shared_dir

# executors get the functions below by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def linear_attribution(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """`df` plus `phi`: array of weight · (value − mean), in the order of `weights`; missing values count as the mean."""
    centre = df.agg(F.struct(*[F.expr(f"avg(cast(`{c}` as double)) as m{i}") for i, c in enumerate(weights)])).scalar()
    terms = ", ".join(f"coalesce({w!r}D * (`{c}` - _m.m{i}), 0D)" for i, (c, w) in enumerate(weights.items()))
    return df.withColumn("_m", centre).withColumn("phi", F.expr(f"array({terms})")).drop("_m")


def logistic_weights(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    return dict(zip(features, map(float, model.stages[-1].coefficients.toArray())))


def importance(attributed: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean_abs_shap, rank), largest first; equal values are ranked by name."""
    means = attributed.agg(*[F.expr(f"avg(abs(phi[{i}])) as a{i}") for i in range(len(features))])
    cells = ", ".join(f"{_text(c)}, a{i}" for i, c in enumerate(features))
    return rank_importance(means.selectExpr(f"stack({len(features)}, {cells}) as (feature, mean_abs_shap)"))


def rank_importance(table: DataFrame, value: str = "mean_abs_shap", feature: str = "feature") -> DataFrame:
    """Add `rank` by falling value: one row per feature, so one small window."""
    return table.selectExpr("*", f"row_number() over (order by `{value}` desc, `{feature}`) as rank")


def best_rank(ranked: DataFrame, fragment: str, limit: int = 5) -> DataFrame:
    """One row: the best rank among features whose name contains `fragment`, and whether it is within `limit`."""
    return ranked.where(F.col("feature").contains(fragment)).agg(F.min("rank").alias("best_rank")).selectExpr(
        f"{_text(fragment)} as fragment", "best_rank", f"coalesce(best_rank <= {limit}, false) as passed")


def dependence(attributed: DataFrame, features: Sequence[str], feature: str, colour: str | None = None,
               fraction: float | None = None) -> DataFrame:
    """(value, attribution, colour) per row for one feature; `fraction` samples the rows for drawing."""
    rows = attributed.sample(fraction, seed=42) if fraction else attributed
    shown = [f"`{feature}` as value", f"phi[{list(features).index(feature)}] as attribution"]
    return rows.selectExpr(*shown, f"`{colour}` as colour" if colour else "cast(null as double) as colour")


# trees -----------------------------------------------------------------------------------------

def _spark_trees(model: PipelineModel, spark) -> list[Tree]:
    """The trees of a fitted forest or boosted model of Spark ML; their size is set by the model, not by the data."""
    ensemble = model.stages[-1]
    path = f"{shared_dir(spark)}/trees-{uuid.uuid4().hex}"
    ensemble.write().save(path)
    # Forest nodes hold weights by class; boosted ones weight, sum and sum of squares.
    classifier = type(ensemble).__name__.startswith("RandomForest")
    weights = [1.0 / len(ensemble.trees)] * len(ensemble.trees) if classifier else list(ensemble.treeWeights)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" not in saved.columns:
        raise ValueError(f"unexpected layout of saved trees: {saved.columns}")
    nodes = saved.selectExpr(
        "treeID as tree", "nodeData.id as id", "nodeData.leftChild as left", "nodeData.rightChild as right",
        "nodeData.prediction as prediction", "nodeData.impurityStats as stats",
        "nodeData.split.featureIndex as feature", "get(nodeData.split.leftCategoriesOrThreshold, 0) as threshold",
    ).toPandas()
    trees = []
    for number, rows in nodes.groupby("tree"):
        found = []
        for r in rows.sort_values("id").itertuples():
            leaf, total = r.left < 0, float(sum(r.stats))
            value = (r.stats[1] / total if classifier else r.prediction) * weights[number] if leaf else 0.0
            # these trees send a row left at the threshold too, and a missing value right
            limit = 0.0 if leaf else float(np.nextafter(r.threshold, np.inf))
            found.append((r.feature, limit, False, r.left, r.right, value, total if classifier else float(r.stats[0])))
        trees.append(Tree.of(found))
    return trees


def trees_of(model: PipelineModel | BoostedTrees, spark) -> tuple[list[Tree], float]:
    """A model's trees and what their sum starts from."""
    return (model.trees, model.start) if isinstance(model, BoostedTrees) else (_spark_trees(model, spark), 0.0)


def tree_attribution(df: DataFrame, model: PipelineModel | BoostedTrees, features: Sequence[str], keep: Sequence[str] = ()
                     ) -> DataFrame:
    """`keep` and feature columns plus `phi` and `base`: base + sum(phi) is the model output of the row.

    The output of a boosted model is its margin (the log-odds; half of them for Spark's), that of a forest its probability.
    """
    spark, columns = df.sparkSession, list(features)
    if isinstance(model, BoostedTrees) and columns != list(model.features):
        raise ValueError("attributions are of the features that the model was fitted on, in their order")
    trees, start = trees_of(model, spark)
    shipped, base = spark.sparkContext.broadcast(trees), start + sum(t.expected() for t in trees)
    rows = df.select(*_q(keep), *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phi = shapley_values(batch[columns].to_numpy(dtype=float), shipped.value)
            yield batch.assign(phi=list(phi), base=base)

    schema = T.StructType([*rows.schema.fields, T.StructField("phi", T.ArrayType(T.DoubleType())),
                           T.StructField("base", T.DoubleType())])
    return rows.mapInPandas(explain, schema)
