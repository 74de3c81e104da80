"""Multi-target models on the imputed, ordinal-encoded mart (auxiliary analysis).

Kept for comparison with the risk champion; nothing is published from here. Linear models come
from sums over the rows and are scored by expressions; forests grow and score where their rows
are (``forest``); boosted trees of all classes are fitted together (``boosting``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import (
    KEYS,
    ORDINAL_LEVELS,
    SCORE,
    TIER_CODES,
    TOP_IMPORTANCES_LEGACY,
)
from cohortlens.models import boosting, forest, neighbors
from cohortlens.models.preparation import ALL_ROWS
from cohortlens.models.together import VectorBase, Weights, fit_least_squares, fit_logistic
from cohortlens.operators import metrics, prep, split
from cohortlens.session import materialize

TARGETS = ("passed", "performance_tier", SCORE)
TREES = 100
NEIGHBORS = 5
CLUSTERS = 3
SEED = 42
# Rounds that a clustering may take until its centres stand still.
CLUSTER_ROUNDS = 300


@dataclass(frozen=True)
class Growth:
    """How far trees grow.

    ``depth`` is that of forests and the single tree, by default so deep that they stop only
    at pure leaves; boosting takes ``trees`` steps of ``boost_depth`` with ``bins`` candidate
    cuts per feature.
    """

    trees: int = TREES
    depth: int = 30
    bins: int = 256
    boost_depth: int = 3

    def single(self, features: int, classes: int) -> forest.Shape:
        return forest.Shape(1, self.depth, features, classes, features, SEED, draw=False)

    def forest(self, features: int, classes: int = 0) -> forest.Shape:
        """Classes are told apart by the root of the features at each node, values by all."""
        subset = max(1, int(features**0.5)) if classes else features
        return forest.Shape(self.trees, self.depth, features, classes, subset, SEED)

    def boost(self) -> dict[str, Any]:
        return {"rounds": self.trees, "depth": self.boost_depth, "step": 0.1, "bins": self.bins}


FULL = Growth()


@dataclass(frozen=True)
class ModelRun:
    """Test predictions in long form, one metrics row per model, the weights, and rows per
    model, actual and predicted class where there are classes."""

    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame | None = None
    confusion: DataFrame | None = None
    models: Mapping[str, Any] = field(default_factory=dict)


def prepare(
    mart: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS
) -> tuple[DataFrame, list[str]]:
    """Imputed and encoded rows, and the numeric feature columns.

    The mart is read several times, for gaps, medians, modes and rows: it is written first.
    """
    mart = materialize(mart)
    encoded = prep.ordinal_encode(prep.impute_median_mode(mart.drop("academic_risk")), levels)
    return encoded, prep.numeric_feature_columns(encoded, TARGETS)


def _parts(
    mart: DataFrame, target: str, levels: Mapping[str, Sequence[str]]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Student-disjoint training and test rows with a feature vector."""
    rows, features = prepare(mart, levels)
    # A feature column without any value cannot be imputed; such rows are left to the models.
    vectors = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    kept = prep.drop_missing_target(rows, target).withColumn("label", F.col(target).cast("double"))
    # Written, so that row numbers stay as they are.
    placed = materialize(
        split.grouped_parts(kept).select(
            *KEYS, "part", "label", *features,
            F.monotonically_increasing_id().alias("id"), F.xxhash64(*KEYS).alias("lot"),
        )
    )
    wide = vectors.transform(placed)
    return (
        wide.where(F.col("part") == "development"),
        wide.where(F.col("part") == "holdout"),
        features,
    )


def _arrays(df: DataFrame) -> DataFrame:
    return df.withColumn("features", vector_to_array("features"))


def _grown(training: DataFrame, test: DataFrame, shape: forest.Shape) -> tuple[DataFrame, forest.Forest]:
    """The test rows with the ``scores`` of a forest, and its summary."""
    rows = _arrays(training).withColumn("part", F.lit(forest.TRAINING)).unionByName(
        _arrays(test).withColumn("part", F.lit(forest.TEST))
    ).select("id", "lot", "part", "label", "features")
    scores, fitted = forest.fit_and_score(rows, shape)
    return test.join(scores, "id"), fitted


def _logistic(training: DataFrame, features: Sequence[str]) -> Weights:
    """Penalised as much as one row weighs; the intercept is free."""
    base = VectorBase(len(features))
    rows = _arrays(training).select("label", "features", F.lit(0).alias("fold"))
    found = fit_logistic(rows, base, "label", {ALL_ROWS: np.eye(base.size)})[ALL_ROWS]
    return Weights(tuple(map(float, found[0])), found[1])


def _weights(models: Mapping[str, Any], features: Sequence[str], kind: str, df: DataFrame) -> DataFrame:
    rows = []
    for name, model in models.items():
        if hasattr(model, "featureImportances"):
            values = model.featureImportances.toArray()
        elif hasattr(model, "coefficients"):
            values = model.coefficients.toArray()
        else:
            continue
        rows += [(kind, name, feature, float(value)) for feature, value in zip(features, values)]
    return df.sparkSession.createDataFrame(
        rows, "type string, model string, feature string, importance double"
    )


def top_importances(weights: DataFrame, top: int = TOP_IMPORTANCES_LEGACY) -> DataFrame:
    """The strongest features of each model."""
    # One short list per model: its number of features.
    best = F.slice(
        F.reverse(F.array_sort(F.collect_list(F.struct("importance", "feature")))), 1, top
    )
    ranked = weights.groupBy("type", "model").agg(best.alias("best"))
    return ranked.select("type", "model", F.explode("best").alias("b")).select(
        "type", "model", "b.feature", "b.importance"
    )


def _most_likely(scores: Column) -> Column:
    """The class with the largest share, the first on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")


def _told(kind: str, name: str, scored: DataFrame, predicted: Column, probability: Column | None = None) -> DataFrame:
    """``(type, model, keys, y_test, y_pred)`` of one model's test rows, written once."""
    more = [] if probability is None else [probability.alias("probability")]
    return materialize(
        scored.select(
            F.lit(kind).alias("type"), F.lit(name).alias("model"), *KEYS,
            F.col("label").alias("y_test"), predicted.alias("y_pred"), *more,
        )
    )


def _together(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def binary_models(
    mart: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS, growth: Growth = FULL
) -> ModelRun:
    """Logistic regression, forest and boosting on ``passed``."""
    training, test, features = _parts(mart, "passed", levels)
    linear = _logistic(training, features)
    grown, trees = _grown(training, test, growth.forest(len(features), 2))
    boosted = boosting.fit_boosted(_arrays(training), features, 1, **growth.boost())
    models = {"LogisticRegression": linear, "RandomForest": trees, "GradientBoosting": boosted}
    p, margin = 1 / (1 + F.exp(-linear.margin(F.col("features")))), F.col("margins")[0]
    scored = _together(
        [
            _told("binary", "LogisticRegression", _arrays(test).withColumn("p", p),
                  (F.col("p") > 0.5).cast("double"), F.col("p")),
            _told("binary", "RandomForest", grown, _most_likely(F.col("scores")), F.col("scores")[1]),
            _told("binary", "GradientBoosting", boosted.score(_arrays(test), [*KEYS, "label"]),
                  (margin > 0).cast("double"), boosting.probability(margin)),
        ]
    )
    by = ["type", "model"]
    errors = metrics.value_scores(scored, "y_test", "y_pred", by)
    table = (
        metrics.class_scores(scored, "y_test", "y_pred", by)
        .join(metrics.roc_auc(scored, "y_test", "probability", by), by)
        .join(errors, by)
        .join(metrics.binary_confusion(scored, "y_test", "y_pred", by), by)
        .withColumns({"msePI2": F.col("mse"), "r2PI2": F.col("r2")})
    )
    cells = metrics.confusion(scored, "y_test", "y_pred", by)
    return ModelRun(scored, table, _weights(models, features, "binary", mart), cells, models)


def ordinal_models(
    mart: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS, growth: Growth = FULL
) -> ModelRun:
    """Tree, forest and one-against-rest boosting on ``performance_tier``."""
    training, test, features = _parts(mart, "performance_tier", levels)
    classes = len(TIER_CODES)
    alone, tree = _grown(training, test, growth.single(len(features), classes))
    grown, trees = _grown(training, test, growth.forest(len(features), classes))
    boosted = boosting.fit_boosted(_arrays(training), features, classes, **growth.boost())
    # One against the rest: the importances of several models are not shown.
    models = {"DecisionTree": tree, "RandomForest": trees}
    margins = boosted.score(_arrays(test), [*KEYS, "label"])
    scored = _together(
        [
            _told("ordinal", "DecisionTree", alone, _most_likely(F.col("scores"))),
            _told("ordinal", "RandomForest", grown, _most_likely(F.col("scores"))),
            _told("ordinal", "GradientBoosting", margins, _most_likely(F.col("margins"))),
        ]
    )
    by = ["type", "model"]
    table = metrics.class_scores(scored, "y_test", "y_pred", by).drop("f1_score").join(
        metrics.value_scores(scored, "y_test", "y_pred", by), by
    )
    cells = metrics.confusion(scored, "y_test", "y_pred", by)
    weights = _weights(models, features, "ordinal", mart)
    return ModelRun(scored, table, weights, cells, models | {"GradientBoosting": boosted})


def regression_models(
    mart: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS, growth: Growth = FULL
) -> ModelRun:
    """Linear regression, forest and nearest neighbours on the weighted score."""
    training, test, features = _parts(mart, SCORE, levels)
    linear = fit_least_squares(_arrays(training), VectorBase(len(features)), "label")
    grown, trees = _grown(training, test, growth.forest(len(features)))
    models = {"LinearRegression": linear, "RandomForestRegressor": trees}
    near = neighbors.nearest_mean(training, test, features, "label", NEIGHBORS).withColumn(
        "label", F.col("actual")
    )
    scored = _together(
        [
            _told("regression", "LinearRegression", _arrays(test), linear.margin(F.col("features"))),
            _told("regression", "RandomForestRegressor", grown, F.col("scores")[0]),
            _told("regression", "KNN", near, F.col("predicted")),
        ]
    )
    table = metrics.value_scores(scored, "y_test", "y_pred", ["type", "model"])
    weights = _weights(models, features, "regression", mart)
    return ModelRun(scored, table, weights, models=models)


def segments(
    mart: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS
) -> ModelRun:
    """KMeans on the unscaled features: cluster sizes, inertia and silhouette.

    The silhouette uses squared Euclidean distance, which needs no row pairs.
    """
    rows, features = prepare(mart, levels)
    vectors = VectorAssembler(inputCols=features, outputCol="features")
    wide = vectors.transform(materialize(rows.select(*KEYS, *features)))
    model = KMeans(k=CLUSTERS, seed=SEED, maxIter=CLUSTER_ROUNDS).fit(wide)
    clustered = materialize(
        model.transform(wide).select(*KEYS, "features", F.col("prediction").alias("cluster"))
    )
    silhouette = ClusteringEvaluator(predictionCol="cluster").evaluate(clustered)
    table = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows")).select(
        "cluster",
        "rows",
        F.lit(float(model.summary.trainingCost)).alias("inertia"),
        F.lit(float(silhouette)).alias("silhouette_score"),
        F.lit(model.summary.numIter < CLUSTER_ROUNDS).alias("converged"),
    )
    return ModelRun(clustered.drop("features"), table, models={"KMeans": model})


def run_all(
    mart: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS, growth: Growth = FULL
) -> dict[str, ModelRun]:
    """All four model families, one after another, on the mart computed once."""
    mart = materialize(mart)
    return {
        "binary": binary_models(mart, levels, growth),
        "ordinal": ordinal_models(mart, levels, growth),
        "regression": regression_models(mart, levels, growth),
        "unsupervised": segments(mart, levels),
    }


def metrics_summary(runs: Mapping[str, ModelRun]) -> DataFrame:
    """One row per supervised model; metrics a family lacks are null."""
    tables = [runs[name].metrics for name in ("binary", "ordinal", "regression")]
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), tables)
