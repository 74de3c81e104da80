"""Queries that show what holds for fitted models, whatever library fitted them.

Another engine cannot repeat a fit, but it can state the rows a model must score, their
labels, and which equations its weights, leaves, centres and metrics must satisfy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.contract import DEFAULT_CUTOFF, KEYS, MAX_FOLDS
from cohortlens.models import legacy, risk
from cohortlens.models.preparation import ALL_ROWS, fit_preparations
from cohortlens.operators import mart, split
from cohortlens.session import materialize
from cohortlens.sources.order_binding import AGE_ORDER, HOLDOUT, SEGMENT_ORDER, order_roles

LEVELS = {"highest_education": SEGMENT_ORDER, "age_band": AGE_ORDER}
LABEL = risk.LABEL
# Largest slope of the penalised loss at a fitted minimum, and of rounding elsewhere.
FLAT, CLOSE = 1e-4, 1e-9


def _mart(spark: SparkSession, folder: str) -> DataFrame:
    return mart.enrollment_mart(order_roles(spark, folder), DEFAULT_CUTOFF)


def signal_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart with a result that clicks explain, but for every tenth student."""
    few = (F.col("total_clicks") < 20) != (F.col("id_student") % 10 == 0)
    return _mart(spark, folder).withColumn("final_result", F.when(few, "Fail").otherwise("Pass"))


def signal_predictions(spark, folder):
    """Holdout keys and labels, and whether probability and class fit together."""
    found = risk.search(signal_mart(spark, folder), HOLDOUT)
    probability = F.col("probability_academic_risk")
    return found.predictions.select(
        *KEYS,
        "academic_risk_actual",
        probability.between(0, 1).alias("probability_in_range"),
        ((probability >= 0.5).cast("int") == F.col("prediction_academic_risk")).alias("class_fits"),
        F.lit(found.champion.name != risk.BASELINE).alias("model_won"),
    )


def _fitted(spark: SparkSession, folder: str, folds: int = 1):
    """All candidates on the training sets of the signal mart's development rows, and these
    rows with their fold."""
    labelled = risk.labelled_features(signal_mart(spark, folder))
    rows = split.temporal_holdout(labelled, HOLDOUT)[0]
    dealt = rows.withColumn("fold", F.lit(0)) if folds == 1 else split.group_folds(rows, folds)
    dealt = materialize(dealt)
    preparations = fit_preparations(dealt, folds)
    wanted = preparations if folds > 1 else {ALL_ROWS: preparations[ALL_ROWS]}
    return risk.fit_candidates(dealt, wanted), dealt


def _sums(values: Mapping[str, Column], df: DataFrame) -> dict[str, float]:
    return df.agg(*[value.alias(name) for name, value in values.items()]).first().asDict()


def _linear_checks(fitted: risk.FittedRisk, rows: DataFrame) -> dict[str, bool]:
    weights = fitted.model.weights
    scored = fitted.probability(fitted.preparation.transform(rows)).select(
        LABEL,
        vector_to_array("features").alias("x"),
        F.col("probability_academic_risk").alias("p"),
    )
    terms = [F.lit(weight) * F.col("x")[place] for place, weight in enumerate(weights)]
    logit = sum(terms, F.lit(float(fitted.model.intercept)))
    error = F.col("p") - F.col(LABEL)
    slopes = {f"s{place}": F.sum(error * F.col("x")[place]) for place in range(len(weights))}
    found = _sums(
        slopes
        | {
            "size": F.count(F.lit(1)),
            "offset": F.sum(error),
            "gap": F.max(F.abs(F.col("p") - 1 / (1 + F.exp(-logit)))),
        },
        scored,
    )
    penalised = [found[f"s{place}"] + risk.PENALTY * weight for place, weight in enumerate(weights)]
    steepest = max(map(abs, [*penalised, found["offset"]])) / found["size"]
    return {
        "probability_is_the_formula": found["gap"] < CLOSE,
        "loss_is_flat": steepest < FLAT,
    }


def _tree_checks(fitted: risk.FittedRisk, rows: DataFrame) -> dict[str, bool]:
    model = fitted.model
    leaves = (
        fitted.probability(rows)
        .withColumn("leaf", model.leaf(fitted.preparation))
        .groupBy("leaf")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(LABEL).alias("rate"),
            F.max("probability_academic_risk").alias("p"),
        )
    )
    found = _sums(
        {"least": F.min("rows"), "gap": F.max(F.abs(F.col("rate") - F.col("p")))}, leaves
    )
    importances = model.importances(fitted.preparation.feature_names())
    return {
        "leaves_hold_50_rows": found["least"] >= 50,
        "probability_is_the_leaf_rate": found["gap"] < CLOSE,
        "depth_is_at_most_4": model.depth <= 4,
        "importances_sum_to_1": abs(sum(importances) - 1) < CLOSE,
    }


def _candidate_checks(fits, number: int, rows: DataFrame) -> list[tuple[str, str, bool]]:
    checks = {
        risk.LINEAR: _linear_checks(fits[risk.LINEAR][number], rows),
        risk.TREE: _tree_checks(fits[risk.TREE][number], rows),
    }
    return [(name, check, bool(holds)) for name, own in checks.items() for check, holds in own.items()]


def signal_model_checks(spark, folder):
    """Equations that the linear model and the tree satisfy."""
    fits, rows = _fitted(spark, folder)
    told = _candidate_checks(fits, ALL_ROWS, rows)
    return spark.createDataFrame(told, "model string, check_name string, holds boolean")


def signal_fold_checks(spark, folder):
    """The same equations for the models of every training set, each on its own rows."""
    fits, rows = _fitted(spark, folder, MAX_FOLDS)
    told = [
        (number, *check)
        for number in (ALL_ROWS, *range(MAX_FOLDS))
        for check in _candidate_checks(fits, number, rows.where(F.col("fold") != number))
    ]
    return spark.createDataFrame(
        told, "training_set int, model string, check_name string, holds boolean"
    )


def candidate_importances(spark, folder):
    """Every candidate's features and kind of weight, whichever candidate wins."""
    fits, _ = _fitted(spark, folder)
    told = [
        (name, fits[name][ALL_ROWS].importance()[0], feature, value >= 0)
        for name in (risk.LINEAR, risk.TREE)
        for feature, value in fits[name][ALL_ROWS].importance()[1]
    ]
    return spark.createDataFrame(
        told, "model string, kind string, feature string, not_negative boolean"
    )


def champion_baseline_candidate(spark, folder):
    """The prevalence baseline's mean metrics over the folds, which are plain rates."""
    found = risk.search(_mart(spark, folder), HOLDOUT).candidates
    return found.where(F.col("model") == risk.BASELINE).select(
        "model", *[F.round(name, 6).alias(name) for name in ("pr_auc", "roc_auc", "brier_score")]
    )


def _recomputed(run: legacy.ModelRun, kind: str) -> DataFrame:
    """Rows and labels per model, whether predictions are possible values, and whether the
    stored metrics follow from the stored predictions."""
    by = ["type", "model"]
    error = F.col("y_test") - F.col("y_pred")
    right = F.avg((F.col("y_test") == F.col("y_pred")).cast("double"))
    if kind == "binary":
        possible = F.col("y_pred").isin(0.0, 1.0) & F.col("probability").between(0, 1)
    elif kind == "ordinal":
        possible = F.col("y_pred").isin(0.0, 1.0, 2.0, 3.0)
    else:
        possible = ~F.isnan("y_pred")
    mean = F.avg("y_test")
    found = run.predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("y_test"), 4).alias("label_sum"),
        F.every(possible).alias("possible"),
        F.avg(error * error).alias("_mse"),
        (1 - F.avg(error * error) / (F.avg(F.col("y_test") * F.col("y_test")) - mean * mean)).alias("_r2"),
        right.alias("_accuracy"),
    )
    close = (F.abs(F.col("mse") - F.col("_mse")) < 1e-6) & (F.abs(F.col("r2") - F.col("_r2")) < 1e-6)
    if kind != "regression":
        close &= F.abs(F.col("accuracy") - F.col("_accuracy")) < 1e-9
    return found.join(run.metrics, by).select(
        *by, "rows", "label_sum", "possible", close.alias("metrics_follow")
    )


def _family(kind: str, models: Callable[..., legacy.ModelRun]):
    def query(spark, folder):
        return _recomputed(models(_mart(spark, folder), LEVELS), kind)

    query.__name__ = f"legacy_{kind}_checks"
    return query


def ordinal_confusion(spark, folder):
    """Test rows per model and actual class, from the confusion table."""
    cells = legacy.ordinal_models(_mart(spark, folder), LEVELS).confusion
    return cells.groupBy("model", "actual").agg(F.sum("count").alias("rows"))


def kmeans_checks(spark, folder):
    """Whether clusters are those of the nearest centres, and the inertia their sum."""
    written = materialize(_mart(spark, folder))
    rows, features = legacy.prepare(written, LEVELS)
    run = legacy.segments(written, LEVELS)
    centers = [list(map(float, center)) for center in run.models["KMeans"].clusterCenters()]
    far = [
        sum(
            ((F.col(name) - F.lit(value)) ** 2 for name, value in zip(features, center)),
            F.lit(0.0),
        )
        for center in centers
    ]
    placed = rows.select(*KEYS, F.array(*far).alias("far")).join(run.predictions, list(KEYS))
    nearest = F.array_min("far")
    own = F.element_at("far", F.col("cluster") + 1)
    found = placed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.every(own <= nearest * (1 + CLOSE) + CLOSE).alias("nearest_centre"),
        F.sum(nearest).alias("_inertia"),
    )
    told = run.metrics.agg(
        F.sum("rows").alias("_all"), F.max("inertia").alias("_told"), F.count(F.lit(1)).alias("clusters"),
        F.every("converged").alias("converged"),
    ).first()
    return found.select(
        "rows",
        "nearest_centre",
        (F.abs(F.col("_inertia") / F.lit(told["_told"]) - 1) < 1e-6).alias("inertia_follows"),
        (F.col("rows") == F.lit(told["_all"])).alias("all_rows_clustered"),
        F.lit(told["clusters"]).alias("clusters"),
        F.lit(told["converged"]).alias("converged"),
    )


CHECKS = (
    signal_predictions, signal_model_checks, signal_fold_checks, candidate_importances, champion_baseline_candidate,
    _family("binary", legacy.binary_models), _family("ordinal", legacy.ordinal_models),
    _family("regression", legacy.regression_models), ordinal_confusion, kmeans_checks,
)
