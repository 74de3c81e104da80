"""Risk champion: grouped cross-validation, one refit, one holdout evaluation.

The candidates of all folds, and those on all development rows, are fitted together
(``together``): a Newton step or a level of the trees reads the rows once for all of them.
Fitted candidates are plain values, applied as column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from typing import Any

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.contract import (
    CATEGORICAL_FEATURES,
    DEFAULT_HOLDOUT,
    FEATURES,
    KEYS,
    NUMERIC_FEATURES,
    RISK_THRESHOLD,
    TOP_IMPORTANCES,
)
from cohortlens.functions.expressions import academic_risk
from cohortlens.models.preparation import ALL_ROWS, Preparation, fit_preparations
from cohortlens.models.together import (
    MartBase,
    Node,
    VectorBase,
    fit_logistic,
    grow_trees,
    set_sizes,
)
from cohortlens.operators import checks, metrics, split
from cohortlens.session import materialize

LABEL = "academic_risk"
BASELINE, LINEAR, TREE = "PrevalenceBaseline", "LogisticRegression", "DecisionTreeClassifier"
# Order matters: it breaks ties between equal metrics.
CANDIDATES = (BASELINE, LINEAR, TREE)
# The logistic model's penalty on half the sum of squared weights, and the tree's limits.
PENALTY, DEPTH, LEAST_ROWS = 1.0, 4, 50


def prevalence(df: DataFrame, label: str) -> float:
    return df.agg(F.avg(F.col(label).cast("double"))).first()[0]


@dataclass(frozen=True)
class LinearModel:
    """A logistic model: one coefficient per encoded feature."""

    weights: tuple[float, ...]
    intercept: float

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def probability(self, preparation: Preparation) -> Column:
        weights = dict(zip(preparation.feature_names(), self.weights, strict=True))
        margin = F.lit(self.intercept)
        for name in CATEGORICAL_FEATURES:
            levels = preparation.categories[name]
            if levels:
                entries = [F.lit(one) for level in levels for one in (level, weights[f"{name}_{level}"])]
                # An unseen category has no weight.
                margin += F.coalesce(
                    F.try_element_at(F.create_map(*entries), preparation.category(name)), F.lit(0.0)
                )
        for name in NUMERIC_FEATURES:
            margin += F.lit(weights[name]) * preparation.number(name)
        return 1 / (1 + F.exp(-margin))

    def configuration(self) -> dict[str, Any]:
        return {"penalty": PENALTY, "fit": "Newton steps to a standstill", "threshold": RISK_THRESHOLD}


@dataclass(frozen=True)
class TreeModel:
    """A decision tree; nodes are numbered 1, and 2n and 2n + 1 below n."""

    nodes: Mapping[int, Node]

    @property
    def depth(self) -> int:
        return max(number.bit_length() for number in self.nodes) - 1

    def _walk(self, preparation: Preparation, value, number: int = 1) -> Column:
        node = self.nodes[number]
        if node.feature is None:
            return value(number, node)
        if node.level is not None:
            right = preparation.category(node.feature) == F.lit(node.level)
        else:
            right = preparation.filled(node.feature) > F.lit(node.cut)
        return F.when(right, self._walk(preparation, value, 2 * number + 1)).otherwise(
            self._walk(preparation, value, 2 * number)
        )

    def probability(self, preparation: Preparation) -> Column:
        return self._walk(preparation, lambda _, node: F.lit(node.rate))

    def leaf(self, preparation: Preparation) -> Column:
        return self._walk(preparation, lambda number, _: F.lit(number))

    def importances(self, names: Sequence[str]) -> list[float]:
        """Each encoded feature's share of the impurity that splits take away."""
        gains = dict.fromkeys(names, 0.0)
        for node in self.nodes.values():
            if node.feature is not None:
                name = node.feature if node.level is None else f"{node.feature}_{node.level}"
                gains[name] += node.gain
        total = sum(gains.values()) or 1.0
        return [gain / total for gain in gains.values()]

    def configuration(self) -> dict[str, Any]:
        return {"impurity": "gini", "max_depth": DEPTH, "least_rows_per_leaf": LEAST_ROWS}


def model_record(model: LinearModel | TreeModel) -> dict[str, Any]:
    """A model as plain values for a file; ``model_of`` reads them."""
    if isinstance(model, LinearModel):
        return {"weights": list(model.weights), "intercept": model.intercept}
    return {"nodes": {str(number): asdict(node) for number, node in model.nodes.items()}}


def model_of(record: Mapping[str, Any]) -> LinearModel | TreeModel:
    if "nodes" in record:
        return TreeModel({int(number): Node(**node) for number, node in record["nodes"].items()})
    return LinearModel(tuple(record["weights"]), record["intercept"])


@dataclass(frozen=True)
class LinearLearner:
    """Fits the logistic model to the label and a vector column ``features``."""

    penalty: float = PENALTY

    def fit(self, df: DataFrame) -> LinearModel:
        rows = df.select(LABEL, vector_to_array("features").alias("features"), F.lit(0).alias("fold"))
        width = len(rows.first()["features"])
        base = VectorBase(width)
        weights, intercept = fit_logistic(
            rows, base, LABEL, {ALL_ROWS: np.eye(base.size)}, self.penalty
        )[ALL_ROWS]
        return LinearModel(tuple(map(float, weights)), intercept)


def _linear(rows: int) -> LinearLearner:
    """L2 with C = 1: the penalty does not grow with the rows."""
    return LinearLearner()


@dataclass(frozen=True)
class FittedRisk:
    """A candidate with the preparation it was fitted on. The baseline has a rate, no model."""

    name: str
    preparation: Preparation
    rate: float
    model: LinearModel | TreeModel | None = None

    def probability_column(self) -> Column:
        if self.model is None:
            return F.lit(self.rate)
        return self.model.probability(self.preparation)

    def probability(self, df: DataFrame) -> DataFrame:
        """Add ``probability_academic_risk``."""
        return df.withColumn("probability_academic_risk", self.probability_column())

    def configuration(self) -> dict[str, str]:
        found = {"classifier": self.name, "preprocessor": "training rows only: most frequent value "
                 "and one-hot for categories, median and scaling for numbers"}
        if self.model is not None:
            found |= {name: str(value) for name, value in self.model.configuration().items()}
        return found

    def importance(self) -> tuple[str, list[tuple[str, float]]]:
        """The kind of importance and its value per encoded feature."""
        names = self.preparation.feature_names()
        if isinstance(self.model, LinearModel):
            return "absolute_coefficient", list(zip(names, map(abs, self.model.weights), strict=True))
        if isinstance(self.model, TreeModel):
            return "feature_importance", list(zip(names, self.model.importances(names), strict=True))
        return "unavailable", []


def no_weights_reason(fitted: FittedRisk) -> str | None:
    """Why a model shows no importances, or None where it does."""
    return None if fitted.model is not None else f"{fitted.name} exposes no weights"


def importance_table(spark: SparkSession, fitted: FittedRisk, top: int = TOP_IMPORTANCES) -> DataFrame:
    """The strongest features; one row with a reason when the model shows none."""
    kind, values = fitted.importance()
    rows = [(fitted.name, kind, name, value) for name, value in values]
    if not rows:
        rows = [(fitted.name, f"{kind}: {no_weights_reason(fitted)}", None, None)]
    table = spark.createDataFrame(rows, "model string, kind string, feature string, importance double")
    return table.orderBy(F.col("importance").desc_nulls_last(), "feature").limit(top)


def fit_candidates(
    rows: DataFrame, preparations: Mapping[int, Preparation]
) -> dict[str, dict[int, FittedRisk]]:
    """Every candidate on every training set, by name and set.

    ``rows`` have a ``fold``; a set is all rows but those of the fold it is named after.
    """
    sizes = set_sizes(rows, LABEL, list(preparations))
    base = MartBase(preparations[ALL_ROWS])
    maps = {number: base.map(own) for number, own in preparations.items()}
    linear = fit_logistic(rows, base, LABEL, maps, PENALTY)
    trees = grow_trees(rows, LABEL, preparations, preparations[ALL_ROWS], sizes, DEPTH, LEAST_ROWS)
    models = {
        BASELINE: dict.fromkeys(preparations),
        LINEAR: {
            number: LinearModel(tuple(map(float, weights)), intercept)
            for number, (weights, intercept) in linear.items()
        },
        TREE: {number: TreeModel(nodes) for number, nodes in trees.items()},
    }
    return {
        name: {
            number: FittedRisk(name, preparations[number], positives / count, models[name][number])
            for number, (count, positives) in sizes.items()
        }
        for name in CANDIDATES
    }


@dataclass(frozen=True)
class RiskSearch:
    """Everything a champion search found."""

    champion: FittedRisk
    candidates: DataFrame
    predictions: DataFrame
    holdout: DataFrame
    importance: DataFrame
    split: DataFrame
    development: DataFrame
    strategy: str
    folds: int

    @property
    def candidate_rows(self) -> list[Mapping[str, Any]]:
        return [row.asDict() for row in self.candidates.collect()]


def labelled_features(mart: DataFrame) -> DataFrame:
    """Keys, contract features and the label, after all training checks."""
    source = "training data"
    checks.require_columns(mart, ["final_result"], source)
    checks.check_contract_columns(mart, source, allow_outcomes=True)
    rows = materialize(
        checks.coerce_numeric(mart.select(*KEYS, *FEATURES, "final_result"), NUMERIC_FEATURES)
    )
    checks.require(
        checks.result_domain(rows)
        .unionByName(checks.duplicate_keys(rows, KEYS, "duplicate_keys"))
        .unionByName(checks.all_null(rows, NUMERIC_FEATURES)),
        source,
    )
    return rows.withColumn(LABEL, academic_risk(F.col("final_result"))).drop("final_result")


def _fold_predictions(
    development: DataFrame, fits: Mapping[str, Mapping[int, FittedRisk]], folds: int
) -> DataFrame:
    """Each candidate's probabilities on the fold it was not fitted on, from one scan."""
    scored = {}
    for name, own in fits.items():
        column = F.lit(None).cast("double")
        for number in range(folds):
            column = F.when(F.col("fold") == number, own[number].probability_column()).otherwise(column)
        scored[name] = column
    entries = [F.struct(F.lit(name).alias("model"), p.alias("probability_academic_risk")) for name, p in scored.items()]
    return development.select("fold", LABEL, F.explode(F.array(*entries)).alias("scored")).select(
        "scored.model", "fold", LABEL, "scored.probability_academic_risk"
    )


def mean_over_folds(per_fold: DataFrame) -> DataFrame:
    """Mean of each metric over folds; a fold without the metric does not count."""
    return per_fold.groupBy("model").agg(*[F.avg(name).alias(name) for name in metrics.METRICS])


def _preference() -> list[Column]:
    """PR-AUC down, then Brier up; a missing PR-AUC ranks as 0, a missing or zero Brier as 1."""
    brier = F.when(F.coalesce(F.col("brier_score"), F.lit(0.0)) == 0, 1.0).otherwise(
        F.col("brier_score")
    )
    place = F.array_position(F.array(*[F.lit(name) for name in CANDIDATES]), F.col("model"))
    return [F.coalesce("pr_auc", F.lit(0.0)).desc(), brier.asc(), place.asc()]


def choose(candidates: DataFrame) -> str:
    return candidates.orderBy(*_preference()).first()["model"]


def require_both_classes(summary: DataFrame) -> None:
    """Development and holdout must each hold risk and non-risk rows."""
    counts = {row["part"]: (row["rows"], row["risk_rows"]) for row in summary.collect()}
    for part in ("development", "holdout"):
        rows, risk = counts.get(part, (0, 0))
        if not 0 < risk < rows:
            raise checks.CheckError(
                f"both academic_risk classes must be present in {part}: {risk} of {rows} rows at risk"
            )


def search(mart: DataFrame, holdout: str = DEFAULT_HOLDOUT) -> RiskSearch:
    """Pick the champion on development folds, refit it, evaluate once on the holdout."""
    spark = mart.sparkSession
    parts, strategy = split.split_parts(labelled_features(mart), holdout)
    parts = materialize(parts)
    summary = split.split_summary(parts)
    require_both_classes(summary)
    everything = parts.where(F.col("part") == "development").drop("part")
    folds = split.fold_count(everything)
    development = materialize(split.group_folds(everything, folds))
    fits = fit_candidates(development, fit_preparations(development, folds))
    per_fold = metrics.risk_metrics(
        materialize(_fold_predictions(development, fits, folds)),
        LABEL, "probability_academic_risk", ["model", "fold"],
    )
    candidates = spark.createDataFrame(
        mean_over_folds(per_fold).collect(),
        "model string, " + ", ".join(f"{name} double" for name in metrics.METRICS),
    )
    champion = fits[choose(candidates)][ALL_ROWS]
    held = materialize(
        champion.probability(parts.where(F.col("part") == "holdout")).select(
            *KEYS, LABEL, "probability_academic_risk"
        )
    )
    predictions = held.select(
        *KEYS,
        F.lit(champion.name).alias("model"),
        F.col(LABEL).alias("academic_risk_actual"),
        "probability_academic_risk",
        (F.col("probability_academic_risk") >= RISK_THRESHOLD)
        .cast("int")
        .alias("prediction_academic_risk"),
    )
    return RiskSearch(
        champion=champion,
        candidates=candidates,
        predictions=predictions,
        holdout=metrics.holdout_report(held, LABEL, "probability_academic_risk"),
        importance=importance_table(spark, champion),
        split=summary,
        development=everything,
        strategy=strategy,
        folds=folds,
    )


def predict(fitted: FittedRisk, frame: DataFrame, cutoff_day: int, *keep: str) -> DataFrame:
    """Class and probability per enrollment; exactly 0.5 is class 0, as models predict it.

    ``keep`` names further columns of ``frame`` to carry along.
    """
    probability = F.col("probability_academic_risk")
    return fitted.probability(frame).select(
        *KEYS,
        F.lit(cutoff_day).alias("cutoff_day"),
        F.lit(LABEL).alias("model_target"),
        (probability > RISK_THRESHOLD).cast("int").alias("prediction_academic_risk"),
        probability,
        *keep,
    )
