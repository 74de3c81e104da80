"""Metrics of a 0/1 label and a probability, and of predicted classes or values.

Ranking metrics work on one row per distinct probability, so equal scores count
as one threshold. ``by`` evaluates many models or folds in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import CALIBRATION_BINS, CAPACITY, KEYS, RISK_THRESHOLD
from cohortlens.operators import sketches
from cohortlens.operators.joins import dimension_join
from cohortlens.operators.ranking import (
    distribution_percentiles,
    equal_frequency_size,
    global_row_number,
    running_totals,
)
from cohortlens.session import materialize

METRICS = ("pr_auc", "roc_auc", "brier_score", "precision_at_0_5", "recall_at_0_5")
EVERYTHING = "_everything"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A constant group when none is asked for."""
    return (df, list(by)) if by else (df.withColumn(EVERYTHING, F.lit(0)), [EVERYTHING])


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def score_table(
    df: DataFrame, label: str, probability: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows and positives per distinct probability, and those scored higher."""
    df, by = _grouped(df, by)
    scores = df.groupBy(*by, F.col(probability).alias("probability")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    return running_totals(scores, by, [F.col("probability").desc()], ["rows", "positives"])


def pr_curve(df: DataFrame, label: str, probability: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall when everything from each distinct probability up is flagged."""
    flagged = F.col("rows_before") + F.col("rows")
    hits = F.col("positives_before") + F.col("positives")
    return score_table(df, label, probability, by).select(
        *by,
        F.col("probability").alias("threshold"),
        flagged.alias("flagged"),
        (hits / flagged).alias("precision"),
        (hits / F.nullif("positives_total", F.lit(0))).alias("recall"),
    )


def _pr_auc() -> Column:
    """Average precision: each threshold's gain in recall times its precision."""
    reached = F.col("positives_before") + F.col("positives")
    precision = reached / (F.col("rows_before") + F.col("rows"))
    return _ratio(F.sum(F.col("positives") * precision), F.max("positives_total"))


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties at half; null for one class."""
    negatives = F.col("rows") - F.col("positives")
    below = (
        F.col("rows_total") - F.col("positives_total")
        - (F.col("rows_before") - F.col("positives_before")) - negatives
    )
    ordered = F.sum((F.col("positives") * (below + negatives / 2)).cast("double"))
    positives = F.max("positives_total").cast("double")
    return ordered / F.nullif(positives * (F.max("rows_total") - positives), F.lit(0.0))


def metrics_of_scores(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    missed = F.col("rows") - F.col("positives")
    error = F.col("positives") * F.pow(F.col("probability") - 1, 2) + missed * F.pow("probability", 2)
    risky = F.col("probability") >= RISK_THRESHOLD
    flagged = F.sum(F.when(risky, F.col("rows")).otherwise(0))
    hits = F.sum(F.when(risky, F.col("positives")).otherwise(0))
    group = by or [EVERYTHING]
    return scores.groupBy(*group).agg(
        _pr_auc().alias("pr_auc"),
        _roc_auc().alias("roc_auc"),
        (F.sum(error) / F.sum("rows")).alias("brier_score"),
        _ratio(hits, flagged).alias("precision_at_0_5"),
        _ratio(hits, F.max("positives_total")).alias("recall_at_0_5"),
    ).select(*by, *METRICS)


def risk_metrics(
    df: DataFrame, label: str, probability: str, by: Sequence[str] = ()
) -> DataFrame:
    """PR-AUC, ROC-AUC, Brier score, precision and recall at 0.5."""
    return metrics_of_scores(score_table(df, label, probability, by), list(by))


def roc_auc(df: DataFrame, label: str, probability: str, by: Sequence[str] = ()) -> DataFrame:
    return risk_metrics(df, label, probability, by).select(*by, "roc_auc")


def calibration_bins(
    df: DataFrame, label: str, probability: str, bins: int = CALIBRATION_BINS,
    approximate: bool = False,
) -> DataFrame:
    """Mean prediction and observed rate per probability quantile; empty bins are dropped.

    ``approximate`` takes the edges from a sketch, within ``sketches.rank_error``, and so orders
    no scores.

    ``bin_rows`` is the bin's size. ``rows`` is the size an equal-frequency split
    into as many bins would give, which differs where scores are tied.
    """
    df, by = _grouped(df, [])
    shares = {f"edge_{i}": i / bins for i in range(1, bins)}
    counts = df.groupBy(*by, F.col(probability).alias("probability")).agg(
        F.count(F.lit(1)).alias("rank"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    if approximate:
        found = sketches.value_sketches(df, by, probability)
        scores, edges = counts, sketches.sketched_percentiles(found, by, shares)
    else:
        scores = running_totals(counts, by, ["probability"], ["rank"])
        edges = distribution_percentiles(scores, by, "probability", shares)
    above = [F.when(F.col("probability") > F.col(edge), 1).otherwise(0) for edge in shares]
    # One row per bin from here on: at most ``bins`` of them.
    held = (
        dimension_join(scores, edges, by, salt_by=["probability"])
        .groupBy(*by, sum(above[1:], above[0]).alias("_edge"))
        .agg(
            F.sum("rank").alias("bin_rows"),
            (F.sum(F.col("probability") * F.col("rank")) / F.sum("rank")).alias(
                "mean_predicted_risk"
            ),
            (F.sum("positives") / F.sum("rank")).alias("observed_risk"),
        )
    )
    frame = held.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("_edge", *[
            "bin_rows", "mean_predicted_risk", "observed_risk"
        ]))).alias("held"),
        F.sum("bin_rows").alias("_rows"),
    )
    placed = frame.select(
        "_rows", F.size("held").alias("_bins"), F.posexplode("held").alias("_place", "b")
    )
    number = F.col("_place") + 1
    return placed.select(
        number.cast("int").alias("bin"),
        F.col("b.mean_predicted_risk").alias("mean_predicted_risk"),
        F.col("b.observed_risk").alias("observed_risk"),
        equal_frequency_size(number, F.col("_rows"), F.col("_bins")).alias("rows"),
        F.col("b.bin_rows").alias("bin_rows"),
    )


def capacity_metrics(
    df: DataFrame,
    label: str,
    probability: str,
    capacity: float = CAPACITY,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Precision and recall when the top share of rows is selected; ties go by key."""
    rows = materialize(
        df.select(*keys, F.col(probability).alias("_p"), F.col(label).cast("bigint").alias("_y"))
    )
    scores = materialize(score_table(rows, "_y", "_p"))
    chosen = F.greatest(F.lit(1), F.floor(F.col("rows_total") * F.lit(float(capacity))))
    after = F.col("rows_before") + F.col("rows")
    # One row: the probability at which the selection ends.
    cut = scores.where((F.col("rows_before") < chosen) & (chosen <= after)).select(
        F.col("probability").alias("_p"),
        (chosen - F.col("rows_before")).alias("_needed"),
        chosen.cast("bigint").alias("selected_rows"),
        "positives_before",
        "positives_total",
    )
    # Only rows tied at the cut need an order.
    tied = global_row_number(rows.join(cut.select("_p"), "_p", "left_semi"), list(keys), "place")
    taken = tied.join(cut, "_p").groupBy("selected_rows", "positives_before", "positives_total").agg(
        F.sum(F.when(F.col("place") <= F.col("_needed"), F.col("_y")).otherwise(0)).alias("_tied")
    )
    hits = F.col("positives_before") + F.col("_tied")
    return taken.select(
        F.lit(float(capacity)).alias("capacity"),
        "selected_rows",
        (hits / F.col("selected_rows")).alias("precision"),
        _ratio(hits, F.col("positives_total")).alias("recall"),
    )


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per actual and predicted class."""
    return df.groupBy(
        *by, F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("count"))


def binary_confusion(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """TP, FP, TN and FN in one row per group."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    cells = {
        "TP": actual & predicted, "FP": ~actual & predicted,
        "TN": ~actual & ~predicted, "FN": actual & ~predicted,
    }
    counted = [F.count_if(test).alias(name) for name, test in cells.items()]
    return df.groupBy(*by).agg(*counted) if by else df.agg(*counted)


def class_scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro precision, recall and F1, and the F1 of class 1.

    Macro means run over the classes found among labels or predictions.
    """
    cells, by = _grouped(confusion(df, label, prediction, by), by)
    # Cells are few: the square of the number of classes.
    right = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)
    sides = cells.withColumn("_hit", right).unpivot(
        [*by, "count", "_hit"], ["actual", "predicted"], "side", "class"
    )

    def side_sum(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("count")).otherwise(0))

    per_class = sides.groupBy(*by, "class").agg(
        side_sum("actual").alias("actual"),
        side_sum("predicted").alias("predicted"),
        F.sum(F.when(F.col("side") == "actual", F.col("_hit")).otherwise(0)).alias("hits"),
    )
    f1 = _ratio(2 * F.col("hits"), F.col("actual") + F.col("predicted"))
    return per_class.groupBy(*by).agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        F.avg(_ratio(F.col("hits"), F.col("predicted"))).alias("precision_macro"),
        F.avg(_ratio(F.col("hits"), F.col("actual"))).alias("recall_macro"),
        F.avg(f1).alias("f1_macro"),
        F.coalesce(F.max(F.when(F.col("class") == 1, f1)), F.lit(0.0)).alias("f1_score"),
    ).drop(EVERYTHING)


def value_scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error and R squared, also over class codes."""
    actual, predicted = F.col(label).cast("double"), F.col(prediction).cast("double")
    residual = F.sum(F.pow(actual - predicted, 2))
    spread = F.var_pop(actual) * F.count(F.lit(1))
    scores = [
        (residual / F.count(F.lit(1))).alias("mse"),
        (1 - residual / F.nullif(spread, F.lit(0.0))).alias("r2"),
    ]
    return df.groupBy(*by).agg(*scores) if by else df.agg(*scores)


def holdout_report(df: DataFrame, label: str, probability: str) -> DataFrame:
    """All holdout metrics, the capacity result and the calibration bins in one row."""
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id_student").alias("students"))
    capacity = capacity_metrics(df, label, probability)
    # At most ``CALIBRATION_BINS`` rows are gathered.
    calibration = calibration_bins(df, label, probability).agg(
        F.array_sort(F.collect_list(F.struct("*"))).alias("calibration")
    )
    return one_row(
        size,
        risk_metrics(df, label, probability),
        capacity.select(F.struct("*").alias("intervention_capacity")),
        calibration,
    )


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables with different columns side by side, without a join."""
    names = [name for part in parts for name in part.columns]
    stacked = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), parts)
    return stacked.agg(*[F.first(name, ignorenulls=True).alias(name) for name in names])
