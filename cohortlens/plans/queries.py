"""Every operator as a query over the order tables bound to cohort roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.contract import (
    ARTIFACTS,
    CATEGORICAL_FEATURES,
    DEFAULT_CUTOFF,
    FEATURES,
    KEYS,
    NUMERIC_FEATURES,
    SCORE,
)
from cohortlens.functions.expressions import academic_risk, fixed_score
from cohortlens.models import legacy, neighbors, risk
from cohortlens.plans import model_checks
from cohortlens.operators import checks, cutoffs, mart, metrics, prep, profile, scoring, sketches
from cohortlens.operators import split
from cohortlens.operators.joins import dimension_join
from cohortlens.session import materialize, scratch_path, shuffle_width
from cohortlens.sources import bucketed
from cohortlens.sources.order_binding import (
    AGE_ORDER,
    HOLDOUT,
    SEGMENT_ORDER,
    enrollments,
    order_keys,
    order_roles,
    order_scoring_tables,
)

Query = Callable[[SparkSession, str], DataFrame]
CUTOFF = DEFAULT_CUTOFF
CUTOFFS = (0, 30, 60)
LEVELS = {"highest_education": SEGMENT_ORDER, "age_band": AGE_ORDER}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at six decimals, for comparison across engines."""
    return df.select(
        *[
            F.round(f"`{name}`", digits).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def bound_mart(spark: SparkSession, folder: str) -> DataFrame:
    return mart.enrollment_mart(order_roles(spark, folder), CUTOFF)


def labelled_mart(spark: SparkSession, folder: str) -> DataFrame:
    return bound_mart(spark, folder).withColumn(
        "academic_risk", academic_risk(F.col("final_result"))
    )


def scored_mart(spark: SparkSession, folder: str) -> DataFrame:
    """Keys, label and the fixed score, with classes predicted at 0.5."""
    score = fixed_score(F.col("total_clicks"), F.col("num_of_prev_attempts"))
    return labelled_mart(spark, folder).select(
        *KEYS, "academic_risk", "performance_tier", SCORE, score.alias("p")
    ).withColumn("predicted", (F.col("p") >= 0.5).cast("int"))


def split_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled mart with its temporal part."""
    columns = [*KEYS, "final_result"]
    rows = materialize(bound_mart(spark, folder).select(*columns))
    labelled = rows.withColumn("academic_risk", academic_risk(F.col("final_result")))
    return split.temporal_parts(labelled, HOLDOUT)


def development_mart(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialize(bound_mart(spark, folder).select(*KEYS))
    return split.temporal_holdout(rows, HOLDOUT)[0]


def _every(count: int) -> Column:
    return F.col("id_student") % count == 0


def drifted(rows: DataFrame) -> DataFrame:
    """The mart with unseen and missing values planted by student number."""
    return rows.withColumns(
        {
            "highest_education": F.when(_every(50), "UNKNOWN").otherwise(F.col("highest_education")),
            "age_band": F.when(~_every(40), F.col("age_band")),
            "studied_credits": F.when(~_every(4), F.col("studied_credits")),
        }
    )


def training_side(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("code_presentation") != HOLDOUT)


def flagged(rows: DataFrame) -> DataFrame:
    """Unseen fields of the drifted rows, seen from the training side."""
    training = training_side(rows)
    planted = drifted(rows).select(*KEYS, *CATEGORICAL_FEATURES)
    unseen = scoring.unseen_fields(planted, split.known_categories(training))
    return scoring.unseen_keys(unseen, split.known_key_values(training)).drop(*CATEGORICAL_FEATURES)


def written_features(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(bound_mart(spark, folder).select(*KEYS, *FEATURES))


# --- mart and its parts -------------------------------------------------------


def enrollment_mart(spark, folder):
    return rounded(bound_mart(spark, folder))


def enrollment_mart_cutoffs(spark, folder):
    """The mart at several cutoff days, from one scan of the clickstream."""
    return rounded(cutoffs.enrollment_marts(order_roles(spark, folder), CUTOFFS))


def enrollment_mart_filtered(spark, folder):
    """The mart from events that a filter of the cohort's keys lets pass at the scan."""
    return rounded(mart.enrollment_mart(order_roles(spark, folder), CUTOFF, filter_events=True))


def enrollment_mart_bucketed(spark, folder):
    """The mart over role tables stored in buckets of students."""
    path = scratch_path(spark)
    prefix = f"roles_{path.rpartition('/')[2]}"
    bucketed.write_bucketed_roles(order_roles(spark, folder), prefix, shuffle_width(spark), path)
    roles = bucketed.read_bucketed_roles(spark, prefix)
    return rounded(cutoffs.enrollment_marts(roles, [CUTOFF], laid_out=True).drop("cutoff_day"))


def _by_presentation(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Values of the columns in long form, by presentation."""
    return rows.select(
        F.col("code_presentation").alias("presentation"),
        *[F.col(name).cast("double").alias(name) for name in columns],
    ).unpivot(["presentation"], columns, "feature", "value")


def sketched_percentiles(spark, folder):
    """Whether sketched quartiles lie within the stated rank error of the exact ranks, per
    presentation, and for all presentations from the sketches of each."""
    rows = materialize(bound_mart(spark, folder))
    long = _by_presentation(rows, list(NUMERIC_FEATURES))
    by = ["presentation", "feature"]
    parts = materialize(sketches.value_sketches(long, by, "value"))
    whole = sketches.united_values(parts, ["feature"]).withColumn("presentation", F.lit("all"))
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    told = sketches.sketched_percentiles(parts.unionByName(whole), by, shares).unpivot(
        by, list(shares), "percentile", "estimate"
    )
    values = long.unionByName(long.withColumn("presentation", F.lit("all")))
    # Joins by the few presentations and features; every value meets three estimates.
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("percentile"))
    counted = dimension_join(
        values.where(F.col("value").isNotNull()).groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n")),
        told, by, salt_by=["value"],
    )
    n, value, estimate = F.col("n"), F.col("value"), F.col("estimate")
    ranks = counted.groupBy(*by, "percentile").agg(
        (F.sum(F.when(value < estimate, n).otherwise(0)) / F.sum("n")).alias("below"),
        (F.sum(F.when(value <= estimate, n).otherwise(0)) / F.sum("n")).alias("upto"),
    )
    error = F.greatest(wanted - F.col("upto"), F.col("below") - wanted, F.lit(0.0))
    return ranks.select(*by, "percentile", (error <= sketches.rank_error()).alias("within_error"))


def sketched_distinct(spark, folder):
    """Whether sketched distinct counts are within the stated error, per presentation and united,
    and whether the united sketches of the parts tell the same as one of the whole."""
    columns = ["id_student", "code_module", "region", "total_clicks"]
    rows = materialize(bound_mart(spark, folder).select("code_presentation", *columns))
    part = F.col("code_presentation").alias("presentation")
    parts = materialize(sketches.distinct_sketches(rows.select(part, *columns), ["presentation"], columns))
    everything = F.lit("all").alias("presentation")
    united = sketches.united_distinct(parts, columns).select(everything, *columns)
    single = sketches.distinct_sketches(rows, [], columns)
    whole = sketches.united_distinct(single, columns).select(everything, *columns)

    def long(sketched: DataFrame, name: str) -> DataFrame:
        counts = sketches.distinct_counts(sketched, ["presentation"], columns)
        return counts.unpivot(["presentation"], columns, "field", name)

    exact = [F.countDistinct(name).alias(name) for name in columns]
    told = rows.groupBy(part).agg(*exact).unionByName(rows.agg(*exact).select(everything, *columns))
    compared = (
        long(parts.unionByName(united), "estimate")
        .join(told.unpivot(["presentation"], columns, "field", "distinct"), ["presentation", "field"])
        .join(long(whole, "whole"), ["presentation", "field"], "left")
    )
    gap = F.abs(F.col("estimate") - F.col("distinct"))
    return compared.select(
        "presentation",
        "field",
        (gap <= F.ceil(F.col("distinct") * sketches.distinct_error())).alias("within_error"),
        F.coalesce(F.col("estimate") == F.col("whole"), F.lit(True)).alias("parts_equal_whole"),
    )


def cohort_filter(spark, folder):
    return mart.cohort(order_roles(spark, folder), CUTOFF).drop("final_result")


def activity_features(spark, folder):
    return mart.activity_features(order_roles(spark, folder).interaction, CUTOFF)


def weighted_score(spark, folder):
    return rounded(mart.weighted_scores(order_roles(spark, folder)))


def outcome_codes(spark, folder):
    return mart.outcome_codes(order_roles(spark, folder).enrollment)


def artifact_features(spark, folder):
    return mart.artifact_tables(bound_mart(spark, folder))["features"]


def artifact_targets(spark, folder):
    return mart.artifact_tables(bound_mart(spark, folder))["targets"]


def artifact_metadata(spark, folder):
    return mart.artifact_metadata(bound_mart(spark, folder), CUTOFF).select(
        "artifact_version", "cutoff_day", "row_count", "feature_column_count", "target_column_count",
        *[F.col(f"artifacts.{name}").alias(f"{name}_table") for name in ARTIFACTS],
    )


# --- checks -------------------------------------------------------------------


def check_completeness(spark, folder):
    return checks.completeness(bound_mart(spark, folder), [*KEYS, "imd_band", SCORE])


def check_duplicate_keys(spark, folder):
    orders = order_keys(spark, folder)
    return checks.duplicate_keys(orders, KEYS, "orders").unionByName(
        checks.duplicate_keys(enrollments(orders), KEYS, "enrollment")
    )


def check_ranges(spark, folder):
    roles = order_roles(spark, folder)
    events = checks.range_rules(
        roles.interaction,
        {
            "negative_clicks": checks.negative("clicks"),
            "event_after_cutoff": checks.after_cutoff("event_day", CUTOFF),
        },
    )
    course = checks.range_rules(
        roles.course, {"non_positive_duration": checks.not_positive("course_duration_days")}
    )
    late = checks.range_rules(
        roles.enrollment, {"starts_after_cutoff": checks.after_cutoff("date_registration", CUTOFF)}
    )
    return events.unionByName(course).unionByName(late)


def check_result_domain(spark, folder):
    broken = order_roles(spark, folder).enrollment.withColumn(
        "final_result",
        F.when(_every(50), None).when(_every(15), "Deferred").otherwise(F.col("final_result")),
    )
    return checks.result_domain(broken)


def check_all_null(spark, folder):
    return checks.all_null(
        bound_mart(spark, folder).withColumn("studied_credits", F.lit(None).cast("int")),
        NUMERIC_FEATURES,
    )


def check_coverage(spark, folder):
    enrollment = order_roles(spark, folder).enrollment
    return checks.coverage(enrollment.where(~_every(60)), enrollment.where(~_every(70)), KEYS)


def check_orphan_activity(spark, folder):
    roles = order_roles(spark, folder)
    cohort = roles.enrollment.where(F.col("date_registration") <= CUTOFF)
    return checks.orphans(roles.interaction, cohort)


def check_classes_present(spark, folder):
    return checks.classes_present(split_mart(spark, folder), "part", "academic_risk")


def coerce_numeric(spark, folder):
    credits = F.col("studied_credits").cast("string")
    raw = order_roles(spark, folder).enrollment.select(
        *KEYS,
        F.when(_every(7), "n/a").when(_every(11), "NaN")
        .when(_every(5), F.concat(credits, F.lit(".5")))
        .otherwise(credits)
        .alias("studied_credits"),
        F.when(_every(3), F.lit(float("nan")))
        .otherwise(F.col("date_registration").cast("double"))
        .alias("date_registration"),
    )
    return checks.coerce_numeric(raw, ["studied_credits", "date_registration"])


def contract_features(spark, folder):
    return bound_mart(spark, folder).select(*KEYS, *FEATURES)


# --- profile ------------------------------------------------------------------


def _profile(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark, folder):
        return rounded(operator(bound_mart(spark, folder)))

    return query


# --- metrics ------------------------------------------------------------------


def _metric(operator: Callable[..., DataFrame]) -> Query:
    def query(spark, folder):
        return rounded(operator(scored_mart(spark, folder), "academic_risk", "p"))

    return query


def confusion_matrix(spark, folder):
    return metrics.confusion(scored_mart(spark, folder), "academic_risk", "predicted")


def binary_confusion(spark, folder):
    return metrics.binary_confusion(scored_mart(spark, folder), "academic_risk", "predicted")


def _tier_guess() -> Column:
    return F.floor(F.col("p") * 100).cast("int") % 4


def macro_scores(spark, folder):
    rows = scored_mart(spark, folder).withColumn("guess", _tier_guess())
    return rounded(metrics.class_scores(rows, "performance_tier", "guess"))


def regression_scores(spark, folder):
    rows = scored_mart(spark, folder).withColumn("guess", _tier_guess())
    tiers = metrics.value_scores(rows, "performance_tier", "guess")
    marks = prep.drop_missing_target(rows, SCORE).withColumn("guess", 100 * F.col("p"))
    return rounded(
        tiers.withColumn("target", F.lit("performance_tier")).unionByName(
            metrics.value_scores(marks, SCORE, "guess").withColumn("target", F.lit(SCORE))
        )
    )


def holdout_report(spark, folder):
    scored = materialize(scored_mart(spark, folder).select(*KEYS, "academic_risk", "p"))
    report = metrics.holdout_report(scored, "academic_risk", "p")
    capacity = F.col("intervention_capacity")
    return rounded(
        report.select(
            "rows",
            "students",
            *metrics.METRICS,
            capacity["selected_rows"].alias("selected_rows"),
            capacity["precision"].alias("capacity_precision"),
            capacity["recall"].alias("capacity_recall"),
            F.size("calibration").cast("bigint").alias("calibration_bins"),
        )
    )


# --- preparation and splits ---------------------------------------------------


def impute_median_mode(spark, folder):
    columns = [*KEYS, "studied_credits", "age_band", "imd_band", SCORE]
    gaps = materialize(bound_mart(spark, folder).select(*columns)).withColumns(
        {
            "studied_credits": F.when(~_every(4), F.col("studied_credits")),
            "age_band": F.when(~_every(9), F.col("age_band")),
        }
    )
    return rounded(prep.impute_median_mode(gaps).select(*columns))


def ordinal_encode(spark, folder):
    levels = {"highest_education": SEGMENT_ORDER, "age_band": AGE_ORDER[:2]}
    encoded = prep.ordinal_encode(drifted(bound_mart(spark, folder)), levels)
    return encoded.select(*KEYS, "highest_education_encoded", "age_band_encoded")


def standardize(spark, folder):
    columns = ["studied_credits", "date_registration", "total_clicks", "vle_sites"]
    rows = materialize(bound_mart(spark, folder).select(*KEYS, *columns))
    return rounded(prep.standardize(rows, columns))


def label_encode(spark, folder):
    rows = bound_mart(spark, folder).select(*KEYS, "final_result")
    return prep.label_encode(materialize(rows), "final_result")


def temporal_holdout(spark, folder):
    return split_mart(spark, folder).select(*KEYS, "part")


def split_summary(spark, folder):
    return split.split_summary(split_mart(spark, folder))


def grouped_holdout(spark, folder):
    return split.grouped_parts(bound_mart(spark, folder)).select(*KEYS, "part")


def group_folds(spark, folder):
    development = materialize(development_mart(spark, folder))
    folds = split.fold_count(development)
    return split.group_folds(development, folds).select(*KEYS, "fold")


def known_key_values(spark, folder):
    return split.known_key_values(development_mart(spark, folder))


def baseline_missing_rates(spark, folder):
    return rounded(split.missing_rates(drifted(training_side(bound_mart(spark, folder)))))


# --- models -------------------------------------------------------------------


def prevalence_baseline(spark, folder):
    parts = materialize(split_mart(spark, folder))
    rate = risk.prevalence(parts.where(F.col("part") == "development"), "academic_risk")
    return parts.where(F.col("part") == "holdout").select(
        *KEYS, F.lit(round(rate, 6)).alias("probability_academic_risk")
    )


def knn_score(spark, folder):
    scored = prep.drop_missing_target(bound_mart(spark, folder), SCORE)
    rows = split.grouped_parts(materialize(scored.select(*KEYS, *NUMERIC_FEATURES, SCORE)))
    return rounded(
        neighbors.nearest_mean(
            rows.where(F.col("part") == "development"),
            rows.where(F.col("part") == "holdout"),
            NUMERIC_FEATURES,
            SCORE,
        )
    )


def champion_candidates(spark, folder):
    return rounded(risk.search(bound_mart(spark, folder), HOLDOUT).candidates)


def champion_predictions(spark, folder):
    return rounded(risk.search(bound_mart(spark, folder), HOLDOUT).predictions)


def feature_importance(spark, folder):
    return rounded(risk.search(bound_mart(spark, folder), HOLDOUT).importance)


def score_enrollments(spark, folder):
    found = risk.search(bound_mart(spark, folder), HOLDOUT)
    frame = scoring.scoring_frame(order_scoring_tables(spark, folder), CUTOFF)
    return rounded(risk.predict(found.champion, frame, CUTOFF))


def legacy_binary(spark, folder):
    return rounded(legacy.binary_models(bound_mart(spark, folder), LEVELS).metrics)


def legacy_ordinal(spark, folder):
    return rounded(legacy.ordinal_models(bound_mart(spark, folder), LEVELS).metrics)


def legacy_regression(spark, folder):
    return rounded(legacy.regression_models(bound_mart(spark, folder), LEVELS).metrics)


def kmeans_segments(spark, folder):
    return rounded(legacy.segments(bound_mart(spark, folder), LEVELS).metrics)


# --- scoring ------------------------------------------------------------------


def _resolved(spark, folder):
    tables = order_scoring_tables(spark, folder)
    student = scoring.canonical_table(tables, "StudentInfo")
    events = scoring.canonical_table(tables, "VLE_clickStream")
    early = events.where(F.col("event_day") <= CUTOFF)
    return scoring.resolve_modules(early, student.select(*KEYS))


def module_resolution(spark, folder):
    return scoring.resolved_activity(_resolved(spark, folder))


def discard_reasons(spark, folder):
    return scoring.discard_reasons(_resolved(spark, folder))


def scoring_frame(spark, folder):
    return scoring.scoring_frame(order_scoring_tables(spark, folder), CUTOFF)


def unseen_fields(spark, folder):
    return flagged(written_features(spark, folder)).drop("oov_key_fields")


def unseen_keys(spark, folder):
    return flagged(written_features(spark, folder)).drop("oov_categorical_fields")


def missing_to_impute(spark, folder):
    return scoring.missing_to_impute(drifted(bound_mart(spark, folder)))


def drift_warnings(spark, folder):
    rows = written_features(spark, folder)
    baseline = split.missing_rates(training_side(rows))
    return rounded(scoring.drift_warnings(drifted(rows), baseline, flagged(rows)))


def probability_summary(spark, folder):
    return rounded(scoring.probability_summary(scored_mart(spark, folder), "p"))


def oov_counts(spark, folder):
    return scoring.oov_counts(flagged(written_features(spark, folder)))


PROFILES = {
    "cohort_snapshot": profile.cohort_snapshot,
    "data_quality": profile.data_quality,
    "categorical_profile": profile.categorical_profile,
    "categorical_candidates": profile.categorical_candidates,
    "numeric_profile": profile.numeric_profile,
    "missingness": profile.missingness,
    "click_histogram": profile.click_histogram,
    "feature_histograms": profile.feature_histograms,
    "clicks_boxplot_by_result": profile.clicks_boxplot_by_result,
    "score_boxplot_by_group": profile.score_boxplot_by_group,
    "result_distribution": profile.result_distribution,
    "risk_distribution": profile.risk_distribution,
    "target_share": profile.target_share,
    "engagement_quartiles": profile.engagement_quartiles,
    "risk_by_engagement_quartile": profile.risk_by_engagement_quartile,
    "risk_by_course_suppressed": profile.risk_by_course,
    "score_missing_by_result": profile.score_missing_by_result,
    "spearman_matrix": profile.spearman_matrix,
    "collinear_pairs": profile.collinear_pairs,
    "eda_headlines": profile.eda_headlines,
}

METRICS = {
    "risk_metrics": metrics.risk_metrics,
    "pr_curve": metrics.pr_curve,
    "roc_auc": metrics.roc_auc,
    "calibration_bins": metrics.calibration_bins,
    "capacity_top20": metrics.capacity_metrics,
}

DIRECT = (
    enrollment_mart, enrollment_mart_cutoffs, enrollment_mart_filtered, enrollment_mart_bucketed,
    sketched_percentiles, sketched_distinct, cohort_filter, activity_features, weighted_score, outcome_codes,
    artifact_features, artifact_targets, artifact_metadata,
    check_completeness, check_duplicate_keys, check_ranges, check_result_domain, check_all_null,
    check_coverage, check_orphan_activity, check_classes_present, coerce_numeric,
    contract_features,
    confusion_matrix, binary_confusion, macro_scores, regression_scores, holdout_report,
    impute_median_mode, ordinal_encode, standardize, label_encode,
    temporal_holdout, split_summary, grouped_holdout, group_folds, known_key_values,
    baseline_missing_rates,
    prevalence_baseline, knn_score,
    module_resolution, discard_reasons, scoring_frame, unseen_fields, unseen_keys,
    missing_to_impute, drift_warnings, probability_summary, oov_counts,
    champion_candidates, champion_predictions, feature_importance, score_enrollments,
    legacy_binary, legacy_ordinal, legacy_regression, kmeans_segments,
)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {query.__name__: query for query in DIRECT}
    found |= {name: _profile(operator) for name, operator in PROFILES.items()}
    found |= {name: _metric(operator) for name, operator in METRICS.items()}
    found |= {query.__name__: query for query in model_checks.CHECKS}
    return found
