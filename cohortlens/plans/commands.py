"""The five workflows: build the mart, profile it, train, build a scoring frame, score."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.contract import (
    DEFAULT_HOLDOUT,
    FEATURES,
    KEYS,
    TARGETS,
    require_cutoff,
)
from cohortlens.models import risk
from cohortlens.operators import checks, mart, profile as profiles, scoring
from cohortlens.operators.metrics import one_row
from cohortlens.session import materialize
from cohortlens.sinks import bundle as bundles
from cohortlens.sinks import tables as sinks
from cohortlens.sources import files
from cohortlens.sources.roles import RoleTables

PROFILE_TABLES = {
    "cohort_snapshot": profiles.cohort_snapshot,
    "cohort_engagement_histogram": profiles.click_histogram,
    "data_quality_checks": profiles.data_quality,
    "categorical_profile": profiles.categorical_profile,
    "univariate_numeric_summary": profiles.numeric_profile,
    "univariate_numeric_histograms": profiles.feature_histograms,
    "univariate_categorical_summary": profiles.categorical_candidates,
    "missingness_and_score_availability": profiles.missingness,
    "candidate_feature_spearman_correlations": profiles.spearman_matrix,
    "collinearity_and_near_duplicate_summary": profiles.collinear_pairs,
    "total_clicks_by_final_result_boxplot_summary": profiles.clicks_boxplot_by_result,
    "bivariate_score_boxplots_summary": profiles.score_boxplot_by_group,
    "final_result_distribution": profiles.result_distribution,
    "academic_risk_distribution": profiles.risk_distribution,
    "academic_risk_by_engagement_quartile": profiles.risk_by_engagement_quartile,
    "academic_risk_by_course_presentation": profiles.risk_by_course,
    "score_missingness_by_final_result": profiles.score_missing_by_result,
    "report_headlines": profiles.eda_headlines,
}


def build_mart(roles: RoleTables, cutoff_day: int, folder: str | None = None, **options) -> DataFrame:
    """The enrollment mart; with ``folder`` also its written artifacts, read back."""
    rows = mart.enrollment_mart(roles.changed(checks.nan_to_null), cutoff_day)
    if folder is None:
        return rows
    paths = sinks.write_artifacts(rows, folder, cutoff_day, **options)
    file_format = options.get("file_format", "parquet")
    return sinks.read_table(rows.sparkSession, paths["full"], rows.schema, file_format)


def validate_profile_input(rows: DataFrame) -> None:
    source = "profile input"
    checks.require_columns(rows, (*KEYS, *TARGETS), source)
    checks.require(
        checks.duplicate_keys(rows, KEYS, "duplicate_keys").unionByName(checks.result_domain(rows)),
        source,
    )


def profile(rows: DataFrame, folder: str | None = None, **options) -> dict[str, DataFrame]:
    """All descriptive tables of a mart, optionally written to ``folder``.

    The columns are correlated once, for the three tables that show it.
    """
    kept = materialize(rows)
    validate_profile_input(kept)
    pairs = materialize(profiles.spearman_pairs(kept))
    tables = {
        name: operator(kept, pairs) if operator in profiles.ON_PAIRS else operator(kept)
        for name, operator in PROFILE_TABLES.items()
    }
    if folder is not None:
        sinks.write_profile(tables, folder, **options)
    return tables


def train_champion(
    rows: DataFrame,
    cutoff_day: int,
    holdout: str = DEFAULT_HOLDOUT,
    folder: str | None = None,
    data_name: str = "",
) -> tuple[risk.RiskSearch, str | None]:
    """Search the champion; with ``folder`` also publish its bundle there."""
    require_cutoff(cutoff_day)
    found = risk.search(rows, holdout)
    path = None
    if folder is not None:
        path = bundles.save_bundle(found, folder, cutoff_day, holdout, data_name)
    return found, path


def train_from_files(
    spark: SparkSession,
    data: str,
    metadata: str,
    folder: str,
    holdout: str = DEFAULT_HOLDOUT,
    file_format: str = "parquet",
) -> str:
    """Train from a written mart, in Parquet or CSV, and its metadata record."""
    if file_format not in ("parquet", "csv"):
        raise ValueError(f"a mart is read from parquet or csv, not {file_format}")
    cutoff_day = files.read_cutoff(spark, metadata)
    read = files.read_mart_csv if file_format == "csv" else files.read_mart
    rows = read(spark, data)
    return train_champion(rows, cutoff_day, holdout, folder, data.rpartition("/")[2])[1]


def build_scoring_frame(tables: Mapping[str, DataFrame], cutoff_day: int) -> DataFrame:
    return scoring.scoring_frame(tables, cutoff_day)


def score_frame(frame: DataFrame, loaded: bundles.Bundle, cutoff_day: int) -> DataFrame:
    """Prediction, probability and unseen fields per enrollment."""
    spark = frame.sparkSession
    checks.check_contract_columns(frame, "scoring frame")
    flagged = scoring.unseen_fields(frame, loaded.known(spark, "known_categories"))
    flagged = scoring.unseen_keys(flagged, loaded.known(spark, "known_key_values"))
    return risk.predict(
        loaded.champion, flagged, cutoff_day, "oov_categorical_fields", "oov_key_fields"
    )


def scoring_report(frame: DataFrame, output: DataFrame, loaded: bundles.Bundle) -> DataFrame:
    """One nested row: counts, unseen values, imputations, probabilities and drift."""
    manifest = loaded.manifest
    told = ("artifact_version", "champion_name", "model_target", "target_definition",
            "contract_version", "contract_fingerprint", "cutoff_day")
    gaps = frame.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in FEATURES])
    summary = scoring.probability_summary(output, "probability_academic_risk")
    # At most one warning per feature and one for unseen categories.
    drift = scoring.drift_warnings(frame, loaded.baseline(frame.sparkSession), output).agg(
        F.array_sort(F.collect_list("warning")).alias("drift_warnings")
    )
    report = one_row(
        output.agg(F.count(F.lit(1)).alias("rows")),
        scoring.oov_counts(output).select(F.struct("*").alias("oov")),
        gaps.select(F.struct("*").alias("missing_values_requiring_imputation")),
        summary.select(F.struct("*").alias("probability_academic_risk")),
        drift,
    )
    return report.select(*[F.lit(manifest.get(name)).alias(name) for name in told], "*")


def score(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    bundle_path: str,
    cutoff_day: int,
    output_path: str,
    source_path: str,
) -> tuple[DataFrame, DataFrame]:
    """Predict every enrollment of a scoring source, write predictions and the report."""
    loaded = bundles.load_bundle(spark, bundle_path, cutoff_day)
    frame = materialize(build_scoring_frame(tables, cutoff_day))
    output = materialize(score_frame(frame, loaded, cutoff_day))
    sinks.write_predictions(output, output_path, source_path)
    report = scoring_report(frame, output, loaded).withColumn("predictions", F.lit(output_path))
    report.coalesce(1).write.mode("overwrite").json(f"{output_path}_report")
    return output, report
