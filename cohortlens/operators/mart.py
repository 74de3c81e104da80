"""The enrollment mart: features seen up to a cutoff day, and later outcomes."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import (
    ACTIVITY,
    ARTIFACTS,
    ARTIFACT_VERSION,
    COURSE_KEYS,
    KEYS,
    SCORE,
    TARGETS,
    require_cutoff,
)
from cohortlens.functions.expressions import passed, performance_tier
from cohortlens.operators.joins import dimension_join, key_filter
from cohortlens.session import materialize
from cohortlens.sources.roles import RoleTables


def registered(enrollment: DataFrame, cutoff_day: int) -> DataFrame:
    """Enrollments registered by the cutoff.

    An unknown registration day cannot show that the student was there.
    """
    return enrollment.where(
        F.col("date_registration").isNotNull() & (F.col("date_registration") <= cutoff_day)
    )


def cohort(roles: RoleTables, cutoff_day: int) -> DataFrame:
    """Enrollments registered by the cutoff, with student and course columns."""
    enrolled = registered(roles.enrollment, cutoff_day)
    # A student has one enrollment per course and presentation, so no key is heavy.
    with_student = enrolled.join(roles.student, "id_student")
    return dimension_join(with_student, roles.course, COURSE_KEYS).select(
        *KEYS,
        "gender",
        "region",
        "highest_education",
        "imd_band",
        "disability",
        "age_band",
        "num_of_prev_attempts",
        "studied_credits",
        "date_registration",
        "course_duration_days",
        "final_result",
    )


def activity_features(interaction: DataFrame, cutoff_day: int) -> DataFrame:
    """Clicks, days, events and sites per enrollment key up to the cutoff."""
    # Distinct counts are combined per (key, day) and (key, site) on the map side,
    # so a key with very many events is not gathered in one task.
    return (
        interaction.where(F.col("event_day") <= cutoff_day)
        .groupBy(*KEYS)
        .agg(
            F.sum("clicks").alias("total_clicks"),
            F.countDistinct("event_day").alias("active_days"),
            F.count(F.lit(1)).alias("vle_events"),
            F.countDistinct("id_site").alias("vle_sites"),
        )
    )


def course_scores(assessment: DataFrame, submission: DataFrame) -> DataFrame:
    """Weighted mean score per student and course over all marked submissions."""
    marked = submission.where(F.col("score").isNotNull())
    score, weight = F.col("score").cast("double"), F.col("weight").cast("double")
    total = F.sum(weight)
    # Assessments are a handful per course. Spark cannot know so before it has read them, and
    # would move every submission once for the join, besides once for its enrollment.
    return (
        marked.join(F.broadcast(assessment), "id_assessment")
        .groupBy(*KEYS)
        .agg((F.sum(score * weight) / F.nullif(total, F.lit(0.0))).alias(SCORE))
    )


def weighted_scores(roles: RoleTables) -> DataFrame:
    """``course_scores`` of enrolled students only; no cutoff applies."""
    scores = course_scores(roles.assessment, roles.submission)
    return scores.join(roles.enrollment.select(*KEYS), list(KEYS), "left_semi")


def outcome_codes(enrollment: DataFrame) -> DataFrame:
    result = F.col("final_result")
    return enrollment.select(
        *KEYS,
        result,
        passed(result).alias("passed"),
        performance_tier(result).alias("performance_tier"),
    )


def cohort_events(roles: RoleTables, cutoff_day: int) -> DataFrame:
    """Events that can belong to the cohort: those of other enrollments are dropped at the scan,
    but for the few that a key filter lets pass."""
    known = key_filter(registered(roles.enrollment, cutoff_day), KEYS)
    return roles.interaction if known is None else roles.interaction.where(known)


def enrollment_mart(roles: RoleTables, cutoff_day: int, filter_events: bool = False) -> DataFrame:
    """One row per enrollment: 13 cohort, 5 activity and 4 outcome columns.

    ``filter_events`` drops events of enrollments outside the cohort before they are shuffled;
    it writes the cohort's enrollments once, as the filter needs them too, and pays where the
    cohort is a part of them.

    The enrollment key must be unique (``checks.duplicate_keys``): outcomes then
    come with the cohort rows and need no second read of the enrollments, and
    the left join below keeps scores of enrolled students only.
    """
    require_cutoff(cutoff_day)
    if filter_events:
        # The cohort, the filter and its size are computed from these.
        roles = replace(roles, enrollment=materialize(registered(roles.enrollment, cutoff_day)))
    rows = cohort(roles, cutoff_day)
    events = cohort_events(roles, cutoff_day) if filter_events else roles.interaction
    activity = activity_features(events, cutoff_day)
    scores = course_scores(roles.assessment, roles.submission)
    result = F.col("final_result")
    return (
        rows.join(activity, list(KEYS), "left")
        .join(scores, list(KEYS), "left")
        .select(
            *[F.col(name) for name in rows.columns if name != "final_result"],
            *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in ACTIVITY],
            F.col("vle_events").isNotNull().cast("int").alias("has_vle_activity"),
            result,
            passed(result).alias("passed"),
            performance_tier(result).alias("performance_tier"),
            F.col(SCORE),
        )
    )


def artifact_tables(mart: DataFrame) -> dict[str, DataFrame]:
    """The mart as full, features and targets tables, doubles at six decimals."""
    rounded = mart.select(
        *[
            F.round(name, 6).alias(name) if kind in ("double", "float") else F.col(name)
            for name, kind in mart.dtypes
        ]
    )
    return {
        "full": rounded,
        "features": rounded.drop(*TARGETS),
        "targets": rounded.select(*KEYS, *TARGETS),
    }


def artifact_metadata(
    mart: DataFrame, cutoff_day: int, generated_at: datetime | None = None
) -> DataFrame:
    """One row describing the artifact tables."""
    moment = (generated_at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    feature_columns = [name for name in mart.columns if name not in (*KEYS, *TARGETS)]
    return mart.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(ARTIFACT_VERSION).alias("artifact_version"),
        F.lit(require_cutoff(cutoff_day)).alias("cutoff_day"),
        F.lit(moment.isoformat()).alias("generated_at"),
        F.array(*[F.lit(name) for name in KEYS]).alias("enrollment_key"),
        F.col("row_count"),
        F.lit(len(feature_columns)).alias("feature_column_count"),
        F.lit(len(TARGETS)).alias("target_column_count"),
        F.struct(*[F.lit(table).alias(name) for name, table in ARTIFACTS.items()]).alias("artifacts"),
    )
