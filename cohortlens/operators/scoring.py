"""The scoring population: validated frame, unseen values and drift."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import (
    ACTIVITY,
    CATEGORICAL_FEATURES,
    COURSE_KEYS,
    FEATURES,
    KEYS,
    MISSINGNESS_SHIFT,
    require_cutoff,
)
from cohortlens.operators import checks
from cohortlens.operators.joins import dimension_join
from cohortlens.operators.ranking import distribution_summary, value_distribution
from cohortlens.operators.split import missing_rates
from cohortlens.session import materialize
from cohortlens.sources.roles import rename

# Native table and column names of the scoring source.
SCORING_TABLES = ("StudentInfo", "Registration", "VLE_clickStream", "cursos")
SCORING_COLUMNS = {
    "StudentInfo": {
        "guid_student_id": "id_student",
        "code_module": "code_module",
        "code_presentation": "code_presentation",
        "highest_education": "highest_education",
        "age_band": "age_band",
        "num_of_prev_attempts": "num_of_prev_attempts",
        "studied_credits": "studied_credits",
    },
    "Registration": {
        "guid_studente_id": "id_student",
        "code_module": "code_module",
        "code_presentation": "code_presentation",
        "date_registration": "date_registration",
    },
    "VLE_clickStream": {
        "guid_student_id": "id_student",
        "modulo": "code_module",
        "presentation": "code_presentation",
        "guid_site_id": "id_site",
        "date": "event_day",
        "sum_clics": "clicks",
    },
    "cursos": {
        "code_module": "code_module",
        "code_presentation": "code_presentation",
        "module_presentation_length": "course_duration_days",
    },
}

# How an event got its module, as numbers: the largest of a group is found by hashing.
REASONS = ("with_module", "resolved", "ambiguous", "no_candidate")
KEPT, RESOLVED, AMBIGUOUS, NO_CANDIDATE = range(len(REASONS))
EVENT_NEEDS = ("id_student", "code_presentation", "id_site", "event_day", "clicks")
STUDENT_TERM = ("id_student", "code_presentation")
UNSEEN_CATEGORY_WARNING = "unseen_categorical_values"


def canonical_table(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    if name not in tables:
        raise checks.CheckError(f"scoring source is missing the table {name}")
    checks.require_columns(tables[name], SCORING_COLUMNS[name], name)
    return rename(tables[name], SCORING_COLUMNS[name])


def resolve_modules(events: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Give events without a module the student's only module of that presentation.

    Events are read once and summed per student, module, presentation, day and site:
    ``clicks`` is their sum and ``events`` their number. ``reason``, a place in
    ``REASONS``, tells kept and resolved events from those to drop: no enrollment in the
    presentation, or more than one.
    """
    only = enrollment.groupBy(*STUDENT_TERM).agg(
        F.count(F.lit(1)).alias("_modules"), F.min("code_module").alias("_module")
    )
    packed = events.groupBy(*KEYS, "event_day", "id_site").agg(
        F.sum("clicks").alias("clicks"), F.count(F.lit(1)).alias("events")
    )
    # Days times sites bound a student's rows, and the activity groups below can stay
    # where this join has put them.
    found = packed.join(only, list(STUDENT_TERM), "left")
    unique = F.col("_modules") == 1
    known = F.col("code_module").isNotNull()
    reason = (
        F.when(known, KEPT)
        .when(F.col("_modules").isNull(), NO_CANDIDATE)
        .when(unique, RESOLVED)
        .otherwise(AMBIGUOUS)
    )
    module = F.when(known, F.col("code_module")).when(unique, F.col("_module"))
    return found.select(
        *[module.alias(name) if name == "code_module" else F.col(name) for name in packed.columns],
        reason.alias("reason"),
    )


def discard_reasons(resolved: DataFrame) -> DataFrame:
    """Events and clicks per resolution outcome."""
    counts = resolved.groupBy("reason").agg(
        F.sum("events").alias("events"), F.sum("clicks").cast("bigint").alias("clicks")
    )
    names = F.array(*[F.lit(name) for name in REASONS])
    return counts.withColumn("reason", names[F.col("reason")])


def _activity_groups(resolved: DataFrame) -> DataFrame:
    """Activity per key; dropped events form groups without a module, told by ``reason``."""
    return resolved.groupBy(*KEYS).agg(
        F.sum("clicks").alias("total_clicks"),
        F.countDistinct("event_day").alias("active_days"),
        F.sum("events").alias("vle_events"),
        F.countDistinct("id_site").alias("vle_sites"),
        F.max("reason").alias("reason"),
    )


def _with_module(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("code_module").isNotNull()).drop("reason")


def resolved_activity(resolved: DataFrame) -> DataFrame:
    """Activity features of the events that ended up with a module."""
    return _with_module(_activity_groups(resolved))


def warn_discarded(groups: DataFrame) -> None:
    """Tell how many events were dropped, and why."""
    lost = {
        row["reason"]: row["events"]
        for row in groups.where(F.col("code_module").isNull())
        .groupBy("reason")
        .agg(F.sum("vle_events").alias("events"))
        .collect()
    }
    if lost:
        # The wording of the warning.
        told = {
            NO_CANDIDATE: "without an enrollment candidate",
            AMBIGUOUS: "with ambiguous enrollment candidates",
        }
        reasons = "; ".join(f"{lost[name]} {text}" for name, text in told.items() if name in lost)
        warnings.warn(
            f"Discarded {sum(lost.values())} pre-cutoff VLE_clickStream events: {reasons}.",
            UserWarning,
            stacklevel=3,
        )


def scoring_frame(
    tables: Mapping[str, DataFrame], cutoff_day: int, strict: bool = True
) -> DataFrame:
    """One row of contract features per enrollment of the four-table source.

    ``strict`` first runs all expectations and raises on any violation.
    Assessment tables are never read: they hold later outcomes.
    """
    require_cutoff(cutoff_day)
    student, registration, events, course = (
        canonical_table(tables, name) for name in SCORING_TABLES
    )
    student = checks.coerce_numeric(student, ["num_of_prev_attempts", "studied_credits"])
    registration = checks.coerce_numeric(registration, ["date_registration"])
    course = checks.coerce_numeric(course, ["course_duration_days"])
    events = checks.coerce_numeric(events, ["event_day", "clicks"])
    if strict:
        # Rules of the events are counted on the way of the one scan that sums them.
        require_tables(student, registration, course, cutoff_day)
        event_rules = (EVENT_NEEDS, {"negative_clicks": checks.negative("clicks")})
        read, observed = checks.observed_rules(events, *event_rules)
    else:
        read, observed = events, None
    seen = resolve_modules(read.where(F.col("event_day") <= cutoff_day), student.select(*KEYS))
    groups = _activity_groups(seen)
    if strict:
        groups = materialize(groups)
        checks.require_observed(observed, events, *event_rules, "VLE_clickStream")
        checks.require(checks.orphans(_with_module(groups), student), "VLE_clickStream")
        warn_discarded(groups)
    activity = _with_module(groups)
    # Both sides hold one row per enrollment key.
    enrollment = student.join(registration, list(KEYS))
    enrollment = dimension_join(enrollment, course, COURSE_KEYS, "left")
    return (
        enrollment.join(activity, list(KEYS), "left")
        .withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in ACTIVITY})
        .withColumn("has_vle_activity", (F.col("vle_events") > 0).cast("int"))
        .select(*KEYS, *FEATURES)
    )


def require_tables(
    student: DataFrame, registration: DataFrame, course: DataFrame, cutoff_day: int
) -> None:
    """Raise on the first small table that breaks its expectations; one job counts them all."""
    late = {"starts_after_cutoff": checks.after_cutoff("date_registration", cutoff_day)}
    short = {"non_positive_duration": checks.not_positive("course_duration_days")}
    checks.require_all(
        {
            "StudentInfo": [checks.keyed_rules(student, KEYS, KEYS)],
            "Registration": [
                checks.keyed_rules(registration, KEYS, (*KEYS, "date_registration"), late)
            ],
            "cursos": [
                checks.keyed_rules(
                    course, COURSE_KEYS, (*COURSE_KEYS, "course_duration_days"), short
                )
            ],
            "identical enrollment coverage of StudentInfo and Registration": [
                checks.coverage(student, registration, KEYS)
            ],
            "coverage of the courses in cursos": [
                checks.orphans(student, course, COURSE_KEYS, "enrollment_without_course")
            ],
        }
    )


def _unseen(df: DataFrame, known: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The rows with the ``;``-joined names of the fields whose value is not known.

    A missing value is never known.
    """
    checked = df
    for field in fields:
        values = known.where(F.col("field") == field).select(
            F.col("value").alias(f"_{field}"), F.lit(True).alias(f"_known_{field}")
        )
        text = checked.withColumn(f"_{field}", F.col(field).cast("string"))
        checked = dimension_join(text, values, [f"_{field}"], "left")
    names = F.concat_ws(
        ";", *[F.when(F.col(f"_known_{field}").isNull(), field) for field in fields]
    )
    return checked.select(*df.columns, F.coalesce(F.nullif(names, F.lit("")), F.lit("none")).alias("_names"))


def unseen_fields(df: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``oov_categorical_fields``, against ``(field, value)`` of the training side."""
    return _unseen(df, known, CATEGORICAL_FEATURES).withColumnRenamed(
        "_names", "oov_categorical_fields"
    )


def unseen_keys(df: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``oov_key_fields`` for modules and presentations not seen in training."""
    return _unseen(df, known, COURSE_KEYS).withColumnRenamed("_names", "oov_key_fields")


def oov_counts(flagged: DataFrame) -> DataFrame:
    """Rows with any unseen category and rows with any unseen key."""
    return flagged.agg(
        F.count_if(F.col("oov_categorical_fields") != "none").alias("rows_with_categorical_oov"),
        F.count_if(F.col("oov_key_fields") != "none").alias("rows_with_key_oov"),
    )


def missing_to_impute(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], list(columns), "feature", "missing_count")


def drift_warnings(
    df: DataFrame,
    baseline: DataFrame,
    unseen: DataFrame | None = None,
    shift: float = MISSINGNESS_SHIFT,
) -> DataFrame:
    """Features whose missing rate moved by ``shift`` or more, and unseen categories.

    ``baseline`` is ``missing_rates`` of the training side; a feature without a
    baseline gives no warning.
    """
    before = baseline.select("feature", F.col("missing_rate").alias("baseline_rate"))
    moved = missing_rates(df).join(before, "feature").where(
        F.abs(F.col("missing_rate") - F.col("baseline_rate")) >= shift
    )
    warnings = moved.select(
        F.concat(F.lit("missingness_shift:"), F.col("feature")).alias("warning"),
        "missing_rate",
        "baseline_rate",
    )
    if unseen is None:
        return warnings
    count = unseen.agg(F.count_if(F.col("oov_categorical_fields") != "none").alias("n"))
    nothing = F.lit(None).cast("double")
    return warnings.unionByName(
        count.where(F.col("n") > 0).select(
            F.lit(UNSEEN_CATEGORY_WARNING).alias("warning"),
            nothing.alias("missing_rate"),
            nothing.alias("baseline_rate"),
        )
    )


def probability_summary(df: DataFrame, probability: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and three percentiles of a probability."""
    rows = df.select(F.lit(0).alias("_all"), F.col(probability).alias("p"))
    shares = {"p5": 0.05, "p50": 0.5, "p95": 0.95}
    return distribution_summary(value_distribution(rows, ["_all"], "p"), ["_all"], "p", shares).select(
        "count", "mean", "std", "min", *shares, "max"
    )
