"""Student-disjoint partitions: temporal holdout, grouped holdout and grouped folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import (
    CATEGORICAL_FEATURES,
    COURSE_KEYS,
    DEFAULT_HOLDOUT,
    FEATURES,
    MAX_FOLDS,
)
from cohortlens.operators.ranking import global_row_number
from cohortlens.operators.sketches import approximate_distinct

GROUP = "id_student"
# One student in so many is held out where no presentation is.
HOLDOUT_EVERY = 4


def numbered_students(df: DataFrame) -> DataFrame:
    """Each student's ``place`` in the order of the ids' md5 sums, and how many there are.

    The order is the same on every engine and run, and says nothing about the ids.
    """
    mixed = F.md5(F.col(GROUP).cast("string").cast("binary"))
    return global_row_number(df.select(GROUP).distinct(), [mixed, GROUP], "place")


def temporal_parts(df: DataFrame, holdout: str = DEFAULT_HOLDOUT) -> DataFrame:
    """Add ``part``: holdout rows, development rows, and overlap rows to be left out.

    Overlap rows belong to students of the holdout presentation but lie in others.
    """
    held = F.col("code_presentation") == holdout
    students = df.where(held).select(GROUP).distinct().withColumn("_held", F.lit(True))
    part = (
        F.when(held, "holdout")
        .when(F.col("_held"), "overlap")
        .otherwise("development")
    )
    # A student has one row per course, so no key of this join is heavy.
    return df.join(students, GROUP, "left").select(*df.columns, part.alias("part"))


def temporal_holdout(df: DataFrame, holdout: str = DEFAULT_HOLDOUT) -> tuple[DataFrame, DataFrame]:
    """Development and holdout rows; holdout students are anti-joined away."""
    held = df.where(F.col("code_presentation") == holdout)
    others = df.where(F.col("code_presentation") != holdout)
    return others.join(held.select(GROUP).distinct(), GROUP, "left_anti"), held


def grouped_parts(df: DataFrame) -> DataFrame:
    """Add ``part`` with a quarter of the students, rounded up, in the holdout."""
    held = F.col("place") <= F.ceil(F.col("place_total") / F.lit(HOLDOUT_EVERY))
    students = numbered_students(df).select(
        GROUP, F.when(held, "holdout").otherwise("development").alias("part")
    )
    return df.join(students, GROUP).select(*df.columns, "part")


def split_parts(df: DataFrame, holdout: str = DEFAULT_HOLDOUT) -> tuple[DataFrame, str]:
    """The temporal split when the holdout presentation has rows, else the grouped one."""
    if df.where(F.col("code_presentation") == holdout).limit(1).count():
        return temporal_parts(df, holdout), f"temporal_holdout_{holdout}"
    return grouped_parts(df), "grouped_random_holdout_fallback"


def split_summary(parts: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, students and risk rows per part; ``approximate`` counts students by sketches."""
    distinct = approximate_distinct if approximate else F.countDistinct
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        distinct(GROUP).alias("students"),
        F.sum("academic_risk").cast("bigint").alias("risk_rows"),
    )


def fold_count(df: DataFrame) -> int:
    """At most five folds, never more than students."""
    students = df.select(GROUP).distinct().limit(MAX_FOLDS).count()
    if students < 2:
        raise ValueError(f"grouped folds take two students or more, development has {students}")
    return students


def group_folds(df: DataFrame, folds: int) -> DataFrame:
    """Add ``fold``; all rows of a student share it, and students are dealt out evenly.

    With at least as many students as folds, no fold is empty.
    """
    students = numbered_students(df).select(
        GROUP, F.pmod(F.col("place") - 1, F.lit(folds)).cast("int").alias("fold")
    )
    return df.join(students, GROUP).select(*df.columns, "fold")


def known_key_values(df: DataFrame) -> DataFrame:
    """``(field, value)`` for each module and presentation of the training rows."""
    return known_values(df, COURSE_KEYS)


def known_categories(df: DataFrame) -> DataFrame:
    return known_values(df, CATEGORICAL_FEATURES)


def known_values(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    long = df.select(*[F.col(name).cast("string").alias(name) for name in columns]).unpivot(
        [], list(columns), "field", "value"
    )
    return long.where(F.col("value").isNotNull()).distinct()


def missing_rates(df: DataFrame, columns: tuple[str, ...] = FEATURES) -> DataFrame:
    """``(feature, missing_rate)`` of the contract features."""
    rates = df.agg(*[F.avg(F.col(name).isNull().cast("double")).alias(name) for name in columns])
    return rates.unpivot([], list(columns), "feature", "missing_rate")
