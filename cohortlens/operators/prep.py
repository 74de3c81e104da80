"""Feature preparation: statistics are fitted by aggregation and applied as expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.contract import KEYS, ORDINAL_LEVELS, TARGETS
from cohortlens.operators.joins import dimension_join
from cohortlens.operators.ranking import exact_percentiles, global_row_number


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    return df.select(*[F.col(name).cast(kind).alias(name) for name in columns]).unpivot(
        [], list(columns), "feature", "value"
    )


def fit_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, median)`` with interpolation, over the rows that have a value."""
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    return exact_percentiles(_long(df, columns, "double"), ["feature"], "value", {"median": 0.5})


def fit_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, mode)``: the most frequent value, the smallest one on ties."""
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, mode string")
    counts = (
        _long(df, columns, "string")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.groupBy("feature").agg(best.alias("best")).select(
        "feature", F.col("best.value").alias("mode")
    )


def as_values(fitted: DataFrame) -> dict[str, object]:
    """Fitted statistics, one row per feature, as driver-side values."""
    return {row[0]: row[1] for row in fitted.collect()}


def _feature_columns(df: DataFrame, kind: type, targets: Sequence[str]) -> list[str]:
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, kind) and field.name not in targets
    ]


def impute_median_mode(df: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Fill numeric columns with their median and text columns with their mode.

    Targets keep their gaps. Whole numbers become doubles only where they are filled.
    """
    numeric = _feature_columns(df, T.NumericType, targets)
    text = _feature_columns(df, T.StringType, targets)
    gaps = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in [*numeric, *text]])
    gaps = gaps.first().asDict() if numeric or text else {}
    medians = as_values(fit_medians(df, [name for name in numeric if gaps[name]]))
    modes = as_values(fit_modes(df, [name for name in text if gaps[name]]))
    filled = {
        name: F.coalesce(F.col(name).cast("double"), F.lit(value)) for name, value in medians.items()
    }
    filled |= {name: F.coalesce(F.col(name), F.lit(value)) for name, value in modes.items()}
    return df.withColumns(filled)


def ordinal_code(column: Column, levels: Sequence[str]) -> Column:
    """Position in ``levels``; unknown and missing values share code 0 with the lowest level."""
    place = F.array_position(F.array(*[F.lit(level) for level in levels]), column)
    return F.coalesce(F.greatest(place - 1, F.lit(0)), F.lit(0)).cast("int")


def ordinal_encode(
    df: DataFrame, levels: Mapping[str, Sequence[str]] = ORDINAL_LEVELS
) -> DataFrame:
    """Add ``<column>_encoded`` for each ordered column that is present."""
    return df.withColumns(
        {
            f"{name}_encoded": ordinal_code(F.col(name), order)
            for name, order in levels.items()
            if name in df.columns
        }
    )


@dataclass(frozen=True)
class Scaling:
    """Training mean and population deviation per column."""

    center: Mapping[str, float]
    scale: Mapping[str, float]

    def apply(self, column: str) -> Column:
        value = F.col(column).cast("double") - F.lit(self.center[column])
        return value / F.lit(self.scale[column]) if self.scale[column] else value


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """One aggregation; a constant column is centred only."""
    row = df.agg(
        *[F.avg(F.col(name).cast("double")).alias(f"m_{name}") for name in columns],
        *[F.stddev_pop(F.col(name).cast("double")).alias(f"s_{name}") for name in columns],
    ).first()
    return Scaling(
        center={name: row[f"m_{name}"] or 0.0 for name in columns},
        scale={name: row[f"s_{name}"] or 0.0 for name in columns},
    )


def standardize(df: DataFrame, columns: Sequence[str], scaling: Scaling | None = None) -> DataFrame:
    scaling = scaling or fit_scaling(df, columns)
    return df.withColumns({name: scaling.apply(name) for name in columns})


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``(column, <column>_code)``: codes 0.. of the distinct values in sorted order."""
    classes = df.select(F.col(column).cast("string").alias(column)).distinct()
    code = f"{column}_code"
    ranked = global_row_number(classes.where(F.col(column).isNotNull()), [column], code)
    return ranked.select(column, (F.col(code) - 1).cast("int").alias(code))


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_code``; missing values get no code."""
    text = df.withColumn(column, F.col(column).cast("string"))
    salt_by = [name for name in KEYS if name in df.columns] or [column]
    return dimension_join(text, label_codes(df, column), [column], "left", salt_by)


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def numeric_feature_columns(
    df: DataFrame,
    targets: Sequence[str],
    excluded: Sequence[str] = ("id_student", "code_presentation"),
) -> list[str]:
    """Numeric columns outside keys, targets and exclusions.

    A ``*_enc`` column gives way to its ``*_encoded`` namesake.
    """
    hidden = {*excluded, *targets, "code_module", "code_presentation"}
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, (T.LongType, T.IntegerType, T.DoubleType))
        and field.name not in hidden
        and not (field.name.endswith("_enc") and f"{field.name}oded" in df.columns)
    ]
