"""Expectations on tables: each returns ``(check_name, violations)`` rows.

All row-level checks of one table share one aggregation. ``require`` turns
violations into an error; ``require_columns`` and the other column rules look at
the schema only and start no job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.contract import (
    BANNED_TOKENS,
    FEATURES,
    KEYS,
    NUMERIC_FEATURES,
    OUTCOMES,
    RESULT_ORDER,
    SENSITIVE,
    TARGETS,
)


class CheckError(ValueError):
    """A table breaks one of its expectations."""


def require_columns(df: DataFrame, columns: Iterable[str], source: str) -> None:
    missing = sorted(set(columns).difference(df.columns))
    if missing:
        raise CheckError(f"{source} lacks the columns {missing}")


def reject_banned_columns(
    df: DataFrame, source: str, tokens: Sequence[str] = BANNED_TOKENS
) -> None:
    banned = [name for name in df.columns if any(token in name.lower() for token in tokens)]
    if banned:
        raise CheckError(f"{source} must not contain the columns {banned}")


def check_contract_columns(df: DataFrame, source: str, allow_outcomes: bool = False) -> None:
    """Keys and features present, outcomes only where allowed, nothing else."""
    require_columns(df, (*KEYS, *FEATURES), source)
    allowed = {*KEYS, *FEATURES, *((*OUTCOMES, *SENSITIVE) if allow_outcomes else ())}
    other = [name for name in df.columns if name not in allowed]
    leaks = sorted(set(other).intersection(OUTCOMES))
    if leaks:
        raise CheckError(f"{source} would leak the outcomes {leaks}")
    if other:
        raise CheckError(f"{source} has columns outside the feature contract: {sorted(other)}")


def _violations(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Count the rows matching each condition, in one pass over ``df``."""
    counted = df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])
    return counted.unpivot([], list(conditions), "check_name", "violations")


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null values per required column."""
    return _violations(df, {name: F.col(name).isNull() for name in columns})


def duplicate_keys(df: DataFrame, keys: Sequence[str], check_name: str = "key") -> DataFrame:
    """Rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    extra = F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint")
    return per_key.agg(extra.alias("violations")).select(
        F.lit(check_name).alias("check_name"), "violations"
    )


def range_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each named rule; a rule is the condition of a violation."""
    return _violations(df, rules)


def _row_rules(required: Sequence[str], broken: Mapping[str, Column]) -> dict[str, Column]:
    return {f"missing_{name}": F.col(name).isNull() for name in required} | dict(broken)


def rules(df: DataFrame, required: Sequence[str], broken: Mapping[str, Column]) -> DataFrame:
    """Null counts of required columns and range rules together, in one pass."""
    return _violations(df, _row_rules(required, broken))


def observed_rules(
    df: DataFrame, required: Sequence[str], broken: Mapping[str, Column]
) -> tuple[DataFrame, Observation]:
    """``rules`` counted while another job reads the rows, without a pass of their own."""
    told = Observation()
    tests = _row_rules(required, broken)
    return df.observe(told, *[F.count_if(test).alias(name) for name, test in tests.items()]), told


def require_observed(
    told: Observation, df: DataFrame, required: Sequence[str], broken: Mapping[str, Column], source: str
) -> None:
    """Raise for observed violations; the job that reads the rows must have ended.

    Where nothing is left to read, Spark may drop the counting with the rest of the plan;
    the rules then take a pass of their own.
    """
    try:
        counts = told.get
    except Py4JError:
        require(rules(df, required, broken), source)
        return
    found = {name: count for name, count in counts.items() if count}
    if found:
        raise CheckError(f"{source} breaks {found}")


def keyed_rules(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    broken: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``rules`` and ``duplicate_keys`` together, in one aggregation by key."""
    tests = {f"missing_{name}": F.col(name).isNull() for name in required} | dict(broken or {})
    per_key = df.groupBy(*keys).agg(
        (F.count(F.lit(1)) - 1).alias("duplicate_keys"),
        *[F.count_if(test).alias(name) for name, test in tests.items()],
    )
    names = ["duplicate_keys", *tests]
    totals = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in names]
    )
    return totals.unpivot([], names, "check_name", "violations")


def negative(column: str) -> Column:
    return F.col(column) < 0


def not_positive(column: str) -> Column:
    return F.col(column) <= 0


def after_cutoff(column: str, cutoff_day: int) -> Column:
    return F.col(column) > cutoff_day


def result_domain(df: DataFrame, column: str = "final_result") -> DataFrame:
    """Missing results and results outside the four known values."""
    known = F.col(column).isin(*RESULT_ORDER)
    return _violations(df, {"missing": F.col(column).isNull(), "unexpected": ~known})


def all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """1 for each column without a single value."""
    counted = df.agg(
        *[F.when(F.count(name) == 0, 1).otherwise(0).cast("bigint").alias(name) for name in columns]
    )
    return counted.unpivot([], list(columns), "check_name", "violations")


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one of two tables holds."""
    mine = left.select(*keys, F.lit(True).alias("_left"))
    other = right.select(*keys, F.lit(True).alias("_right"))
    return _violations(
        mine.join(other, list(keys), "full_outer"),
        {"only_left": F.col("_right").isNull(), "only_right": F.col("_left").isNull()},
    )


def orphans(
    rows: DataFrame,
    parents: DataFrame,
    keys: Sequence[str] = KEYS,
    check_name: str = "activity_without_enrollment",
) -> DataFrame:
    """Distinct keys of ``rows`` that ``parents`` does not hold."""
    # One row per key, so no key is heavy in the join.
    lone = rows.select(*keys).distinct().join(parents.select(*keys), list(keys), "left_anti")
    return lone.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check_name).alias("check_name"), "violations"
    )


def classes_present(df: DataFrame, partition: str, label: str) -> DataFrame:
    """1 for each partition that does not hold both label values."""
    return df.groupBy(partition).agg(
        F.when(F.min(label) == F.max(label), 1).otherwise(0).cast("bigint").alias("violations")
    ).select(F.col(partition).alias("check_name"), "violations")


def require_all(checks: Mapping[str, Sequence[DataFrame]]) -> None:
    """Evaluate the checks of all sources in one job; raise for the first broken source."""
    labelled = [
        check.select(F.lit(source).alias("source"), "check_name", "violations")
        for source, found in checks.items()
        for check in found
    ]
    rows = reduce(DataFrame.unionByName, labelled).where(F.col("violations") > 0).collect()
    for source in checks:
        broken = {row["check_name"]: row["violations"] for row in rows if row["source"] == source}
        if broken:
            raise CheckError(f"{source} breaks {broken}")


def require(checks: DataFrame, source: str) -> None:
    """Raise with the names and counts of all broken checks."""
    require_all({source: [checks]})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns as doubles, unparsable text as null; numbers stay as they are.

    Not-a-number is a missing value, whether it comes as a number or as text.
    """
    numeric = {
        field.name for field in df.schema.fields if isinstance(field.dataType, T.NumericType)
    }
    parsed = {name: F.col(name).try_cast("double") for name in columns if name not in numeric}
    return nan_to_null(df.withColumns(parsed), columns)


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Floating-point not-a-number as null, in all columns or the given ones.

    Comparisons place it above every number, so a filter by day would drop it unseen.
    """
    wanted = set(df.columns if columns is None else columns)
    return df.withColumns(
        {
            name: F.when(~F.isnan(name), F.col(name))
            for name, kind in df.dtypes
            if kind in ("double", "float") and name in wanted
        }
    )


def contract_features(df: DataFrame, source: str, allow_outcomes: bool = False) -> DataFrame:
    """The keys and the eleven contract features after all contract checks."""
    check_contract_columns(df, source, allow_outcomes)
    features = coerce_numeric(df.select(*KEYS, *FEATURES), NUMERIC_FEATURES)
    checks = duplicate_keys(df, KEYS, "duplicate_keys").unionByName(
        all_null(features, NUMERIC_FEATURES)
    )
    require(checks, source)
    return features


def validate_mart(df: DataFrame, source: str = "training mart") -> None:
    """Keys and targets present, one row per key, no banned column."""
    require_columns(df, (*KEYS, *TARGETS), source)
    reject_banned_columns(df, source)
    require(duplicate_keys(df, KEYS, "duplicate_keys"), source)
