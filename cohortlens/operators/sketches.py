"""Percentiles and distinct counts from mergeable sketches, where an error is accepted.

The exact operators stay the default. A sketch is a small binary column: tables keep one per
group (a presentation, a day), and any union of groups is answered from the sketches without
reading the rows again. Sketches are made on the map side, so no value is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch, and the logarithm of the registers of a distinct-count sketch.
QUANTILE_SIZE, REGISTERS_LOG = 800, 14


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far a percentile's rank may be from the one asked for, as a share of the rows.

    Twice the error that the sketch keeps in 99 of 100 cases.
    """
    return 2 * 2.296 / size**0.9021


def distinct_error(registers_log: int = REGISTERS_LOG) -> float:
    """How far a distinct count may be off, as a share of it: four standard errors."""
    return 4 * 1.04 / sqrt(2**registers_log)


# --- percentiles ----------------------------------------------------------------------


def value_sketches(
    df: DataFrame, by: Sequence[str], value: str, size: int = QUANTILE_SIZE
) -> DataFrame:
    """Per group: ``count``, ``missing``, ``mean``, ``squares`` (squared distances from the
    mean), ``min``, ``max`` and the quantile ``sketch`` of a column."""
    held = F.col(value).cast("double")
    count = F.count(held)
    return df.groupBy(*by).agg(
        count.alias("count"),
        F.count_if(held.isNull()).alias("missing"),
        F.avg(held).alias("mean"),
        (F.var_pop(held) * count).alias("squares"),
        F.min(held).alias("min"),
        F.max(held).alias("max"),
        F.kll_sketch_agg_double(held, F.lit(size)).alias("sketch"),
    )


def united_values(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Groups of ``value_sketches`` united to coarser ones, without the rows."""
    count = F.sum("count")
    mean = F.sum(F.col("count") * F.coalesce("mean", F.lit(0.0))) / F.nullif(count, F.lit(0))
    # Means of parts are measured from one of them, so that large ones keep their digits.
    near = F.coalesce(F.col("mean"), F.col("_near"))
    shifted = F.sum(F.col("count") * (near - F.col("_near")))
    spread = F.sum(F.col("count") * F.pow(near - F.col("_near"), 2))
    within = F.coalesce(F.sum("squares"), F.lit(0.0))
    nearby = sketches.groupBy(*by).agg(F.coalesce(F.max("mean"), F.lit(0.0)).alias("_near"))
    joined = sketches.join(nearby, list(by)) if by else sketches.withColumn("_near", nearby.scalar())
    return joined.groupBy(*by).agg(
        count.alias("count"),
        F.sum("missing").alias("missing"),
        mean.alias("mean"),
        F.when(count > 0, within + spread - shifted * shifted / count).alias("squares"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def _quantile(share: float) -> Column:
    found = F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(float(share)))
    # An empty sketch has no quantile to ask for.
    return F.when(F.col("count") > 0, found)


def sketched_percentiles(
    sketches: DataFrame, by: Sequence[str], probabilities: Mapping[str, float]
) -> DataFrame:
    """Values whose ranks are within ``rank_error`` of the probabilities, per group."""
    return sketches.select(
        *by, *[_quantile(share).alias(name) for name, share in probabilities.items()]
    )


def sketched_summary(
    sketches: DataFrame, by: Sequence[str], probabilities: Mapping[str, float]
) -> DataFrame:
    """Count, missing, mean, sample deviation, extremes and percentiles per group."""
    return sketches.select(
        *by,
        "count",
        "missing",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"),
        "min",
        "max",
        *[_quantile(share).alias(name) for name, share in probabilities.items()],
    )


# --- distinct counts -------------------------------------------------------------------


def distinct_sketches(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], registers_log: int = REGISTERS_LOG
) -> DataFrame:
    """Per group one distinct-count sketch for each column, under its name."""
    # Keys of all kinds are hashed alike, so that sketches of one column always unite.
    return df.groupBy(*by).agg(
        *[F.hll_sketch_agg(F.col(name).cast("string"), F.lit(registers_log)).alias(name) for name in columns]
    )


def united_distinct(
    sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Groups of ``distinct_sketches`` united to coarser ones, without the rows."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(name).alias(name) for name in columns])


def distinct_counts(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The estimated distinct values of each sketched column."""
    return sketches.select(*by, *[F.hll_sketch_estimate(name).alias(name) for name in columns])


def approximate_distinct(column: str, registers_log: int = REGISTERS_LOG) -> Column:
    """An aggregate that stands in for an exact distinct count."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(registers_log)))
