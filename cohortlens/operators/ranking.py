"""Global ranks, running totals and exact percentiles without a single-task window.

A window ordered over the whole table sends every row to one task. Here rows are
range-partitioned by the order, the placement is written once, and the rows (or
sums) of earlier partitions are added as an offset.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.session import materialize, shuffle_width

# monotonically_increasing_id keeps the partition number above these bits.
POSITION_BITS = 33


def global_row_number(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "row_number"
) -> DataFrame:
    """Number all rows 1..n in ``order_by``, and add n as ``<name>_total``.

    ``order_by`` must order every pair of rows.
    """
    placed = materialize(
        df.repartitionByRange(shuffle_width(df.sparkSession), *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(
            *df.columns,
            F.shiftright("_id", POSITION_BITS).alias("_part"),
            F.col("_id").bitwiseAND((1 << POSITION_BITS) - 1).alias("_place"),
        )
    )
    # One row per range partition: the offsets are as few as the partitions.
    every = W.partitionBy(F.lit(0))
    earlier = every.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(every).alias(f"{name}_total"),
        )
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_place") + 1).alias(name), f"{name}_total"
    )


def equal_frequency_bin(rank: Column, rows: Column, bins: int | Column) -> Column:
    """Bin 1..q of rank 1..n when q equal-frequency edges are laid over the ranks."""
    bins = F.lit(bins) if isinstance(bins, int) else bins
    steps = F.greatest(rows - 1, F.lit(1))
    return F.greatest(
        F.lit(1), F.floor(((rank - 1) * bins + steps - 1) / steps).cast("int")
    )


def equal_frequency_size(bin_no: Column, rows: Column, bins: Column) -> Column:
    """How many of n ranks fall in bin ``bin_no`` of ``bins``."""
    upper = F.floor(bin_no * (rows - 1) / bins)
    lower = F.floor((bin_no - 1) * (rows - 1) / bins)
    return (upper - lower + F.when(bin_no == 1, 1).otherwise(0)).cast("bigint")


def running_totals(
    df: DataFrame, by: Sequence[str], order_by: Sequence[str | Column], sums: Sequence[str]
) -> DataFrame:
    """Add ``<sum>_before``, the group's total over the rows that come earlier, and
    ``<sum>_total`` over all its rows.

    ``by`` values must not be null, and ``by`` plus ``order_by`` must be unique.
    """
    placed = materialize(
        df.repartitionByRange(shuffle_width(df.sparkSession), *by, *order_by).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    keys = [*by, "_part"]
    group = W.partitionBy(*(by or [F.lit(0)]))
    earlier_parts = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per group and range partition.
    per_part = placed.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums])
    offsets = per_part.select(
        *keys,
        *[
            F.coalesce(F.sum(name).over(earlier_parts), F.lit(0)).alias(f"_{name}_parts")
            for name in sums
        ],
        *[F.sum(name).over(group).alias(f"{name}_total") for name in sums],
    )
    earlier_rows = W.partitionBy(*keys).orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    inside = placed.select(
        "*",
        *[
            F.coalesce(F.sum(name).over(earlier_rows), F.lit(0)).alias(f"_{name}_rows")
            for name in sums
        ],
    )
    return inside.join(offsets, keys).select(
        *df.columns,
        *[(F.col(f"_{name}_rows") + F.col(f"_{name}_parts")).alias(f"{name}_before") for name in sums],
        *[f"{name}_total" for name in sums],
    )


def value_distribution(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per group and distinct value: its rows ``n``, the ``rank_before`` rows with
    smaller values, and the group's ``rank_total`` and ``weight_total`` (sum of values).

    Null values keep their row (``n`` counts them) but take no rank.
    """
    held = F.col(value).isNotNull()
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    weighted = counts.select(
        "*",
        F.when(held, F.col("n")).otherwise(0).alias("rank"),
        F.when(held, F.col("n") * F.col(value).cast("double")).otherwise(0.0).alias("weight"),
    )
    return running_totals(weighted, by, [value], ["rank", "weight"]).drop("weight", "weight_before")


def percentile_columns(
    value: str, probabilities: Mapping[str, float]
) -> tuple[list[Column], list[Column]]:
    """Aggregates and the result columns on top of them, for linear interpolation."""
    held = F.col(value).cast("double")
    start, total = F.col("rank_before"), F.col("rank_total")
    picks, results = [], []
    for name, share in probabilities.items():
        position = F.lit(float(share)) * (total - 1)
        for end, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            covers = (start <= rank) & (rank < start + F.col("rank"))
            picks.append(F.max(F.when(covers, held)).alias(f"_{name}_{end}"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picks, results


def distribution_percentiles(
    distribution: DataFrame, by: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Exact linearly interpolated percentiles per group of a value distribution.

    Groups without any value give null percentiles.
    """
    picks, results = percentile_columns(value, probabilities)
    return distribution.groupBy(*by, "rank_total").agg(*picks).select(*by, *results)


def exact_percentiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    return distribution_percentiles(value_distribution(df, by, value), by, value, probabilities)


def distribution_summary(
    distribution: DataFrame, by: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Count, missing, mean, sample deviation, extremes and percentiles per group, in one pass."""
    held = F.col(value).cast("double")
    count = F.col("rank_total")
    picks, percentiles = percentile_columns(value, probabilities)
    totals = (
        distribution.withColumn("mean", F.col("weight_total") / F.nullif(count, F.lit(0)))
        .groupBy(*by, "rank_total", "mean")
        .agg(
            F.sum(F.col("n") - F.col("rank")).alias("missing"),
            F.sum(F.col("rank") * F.pow(held - F.col("mean"), 2)).alias("_squares"),
            F.min(held).alias("min"),
            F.max(held).alias("max"),
            *picks,
        )
    )
    deviation = F.sqrt(F.col("_squares") / F.when(count > 1, count - 1))
    return totals.select(
        *by, count.alias("count"), "missing", "mean", deviation.alias("std"), "min", "max", *percentiles
    )
