"""Fold-safe preparation: imputation, one-hot and scaling fitted on training rows only.

All training sets of a cross-validation (each leaves one fold out, one keeps all
rows) are fitted together from counts per fold, so the rows are read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from math import sqrt

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from cohortlens.operators.ranking import running_totals

ALL_ROWS = -1
# Most values a category may have: each is a column of the encoded features.
MOST_LEVELS = 10_000


def check_width(counts: DataFrame, what: str, most: int = MOST_LEVELS) -> None:
    """Refuse a field with more values than an encoding or a record can hold.

    ``counts`` has one row per field, its number of values in ``count``.
    """
    wide = counts.where(F.col("count") > most).limit(1).collect()
    if wide:
        raise ValueError(f"{what}: {wide[0].asDict()} has more than {most} values")


@dataclass(frozen=True)
class Preparation:
    """Fitted statistics as plain values; ``transform`` applies them as expressions."""

    medians: Mapping[str, float]
    centers: Mapping[str, float]
    scales: Mapping[str, float]
    modes: Mapping[str, str]
    categories: Mapping[str, Sequence[str]]

    def feature_names(self) -> list[str]:
        names = [f"{name}_{level}" for name in CATEGORICAL_FEATURES for level in self.categories[name]]
        return [*names, *NUMERIC_FEATURES]

    def category(self, name: str) -> Column:
        """The category, gaps filled with the most frequent one."""
        return F.coalesce(F.col(name).cast("string"), F.lit(self.modes[name]))

    def filled(self, name: str) -> Column:
        """The number, gaps filled with the median."""
        return F.coalesce(F.col(name).cast("double"), F.lit(self.medians[name]))

    def number(self, name: str) -> Column:
        """The filled number, centred and scaled."""
        value = self.filled(name) - F.lit(self.centers[name])
        return value / F.lit(self.scales[name]) if self.scales[name] else value

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the ``features`` vector; an unseen category is all zeros."""
        inputs = {}
        for name in CATEGORICAL_FEATURES:
            value = self.category(name)
            for place, level in enumerate(self.categories[name]):
                inputs[f"_{name}_{place}"] = (value == F.lit(level)).cast("double")
        for name in NUMERIC_FEATURES:
            inputs[f"_{name}"] = self.number(name)
        wide = df.withColumns(inputs)
        assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
        return assembler.transform(wide).drop(*inputs)

    def as_dict(self) -> dict:
        return asdict(self)


def _value_counts(df: DataFrame, columns: Sequence[str], kind: str, folds: int) -> DataFrame:
    """Per feature and value: rows in all, and in each fold."""
    long = df.select(
        "fold", *[F.col(name).cast(kind).alias(name) for name in columns]
    ).unpivot(["fold"], list(columns), "feature", "value")
    return long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias(f"n_{ALL_ROWS}"),
        *[F.count_if(F.col("fold") == number).alias(f"n_{number}") for number in range(folds)],
    )


def _of_set(name: str, number: int) -> Column:
    """A count of a training set: all rows, less the fold that is left out."""
    whole = F.col(f"{name}_{ALL_ROWS}")
    return whole if number == ALL_ROWS else whole - F.col(f"{name}_{number}")


def _numeric_statistics(df: DataFrame, folds: int) -> dict[int, dict[str, tuple[float, ...]]]:
    """Per set and feature the median, and mean and population deviation after filling gaps
    with the median.

    Values are ordered once for all sets. Sums are taken of distances from the overall mean,
    so that large values keep their digits.
    """
    sets = (ALL_ROWS, *range(folds))
    near = df.agg(*[F.avg(F.col(name).cast("double")).alias(name) for name in NUMERIC_FEATURES]).first()
    counts = _value_counts(df, NUMERIC_FEATURES, "double", folds)
    held = F.col("value").isNotNull()
    ranked = counts.select("*", *[F.when(held, F.col(f"n_{number}")).otherwise(0).alias(f"r_{number}") for number in sets])
    ordered = running_totals(ranked, ["feature"], ["value"], [f"r_{number}" for number in sets])
    means = F.create_map(*[F.lit(x) for name in NUMERIC_FEATURES for x in (name, float(near[name] or 0.0))])
    distance = F.col("value") - F.try_element_at(means, F.col("feature"))
    sums = []
    for number in sets:
        before, total = (
            F.col(f"r_{ALL_ROWS}_{end}") - (F.lit(0) if number == ALL_ROWS else F.col(f"r_{number}_{end}"))
            for end in ("before", "total")
        )
        rows, rank = _of_set("n", number), _of_set("r", number)
        for end, middle in (("low", F.floor((total - 1) / 2)), ("high", F.ceil((total - 1) / 2))):
            covers = (before <= middle) & (middle < before + rank)
            sums.append(F.max(F.when(covers, F.col("value"))).alias(f"{end}_{number}"))
        sums += [
            F.sum(rows).alias(f"rows_{number}"),
            F.sum(rows - rank).alias(f"gaps_{number}"),
            F.sum(rank * distance).alias(f"first_{number}"),
            F.sum(rank * distance * distance).alias(f"second_{number}"),
        ]
    found: dict[int, dict[str, tuple[float, ...]]] = {number: {} for number in sets}
    for row in ordered.groupBy("feature").agg(*sums).collect():
        name = row["feature"]
        mean = float(near[name] or 0.0)
        for number in sets:
            low, high = row[f"low_{number}"], row[f"high_{number}"]
            if low is None:
                found[number][name] = (None, None, None)
                continue
            median = low + (high - low) / 2
            rows, gaps = row[f"rows_{number}"], row[f"gaps_{number}"]
            first = ((row[f"first_{number}"] or 0.0) + gaps * (median - mean)) / rows
            second = ((row[f"second_{number}"] or 0.0) + gaps * (median - mean) ** 2) / rows
            spread = second - first * first
            # What rounding leaves of equal values is no deviation.
            scale = sqrt(spread) if spread > 1e-14 * second else 0.0
            found[number][name] = (median, mean + first, scale)
    return found


def _category_statistics(df: DataFrame, folds: int) -> dict[int, dict[str, tuple[str, list[str]]]]:
    """Per set and feature the most frequent value (smallest on ties) and sorted categories."""
    counts = _value_counts(df, CATEGORICAL_FEATURES, "string", folds).where(F.col("value").isNotNull())
    check_width(counts.groupBy("feature").count(), "categories")
    rows = counts.collect()
    found: dict[int, dict[str, tuple[str, list[str]]]] = {}
    for number in (ALL_ROWS, *range(folds)):
        found[number] = {}
        for name in CATEGORICAL_FEATURES:
            held = {
                row["value"]: row[f"n_{ALL_ROWS}"] - (0 if number == ALL_ROWS else row[f"n_{number}"])
                for row in rows
                if row["feature"] == name
            }
            held = {value: n for value, n in held.items() if n}
            if held:
                mode = min(held, key=lambda value: (-held[value], value))
                found[number][name] = (mode, sorted(held))
    return found


def fit_preparations(df: DataFrame, folds: int) -> dict[int, Preparation]:
    """One preparation per left-out fold, and one for all rows under ``ALL_ROWS``."""
    numeric = _numeric_statistics(df, folds)
    category = _category_statistics(df, folds)
    return {
        number: Preparation(
            medians={name: median for name, (median, _, _) in numeric[number].items()},
            centers={name: center for name, (_, center, _) in numeric[number].items()},
            scales={name: scale for name, (_, _, scale) in numeric[number].items()},
            modes={name: mode for name, (mode, _) in category[number].items()},
            categories={name: levels for name, (_, levels) in category[number].items()},
        )
        for number in (ALL_ROWS, *range(folds))
    }
