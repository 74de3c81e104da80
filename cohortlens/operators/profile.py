"""Descriptive tables over the mart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.contract import (
    CATEGORY_ORDERS,
    COURSE_KEYS,
    DESCRIPTIVE_ONLY,
    ENGAGEMENT,
    KEYS,
    MISSING_LABEL,
    NEAR_DUPLICATE,
    NON_RISK_LABEL,
    RESULT_ORDER,
    RISK_LABEL,
    ROLES,
    SCORE,
    SPARSE_GROUP,
    WHISKER,
)
from cohortlens.functions.expressions import academic_risk
from cohortlens.operators import sketches
from cohortlens.operators.joins import dimension_join
from cohortlens.operators.ranking import (
    distribution_percentiles,
    distribution_summary,
    equal_frequency_bin,
    global_row_number,
    running_totals,
    value_distribution,
)
from cohortlens.session import materialize

PROFILE_COLUMNS = ("code_module", "code_presentation", "gender", "age_band", "imd_band")
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
CLICK_BINS = 40


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _share(counts: DataFrame, *by: str) -> DataFrame:
    """Add each category's part of its column; ``counts`` has one row per category."""
    total = F.sum("count").over(W.partitionBy(*(by or [F.lit(0)])))
    return counts.withColumn("share", F.col("count") / total)


def cohort_snapshot(mart: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, columns and distinct keys; ``approximate`` counts distinct keys by sketches, within
    ``sketches.distinct_error``."""
    distinct = sketches.approximate_distinct if approximate else F.countDistinct
    names = ("enrollment_rows", "columns", "unique_students", "courses", "presentations",
             "candidate_features")
    counted = mart.agg(
        F.count(F.lit(1)).alias(names[0]),
        F.lit(len(mart.columns)).cast("bigint").alias(names[1]),
        distinct("id_student").alias(names[2]),
        distinct("code_module").alias(names[3]),
        distinct("code_presentation").alias(names[4]),
        F.lit(len(ROLES.candidates(mart.schema))).cast("bigint").alias(names[5]),
    )
    return counted.unpivot([], list(names), "metric", "value")


def data_quality(mart: DataFrame) -> DataFrame:
    """Three counted facts; ``failed`` is fixed per check, as downstream readers expect."""
    per_key = mart.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("rows"), _count(F.col(ENGAGEMENT) == 0).alias("idle")
    )
    names = ("required_columns_present", "duplicate_enrollment_keys", "zero_vle_engagement")
    counted = per_key.agg(
        F.lit(0).cast("bigint").alias(names[0]),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint").alias(names[1]),
        F.coalesce(F.sum("idle"), F.lit(0)).alias(names[2]),
    )
    return counted.unpivot([], list(names), "check", "count").select(
        "check", (F.col("check") == names[0]).alias("failed"), "count"
    )


def _display(mart: DataFrame, column: str) -> Column:
    """A category as text; booleans as True and False."""
    value = F.col(column)
    if isinstance(mart.schema[column].dataType, T.BooleanType):
        return F.initcap(value.cast("string"))
    return value.cast("string")


def _category_counts(
    mart: DataFrame, columns: Sequence[str], labelled: Sequence[str], name: str
) -> DataFrame:
    """Rows and share per column and category, all columns in one shuffle."""
    text = mart.select(
        *[
            (
                F.coalesce(_display(mart, column), F.lit(MISSING_LABEL))
                if column in labelled
                else F.coalesce(_display(mart, column), F.lit("nan"))
            ).alias(column)
            for column in columns
        ]
    )
    counts = (
        text.unpivot([], list(columns), name, "category")
        .groupBy(name, "category")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _share(counts, name)


def categorical_profile(mart: DataFrame) -> DataFrame:
    columns = [name for name in PROFILE_COLUMNS if name in mart.columns]
    return _category_counts(mart, columns, ("imd_band",), "column")


def categorical_candidates(mart: DataFrame) -> DataFrame:
    columns = ROLES.categorical_candidates(mart.schema)
    return _category_counts(mart, columns, columns, "feature")


def _long(mart: DataFrame, columns: Sequence[str]) -> DataFrame:
    return mart.select(*[F.col(name).cast("double").alias(name) for name in columns]).unpivot(
        [], list(columns), "feature", "value"
    )


def numeric_distribution(mart: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns in long form, nulls included."""
    return value_distribution(_long(mart, columns), ["feature"], "value")


def numeric_profile(mart: DataFrame, approximate: bool = False) -> DataFrame:
    """Count, missing, mean, median, std, min, quartiles and max per numeric candidate.

    ``approximate`` takes the quartiles from sketches, within ``sketches.rank_error``.
    """
    columns = ROLES.numeric_candidates(mart.schema)
    if approximate:
        found = sketches.value_sketches(_long(mart, columns), ["feature"], "value")
        summary = sketches.sketched_summary(found, ["feature"], QUARTILES)
    else:
        summary = distribution_summary(
            numeric_distribution(mart, columns), ["feature"], "value", QUARTILES
        )
    return summary.select(
        "feature", "count", F.col("missing").alias("missing_count"), "mean", "median", "std", "min",
        "q1", "q3", "max",
    )


def missingness(mart: DataFrame) -> DataFrame:
    """Missing rows, share and available rows of every column."""
    counted = mart.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_count(F.col(name).isNull()).alias(name) for name in mart.columns],
    )
    long = counted.unpivot(["_rows"], mart.columns, "column", "missing_count")
    return long.select(
        "column",
        "missing_count",
        (F.col("missing_count") / F.col("_rows")).alias("missing_share"),
        (F.col("_rows") - F.col("missing_count")).alias("available_count"),
    ).orderBy(F.col("missing_count").desc(), F.col("column").asc())


def _histogram(counts: DataFrame, bins: Column) -> DataFrame:
    """Equal-width bins per feature of value counts; bins without rows are kept.

    A feature with one value is laid over [value - 0.5, value + 0.5].
    """
    zero = F.when(F.col("value") == 0, F.col("n")).otherwise(0)
    edges = counts.groupBy("feature").agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.sum("n").alias("_rows"),
        F.sum(zero).alias("zero_count"),
    )
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        "feature",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        bins.cast("int").alias("bins"),
        "zero_count",
    )
    step = F.floor((F.col("value") - F.col("lo")) * F.col("bins") / (F.col("hi") - F.col("lo")))
    filled = (
        dimension_join(counts, edges, ["feature"], salt_by=["value"])
        .groupBy("feature", F.least(step, F.col("bins") - 1).cast("int").alias("bin"))
        .agg(F.sum("n").alias("count"))
    )
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    return frame.join(filled, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
        "zero_count",
    )


def _value_counts(mart: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per feature and value, written once for the edges and the bins."""
    long = mart.select(*[F.col(name).cast("double").alias(name) for name in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    return materialize(
        long.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def click_histogram(mart: DataFrame, bins: int = CLICK_BINS) -> DataFrame:
    counts = _value_counts(mart, [ENGAGEMENT])
    return _histogram(counts, F.lit(bins)).drop("feature", "zero_count")


def feature_histograms(mart: DataFrame) -> DataFrame:
    """One histogram per numeric candidate, with the feature's zero count."""
    counts = _value_counts(mart, ROLES.numeric_candidates(mart.schema))
    return _histogram(counts, F.least(F.lit(40), F.greatest(F.lit(5), F.floor(F.sqrt("_rows")))))


def _value_rows(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Value counts without ranks, in the form of a value distribution."""
    rank = F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0)
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n")).withColumn("rank", rank)


def _box(df: DataFrame, by: Sequence[str], value: str, approximate: bool) -> DataFrame:
    """``box_summary`` of rows, with exact quartiles or those of sketches."""
    if not approximate:
        return box_summary(value_distribution(df, by, value), by, value)
    found = sketches.value_sketches(df, by, value)
    return box_summary(
        _value_rows(df, by, value), by, value, sketches.sketched_percentiles(found, by, QUARTILES)
    )


def box_summary(
    distribution: DataFrame, by: Sequence[str], value: str, quartiles: DataFrame | None = None
) -> DataFrame:
    """Quartiles, extremes and whiskers per group of a value distribution.

    ``quartiles`` are computed from the distribution's ranks where none are given.
    """
    if quartiles is None:
        quartiles = distribution_percentiles(distribution, by, value, QUARTILES)
    quartiles = quartiles.withColumn("iqr", F.col("q3") - F.col("q1"))
    held = F.col(value).cast("double")
    low = F.col("q1") - WHISKER * F.col("iqr")
    high = F.col("q3") + WHISKER * F.col("iqr")
    return (
        dimension_join(distribution, quartiles, by, salt_by=[value])
        .groupBy(*by, "median", "q1", "q3", "iqr")
        .agg(
            F.sum("rank").alias("count"),
            F.sum(F.col("n") - F.col("rank")).alias("missing"),
            F.min(held).alias("min"),
            F.max(held).alias("max"),
            F.min(F.when(held >= low, held)).alias("lower_whisker"),
            F.max(F.when(held <= high, held)).alias("upper_whisker"),
        )
    )


def _position(column: Column, order: Sequence[str]) -> Column:
    place = F.array_position(F.array(*[F.lit(level) for level in order]), column)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def clicks_boxplot_by_result(mart: DataFrame, approximate: bool = False) -> DataFrame:
    rows = mart.where(F.col("final_result").isin(*RESULT_ORDER))
    return (
        _box(rows, ["final_result"], ENGAGEMENT, approximate)
        .select("final_result", "count", "median", "q1", "q3", "iqr", "min", "max",
                "lower_whisker", "upper_whisker")
        .orderBy(_position(F.col("final_result"), RESULT_ORDER))
    )


def score_boxplot_by_group(mart: DataFrame, approximate: bool = False) -> DataFrame:
    """Observed and missing scores per category of each descriptive column."""
    by = ["characteristic", "category"]
    long = mart.select(
        SCORE,
        *[
            F.coalesce(_display(mart, name), F.lit(MISSING_LABEL)).alias(name)
            for name in DESCRIPTIVE_ONLY
        ],
    ).unpivot([SCORE], list(DESCRIPTIVE_ONLY), *by)
    summary = _box(long, by, SCORE, approximate)
    place = F.lit(0)
    for name, order in CATEGORY_ORDERS.items():
        place = F.when(
            F.col("characteristic") == name, _position(F.col("category"), order)
        ).otherwise(place)
    return summary.select(
        *by,
        F.col("count").alias("observed_score_count"),
        F.col("missing").alias("missing_score_count"),
        "median", "q1", "q3", "iqr", "min", "max", "lower_whisker", "upper_whisker",
    ).orderBy(_position(F.col("characteristic"), DESCRIPTIVE_ONLY), place, "category")


def result_distribution(mart: DataFrame) -> DataFrame:
    counts = mart.groupBy("final_result").agg(F.count(F.lit(1)).alias("count"))
    return _share(counts).withColumnRenamed("count", "n_total")


def risk_distribution(mart: DataFrame) -> DataFrame:
    # A missing result is not a risk result.
    risk = F.coalesce(academic_risk(F.col("final_result")), F.lit(0))
    label = F.when(risk == 1, RISK_LABEL).otherwise(NON_RISK_LABEL)
    counts = mart.groupBy(label.alias("academic_risk")).agg(F.count(F.lit(1)).alias("count"))
    return _share(counts).withColumnRenamed("count", "n_total")


def target_share(mart: DataFrame) -> DataFrame:
    """Share of each ``academic_risk`` value; a missing result counts as 0."""
    risk = F.coalesce(academic_risk(F.col("final_result")), F.lit(0)).alias("academic_risk")
    counts = mart.groupBy(risk).agg(F.count(F.lit(1)).alias("count"))
    return _share(counts).drop("count")


def engagement_quartiles(mart: DataFrame) -> DataFrame:
    """Each enrollment's quartile by clicks; equal clicks are ordered by key."""
    columns = [*KEYS, ENGAGEMENT, "final_result"]
    rows = mart.select(*columns).where(F.col(ENGAGEMENT).isNotNull())
    ranked = global_row_number(rows, [ENGAGEMENT, *KEYS], "place")
    quartile = equal_frequency_bin(F.col("place"), F.col("place_total"), 4)
    return ranked.select(
        *columns, F.concat(F.lit("Q"), quartile.cast("string")).alias("engagement_quantile")
    )


def _risk_rate(df: DataFrame, *by: str) -> DataFrame:
    risk = F.coalesce(academic_risk(F.col("final_result")), F.lit(0))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"), F.sum(risk).alias("n_academic_risk")
    ).withColumn("academic_risk_rate", F.col("n_academic_risk") / F.col("n_total"))


def risk_by_engagement_quartile(mart: DataFrame) -> DataFrame:
    """Rows and risk per quartile by clicks; equal clicks are ordered by key.

    A click count whose rows all fall into one quartile needs no order of rows. At most
    three counts straddle an edge; only their rows are numbered.
    """
    risk = F.coalesce(academic_risk(F.col("final_result")), F.lit(0))
    rows = materialize(
        mart.where(F.col(ENGAGEMENT).isNotNull()).select(
            *KEYS, F.col(ENGAGEMENT).alias("_clicks"), risk.alias("_risk")
        )
    )
    counts = rows.groupBy("_clicks").agg(F.count(F.lit(1)).alias("n"), F.sum("_risk").alias("_risk"))
    totals = running_totals(counts, [], ["_clicks"], ["n"])
    low = equal_frequency_bin(F.col("n_before") + 1, F.col("n_total"), 4)
    high = equal_frequency_bin(F.col("n_before") + F.col("n"), F.col("n_total"), 4)
    placed = materialize(totals.withColumns({"_low": low, "_high": high}))
    whole = placed.where(F.col("_low") == F.col("_high")).select(
        F.col("_low").alias("_quartile"), "n", "_risk"
    )
    # At most three rows: one per inner edge of the quartiles.
    edges = placed.where(F.col("_low") != F.col("_high")).select("_clicks", "n_before", "n_total")
    tied = global_row_number(rows.join(edges.select("_clicks"), "_clicks", "left_semi"), ["_clicks", *KEYS], "_all")
    first = tied.groupBy("_clicks").agg(F.min("_all").alias("_first"))
    rank = F.col("n_before") + F.col("_all") - F.col("_first") + 1
    split = (
        tied.join(edges.join(first, "_clicks"), "_clicks")
        .groupBy(equal_frequency_bin(rank, F.col("n_total"), 4).alias("_quartile"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_risk").alias("_risk"))
    )
    summed = whole.unionByName(split).groupBy("_quartile").agg(
        F.sum("n").alias("n_total"), F.sum("_risk").alias("n_academic_risk")
    )
    return summed.select(
        F.concat(F.lit("Q"), F.col("_quartile").cast("string")).alias("engagement_quantile"),
        "n_total",
        "n_academic_risk",
        (F.col("n_academic_risk") / F.col("n_total")).alias("academic_risk_rate"),
    )


def risk_by_course(mart: DataFrame) -> DataFrame:
    """Risk rate per course and presentation, hidden for small groups."""
    small = F.col("n_total") < SPARSE_GROUP
    return _risk_rate(mart, *COURSE_KEYS).select(
        F.concat_ws(" ", *COURSE_KEYS).alias("label"),
        *COURSE_KEYS,
        "n_total",
        "n_academic_risk",
        F.when(~small, F.col("academic_risk_rate")).alias("academic_risk_rate"),
        small.alias("suppressed"),
    )


def score_missing_by_result(mart: DataFrame) -> DataFrame:
    return mart.groupBy("final_result").agg(
        F.count(F.lit(1)).alias("n_total"),
        _count(F.col(SCORE).isNull()).alias("n_score_missing"),
    ).withColumn("score_missing_rate", F.col("n_score_missing") / F.col("n_total"))


PAIR_SCHEMA = "feature_a string, feature_b string, spearman_correlation double"


def spearman_pairs(mart: DataFrame) -> DataFrame:
    """Spearman correlation of each pair of numeric candidates.

    Ranks are taken over the rows where both columns have a value. Columns whose
    missing rows are the same, none as a rule, rank alike in all their pairs: each is
    ranked once, from the counts of its values, and one aggregate sums all products of
    ranks. Only the other pairs are ranked on their own. A constant column gives a
    null correlation.
    """
    features = ROLES.numeric_candidates(mart.schema)
    mart = materialize(mart.select(*[F.col(name).cast("double").alias(name) for name in features]))
    groups = _alike(mart, features)
    names = list(combinations(features, 2))
    apart = [pair for pair in names if not any({*pair} <= group for group in groups)]
    found = [_ranked_once(mart, sorted(group)) for group in groups if len(group) > 1]
    if apart:
        found.append(_ranked_apart(mart, apart))
    if not found:
        return mart.sparkSession.createDataFrame([], PAIR_SCHEMA)
    order = {name: place for place, name in enumerate(features)}
    places = F.create_map(*[F.lit(item) for pair in order.items() for item in pair])
    swapped = places[F.col("feature_a")] > places[F.col("feature_b")]
    return reduce(DataFrame.unionByName, found).select(
        F.when(swapped, F.col("feature_b")).otherwise(F.col("feature_a")).alias("feature_a"),
        F.when(swapped, F.col("feature_a")).otherwise(F.col("feature_b")).alias("feature_b"),
        "spearman_correlation",
    )


def _alike(mart: DataFrame, features: list[str]) -> list[set[str]]:
    """Columns by the rows in which they are missing, told by count and a hash sum."""
    row = F.xxhash64(*features).cast("decimal(38,0)")
    told = mart.agg(
        *[
            F.struct(_count(F.col(name).isNull()), F.sum(F.when(F.col(name).isNull(), row))).alias(name)
            for name in features
        ]
    ).first()
    groups: dict[tuple, set[str]] = {}
    for name in features:
        groups.setdefault(tuple(told[name]) if told else (), set()).add(name)
    return list(groups.values())


def _ranked_once(mart: DataFrame, features: list[str]) -> DataFrame:
    """Correlations of columns that are missing in the same rows."""
    held = mart.select(*features).where(F.col(features[0]).isNotNull())
    counts = (
        held.unpivot([], features, "feature", "value")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Average rank of tied values, relative to the mean rank (rows + 1) / 2.
    rank = F.col("n_before") + (F.col("n") + 1) / 2 - (F.col("n_total") + 1) / 2
    ranks = materialize(
        running_totals(counts, ["feature"], ["value"], ["n"]).select(
            "feature", "value", rank.alias("rank")
        )
    )
    for name in features:
        own = ranks.where(F.col("feature") == name).select(
            F.col("value").alias(name), F.col("rank").alias(f"_{name}")
        )
        others = [other for other in held.columns if other != name]
        held = dimension_join(held, own, [name], salt_by=others[:3] or [name]).drop(name)
    products = {
        (left, right): F.sum(F.col(f"_{left}") * F.col(f"_{right}"))
        for place, left in enumerate(features)
        for right in features[place:]
    }
    sums = held.agg(
        *[total.alias(f"{left}*{right}") for (left, right), total in products.items()]
    )

    def of(left: str, right: str) -> Column:
        return F.col(f"`{left}*{right}`")

    pairs = [
        F.struct(
            F.lit(left).alias("feature_a"),
            F.lit(right).alias("feature_b"),
            _bounded(of(left, right), of(left, left), of(right, right)).alias(
                "spearman_correlation"
            ),
        )
        for left, right in combinations(features, 2)
    ]
    return sums.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def _bounded(products: Column, left: Column, right: Column) -> Column:
    size = F.sqrt(left) * F.sqrt(right)
    inside = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), products / F.when(size > 0, size)))
    return F.when(size > 0, inside)


def _ranked_apart(mart: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Correlations of pairs whose columns are missing in different rows.

    The rows are first reduced to counts per pair of values, so ranking and summing
    work on distinct values.
    """
    pairs = [
        F.struct(F.lit(place).alias("pair"), F.col(left).alias("a"), F.col(right).alias("b"))
        for place, (left, right) in enumerate(names)
    ]
    counts = materialize(
        mart.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("pair", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    left = F.array(*[F.lit(name) for name, _ in names])
    right = F.array(*[F.lit(name) for _, name in names])
    return _correlate(counts).select(
        left[F.col("pair")].alias("feature_a"),
        right[F.col("pair")].alias("feature_b"),
        "spearman_correlation",
    )


def _correlate(counts: DataFrame) -> DataFrame:
    side = ["pair", "side"]
    margins = (
        counts.unpivot(["pair", "n"], ["a", "b"], "side", "value")
        .groupBy(*side, "value")
        .agg(F.sum("n").alias("n"))
    )
    # Average rank of tied values, relative to the mean rank (rows + 1) / 2.
    rank = F.col("n_before") + (F.col("n") + 1) / 2 - (F.col("n_total") + 1) / 2
    ranks = materialize(
        running_totals(margins, side, ["value"], ["n"]).select(
            *side, "value", "n", rank.alias("rank")
        )
    )

    def of(name: str) -> DataFrame:
        return ranks.where(F.col("side") == name).select(
            "pair", F.col("value").alias(name), F.col("rank").alias(f"rank_{name}"),
            F.col("n").alias(f"n_{name}"),
        )

    # Summing over b first leaves one row per value of a for the second join.
    per_a = (
        dimension_join(counts, of("b").drop("n_b"), ["pair", "b"], salt_by=["a"])
        .groupBy("pair", "a")
        .agg(F.sum(F.col("n") * F.col("rank_b")).alias("weighted_b"))
    )
    products = (
        per_a.join(of("a"), ["pair", "a"])
        .groupBy("pair")
        .agg(
            F.sum(F.col("weighted_b") * F.col("rank_a")).alias("sp"),
            F.sum(F.col("n_a") * F.col("rank_a") * F.col("rank_a")).alias("ss_a"),
        )
    )
    spread = of("b").groupBy("pair").agg(
        F.sum(F.col("n_b") * F.col("rank_b") * F.col("rank_b")).alias("ss_b")
    )
    bounded = _bounded(F.col("sp"), F.col("ss_a"), F.col("ss_b"))
    return products.join(spread, "pair").select("pair", bounded.alias("spearman_correlation"))


def spearman_matrix(mart: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """The symmetric correlation matrix, one row and one column per feature.

    ``pairs`` are the mart's ``spearman_pairs`` where they are known already.
    """
    features = ROLES.numeric_candidates(mart.schema)
    if pairs is None:
        mart = materialize(mart.select(*features))
        pairs = spearman_pairs(mart)
    mirrored = pairs.select(
        F.col("feature_b").alias("feature_a"),
        F.col("feature_a").alias("feature_b"),
        "spearman_correlation",
    )
    varies = mart.agg(
        *[
            F.when(F.min(name) < F.max(name), F.lit(1.0)).alias(name)
            for name in features
        ]
    ).unpivot([], features, "feature_a", "spearman_correlation")
    diagonal = varies.select(
        "feature_a", F.col("feature_a").alias("feature_b"), "spearman_correlation"
    )
    long = pairs.unionByName(mirrored).unionByName(diagonal)
    return (
        long.groupBy(F.col("feature_a").alias("feature"))
        .pivot("feature_b", features)
        .agg(F.max("spearman_correlation"))
    )


def collinear_pairs(
    mart: DataFrame, pairs: DataFrame | None = None, threshold: float = NEAR_DUPLICATE
) -> DataFrame:
    """Correlated pairs by strength; pairs without a correlation are left out."""
    strength = F.abs("spearman_correlation")
    return (
        (spearman_pairs(mart) if pairs is None else pairs)
        .where(F.col("spearman_correlation").isNotNull())
        .withColumn("absolute_correlation", strength)
        .withColumn("near_duplicate", strength >= threshold)
        .orderBy(F.col("absolute_correlation").desc(), "feature_a", "feature_b")
    )


def eda_headlines(mart: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """The single numbers a reader of the profile looks for, as ``(headline, value)``.

    ``pairs`` are the mart's ``spearman_pairs`` where they are known already; the mart
    is then taken to be written.
    """
    if pairs is None:
        mart = materialize(mart)
        pairs = spearman_pairs(mart)
    risk = F.coalesce(academic_risk(F.col("final_result")), F.lit(0))
    rows = F.count(F.lit(1))
    facts = {
        "enrollment_rows": rows,
        "columns": F.lit(len(mart.columns)),
        "students": F.countDistinct("id_student"),
        "courses": F.countDistinct("code_module"),
        "presentations": F.countDistinct("code_presentation"),
        "candidate_features": F.lit(len(ROLES.candidates(mart.schema))),
        "numeric_candidates": F.lit(len(ROLES.numeric_candidates(mart.schema))),
        "categorical_candidates": F.lit(len(ROLES.categorical_candidates(mart.schema))),
        "zero_engagement_rows": _count(F.col(ENGAGEMENT) == 0),
        "risk_rows": F.sum(risk),
        "risk_share": F.sum(risk) / rows,
        "score_available": F.count(SCORE),
        "score_missing": _count(F.col(SCORE).isNull()),
        "imd_missing": _count(F.col("imd_band").isNull()),
        "imd_missing_share": _count(F.col("imd_band").isNull()) / rows,
    }
    facts = {name: value.cast("double") for name, value in facts.items()}
    base = mart.agg(*[value.alias(name) for name, value in facts.items()]).unpivot(
        [], list(facts), "headline", "value"
    )
    quartiles = risk_by_engagement_quartile(mart).where(
        F.col("engagement_quantile").isin("Q1", "Q4")
    )
    parts = ("n_total", "n_academic_risk", "academic_risk_rate")
    rates = quartiles.select(
        "engagement_quantile", *[F.col(name).cast("double").alias(name) for name in parts]
    ).unpivot(["engagement_quantile"], list(parts), "part", "value")
    rates = rates.select(F.concat_ws("_", "engagement_quantile", "part").alias("headline"), "value")
    hidden = risk_by_course(mart).agg(_count(F.col("suppressed")).cast("double").alias("value"))
    close = pairs.agg(
        _count(F.abs("spearman_correlation") >= NEAR_DUPLICATE).cast("double").alias("value")
    )
    return (
        base.unionByName(rates)
        .unionByName(hidden.select(F.lit("suppressed_groups").alias("headline"), "value"))
        .unionByName(close.select(F.lit("near_duplicate_pairs").alias("headline"), "value"))
    )


# Tables that take the correlations as a second argument.
ON_PAIRS = (spearman_matrix, collinear_pairs, eda_headlines)
