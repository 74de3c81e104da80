"""Marts at many cutoffs, key filters, bucketed roles and sketches against the plain operators."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.contract import KEYS, MART_SCHEMA
from cohortlens.operators import cutoffs, joins, mart, metrics, profile, sketches, split
from cohortlens.sources import bucketed
from cohortlens.sources.order_binding import order_roles
from cohortlens.sources.roles import RoleTables

MARKED = "id_student int, code_module string, code_presentation string"


@pytest.fixture(scope="module")
def roles(spark):
    generator = random.Random(3)
    students = range(1, 61)
    enrolled = [
        (s, m, "2014J", s % 3, 60, generator.choice([None, -20, 0, 5, 30, 31, 90]), generator.choice(["Pass", "Fail"]))
        for s in students for m in ("AAA", "BBB") if (s + len(m)) % 4
    ]
    events = [
        (s, m, "2014J", generator.choice([None, 1, 2, 3, 4]), generator.choice([None, -5, 0, 1, 29, 30, 31, 59, 60, 61]), generator.randint(0, 9))
        for s in range(1, 80) for m in ("AAA", "BBB") for _ in range(generator.randint(0, 12))
    ]
    table = spark.createDataFrame
    return RoleTables(
        enrollment=table(enrolled, f"{MARKED}, num_of_prev_attempts int, studied_credits int, date_registration int, final_result string"),
        student=table([(s, "F", "North", "HE", None, False, "0-35") for s in students],
                      "id_student int, gender string, region string, highest_education string, imd_band string, disability boolean, age_band string"),
        course=table([(m, "2014J", 100) for m in ("AAA", "BBB")], "code_module string, code_presentation string, course_duration_days int"),
        interaction=table(events, f"{MARKED}, id_site int, event_day int, clicks int"),
        assessment=table([(f"{m}{n}", m, "2014J", 10.0 * n) for m in ("AAA", "BBB") for n in range(3)],
                         "id_assessment string, code_module string, code_presentation string, weight double"),
        submission=table([(f"{m}{n}", s, float(s % 100)) for s in students for m in ("AAA", "BBB") for n in range(3) if (s + n) % 2],
                         "id_assessment string, id_student int, score double"),
    )


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("days", [(30,), (0, 30, 60), (60, 0, 29, 30, 31, 0, -30, 400)])
def test_marts_at_many_cutoffs_are_the_marts_of_each(roles, days):
    together = cutoffs.enrollment_marts(roles, days)
    assert together.columns == ["cutoff_day", *MART_SCHEMA.names]
    for day in set(days):
        one = together.where(F.col("cutoff_day") == day).drop("cutoff_day")
        assert rows_of(one) == rows_of(mart.enrollment_mart(roles, day))


def test_many_cutoffs_read_the_clickstream_once(roles, spark, tmp_path):
    roles.interaction.write.parquet(str(tmp_path / "events"))
    stored = RoleTables(**{**roles.__dict__, "interaction": spark.read.parquet(str(tmp_path / "events"))})
    plan = cutoffs.enrollment_marts(stored, (0, 30, 60))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/events]") == 1 and "LessThanOrEqual(event_day,60)" in plan
    with pytest.raises(ValueError):
        cutoffs.enrollment_marts(roles, ())


def test_key_filter_keeps_all_keys_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).select((F.col("id") * 7919).alias("a"), (F.col("id") % 13).cast("string").alias("b"))
    rows = spark.range(0, 40_000).select((F.col("id") * 7919).alias("a"), (F.col("id") % 13).cast("string").alias("b"), "id")
    held = joins.key_filter(keys, ["a", "b"])
    passed = rows.where(held)
    assert passed.join(keys, ["a", "b"]).count() == 20_000
    assert passed.count() < 20_000 * 1.03
    nothing = joins.key_filter(keys.limit(0), ["a", "b"])
    assert rows.where(nothing).count() == 0
    assert joins.key_filter(keys, ["a", "b"], most=100) is None
    nulls = spark.createDataFrame([(None, "x"), (1, None)], "a long, b string")
    assert nulls.where(joins.key_filter(nulls, ["a", "b"])).count() == 2


def test_events_outside_the_cohort_are_dropped_before_the_shuffle(roles, spark, tmp_path):
    assert rows_of(mart.enrollment_mart(roles, 30, filter_events=True)) == rows_of(mart.enrollment_mart(roles, 30))
    registered = roles.enrollment.where("date_registration <= 30")
    kept = mart.cohort_events(roles, 30)
    inside = roles.interaction.join(registered, list(KEYS), "left_semi").count()
    assert inside <= kept.count() <= inside + 0.1 * roles.interaction.count()
    roles.interaction.write.parquet(str(tmp_path / "events"))
    stored = RoleTables(**{**roles.__dict__, "interaction": spark.read.parquet(str(tmp_path / "events"))})
    plan = mart.activity_features(mart.cohort_events(stored, 30), 30)._jdf.queryExecution().executedPlan().toString()
    # Between the scan and the first exchange above it stands the filter with the words.
    above = plan[: plan.index("/events]")]
    below_exchange = above[above.rindex("Exchange hashpartitioning(id_student"):]
    assert "Filter" in below_exchange and "subquery#" in below_exchange.lower(), below_exchange


def test_a_row_is_hashed_twice_at_most_for_a_key_filter(spark):
    """A key that is an expression is not computed anew for every bit, nor the filter read for each."""
    derived = spark.range(0, 30_000).selectExpr("id", "concat('M', CAST(id % 7 AS string)) AS b")
    keys = spark.range(0, 30_000, 3).selectExpr("id", "concat('M', CAST(id % 7 AS string)) AS b")
    held = derived.where(joins.key_filter(keys, ["id", "b"]))
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert condition.count("xxhash64") <= 2 and condition.count("scalar-subquery#") == 1, condition
    assert held.join(keys, ["id", "b"]).count() == 10_000
    assert held.count() < 10_000 * 1.05
    # Several chunks of words, and keys that come twice.
    assert joins.FILTER_CHUNK * 64 < 30_000 * joins.BITS_PER_KEY
    wide = spark.range(0, 30_000).selectExpr("id", "CAST(id AS string) AS b")
    assert wide.where(joins.key_filter(wide, ["id", "b"])).count() == 30_000
    twice = wide.unionByName(wide)
    assert twice.where(joins.key_filter(twice, ["id", "b"])).count() == 60_000


def test_the_filtered_mart_computes_the_enrollments_once(spark):
    """The cohort, its filter and the filter's size come from enrollments written once."""
    bound = order_roles(spark, "/root/testdata/sf0.001")
    filtered = mart.enrollment_mart(bound, 30, filter_events=True)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "subquery#" in plan.lower()
    assert rows_of(filtered) == rows_of(mart.enrollment_mart(bound, 30))


def test_bucketed_roles_join_without_moving_rows(roles, spark, tmp_path):
    bucketed.write_bucketed_roles(roles, "bucket_test", 4, str(tmp_path))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # Only the courses and assessments are small: stated here, as all test tables are.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        stored = bucketed.read_bucketed_roles(spark, "bucket_test")
        small = {name: F.broadcast(getattr(stored, name)) for name in ("course", "assessment")}
        stored = RoleTables(**{**stored.__dict__, **small})
        df = cutoffs.enrollment_marts(stored, [30], laid_out=True)
        assert rows_of(df.drop("cutoff_day")) == rows_of(mart.enrollment_mart(roles, 30))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan, plan
        students = stored.enrollment.join(stored.student.hint("merge"), "id_student")
        activity = cutoffs.activity_between(stored.interaction, [30], laid_out=True).hint("merge")
        both = students.join(activity, list(KEYS), "left")
        joined = both._jdf.queryExecution().executedPlan().toString()
        assert joined.count("SortMergeJoin") == 2 and "Exchange" not in joined
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.unset(bucketed.COARSE_LAYOUT)
        for role in RoleTables.__dataclass_fields__:
            spark.sql(f"DROP TABLE IF EXISTS bucket_test_{role}")


# --- sketches -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(3, 1, 30_000), np.full(5_000, 20.0)])
    rows = [(int(n % 5), float(v)) for n, v in enumerate(values)] + [(0, None), (9, None)]
    return spark.createDataFrame(rows, "part int, value double").repartition(4), values


def test_sketched_percentiles_keep_the_stated_error(numbers):
    df, values = numbers
    shares = {f"p{share}": share / 100 for share in (0, 1, 25, 50, 90, 99, 100)}
    parts = sketches.value_sketches(df, ["part"], "value")
    for found in (parts, sketches.value_sketches(df, [], "value")):
        row = sketches.sketched_percentiles(sketches.united_values(found), [], shares).first()
        for name, share in shares.items():
            below, upto = np.mean(values < row[name]), np.mean(values <= row[name])
            assert below - sketches.rank_error() <= share <= upto + sketches.rank_error()
    assert 0 < sketches.rank_error(1600) < sketches.rank_error() < 0.02


def test_united_sketches_keep_counts_and_moments(numbers):
    df, values = numbers
    parts = sketches.value_sketches(df.withColumn("value", F.col("value") + 1e6), ["part"], "value")
    row = sketches.sketched_summary(sketches.united_values(parts), [], {"median": 0.5}).first()
    assert (row["count"], row["missing"]) == (len(values), 2)
    assert row["mean"] == pytest.approx(values.mean() + 1e6)
    assert row["std"] == pytest.approx(values.std(ddof=1), rel=1e-6)
    assert (row["min"], row["max"]) == (values.min() + 1e6, values.max() + 1e6)
    alone = {r["part"]: r for r in sketches.sketched_summary(parts, ["part"], {"median": 0.5}).collect()}
    assert alone[9]["count"] == 0 and alone[9]["median"] is None and alone[9]["std"] is None
    coarse = sketches.united_values(parts.withColumn("half", F.col("part") > 2), ["half"])
    assert coarse.agg(F.sum("count")).first()[0] == len(values)


def test_distinct_sketches_unite_like_the_whole(spark):
    df = spark.range(200_000).select((F.col("id") % 90_000).alias("key"), (F.col("id") % 7).alias("part"))
    parts = sketches.distinct_sketches(df, ["part"], ["key"])
    united = sketches.distinct_counts(sketches.united_distinct(parts, ["key"]), [], ["key"]).first()["key"]
    whole = sketches.distinct_counts(
        sketches.united_distinct(sketches.distinct_sketches(df.repartition(5), [], ["key"]), ["key"]), [], ["key"]
    ).first()["key"]
    assert united == whole
    assert abs(united - 90_000) <= 90_000 * sketches.distinct_error()


def test_profiles_take_sketches_only_when_asked(mart8):
    exact = {r["feature"]: r for r in profile.numeric_profile(mart8).collect()}
    told = {r["feature"]: r for r in profile.numeric_profile(mart8, approximate=True).collect()}
    assert exact.keys() == told.keys()
    for name, row in exact.items():
        for field in ("count", "missing_count", "mean", "std", "min", "max"):
            assert told[name][field] == pytest.approx(row[field])
        assert row["min"] <= told[name]["q1"] <= told[name]["median"] <= told[name]["q3"] <= row["max"]
    for query in (profile.clicks_boxplot_by_result, profile.score_boxplot_by_group):
        one, other = query(mart8), query(mart8, approximate=True)
        assert one.columns == other.columns and one.count() == other.count()
    assert rows_of(profile.cohort_snapshot(mart8)) == rows_of(profile.cohort_snapshot(mart8, approximate=True))
    parts = split.temporal_parts(mart8.withColumn("academic_risk", F.lit(1)))
    assert rows_of(split.split_summary(parts)) == rows_of(split.split_summary(parts, approximate=True))


def test_calibration_edges_from_a_sketch(spark):
    rows = spark.range(1000).select(((F.col("id") % 997) / 1000.0).alias("p"), (F.col("id") % 2).cast("int").alias("y"))
    exact = metrics.calibration_bins(rows, "y", "p").collect()
    told = metrics.calibration_bins(rows, "y", "p", approximate=True).collect()
    assert len(exact) == len(told) == 5 and sum(r["bin_rows"] for r in told) == 1000
    assert all(abs(a["bin_rows"] - b["bin_rows"]) <= 2 * 1000 * sketches.rank_error() for a, b in zip(exact, told))
