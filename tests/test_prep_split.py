import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.models import neighbors
from cohortlens.operators import prep, split


def test_ordinal_codes_share_zero_for_unknown_and_missing(spark):
    df = spark.createDataFrame([("Bachelor",), ("No Formal",), ("Master",), ("?",), (None,)], "highest_education string")
    got = [r.highest_education_encoded for r in prep.ordinal_encode(df).collect()]
    assert got == [3, 0, 4, 0, 0]


def test_only_features_are_imputed(spark):
    df = spark.createDataFrame(
        [(1, None, None, None, None, None, "b"), (2, 4, "Pass", 1, 2, 80.0, None), (3, 7, "Pass", 1, 2, 80.0, "a")],
        "id_student int, total_clicks int, final_result string, passed int, performance_tier int,"
        "weighted_assessment_score double, region string",
    )
    rows = {r.id_student: r for r in prep.impute_median_mode(df).collect()}
    assert rows[1].total_clicks == 5.5 and rows[2].region == "a"
    assert (rows[1].final_result, rows[1].passed, rows[1].weighted_assessment_score) == (None, None, None)


def test_mode_takes_the_smallest_value_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    assert prep.as_values(prep.fit_modes(df, ["v"])) == {"v": "a"}


def test_scaling_uses_population_deviation_and_centres_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = prep.standardize(df, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_label_codes_follow_sorted_order(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",), ("a",), (None,)], "v string")
    got = {r.v: r.v_code for r in prep.label_encode(df, "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, None: None}


def test_numeric_features_leave_keys_targets_and_doubled_columns_out(mart8):
    df = mart8.withColumns({"age_enc": F.lit(1), "age_encoded": F.lit(1), "x_enc": F.lit(2)})
    names = prep.numeric_feature_columns(df, ["passed", "performance_tier", "weighted_assessment_score"])
    assert "age_encoded" in names and "x_enc" in names and "age_enc" not in names
    assert not {"id_student", "passed", "performance_tier", "disability"} & set(names)


@pytest.fixture()
def enrolled(spark):
    rows = [(s, "AAA", f"201{y}J", s % 2) for s in range(1, 201) for y in (2, 3, 4) if s % (y + 1) == 0 or y == 3]
    return spark.createDataFrame(
        rows, "id_student int, code_module string, code_presentation string, academic_risk int"
    )


def test_temporal_parts_keep_students_apart(enrolled):
    parts = split.temporal_parts(enrolled, "2014J").toPandas()
    held = set(parts.loc[parts.part == "holdout", "id_student"])
    developed = set(parts.loc[parts.part == "development", "id_student"])
    assert held and developed and not held & developed
    overlap = parts[parts.part == "overlap"]
    assert set(overlap.id_student) <= held and (overlap.code_presentation != "2014J").all()
    development, holdout = split.temporal_holdout(enrolled, "2014J")
    assert development.count() == (parts.part == "development").sum()
    assert holdout.count() == (parts.part == "holdout").sum()


def test_fallback_split_holds_a_quarter_of_the_students(enrolled):
    parts, strategy = split.split_parts(enrolled, "2099J")
    assert strategy == "grouped_random_holdout_fallback"
    frame = parts.toPandas()
    per_student = frame.groupby("id_student").part.nunique()
    assert per_student.max() == 1
    share = (frame.drop_duplicates("id_student").part == "holdout").mean()
    assert 0.15 < share < 0.35


def test_folds_hold_whole_students(enrolled, spark):
    assert split.fold_count(enrolled) == 5
    frame = split.group_folds(enrolled, 5).toPandas()
    assert frame.groupby("id_student").fold.nunique().max() == 1
    assert set(frame.fold) == set(range(5))
    assert split.fold_count(enrolled.where("id_student < 4")) == 3
    with pytest.raises(ValueError, match="two students"):
        split.fold_count(enrolled.where("id_student = 1"))


def test_known_values_and_missing_rates(spark, mart8):
    known = {(r.field, r.value) for r in split.known_key_values(mart8).collect()}
    assert known == {
        ("code_module", "AAA"), ("code_module", "BBB"),
        ("code_presentation", "2013J"), ("code_presentation", "2014J"),
    }
    rates = dict(split.missing_rates(mart8.withColumn("age_band", F.lit(None).cast("string"))).collect())
    assert rates["age_band"] == 1.0 and rates["total_clicks"] == 0.0


@pytest.mark.parametrize("pivots,block", [((1, 1), 4096), ((7, 7), 16), ((500, 500), 8)])
def test_neighbors_equal_brute_force(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(neighbors, "PIVOTS", pivots)
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 12, 300), rng.integers(0, 3, 300)
    a[:100], b[:100] = 0, 0
    y = rng.random(300)
    rows = [(int(i), "M", "P", int(a[i]), int(b[i]), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(
        rows, "id_student int, code_module string, code_presentation string, a int, b int, y double"
    )
    train, test = df.where("id_student % 4 <> 0"), df.where("id_student % 4 = 0")
    got = {r.id_student: r.predicted for r in neighbors.nearest_mean(train, test, ["a", "b"], "y").collect()}
    known = [i for i in range(300) if i % 4]
    assert len(got) == 75
    for i in range(0, 300, 4):
        near = sorted(known, key=lambda j: ((a[i] - a[j]) ** 2 + (b[i] - b[j]) ** 2, j))[:5]
        assert got[i] == pytest.approx(y[near].mean())


def test_neighbors_with_fewer_points_than_k(spark):
    df = spark.createDataFrame(
        [(1, "M", "P", 0, 1.0), (2, "M", "P", 5, 3.0), (3, "M", "P", 2, 0.0)],
        "id_student int, code_module string, code_presentation string, a int, y double",
    )
    row = neighbors.nearest_mean(df.where("id_student < 3"), df.where("id_student = 3"), ["a"], "y").first()
    assert row.predicted == 2.0
