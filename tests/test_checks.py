import pytest
from pyspark.sql import functions as F

from cohortlens.contract import FEATURES, KEYS, OUTCOMES, contract_fingerprint
from cohortlens.operators import checks


def counts(df):
    return {r["check_name"]: r["violations"] for r in df.collect()}


@pytest.fixture()
def features(mart8):
    return mart8.select(*KEYS, *FEATURES)


def test_contract_has_eleven_features_and_a_stable_fingerprint():
    assert len(FEATURES) == 11
    assert contract_fingerprint() == contract_fingerprint()
    assert len(contract_fingerprint()) == 64


def test_contract_rejects_outcomes_unless_allowed(mart8, features):
    for name in OUTCOMES:
        with pytest.raises(checks.CheckError, match="leak the outcomes"):
            checks.check_contract_columns(features.withColumn(name, F.lit(1)), "source")
    checks.check_contract_columns(mart8, "source", allow_outcomes=True)
    assert checks.contract_features(features, "source").columns == [*KEYS, *FEATURES]


def test_contract_rejects_missing_and_unsupported_columns(features):
    with pytest.raises(checks.CheckError, match="lacks the columns"):
        checks.check_contract_columns(features.drop("vle_sites"), "source")
    with pytest.raises(checks.CheckError, match="outside the feature contract"):
        checks.check_contract_columns(features.withColumn("late_score", F.lit(1)), "source")


def test_contract_rejects_duplicates_and_unusable_columns(features):
    with pytest.raises(checks.CheckError, match="duplicate_keys"):
        checks.contract_features(features.union(features.limit(2)), "source")
    empty = features.withColumn("studied_credits", F.lit("n/a"))
    with pytest.raises(checks.CheckError, match="studied_credits"):
        checks.contract_features(empty, "source")


def test_completeness_and_domain(mart8):
    assert counts(checks.completeness(mart8, ["imd_band", "gender"])) == {"imd_band": 1, "gender": 0}
    broken = mart8.withColumn(
        "final_result",
        F.when(F.col("id_student") == 1, None).when(F.col("id_student") < 4, "X").otherwise("Pass"),
    )
    assert counts(checks.result_domain(broken)) == {"missing": 1, "unexpected": 2}
    with pytest.raises(checks.CheckError, match="unexpected"):
        checks.require(checks.result_domain(broken), "mart")


def test_duplicate_keys_count_rows_beyond_the_first(mart8):
    tripled = mart8.union(mart8.limit(3)).union(mart8.limit(1))
    assert counts(checks.duplicate_keys(tripled, KEYS)) == {"key": 4}
    assert counts(checks.duplicate_keys(mart8.limit(0), KEYS)) == {"key": 0}


def test_ranges_coverage_and_orphans(spark):
    events = spark.createDataFrame([(1, -2), (2, 3), (3, None)], "k int, clicks int")
    assert counts(checks.range_rules(events, {"neg": checks.negative("clicks")})) == {"neg": 1}
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    assert counts(checks.coverage(left, right, ["k"])) == {"only_left": 1, "only_right": 2}
    assert counts(checks.orphans(events, left, ["k"])) == {"activity_without_enrollment": 1}


def test_both_classes_are_needed_per_partition(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), ("b", 1)], "part string, y int")
    assert counts(checks.classes_present(df, "part", "y")) == {"a": 0, "b": 1}


def test_text_becomes_number_or_null(spark):
    df = spark.createDataFrame([("1.5", 1), ("x", 2), (None, 3), ("7", 4)], "v string, n int")
    got = checks.coerce_numeric(df, ["v", "n"])
    assert [r.v for r in got.orderBy("n").collect()] == [1.5, None, None, 7.0]
    assert dict(got.dtypes) == {"v": "double", "n": "int"}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert checks.nan_to_null(df).where("v is null").count() == 2
