import warnings

import pytest
from pyspark.sql import functions as F

from cohortlens.contract import FEATURES, KEYS
from cohortlens.operators import scoring, split
from cohortlens.operators.checks import CheckError
from cohortlens.sources import files

STUDENT = (
    "guid_student_id string, code_module string, code_presentation string, gender string, region string,"
    "highest_education string, imd_band string, age_band string, num_of_prev_attempts string,"
    "studied_credits string, disability string, final_result string"
)
REGISTRATION = "guid_studente_id string, code_module string, code_presentation string, date_registration int"
CLICKS = "guid_student_id string, guid_site_id int, modulo string, presentation string, date int, sum_clics int"
COURSE = "code_module string, code_presentation string, module_presentation_length int"


def source(
    spark, *, missing_registration=False, missing_optional=False, unresolved_day=None, ambiguous=False,
    clicks=(), courses=(("AAA", "2013J", 100), ("BBB", "2014J", 120)), registered=(-10, -5),
):
    students = [
        ("student-1", "AAA", "2013J", "F", "North", "Bachelor", "20-30%",
         None if missing_optional else "0-35", "0", None if missing_optional else "60", "N", "Pass"),
        ("student-2", "BBB", "2014J", "M", "New region", "Master", "30-40%", "35-55",
         None if missing_optional else "1", "90", "N", "Fail"),
    ]
    registrations = [("student-1", "AAA", "2013J", registered[0]), ("student-2", "BBB", "2014J", registered[1])]
    events = [("student-1", 10, "AAA", "2013J", 5, 4), ("student-2", 20, None, "2014J", 10, 7), *clicks]
    courses = list(courses)
    if ambiguous:
        students.append(("student-2", "CCC", "2014J", "M", "North", "Master", "30-40%", "35-55", "1", "90", "N", "Pass"))
        registrations.append(("student-2", "CCC", "2014J", -5))
        courses.append(("CCC", "2014J", 120))
    if missing_registration:
        registrations = registrations[:1]
    if unresolved_day is not None:
        events.append(("unknown-student", 30, None, "2024J", unresolved_day, 5))
    return {
        "StudentInfo": spark.createDataFrame(students, STUDENT),
        "Registration": spark.createDataFrame(registrations, REGISTRATION),
        "VLE_clickStream": spark.createDataFrame(events, CLICKS),
        "cursos": spark.createDataFrame(courses, COURSE),
    }


def clicks_of(frame):
    return [r.total_clicks for r in frame.orderBy(*KEYS).collect()]


def test_frame_holds_contract_columns_and_cutoff_activity(spark):
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        frame = scoring.scoring_frame(source(spark, unresolved_day=31), 30)
    assert frame.columns == [*KEYS, *FEATURES]
    assert clicks_of(frame) == [4, 7]
    assert [r.vle_sites for r in frame.collect()] == [1, 1]


def test_unresolved_module_is_dropped_and_counted(spark):
    message = "Discarded 1 pre-cutoff VLE_clickStream events: 1 without an enrollment candidate."
    with pytest.warns(UserWarning, match=message):
        frame = scoring.scoring_frame(source(spark, unresolved_day=30), 30)
    assert clicks_of(frame) == [4, 7]


def test_ambiguous_module_is_dropped_and_counted(spark):
    message = "Discarded 1 pre-cutoff VLE_clickStream events: 1 with ambiguous enrollment candidates."
    with pytest.warns(UserWarning, match=message):
        frame = scoring.scoring_frame(source(spark, ambiguous=True), 30)
    assert clicks_of(frame) == [4, 0, 0]
    assert [r.has_vle_activity for r in frame.orderBy(*KEYS).collect()] == [1, 0, 0]


def test_repeated_blank_events_all_count(spark):
    again = [("student-2", 20, None, "2014J", 10, 7)] * 3
    row = scoring.scoring_frame(source(spark, clicks=again), 30).where("id_student = 'student-2'").first()
    assert (row.total_clicks, row.vle_events, row.active_days, row.vle_sites) == (28, 4, 1, 1)


@pytest.mark.parametrize(
    "change,message",
    [
        ({"missing_registration": True}, "identical enrollment coverage"),
        ({"clicks": [("student-1", 1, "AAA", "2013J", 40, -1)]}, "negative_clicks"),
        ({"clicks": [("student-1", None, "AAA", "2013J", 40, 1)]}, "missing_id_site"),
        ({"clicks": [("student-1", 1, "BBB", "2013J", 3, 1)]}, "activity_without_enrollment"),
        ({"registered": (31, -5)}, "starts_after_cutoff"),
        ({"registered": (None, -5)}, "missing_date_registration"),
        ({"courses": [("AAA", "2013J", 0), ("BBB", "2014J", 120)]}, "non_positive_duration"),
        ({"courses": [("AAA", "2013J", 100)]}, "enrollment_without_course"),
        ({"courses": [("AAA", "2013J", 1), ("AAA", "2013J", 2), ("BBB", "2014J", 3)]}, "cursos breaks {'duplicate_keys': 1}"),
    ],
)
def test_broken_sources_are_refused(spark, change, message):
    with pytest.raises(CheckError, match=message):
        scoring.scoring_frame(source(spark, **change), 30)


def test_missing_table_or_column_is_refused(spark, tmp_path):
    tables = source(spark)
    with pytest.raises(CheckError, match="lacks the columns"):
        scoring.scoring_frame(tables | {"cursos": tables["cursos"].drop("module_presentation_length")}, 30)
    for name in ("StudentInfo", "Registration", "VLE_clickStream"):
        tables[name].write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(CheckError, match=r"lacks the tables \['cursos'\]"):
        files.read_scoring_tables(spark, str(tmp_path))
    tables["cursos"].write.parquet(f"{tmp_path}/cursos")
    assert clicks_of(scoring.scoring_frame(files.read_scoring_tables(spark, str(tmp_path)), 30)) == [4, 7]


def test_source_without_early_activity_gives_zeros(spark):
    frame = scoring.scoring_frame(source(spark), 4)
    assert clicks_of(frame) == [0, 0]


@pytest.fixture()
def known(spark, mart8):
    return split.known_categories(mart8), split.known_key_values(mart8)


def test_unseen_values_and_missing_values_are_named(spark, mart8, known):
    changed = mart8.withColumns(
        {
            "highest_education": F.when(F.col("id_student") < 3, "?").otherwise(F.col("highest_education")),
            "age_band": F.when(F.col("id_student") != 2, F.col("age_band")),
            "code_module": F.when(F.col("id_student") == 5, "ZZZ").otherwise(F.col("code_module")),
        }
    )
    flagged = scoring.unseen_keys(scoring.unseen_fields(changed, known[0]), known[1])
    rows = {r.id_student: r for r in flagged.collect()}
    assert rows[1].oov_categorical_fields == "highest_education"
    assert rows[2].oov_categorical_fields == "highest_education;age_band"
    assert rows[3].oov_categorical_fields == "none"
    assert rows[5].oov_key_fields == "code_module" and rows[1].oov_key_fields == "none"
    assert scoring.oov_counts(flagged).first() == (2, 1)


def test_drift_needs_a_baseline_and_a_large_shift(spark, mart8, known):
    baseline = split.missing_rates(mart8)
    changed = mart8.withColumns(
        {
            "studied_credits": F.when(F.col("id_student") > 2, F.col("studied_credits")),
            "vle_sites": F.when(F.col("id_student") > 1, F.col("vle_sites")),
        }
    )
    flagged = scoring.unseen_fields(changed, known[0])
    names = [r.warning for r in scoring.drift_warnings(changed, baseline, flagged).collect()]
    assert names == ["missingness_shift:studied_credits"]
    without = baseline.where("feature <> 'studied_credits'")
    assert scoring.drift_warnings(changed, without, flagged).count() == 0
    unseen = scoring.unseen_fields(mart8.withColumn("age_band", F.lit("?")), known[0])
    names = [r.warning for r in scoring.drift_warnings(mart8, baseline, unseen).collect()]
    assert names == ["unseen_categorical_values"]


def test_probability_summary(spark):
    df = spark.createDataFrame([(v / 100,) for v in range(101)], "p double")
    row = scoring.probability_summary(df, "p").first()
    assert (row["count"], row["min"], row["max"]) == (101, 0.0, 1.0)
    assert (row.p5, row.p50, row.p95) == pytest.approx((0.05, 0.5, 0.95))
