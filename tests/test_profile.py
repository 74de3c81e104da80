import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.contract import KEYS, MISSING_LABEL, ROLES, SCORE
from cohortlens.operators import profile
from cohortlens.plans.commands import PROFILE_TABLES, profile as run_profile


def by(df, *names):
    return {tuple(r[n] for n in names) if len(names) > 1 else r[names[0]]: r for r in df.collect()}


def test_click_boxes(mart8):
    rows = profile.clicks_boxplot_by_result(mart8).collect()
    assert [r.final_result for r in rows] == ["Fail", "Pass"]
    assert [r["median"] for r in rows] == [15, 55]
    assert [r.iqr for r in rows] == [15, 15]
    assert [(r.lower_whisker, r.upper_whisker) for r in rows] == [(0, 30), (40, 70)]
    assert [r["count"] for r in rows] == [4, 4]


def test_whiskers_leave_outliers_out(spark):
    df = spark.createDataFrame([("g", v) for v in (1, 2, 3, 4, 100)], "g string, v int")
    from cohortlens.operators.ranking import value_distribution

    row = profile.box_summary(value_distribution(df, ["g"], "v"), ["g"], "v").first()
    assert (row["max"], row.upper_whisker, row.lower_whisker) == (100, 4, 1)


def test_score_boxes_account_for_missing_scores(mart8):
    got = by(profile.score_boxplot_by_group(mart8), "characteristic", "category")
    f, m = got[("gender", "F")], got[("gender", "M")]
    assert (f.observed_score_count, m.observed_score_count) == (3, 2)
    assert (f.missing_score_count, m.missing_score_count) == (1, 2)
    gaps = mart8.withColumn("age_band", F.when(F.col("id_student") > 6, F.col("age_band")))
    rows = profile.score_boxplot_by_group(gaps).collect()
    ages = [r.category for r in rows if r.characteristic == "age_band"]
    assert ages == ["0-35", MISSING_LABEL]


def test_candidates_leave_outcomes_and_descriptive_columns_out(mart8):
    schema = mart8.withColumn("academic_risk", F.lit(1)).schema
    names = ROLES.candidates(schema)
    assert not {"academic_risk", SCORE, "gender", "age_band", "highest_education", *KEYS} & set(names)
    assert ROLES.categorical_candidates(schema) == ["region", "imd_band", "disability"]
    assert "disability" not in ROLES.numeric_candidates(schema)
    assert len(ROLES.numeric_candidates(schema)) == 9


def test_categories_label_missing_values(mart8):
    row = by(profile.categorical_profile(mart8), "column", "category")[("imd_band", MISSING_LABEL)]
    assert (row["count"], row.share) == (1, 0.125)
    candidates = by(profile.categorical_candidates(mart8), "feature", "category")
    assert candidates[("disability", "False")]["count"] == 8


def test_quartile_rates(mart8):
    got = by(profile.risk_by_engagement_quartile(mart8), "engagement_quantile")
    assert got["Q1"].academic_risk_rate == 1.0 and got["Q4"].academic_risk_rate == 0.0
    assert sum(r.n_total for r in got.values()) == 8


def test_small_course_groups_are_hidden(mart8):
    rows = profile.risk_by_course(mart8).collect()
    assert len(rows) == 4
    assert all(r.suppressed and r.academic_risk_rate is None for r in rows)
    assert {r.label for r in rows} == {"AAA 2013J", "AAA 2014J", "BBB 2013J", "BBB 2014J"}


def test_numeric_profile_matches_pandas(mart8):
    gaps = mart8.withColumn("studied_credits", F.when(F.col("id_student") > 2, F.col("total_clicks")))
    frame = gaps.toPandas()
    got = by(profile.numeric_profile(gaps), "feature")
    for name in ROLES.numeric_candidates(gaps.schema):
        values, row = pd.to_numeric(frame[name]), got[name]
        assert (row["count"], row.missing_count) == (values.count(), values.isna().sum())
        for mine, want in (
            (row["mean"], values.mean()), (row["median"], values.median()), (row["std"], values.std()),
            (row["min"], values.min()), (row.q1, values.quantile(0.25)),
            (row.q3, values.quantile(0.75)), (row["max"], values.max()),
        ):
            assert mine == pytest.approx(want)


def test_histogram_matches_numpy(mart8):
    rows = profile.click_histogram(mart8).orderBy("bin").collect()
    want, edges = np.histogram([10 * i for i in range(8)], bins=40)
    assert [r["count"] for r in rows] == want.tolist()
    assert [r.lower for r in rows] == pytest.approx(edges[:-1].tolist())
    flat = by(profile.feature_histograms(mart8).where("feature = 'num_of_prev_attempts'"), "bin")
    want, edges = np.histogram([0] * 8, bins=5)
    assert [flat[b]["count"] for b in range(5)] == want.tolist()
    assert flat[0].lower == edges[0] and flat[0].zero_count == 8


def test_spearman_ranks_pairs_of_present_values(spark, mart8):
    rng = np.random.default_rng(3)
    frame = mart8.toPandas()
    frame = pd.concat([frame] * 10, ignore_index=True)
    frame["total_clicks"] = rng.integers(0, 9, len(frame))
    frame["active_days"] = rng.integers(0, 5, len(frame))
    frame["studied_credits"] = rng.integers(0, 4, len(frame)).astype(float)
    frame.loc[::3, "studied_credits"] = np.nan
    columns = ["total_clicks", "active_days", "studied_credits", "vle_sites", "course_duration_days"]
    rows = [
        tuple(None if pd.isna(v) else float(v) for v in row)
        for row in frame[columns].itertuples(index=False)
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = profile.spearman_matrix(df).toPandas().set_index("feature")
    want = frame[columns].corr(method="spearman")
    for a in columns:
        for b in columns:
            mine, exact = got.loc[a, b], want.loc[a, b]
            assert (pd.isna(mine) and pd.isna(exact)) or mine == pytest.approx(exact)
    pairs = profile.collinear_pairs(df).collect()
    assert all("course_duration_days" not in (r.feature_a, r.feature_b) for r in pairs)
    strength = [r.absolute_correlation for r in pairs]
    assert strength == sorted(strength, reverse=True) and len(strength) == 6


def test_one_numeric_column_gives_a_one_by_one_matrix(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "total_clicks double")
    assert profile.collinear_pairs(df).count() == 0
    assert profile.spearman_matrix(df).collect() == [("total_clicks", 1.0)]


def test_near_duplicates_are_flagged(mart8):
    got = by(profile.collinear_pairs(mart8), "feature_a", "feature_b")
    assert got[("total_clicks", "active_days")].near_duplicate


def test_missingness_order(mart8):
    rows = profile.missingness(mart8).collect()
    assert [(r["column"], r.missing_count) for r in rows[:3]] == [
        (SCORE, 3), ("imd_band", 1), ("active_days", 0),
    ]


def test_data_quality_counts_duplicates(mart8):
    got = by(profile.data_quality(mart8.union(mart8.limit(1))), "check")
    assert got["duplicate_enrollment_keys"]["count"] == 1
    assert got["required_columns_present"].failed
    assert got["zero_vle_engagement"]["count"] == 2


def test_profile_writes_every_table(spark, mart8, tmp_path):
    tables = run_profile(mart8, str(tmp_path))
    assert set(tables) == set(PROFILE_TABLES)
    for name in PROFILE_TABLES:
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0


def test_profile_refuses_duplicate_keys(mart8):
    with pytest.raises(ValueError, match="duplicate_keys"):
        run_profile(mart8.union(mart8.limit(1)))


def test_target_share(mart8):
    assert {r.academic_risk: r.share for r in profile.target_share(mart8).collect()} == {0: 0.5, 1: 0.5}
