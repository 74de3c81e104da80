import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.contract import CATEGORICAL_FEATURES, FEATURES, KEYS, NUMERIC_FEATURES
from cohortlens.models import legacy, risk
from cohortlens.models.preparation import ALL_ROWS, fit_preparations
from cohortlens.operators import split
from cohortlens.plans import commands
from cohortlens.sinks import bundle as bundles
from cohortlens.sinks import tables as sinks
from cohortlens.sources import files
from tests.test_scoring import source


def training_rows(spark, students=16, signal=True):
    rows = []
    for s in range(1, students + 1):
        rows.append(
            (s, "AAA" if s % 2 else "BBB", "2013J" if s <= students * 3 // 4 else "2014J",
             "F" if s % 2 else "M", "North" if s % 3 else "South", "Bachelor" if s % 5 else "Master",
             "20-30%", False, "0-35" if s % 7 else None, s % 3, 60 + s, -s, 100,
             s * 10 if s % 2 or not signal else s * 10 + 500, s, s, 1, 1,
             "Fail" if s % 2 else "Pass", 0 if s % 2 else 1, 0 if s % 2 else 2, 40.0 + s)
        )
    from cohortlens.contract import MART_SCHEMA

    return spark.createDataFrame(rows, MART_SCHEMA)


def test_preparations_use_training_rows_only(spark):
    rows = split.group_folds(training_rows(spark, 40), 4)
    frame = rows.toPandas()
    for number, got in fit_preparations(rows, 4).items():
        part = frame if number == ALL_ROWS else frame[frame.fold != number]
        for name in NUMERIC_FEATURES:
            assert got.medians[name] == pytest.approx(part[name].median())
            assert got.centers[name] == pytest.approx(part[name].mean())
            assert got.scales[name] == pytest.approx(part[name].std(ddof=0))
        for name in CATEGORICAL_FEATURES:
            assert got.modes[name] == part[name].mode().iloc[0]
            assert list(got.categories[name]) == sorted(part[name].dropna().unique())


def test_unseen_category_is_all_zeros(spark):
    rows = split.group_folds(training_rows(spark), 2)
    preparation = fit_preparations(rows, 2)[ALL_ROWS]
    odd = rows.withColumn("highest_education", F.lit("?")).limit(1)
    vector = preparation.transform(odd).first().features.toArray()
    width = len(preparation.categories["highest_education"])
    assert vector[:width].tolist() == [0.0] * width


def test_linear_model_matches_newton(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 0.0] + 0.3)))).astype(int)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(int(b), Vectors.dense(a.tolist())) for a, b in zip(x, y)], ["academic_risk", "features"]
    )
    model = risk._linear(400).fit(df)
    design, w = np.c_[np.ones(400), x], np.zeros(4)
    penalty = np.diag([0.0, 1, 1, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) + penalty @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        w -= np.linalg.solve(hessian, gradient)
    assert model.intercept == pytest.approx(w[0], abs=1e-4)
    assert model.coefficients.toArray() == pytest.approx(w[1:], abs=1e-4)


@pytest.mark.parametrize(
    "rows,winner",
    [
        ([(risk.BASELINE, 0.5, 0.2), (risk.LINEAR, 0.6, 0.3), (risk.TREE, 0.6, 0.25)], risk.TREE),
        ([(risk.BASELINE, 0.5, 0.2), (risk.LINEAR, 0.5, 0.2), (risk.TREE, 0.5, 0.2)], risk.BASELINE),
        ([(risk.BASELINE, None, 0.2), (risk.LINEAR, 0.1, 0.9), (risk.TREE, 0.1, None)], risk.LINEAR),
        ([(risk.BASELINE, 0.5, 0.4), (risk.LINEAR, 0.5, 0.0), (risk.TREE, 0.5, 0.5)], risk.BASELINE),
    ],
)
def test_champion_order(spark, rows, winner):
    table = spark.createDataFrame(rows[::-1], "model string, pr_auc double, brier_score double")
    assert risk.choose(table) == winner


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bundles")
    rows = training_rows(spark, 160)
    found, path = commands.train_champion(rows, 30, "2014J", str(folder), "mart")
    return rows, found, path


def test_search_keeps_the_holdout_apart(trained):
    rows, found, _ = trained
    assert found.strategy == "temporal_holdout_2014J"
    frame = rows.toPandas()
    held = {r.id_student for r in found.predictions.collect()}
    assert held == set(frame.loc[frame.code_presentation == "2014J", "id_student"])
    parts = {r.part: r.rows for r in found.split.collect()}
    assert parts == {"holdout": 40, "development": 120}
    development = frame[frame.code_presentation == "2013J"]
    medians = found.champion.preparation.medians
    assert medians["total_clicks"] == pytest.approx(development.total_clicks.median())


def test_search_prefers_a_model_that_ranks(trained):
    _, found, _ = trained
    metrics = {r["model"]: r for r in found.candidate_rows}
    assert set(metrics) == set(risk.CANDIDATES)
    assert found.champion.name != risk.BASELINE
    assert metrics[found.champion.name]["pr_auc"] > metrics[risk.BASELINE]["pr_auc"]
    weights = found.importance.collect()
    assert weights[0].importance == max(r.importance for r in weights) and len(weights) <= 15


def test_bundle_record(spark, trained):
    _, found, path = trained
    manifest = json.loads(spark.read.text(f"{path}/manifest", wholetext=True).first().value)
    report = json.loads(spark.read.text(f"{path}/training_report", wholetext=True).first().value)
    assert manifest["champion_name"] == report["champion"]["name"] == found.champion.name
    assert manifest["training_artifacts"] == report["artifacts"]
    assert (manifest["training_rows"], manifest["evaluation_rows"]) == (120, 40)
    assert report["selection"]["rows"] == 120 and report["selection"]["holdout_rows_used"] == 0
    assert report["evaluation"]["strategy"] == "temporal_holdout_2014J"
    assert manifest["known_key_values"] == {"code_module": ["AAA", "BBB"], "code_presentation": ["2013J"]}
    assert len(path.rpartition("/")[2]) == 32
    assert spark.read.parquet(f"{path}/holdout_predictions").count() == 40


def test_loaded_model_scores_alike(spark, trained):
    rows, found, path = trained
    loaded = bundles.load_bundle(spark, path, 30)
    frame = rows.select(*KEYS, *FEATURES)
    mine = found.champion.probability(frame).select("id_student", F.col("probability_academic_risk").alias("a"))
    other = loaded.champion.probability(frame).select("id_student", F.col("probability_academic_risk").alias("b"))
    assert mine.join(other, "id_student").where("abs(a - b) > 1e-12").count() == 0


def test_bundle_is_refused_when_absent_or_different(spark, trained, tmp_path, monkeypatch):
    _, _, path = trained
    with pytest.raises(FileNotFoundError, match="no finished bundle"):
        bundles.load_bundle(spark, path.rpartition("/")[0], 30)
    with pytest.raises(ValueError, match="cutoff_day"):
        bundles.load_bundle(spark, path, 31)
    monkeypatch.setattr(bundles, "contract_fingerprint", lambda: "other")
    with pytest.raises(ValueError, match="incompatible"):
        bundles.load_bundle(spark, path, 30)


def test_scoring_end_to_end(spark, trained, tmp_path):
    _, found, path = trained
    tables = source(spark, missing_optional=True)
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/source/{name}")
    read = files.read_scoring_tables(spark, f"{tmp_path}/source")
    output, report = commands.score(
        spark, read, path, 30, f"{tmp_path}/predictions", f"{tmp_path}/source"
    )
    rows = {r.id_student: r for r in output.collect()}
    assert set(rows) == {"student-1", "student-2"}
    assert all(0 <= r.probability_academic_risk <= 1 for r in rows.values())
    assert rows["student-1"].oov_categorical_fields == "age_band"
    assert rows["student-1"].oov_key_fields == "none"
    assert rows["student-2"].oov_key_fields == "code_presentation"
    told = report.first()
    assert told.rows == 2 and told.champion_name == found.champion.name
    assert told.oov.rows_with_categorical_oov == 2
    assert "unseen_categorical_values" in told.drift_warnings
    assert "missingness_shift:studied_credits" in told.drift_warnings
    assert told.missing_values_requiring_imputation.num_of_prev_attempts == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/predictions").count() == 2
    for target in ("source", "source/", "source/StudentInfo"):
        with pytest.raises(ValueError, match="must not overwrite"):
            sinks.write_predictions(output, f"{tmp_path}/{target}", f"{tmp_path}/source")


def test_training_needs_both_classes(spark):
    rows = training_rows(spark, 16).withColumn("final_result", F.lit("Fail"))
    with pytest.raises(ValueError, match="both academic_risk classes"):
        risk.search(rows, "2014J")


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_train_from_written_artifacts(spark, tmp_path, file_format):
    rows = training_rows(spark, 80)
    paths = sinks.write_artifacts(rows, str(tmp_path / "mart"), 30, file_format)
    path = commands.train_from_files(
        spark, paths["full"], paths["metadata"], str(tmp_path / "out"), file_format=file_format
    )
    assert bundles.load_bundle(spark, path, 30).manifest["data_name"] == "training_full"


def test_legacy_models_write_predictions_and_metrics(spark, tmp_path):
    growth = legacy.Growth(trees=3, depth=2, bins=64, boost_depth=2)
    rows = training_rows(spark, 120).withColumn(
        "performance_tier", (F.col("id_student") % 4).cast("int")
    )
    runs = legacy.run_all(rows, growth=growth)
    paths = sinks.write_legacy(runs, str(tmp_path))
    summary = {(r.type, r.model): r for r in spark.read.parquet(paths["metrics_summary"]).collect()}
    assert len(summary) == 9
    assert summary[("binary", "LogisticRegression")].roc_auc is not None
    assert summary[("regression", "KNN")].accuracy is None
    held = split.grouped_parts(rows).where("part = 'holdout'").count()
    for row in summary.values():
        if row.type == "binary":
            assert row.TP + row.FP + row.TN + row.FN == held
            assert row.msePI2 == row.mse
    cells = runs["ordinal"].confusion.groupBy("model").agg(F.sum("count")).collect()
    assert [n for _, n in cells] == [held] * 3
    for name in ("binary", "ordinal", "regression"):
        assert spark.read.parquet(paths[name]).count() == 3 * held
    clusters = runs["unsupervised"].metrics.collect()
    assert sum(r.rows for r in clusters) == 120 and len(clusters) == 3
    top = legacy.top_importances(runs["binary"].importance, 2)
    assert top.count() == 6
