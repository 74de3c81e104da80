import numpy as np
import pytest

from cohortlens.operators import metrics


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    p = np.round(rng.random(600), 2)
    p[:200] = 0.5
    y = (rng.random(600) < p).astype(int)
    rows = [(int(i), "M", "P", float(a), int(b)) for i, (a, b) in enumerate(zip(p, y))]
    df = spark.createDataFrame(
        rows, "id_student int, code_module string, code_presentation string, p double, y int"
    ).cache()
    return df, p, y


def average_precision(p, y):
    total, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        chosen = p >= t
        recall = y[chosen].sum() / y.sum()
        total += (recall - last) * y[chosen].mean()
        last = recall
    return total


def auc(p, y):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


def test_risk_metrics_match_brute_force(scored):
    df, p, y = scored
    row = metrics.risk_metrics(df, "y", "p").first()
    assert row.pr_auc == pytest.approx(average_precision(p, y))
    assert row.roc_auc == pytest.approx(auc(p, y))
    assert row.brier_score == pytest.approx(np.mean((p - y) ** 2))
    flagged = p >= 0.5
    assert row.precision_at_0_5 == pytest.approx(y[flagged].mean())
    assert row.recall_at_0_5 == pytest.approx(y[flagged].sum() / y.sum())


def test_groups_are_scored_apart(spark, scored):
    df, p, y = scored
    split = df.withColumn("g", (df.id_student % 2).cast("string"))
    rows = {r.g: r for r in metrics.risk_metrics(split, "y", "p", ["g"]).collect()}
    for g in ("0", "1"):
        part = np.arange(600) % 2 == int(g)
        assert rows[g].pr_auc == pytest.approx(average_precision(p[part], y[part]))


def test_one_class_has_no_auc_and_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, y int")
    row = metrics.risk_metrics(df, "y", "p").first()
    assert row.roc_auc is None
    assert (row.pr_auc, row.precision_at_0_5, row.recall_at_0_5) == (0.0, 0.0, 0.0)


def test_calibration_matches_quantile_bins(scored):
    df, p, y = scored
    edges = np.percentile(p, [20, 40, 60, 80])
    place = np.searchsorted(edges, p)
    held = [b for b in range(5) if (place == b).any()]
    rows = metrics.calibration_bins(df, "y", "p").orderBy("bin").collect()
    assert [r.bin for r in rows] == list(range(1, len(held) + 1))
    assert [r.bin_rows for r in rows] == [int((place == b).sum()) for b in held]
    assert [r.mean_predicted_risk for r in rows] == pytest.approx([p[place == b].mean() for b in held])
    assert [r.observed_risk for r in rows] == pytest.approx([y[place == b].mean() for b in held])
    assert sum(r.rows for r in rows) == 600


def test_capacity_takes_the_top_share_with_ties_by_key(scored):
    df, p, y = scored
    order = np.lexsort((np.arange(600), -p))[:120]
    row = metrics.capacity_metrics(df, "y", "p").first()
    assert row.selected_rows == 120
    assert row.precision == pytest.approx(y[order].mean())
    assert row.recall == pytest.approx(y[order].sum() / y.sum())


def test_capacity_selects_at_least_one_row(spark):
    df = spark.createDataFrame(
        [(1, "M", "P", 0.9, 1), (2, "M", "P", 0.1, 0)],
        "id_student int, code_module string, code_presentation string, p double, y int",
    )
    row = metrics.capacity_metrics(df, "y", "p").first()
    assert (row.selected_rows, row.precision, row.recall) == (1, 1.0, 1.0)


def test_class_scores_are_macro_means(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 1)] + [(1, 3)]
    df = spark.createDataFrame(pairs, "y int, yh int")
    row = metrics.class_scores(df, "y", "yh").first()
    assert row.accuracy == pytest.approx(5 / 8)
    assert row.precision_macro == pytest.approx((1 + 0.5 + 0 + 0) / 4)
    assert row.recall_macro == pytest.approx((0.75 + 2 / 3 + 0 + 0) / 4)
    assert row.f1_score == pytest.approx(4 / 7)
    assert row.f1_macro == pytest.approx((6 / 7 + 4 / 7) / 4)


def test_binary_confusion_and_value_scores(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, yh int")
    row = metrics.binary_confusion(df, "y", "yh").first()
    assert (row.TP, row.FP, row.TN, row.FN) == (1, 1, 2, 1)
    errors = metrics.value_scores(df, "y", "yh").first()
    assert errors.mse == pytest.approx(0.4)
    assert errors.r2 == pytest.approx(1 - 2 / 1.2)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, yh double")
    assert metrics.value_scores(flat, "y", "yh").first().r2 is None


def test_holdout_report_nests_all_parts(scored):
    df, _, _ = scored
    row = metrics.holdout_report(df, "y", "p").first()
    assert row.rows == 600 and row.students == 600
    assert row.intervention_capacity.selected_rows == 120
    assert [b.bin for b in row.calibration] == sorted(b.bin for b in row.calibration)
