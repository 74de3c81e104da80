"""Models fitted side by side, and fully grown forests, against plain versions of both."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.contract import CATEGORICAL_FEATURES, KEYS, NUMERIC_FEATURES
from cohortlens.models import forest, legacy, risk, together
from cohortlens.models.preparation import ALL_ROWS, fit_preparations
from cohortlens.operators import split
from tests.test_models import training_rows

FOLDS = 4


@pytest.fixture(scope="module")
def dealt(spark):
    rows = training_rows(spark, 600).withColumn("studied_credits", F.expr("if(id_student % 11 = 0, null, 30 * (id_student % 5))"))
    noisy = F.xxhash64("id_student") % 3 == 0
    rows = rows.withColumn(risk.LABEL, ((F.col("id_student") % 2 == 1) != noisy).cast("int"))
    from cohortlens.session import materialize

    return materialize(split.group_folds(rows, FOLDS).repartition(3))


@pytest.fixture(scope="module")
def fitted(dealt):
    preparations = fit_preparations(dealt, FOLDS)
    return risk.fit_candidates(dealt, preparations), preparations


def encoded(frame, preparation):
    columns = []
    for name in CATEGORICAL_FEATURES:
        value = frame[name].fillna(preparation.modes[name])
        columns += [(value == level).astype(float).to_numpy() for level in preparation.categories[name]]
    for name in NUMERIC_FEATURES:
        value = frame[name].astype(float).fillna(preparation.medians[name]) - preparation.centers[name]
        columns.append((value / (preparation.scales[name] or 1.0)).to_numpy())
    return np.array(columns).T


def newton(x, y):
    design, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        w -= np.linalg.lstsq(hessian, design.T @ (p - y) + penalty @ w, rcond=None)[0]
    return w


def test_every_fold_s_linear_model_is_its_own_minimum(dealt, fitted):
    fits, preparations = fitted
    frame = dealt.toPandas()
    for number, preparation in preparations.items():
        part = frame if number == ALL_ROWS else frame[frame.fold != number]
        wanted = newton(encoded(part, preparation), part[risk.LABEL].to_numpy())
        model = fits[risk.LINEAR][number].model
        assert model.intercept == pytest.approx(wanted[0], abs=1e-6)
        assert model.weights == pytest.approx(wanted[1:], abs=1e-6)


def best_split(x, y, least):
    """(gain, feature, cut) of the best exact split, the first on ties."""
    def gini(labels):
        return 2 * labels.sum() * (len(labels) - labels.sum()) / max(1, len(labels))

    found = []
    for feature in range(x.shape[1]):
        for cut in np.unique(x[:, feature])[:-1]:
            low = x[:, feature] <= cut
            if min(low.sum(), (~low).sum()) >= least:
                found.append((round(gini(y) - gini(y[low]) - gini(y[~low]), 9), feature, low))
    return max(found, key=lambda one: (one[0], -one[1]), default=None)


def test_every_fold_s_tree_splits_best(dealt, fitted):
    fits, preparations = fitted
    frame = dealt.toPandas()
    for number, preparation in preparations.items():
        part = frame if number == ALL_ROWS else frame[frame.fold != number]
        model = fits[risk.TREE][number].model
        y, x = part[risk.LABEL].to_numpy(), encoded(part, preparation)
        root = model.nodes[1]
        gain, _, low = best_split(x, y, risk.LEAST_ROWS)
        assert (root.rows, root.positives) == (len(y), y.sum())
        assert root.gain == pytest.approx(gain, abs=1e-6)
        children = sorted(model.nodes[child].rows for child in (2, 3))
        assert children == sorted([low.sum(), (~low).sum()])
        assert all(node.rows >= risk.LEAST_ROWS for node in model.nodes.values())
        for name, node in model.nodes.items():
            if node.feature is not None:
                left, right = model.nodes[2 * name], model.nodes[2 * name + 1]
                assert (left.rows + right.rows, left.positives + right.positives) == (node.rows, node.positives)


def test_folds_are_scored_by_models_that_did_not_see_them(dealt, fitted):
    fits, preparations = fitted
    scored = risk._fold_predictions(dealt, fits, FOLDS)
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()
    rates = {
        (row["model"], row["fold"]): row["p"]
        for row in scored.groupBy("model", "fold").agg(F.max("probability_academic_risk").alias("p")).collect()
    }
    for fold in range(FOLDS):
        assert rates[risk.BASELINE, fold] == pytest.approx(fits[risk.BASELINE][fold].rate)
    assert scored.count() == 3 * dealt.count()


def test_steps_and_levels_read_the_rows_once_for_all_folds(spark, dealt, fitted):
    _, preparations = fitted
    base = together.MartBase(preparations[ALL_ROWS])
    sums = together._step_sums(base, risk.LABEL, {number: np.zeros(base.size) for number in preparations})
    one = together.with_bucket(dealt).mapInArrow(sums, together.SUMS)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
    assert one.select("training_set").distinct().count() == len(preparations)


def test_models_come_back_from_their_records(fitted, dealt):
    fits, _ = fitted
    for name in (risk.LINEAR, risk.TREE):
        one = fits[name][ALL_ROWS]
        again = risk.FittedRisk(name, one.preparation, one.rate, risk.model_of(json.loads(json.dumps(risk.model_record(one.model)))))
        gap = dealt.agg(F.max(F.abs(one.probability_column() - again.probability_column()))).first()[0]
        assert gap == 0


def test_a_set_of_one_class_has_an_endless_intercept(spark):
    rows = spark.createDataFrame([([float(n)], 1, n % 2) for n in range(10)], "features array<double>, y int, fold int")
    for label, wanted in ((F.lit(1), np.inf), (F.lit(0), -np.inf)):
        found = together.fit_logistic(rows.withColumn("y", label), together.VectorBase(1), "y", {0: np.eye(2)})
        assert found[0][1] == wanted and found[0][0].tolist() == [0.0]


def test_least_squares_of_dependent_columns(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 3)) * [1, 1e4, 1] + [0, 1e6, 5]
    x = np.c_[x, x[:, 0] * 2, np.full(200, 7.0)]
    y = x[:, 0] * 3 + x[:, 1] / 1e4 - x[:, 2] + 2
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "features array<double>, label double")
    found = together.fit_least_squares(df, together.VectorBase(5), "label")
    told = x @ np.array(found.weights) + found.intercept
    assert told == pytest.approx(y, abs=1e-4)


# --- forests ------------------------------------------------------------------------


def forest_rows(spark, count=500, parts=4, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(count, 4)), 2)
    y = np.where(x[:, 0] > 0.3, 3.0, 0.0) + x[:, 1] ** 2 + rng.normal(size=count) * 0.1
    rows = [
        (n, n * 31, forest.TEST if n % 4 == 0 else forest.TRAINING, float(y[n]), x[n].tolist()) for n in range(count)
    ]
    schema = "id long, lot long, part int, label double, features array<double>"
    return spark.createDataFrame(rows, schema).repartition(parts), x, y


def test_a_single_tree_grows_to_the_last_row(spark):
    rows, x, y = forest_rows(spark)
    again = rows.where("part = 0").withColumn("part", F.lit(forest.TEST)).withColumn("id", F.col("id") + 10_000)
    shape = forest.Shape(1, 30, 4, 0, 4, 1, draw=False)
    scores, fitted = forest.fit_and_score(rows.unionByName(again), shape)
    found = {row["id"]: row["scores"][0] for row in scores.collect()}
    distinct = {tuple(row): index for index, row in enumerate(x.tolist())}
    assert len(distinct) == len(x)
    for number in range(len(x)):
        if number % 4:
            assert found[10_000 + number] == pytest.approx(y[number])
    assert sum(fitted.importances) == pytest.approx(1)
    assert fitted.nodes == 2 * sum(1 for n in range(len(x)) if n % 4) - 1


@pytest.mark.parametrize("local_rows", [10_000, 60])
def test_forests_predict_and_do_not_depend_on_the_layout(spark, local_rows):
    found = []
    for parts in (1, 5):
        rows, x, y = forest_rows(spark, parts=parts)
        shape = forest.Shape(20, 30, 4, 0, 4, 7, local_rows=local_rows)
        scores, fitted = forest.fit_and_score(rows, shape)
        found.append({row["id"]: row["scores"][0] for row in scores.collect()})
        assert np.argmax(fitted.importances) == 0 and sum(fitted.importances) == pytest.approx(1)
    assert found[0].keys() == found[1].keys() == {n for n in range(500) if n % 4 == 0}
    if local_rows > 500:
        assert found[0] == pytest.approx(found[1])
    told = np.array([found[0][n] for n in sorted(found[0])])
    truth = np.array([y[n] for n in sorted(found[0])])
    assert 1 - np.sum((told - truth) ** 2) / np.sum((truth - truth.mean()) ** 2) > 0.9


@pytest.mark.parametrize("local_rows", [10_000, 50])
def test_classes_and_rows_that_no_cut_tells_apart(spark, local_rows):
    rng = np.random.default_rng(2)
    rows = []
    for n in range(400):
        same = n < 200
        x = [1.0, 1.0, 1.0] if same else rng.normal(size=3).round(1).tolist()
        label = float(n % 4 == 1) if same else float(x[0] > 0) + float(x[1] > 0)
        rows.append((n, n * 17, int(n % 5 == 0), label, x))
    df = spark.createDataFrame(rows, "id long, lot long, part int, label double, features array<double>")
    shape = forest.Shape(12, 30, 3, 3, 1, 5, local_rows=local_rows)
    scores, _ = forest.fit_and_score(df.repartition(3), shape)
    found = {row["id"]: row["scores"] for row in scores.collect()}
    assert set(found) == {row[0] for row in rows if row[2]}
    assert all(sum(shares) == pytest.approx(1) and min(shares) >= 0 for shares in found.values())
    assert 0.1 < found[0][1] < 0.5 and found[0] == pytest.approx(found[5])
    hits = [np.argmax(found[n]) == rows[n][3] for n in found if n >= 200]
    assert np.mean(hits) > 0.7


def test_draws_are_those_of_a_poisson_law():
    lots = np.arange(200_000) * 7 - 3
    drawn = forest.draws(lots, 3, 42)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)
    assert (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert (drawn != forest.draws(lots, 4, 42)).any()


def test_large_nodes_are_sorted_column_by_column(monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 5)).round(1), rng.normal(size=300)
    shape = forest.Shape(1, 30, 5, 0, 5, 1)
    whole = forest.grow_subtree(shape, x, y, np.ones(300), 30, (0, 1))
    monkeypatch.setattr(forest, "SORTED_AT_ONCE", 100)
    parts = forest.grow_subtree(shape, x, y, np.ones(300), 30, (0, 1))
    assert whole.predict(x) == pytest.approx(parts.predict(x))


def test_no_task_carries_the_trees(spark):
    rows = training_rows(spark, 200).withColumn("performance_tier", (F.col("id_student") % 4).cast("int"))
    training, test, features = legacy._parts(rows, "performance_tier", {})
    assert {"id", "lot", *KEYS} <= set(training.columns)
    scored, fitted = legacy._grown(training, test, legacy.Growth(trees=5).forest(len(features), 4))
    assert scored.count() == test.count() and fitted.nodes > 5


def test_subtrees_split_all_nodes_of_a_level_together(monkeypatch):
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 50, size=(5_000, 4)).astype(float), rng.integers(0, 4, 5_000).astype(float)
    calls, split = [], forest._level_splits
    monkeypatch.setattr(forest, "_level_splits", lambda *args: calls.append(1) or split(*args))
    grown = forest.grow_subtree(forest.Shape(1, 90, 4, 4, 2, 1), x, y, np.ones(5_000), 90, (0, 1))
    assert len(grown.feature) > 3_000 and len(calls) <= 90
    distinct, first, counts = np.unique(x, axis=0, return_index=True, return_counts=True)
    alone = first[counts == 1]
    assert np.argmax(grown.predict(x[alone]), axis=1).tolist() == y[alone].tolist()


def test_boosting_of_all_classes_equals_one_against_rest(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from cohortlens.models import boosting

    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 40, 900), rng.normal(size=900).round(1), rng.integers(0, 3, 900)])
    y = (x[:, 0] > 20).astype(int) + ((x[:, 1] > 0) ^ (rng.random(900) < 0.2))
    rows = spark.createDataFrame(
        [(n, float(label), own.tolist()) for n, (label, own) in enumerate(zip(y, x))],
        "id long, label double, features array<double>",
    ).repartition(3)
    wide = rows.select("id", "label", *[F.col("features")[place].alias(f"f{place}") for place in range(3)], "features")
    model = boosting.fit_boosted(wide, ["f0", "f1", "f2"], 3, rounds=12, depth=3, step=0.1, bins=256)
    told = {row["id"]: row["margins"] for row in model.score(wide, ["id"]).collect()}
    for number in range(3):
        single = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.1, maxBins=256, seed=1)
        own = rows.select("id", (F.col("label") == number).cast("double").alias("label"), array_to_vector("features").alias("features"))
        scored = single.fit(own).transform(own).select("id", vector_to_array("rawPrediction")[1].alias("raw"))
        for row in scored.collect():
            assert told[row["id"]][number] == pytest.approx(row["raw"], abs=1e-9)


def test_bins_are_found_once_for_all_training_sets(dealt, monkeypatch):
    preparations = fit_preparations(dealt, FOLDS)
    cuts = together.possible_cuts(dealt, preparations[ALL_ROWS])
    sizes = together.set_sizes(dealt, risk.LABEL, list(preparations))
    trees = {number: {1: together.Node(*sizes[number])} for number in preparations}
    batch = dealt.select("fold", risk.LABEL, *together.FEATURE_ORDER).toArrow().combine_chunks().to_batches()[0]
    calls, codes = [], together.Cuts.codes
    monkeypatch.setattr(together.Cuts, "codes", lambda *args: calls.append(1) or codes(*args))
    run = together._histograms(cuts, risk.LABEL, preparations, trees, dict.fromkeys(preparations, [1]))
    (told,) = run(iter([batch]))
    assert len(calls) == len(together.FEATURE_ORDER)
    for row in told.to_pylist():
        rows, positives = np.frombuffer(row["counts"], np.int64).reshape(2, -1).sum(axis=1)
        assert (rows, positives) == sizes[row["training_set"]]


def test_kmeans_checks_compute_the_mart_once(spark, monkeypatch):
    from cohortlens.plans import model_checks

    calls, mart_of = [], model_checks._mart
    monkeypatch.setattr(model_checks, "_mart", lambda *args: calls.append(1) or mart_of(*args))
    found = model_checks.kmeans_checks(spark, "/root/testdata/sf0.001").first()
    assert len(calls) == 1 and found["nearest_centre"] and found["all_rows_clustered"]


def test_whole_number_distances_take_one_product_and_stay_exact():
    from cohortlens.models import neighbors

    rng = np.random.default_rng(8)
    whole = rng.integers(-5_000, 5_000, size=(40, 9)).astype(float)
    exact = [[float(np.sum((a - b) ** 2)) for b in whole] for a in whole]
    assert neighbors._whole(whole) and neighbors._distances(whole, whole).tolist() == exact
    for odd in (whole + 0.3, whole * 1e6):
        assert not neighbors._whole(odd)
        assert (np.diag(neighbors._distances(odd, odd)) == 0).all()


def test_a_boosting_pass_counts_narrow_features_together(monkeypatch):
    import pyarrow as pa

    from cohortlens.models import boosting

    rng = np.random.default_rng(9)
    widths = [5, 4, 91, 2, 208, 10, 10, 10, 2, 5, 3]
    cuts = [np.arange(width - 1) + 0.5 for width in widths]
    x = np.column_stack([rng.integers(0, width, 70_000) for width in widths]).astype(float)
    labels, margins = rng.integers(0, 3, 70_000), np.zeros((3, 70_000))
    codes, layout = boosting._codes(x, cuts), boosting.Layout.of(cuts)
    assert sorted(sum(layout.lines, [])) == list(range(11)) and len(layout.lines) == 4
    growing = [boosting.Tree.empty(3) for _ in range(3)]
    for number, tree in enumerate(growing):
        tree.feature[1], tree.cut[1] = 2, 20 + number
    packed = [labels.astype(np.int16).tobytes(), codes.tobytes(), margins.tobytes()]
    batch = pa.RecordBatch.from_arrays(
        [*[pa.array([own], pa.binary()) for own in packed], pa.array([3], pa.int32())], names=["a", "b", "c", "bucket"]
    )
    calls, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *args, **more: calls.append(1) or count(*args, **more))
    run = boosting._histograms(layout, codes.dtype, 3, [], True, growing, 1)
    (made,) = run(iter([batch]))
    # Rows and sums of a line and class: a counter for each feature would take 66.
    assert len(calls) == 2 * 3 * 4
    found = boosting._totals([made.column("sums")[0].as_py()], layout, 3, 2)
    for number in range(3):
        wanted, right = np.where(labels == number, 1.0, -1.0), x[:, 2] > 20 + number
        for feature, width in enumerate(widths):
            for node, rows in enumerate((~right, right)):
                held = x[rows, feature].astype(int)
                assert (found[number][feature][0, node] == count(held, minlength=width)).all()
                assert found[number][feature][1, node] == pytest.approx(count(held, wanted[rows], width))


def test_rows_go_down_boosted_trees_as_single_steps_would():
    from cohortlens.models import boosting

    rng = np.random.default_rng(5)
    for bins, kind in ((200, np.uint8), (300, np.uint16)):
        codes = rng.integers(0, bins, (4, 500)).astype(kind)
        tree = boosting.Tree.empty(3)
        for node in range(1, 8):
            # A node that does not split sends all rows left.
            if node != 3:
                tree.feature[node], tree.cut[node] = rng.integers(4), rng.integers(bins)
        for levels in range(4):
            told = tree.places(codes, levels)
            for row in range(500):
                node = 1
                for _ in range(levels):
                    node = 2 * node + int(codes[tree.feature[node], row] > tree.cut[node])
                assert told[row] == node - (1 << levels)


def test_distinct_values_are_gathered_once(spark):
    rows = spark.createDataFrame([(float(n % 7), float(n)) for n in range(60)], "a double, b double")
    found = together.value_cuts(rows.unionByName(rows).withColumn("c", F.lit(None).cast("double")), ["a", "b", "c"], 10)
    assert found["a"].tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and len(found["b"]) == 9 and not len(found["c"])


def test_draws_by_table_are_those_of_the_law():
    lots = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 300_000)
    mixed = (lots.astype(np.uint64) + np.uint64(12 * 0x9E3779B97F4A7C15 % 2**64)) ^ np.uint64(42)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    share = ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    told = forest.draws(lots, 11, 42)
    assert told.dtype == np.int8 and (told == np.searchsorted(forest._DRAWS, share, "right")).all()


def test_a_level_tries_only_as_many_features_as_its_nodes_draw(monkeypatch):
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 40, size=(4_000, 9)).astype(float), rng.integers(0, 3, 4_000).astype(float)
    calls, levels, by_value, split = [], [], forest._by_value, forest._level_splits
    monkeypatch.setattr(forest, "_by_value", lambda *args: calls.append(1) or by_value(*args))
    monkeypatch.setattr(forest, "_level_splits", lambda *args: levels.append(1) or split(*args))
    forest.grow_subtree(forest.Shape(1, 8, 9, 3, 3, 1), x, y, np.ones(4_000), 8, (0, 1))
    assert len(levels) == 8 and len(calls) == 3 * 8


def test_the_trees_of_a_test_row_meet_as_blocks(spark):
    rows, _, _ = forest_rows(spark)
    shape = forest.Shape(6, 30, 4, 0, 4, 7, local_rows=60)
    upper, _ = forest._grow_upper(rows, shape)
    made = rows.mapInArrow(forest._packer(shape, upper), forest.PACKED)
    grown = made.groupBy("tree", "node", "chunk").applyInArrow(forest._grower(shape, upper), forest.GROWN)
    pieces = grown.where("block >= 0").collect()
    assert sum(len(row["places"]) // 2 for row in pieces) == 6 * 125 and len(pieces) < 6 * 125
    # The ids travel with one tree only.
    assert sorted(n for row in pieces for n in np.frombuffer(row["ids"], np.int64)) == list(range(0, 500, 4))


def test_upper_levels_place_values_and_bins_alike():
    rng = np.random.default_rng(3)
    cuts = [np.array([0.5, 1.5, 2.5]), np.array([10.0, 20.0])]
    x = np.array([rng.integers(0, 4, 400), rng.integers(0, 30, 400)]).astype(float)
    none = np.zeros(1)
    tree = {1: forest.Split(0, 1.5, none, 1), 3: forest.Split(1, 20.0, none, 1), 2: forest.Split(1, 10.0, none, 0),
            5: forest.Split(None, 0.0, none), 6: forest.Split(0, 2.5, none, 2)}
    paths = forest.Paths.of(tree)
    codes = np.array([np.searchsorted(own, line, "left") for own, line in zip(cuts, x)], np.uint8)
    told = paths.ends[paths.slots(x)]
    assert (told == paths.ends[paths.slots(codes, coded=True)]).all()
    for node, row in zip(told, x.T):
        at = 1
        while at in tree and tree[at].feature is not None:
            at = 2 * at + int(row[tree[at].feature] > tree[at].cut)
        assert at == node


@pytest.mark.parametrize("classes", [0, 3])
def test_sorted_keys_sum_up_like_counters(monkeypatch, classes):
    rng = np.random.default_rng(2)
    shape, count = forest.Shape(1, 30, 4, classes, 4, 1), 4_000
    key, weight = rng.integers(0, 900, count), rng.integers(1, 17, count).astype(float)
    target = rng.integers(0, 3, count) if classes else weight * rng.normal(size=count)
    # Values come times their weight, so that a level multiplies once for all features.
    wanted = [(np.bincount(key, weight * (target == own)) if classes else np.bincount(key, target)) for own in range(classes or 1)]
    for cells in (1 << 16, 900, 1 << 58):
        with monkeypatch.context() as patch:
            if cells > 900:
                patch.setattr(forest, "SORTED_AT_ONCE", 10)
            if cells > 1 << 50 and classes:
                continue
            found, held, sums = forest._by_value(shape, key, cells, weight, target)
        assert found.tolist() == np.unique(key).tolist()
        assert held == pytest.approx(np.bincount(key, weight)[found])
        assert sums == pytest.approx(np.array(wanted).T[found])
