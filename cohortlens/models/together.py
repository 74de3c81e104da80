"""Models of many training sets fitted side by side, each pass reading the rows once.

A training set is all rows but those of one fold (or all rows). Every pass over the rows
serves all sets: a Newton step of the logistic models takes one aggregate of gradients and
Gram matrices, a level of the trees one aggregate of histograms. Rows are encoded once, in a
base that does not depend on the set; what a set fills in for gaps, centres and scales is a
linear map of that base (for the linear models) or another bin (for the trees).

Only sums reach the driver: per set a matrix as wide as the features, per tree node and
feature the best cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from cohortlens.models.preparation import Preparation
from cohortlens.session import materialize

#: Partial sums of a set that reach the driver at most.
BUCKETS = 16
#: Newton steps at most, and the relative step that ends them.
MOST_STEPS, STILL = 100, 1e-10
#: Distinct values up to which each gap between two is a possible cut; beyond, so many quantiles.
MOST_CUTS = 1024

SUMS = "training_set int, bucket int, sums binary"


# --- logistic models -----------------------------------------------------------------


@dataclass(frozen=True)
class VectorBase:
    """Rows whose features are one array column."""

    width: int

    @property
    def columns(self) -> list[str]:
        return ["features"]

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
        return np.hstack([np.ones((batch.num_rows, 1)), flat.reshape(batch.num_rows, -1)])

    @property
    def size(self) -> int:
        return self.width + 1


@dataclass(frozen=True)
class MartBase:
    """The contract features: a constant, one column per level, one for each field's gaps, and
    numbers on the scale of all rows."""

    whole: Preparation

    @property
    def columns(self) -> list[str]:
        return [*CATEGORICAL_FEATURES, *NUMERIC_FEATURES]

    @property
    def size(self) -> int:
        levels = sum(len(self.whole.categories[name]) + 1 for name in CATEGORICAL_FEATURES)
        return 1 + levels + 2 * len(NUMERIC_FEATURES)

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        found = np.zeros((batch.num_rows, self.size))
        found[:, 0] = 1
        every, place = np.arange(batch.num_rows), 1
        for name in CATEGORICAL_FEATURES:
            levels = self.whole.categories[name]
            code = level_codes(batch.column(name), levels)
            known = code < len(levels)
            found[every[known], place + code[known]] = 1
            place += len(levels)
            found[:, place] = batch.column(name).is_null().to_numpy(zero_copy_only=False)
            place += 1
        for name in NUMERIC_FEATURES:
            value = numbers(batch.column(name))
            gap = np.isnan(value)
            scale = self.whole.scales[name] or 1.0
            found[:, place] = np.where(gap, 0.0, (value - self.whole.centers[name]) / scale)
            found[:, place + 1] = gap
            place += 2
        return found

    def map(self, preparation: Preparation) -> np.ndarray:
        """The constant and encoded features of a preparation as combinations of the base."""
        rows, place = [np.eye(1, self.size)[0]], 1
        for name in CATEGORICAL_FEATURES:
            levels = list(self.whole.categories[name])
            for level in preparation.categories[name]:
                row = np.zeros(self.size)
                row[place + levels.index(level)] = 1
                row[place + len(levels)] = level == preparation.modes[name]
                rows.append(row)
            place += len(levels) + 1
        for name in NUMERIC_FEATURES:
            row = np.zeros(self.size)
            own = preparation.scales[name] or 1.0
            center, scale = self.whole.centers[name], self.whole.scales[name] or 1.0
            row[0] = (center - preparation.centers[name]) / own
            row[place] = scale / own
            row[place + 1] = (preparation.medians[name] - center) / own
            rows.append(row)
            place += 2
        return np.array(rows)


def numbers(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)


def level_codes(column: pa.Array, levels: Sequence[str]) -> np.ndarray:
    """The place of each value among the levels; their number for gaps and other values."""
    found = pc.index_in(column.cast(pa.string()), value_set=pa.array(levels, pa.string()))
    return pc.fill_null(found, len(levels)).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass(frozen=True)
class Weights:
    """A linear model of an array of features."""

    weights: tuple[float, ...]
    intercept: float

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def margin(self, features: Column) -> Column:
        terms = (F.lit(weight) * features[place] for place, weight in enumerate(self.weights))
        return sum(terms, F.lit(self.intercept))


def sigmoid(margin: np.ndarray) -> np.ndarray:
    low = np.exp(-np.abs(margin))
    return np.where(margin >= 0, 1 / (1 + low), low / (1 + low))


def _step_sums(base: Any, label: str, weights: Mapping[int, np.ndarray]):
    """Per set: loss, gradient and Gram matrix of the rows outside its fold, in the base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = base.size
        sums = {number: np.zeros(1 + size + size * size) for number in weights}
        bucket = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = batch.column("bucket")[0].as_py()
            x, y = base.matrix(batch), numbers(batch.column(label))
            fold = batch.column("fold").to_numpy()
            for number, weight in weights.items():
                # Rows of the fold count as nothing, which spares a copy of all others.
                inside = (fold != number).astype(float)
                margin = x @ weight
                p = sigmoid(margin)
                total = sums[number]
                total[0] += np.sum(inside * (np.logaddexp(0, margin) - y * margin))
                total[1 : 1 + size] += (inside * (p - y)) @ x
                total[1 + size :] += ((x * (inside * p * (1 - p))[:, None]).T @ x).ravel()
        yield _sum_rows([(number, bucket, total.tobytes()) for number, total in sums.items()])

    return run


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = (pa.int32(), pa.int32(), pa.binary())
    names = ("training_set", "bucket", "sums")
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=list(names)
    )


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(data) for data in table.column("sums").to_pylist())
    row = (table.column("training_set")[0].as_py(), table.column("bucket")[0].as_py(), total.tobytes())
    return pa.Table.from_batches([_sum_rows([row])])


def with_bucket(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))


def fit_logistic(
    rows: DataFrame, base: Any, label: str, maps: Mapping[int, np.ndarray], penalty: float = 1.0
) -> dict[int, tuple[np.ndarray, float]]:
    """Weights and intercept per training set, by Newton's method with halved steps.

    ``maps`` gives each set's constant and features as combinations of the base; the weights
    carry half the penalty times their squares, the intercept none. A set whose rows are all
    of one class gets an endless intercept and no weights.
    """
    table = with_bucket(rows.select("fold", F.col(label).cast("double").alias(label), *base.columns))
    weights = {number: np.zeros(len(own)) for number, own in maps.items()}
    moves: dict[int, np.ndarray] = {}
    losses: dict[int, float] = {}
    found: dict[int, tuple[np.ndarray, float]] = {}
    for _ in range(MOST_STEPS):
        open_sets = {
            number: maps[number].T @ weights[number] for number in maps if number not in found
        }
        if not open_sets:
            break
        partial = table.mapInArrow(_step_sums(base, label, open_sets), SUMS)
        collected = partial.groupBy("training_set", "bucket").applyInArrow(_add_up, SUMS).collect()
        for number in open_sets:
            own = [np.frombuffer(row["sums"]) for row in collected if row["training_set"] == number]
            _newton_step(number, sum(own), maps, weights, moves, losses, found, penalty)
    left = {number for number in maps if number not in found}
    return found | {number: (weights[number][1:], float(weights[number][0])) for number in left}


def _newton_step(number, sums, maps, weights, moves, losses, found, penalty) -> None:
    """Take, halve or end a set's step, given the sums at its weights."""
    own, weight = maps[number], weights[number]
    size = own.shape[1]
    shrink = np.full(len(own), penalty)
    shrink[0] = 0.0
    loss = sums[0] + 0.5 * np.sum(shrink * weight * weight)
    gradient = own @ sums[1 : 1 + size] + shrink * weight
    gram = own @ sums[1 + size :].reshape(size, size) @ own.T + np.diag(shrink)
    before = losses.get(number)
    if before is None:
        # At zero weights the residual is the rate less one half, so this tells the classes.
        rows, residual = 4 * sums[1 + size], sums[1]
        if abs(2 * abs(residual) - rows) < 0.25:
            found[number] = (np.zeros(len(own) - 1), float("-inf") if residual > 0 else float("inf"))
            return
    elif loss > before + 1e-9 * abs(before):
        moves[number] = moves[number] / 2
        weights[number] = weight - moves[number]
        return
    losses[number] = loss
    move = np.linalg.lstsq(gram, -gradient, rcond=None)[0]
    moves[number] = move
    weights[number] = weight + move
    if np.max(np.abs(move)) <= STILL * (1 + np.max(np.abs(weight))):
        found[number] = (weights[number][1:], float(weights[number][0]))


def _square_sums(base: Any, label: str):
    """Gram matrix of the base and the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket = np.zeros((base.size + 1, base.size + 1)), 0
        for batch in batches:
            if batch.num_rows:
                bucket = batch.column("bucket")[0].as_py()
                whole = np.column_stack([base.matrix(batch), numbers(batch.column(label))])
                total += whole.T @ whole
        yield _sum_rows([(0, bucket, total.tobytes())])

    return run


def fit_least_squares(rows: DataFrame, base: Any, label: str) -> Weights:
    """The shortest of the weights with the least squared error, from one aggregate.

    Columns are centred and scaled before solving, so their units do not matter.
    """
    table = with_bucket(rows.select(F.col(label).cast("double").alias(label), *base.columns))
    partial = table.mapInArrow(_square_sums(base, label), SUMS)
    found = partial.groupBy("training_set", "bucket").applyInArrow(_add_up, SUMS).collect()
    gram = sum(np.frombuffer(row["sums"]) for row in found).reshape(base.size + 1, -1)
    mean = gram[0, 1:] / gram[0, 0]
    spread = gram[1:, 1:] / gram[0, 0] - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread)[:-1], 0.0))
    scale[scale <= 1e-9 * np.abs(mean[:-1])] = 0.0
    by = np.where(scale > 0, scale, 1.0)
    held = scale > 0
    inner = np.where(np.outer(held, held), spread[:-1, :-1] / np.outer(by, by), 0.0)
    outer = np.where(held, spread[:-1, -1] / by, 0.0)
    weights = np.linalg.lstsq(inner, outer, rcond=1e-10)[0] / by
    return Weights(tuple(map(float, weights)), float(mean[-1] - weights @ mean[:-1]))


# --- trees ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """A node of a tree: its rows and positives, and how it splits.

    ``feature`` names a number or a category, None in a leaf. Rows go left up to ``cut``, or
    where the category is not ``level``.
    """

    rows: int
    positives: int
    feature: str | None = None
    cut: float | None = None
    level: str | None = None
    gain: float = 0.0

    @property
    def rate(self) -> float:
        return self.positives / self.rows


@dataclass(frozen=True)
class Cuts:
    """The possible cuts of each number and the levels of each category."""

    cuts: Mapping[str, np.ndarray]
    levels: Mapping[str, Sequence[str]]

    def bins(self, feature: str) -> int:
        return len(self.levels[feature]) + 1 if feature in self.levels else len(self.cuts[feature]) + 1

    def codes(self, feature: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each row's bin, and the rows that have a gap there."""
        gaps = np.flatnonzero(column.is_null(nan_is_null=True).to_numpy(zero_copy_only=False))
        if feature in self.levels:
            return level_codes(column, self.levels[feature]), gaps
        return np.searchsorted(self.cuts[feature], numbers(column), "left"), gaps

    def filled(self, feature: str, codes: np.ndarray, gaps: np.ndarray, preparation: Preparation) -> np.ndarray:
        """The bins with gaps filled in as the preparation says."""
        if not len(gaps):
            return codes
        if feature in self.levels:
            code = level_codes(pa.array([preparation.modes[feature]], pa.string()), self.levels[feature])[0]
        else:
            code = np.searchsorted(self.cuts[feature], preparation.medians[feature], "left")
        codes = codes.copy()
        codes[gaps] = code
        return codes


def value_cuts(rows: DataFrame, columns: Sequence[str], most: int) -> dict[str, np.ndarray]:
    """Midpoints between a column's neighbouring values where these are at most ``most``, else
    quantiles."""
    numeric = [F.col(name).cast("double").alias(name) for name in columns]
    long = rows.select(*numeric).unpivot([], list(columns), "feature", "value")
    # Written, as two passes read it.
    counts = materialize(long.where(F.col("value").isNotNull()).select("feature", "value").distinct())
    shares = [place / most for place in range(1, most)]
    # The values of a feature are gathered only up to the bound; the rest goes by quantiles.
    few = F.slice(F.array_sort(F.collect_set("value")), 1, most + 1)
    widths = {row["feature"]: row["count"] for row in counts.groupBy("feature").count().collect()}
    cuts = {name: np.zeros(0) for name in columns}
    narrow = [name for name in columns if widths.get(name, 0) <= most]
    held = counts.where(F.col("feature").isin(narrow)).groupBy("feature").agg(few.alias("values"))
    for row in held.collect():
        values = np.array(row["values"])
        middle = values[:-1] + np.diff(values) / 2
        # Between neighbours in floating point the middle is one of them: cut at the lower.
        cuts[row["feature"]] = np.where(middle < values[1:], middle, values[:-1])
    wide = [name for name in columns if name not in narrow]
    if wide:
        marks = rows.agg(
            *[F.percentile_approx(F.col(name).cast("double"), shares, 10 * most).alias(name) for name in wide]
        ).first()
        cuts |= {name: np.unique(np.array(marks[name])) for name in wide}
    return cuts


def possible_cuts(rows: DataFrame, whole: Preparation) -> Cuts:
    """The cuts of the contract's numbers and the levels of its categories."""
    cuts = value_cuts(rows, NUMERIC_FEATURES, MOST_CUTS)
    return Cuts(cuts, {name: list(whole.categories[name]) for name in CATEGORICAL_FEATURES})


Trees = Mapping[int, Mapping[int, Node]]
FEATURE_ORDER = (*CATEGORICAL_FEATURES, *NUMERIC_FEATURES)
HISTOGRAM = "training_set int, node int, feature int, counts binary"
BEST = "training_set int, node int, feature int, bin int, gain double, left_rows long, left_positives long"


def _nodes_of(batch: pa.RecordBatch, tree: Mapping[int, Node], codes: Mapping[str, np.ndarray], cuts: Cuts) -> np.ndarray:
    """The deepest node of each row; nodes are numbered 1, and 2n and 2n + 1 below n."""
    node = np.ones(batch.num_rows, np.int64)
    for number in sorted(tree):
        split = tree[number]
        if split.feature is None:
            continue
        here = np.flatnonzero(node == number)
        code = codes[split.feature][here]
        if split.feature in cuts.levels:
            right = code == cuts.levels[split.feature].index(split.level)
        else:
            right = code > np.searchsorted(cuts.cuts[split.feature], split.cut, "left")
        node[here] = 2 * number + right
    return node


def _histograms(cuts: Cuts, label: str, preparations: Mapping[int, Preparation], trees: Trees, active):
    """Rows and positives per set, open node, feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths = [cuts.bins(feature) for feature in FEATURE_ORDER]
        totals = {
            number: [np.zeros((2, len(nodes), width), np.int64) for width in widths]
            for number, nodes in active.items()
        }
        for batch in batches:
            if not batch.num_rows:
                continue
            fold = batch.column("fold").to_numpy()
            positive = numbers(batch.column(label)) > 0
            # Bins are found once for all sets; a set only fills its gaps.
            found = {name: cuts.codes(name, batch.column(name)) for name in FEATURE_ORDER}
            for number, nodes in active.items():
                codes = {name: cuts.filled(name, *own, preparations[number]) for name, own in found.items()}
                at = _nodes_of(batch, trees[number], codes, cuts)
                place = np.full(2 * max(max(nodes), int(at.max())), -1)
                place[list(nodes)] = np.arange(len(nodes))
                open_node = np.where(fold != number, place[at], -1)
                inside = open_node >= 0
                hit = inside & positive
                for total, width, name in zip(totals[number], widths, FEATURE_ORDER):
                    key = open_node * width + codes[name]
                    for line, rows in enumerate((inside, hit)):
                        counted = np.bincount(key[rows], minlength=len(nodes) * width)
                        total[line] += counted.reshape(len(nodes), width)
        rows = [
            (number, node, place, np.ascontiguousarray(total[:, at]).tobytes())
            for number, nodes in active.items()
            for place, total in enumerate(totals[number])
            for at, node in enumerate(nodes)
        ]
        columns = list(zip(*rows))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, kinds)],
            names=["training_set", "node", "feature", "counts"],
        )

    return run


def impurity(rows: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """Gini impurity times rows."""
    return 2 * positives * (rows - positives) / np.maximum(rows, 1)


def _best_cut(cuts: Cuts, least_rows: int):
    """The best split of one node by one feature, from the sums of its histograms."""

    def run(table: pa.Table) -> pa.Table:
        feature = FEATURE_ORDER[table.column("feature")[0].as_py()]
        bins = cuts.bins(feature)
        total = sum(np.frombuffer(data, np.int64) for data in table.column("counts").to_pylist())
        rows, positives = total.reshape(2, bins)
        if feature in cuts.levels:
            # Rows of the level go right, all others left.
            left, left_positives = rows.sum() - rows[:-1], positives.sum() - positives[:-1]
        else:
            left, left_positives = np.cumsum(rows)[:-1], np.cumsum(positives)[:-1]
        right, right_positives = rows.sum() - left, positives.sum() - left_positives
        gain = impurity(rows.sum(), positives.sum()) - impurity(left, left_positives)
        gain = gain - impurity(right, right_positives)
        gain = np.where((left >= least_rows) & (right >= least_rows), gain, -1.0)
        # The root's own counts travel with a split that is none.
        best = int(np.argmax(gain)) if len(gain) else -1
        told = (
            [float(gain[best]), int(left[best]), int(left_positives[best])]
            if best >= 0 and gain[best] > 0
            else [-1.0, int(rows.sum()), int(positives.sum())]
        )
        values = [table.column(name)[0].as_py() for name in ("training_set", "node", "feature")]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
        names = ["training_set", "node", "feature", "bin", "gain", "left_rows", "left_positives"]
        return pa.table(
            [pa.array([value], kind) for value, kind in zip([*values, best, *told], kinds)], names=names
        )

    return run


def grow_trees(
    rows: DataFrame, label: str, preparations: Mapping[int, Preparation], whole: Preparation,
    sizes: Mapping[int, tuple[int, int]], depth: int = 4, least_rows: int = 50,
) -> dict[int, dict[int, Node]]:
    """A tree per training set, all grown level by level together.

    ``sizes`` gives each set's rows and positives. A node splits where that lowers the Gini
    impurity most, the first feature and lowest cut on ties.
    """
    cuts = possible_cuts(rows, whole)
    table = rows.select("fold", F.col(label).cast("double").alias(label), *FEATURE_ORDER)
    trees = {number: {1: Node(*sizes[number])} for number in preparations}
    open_nodes = {number: [1] for number in preparations}
    for _ in range(depth):
        active = {
            number: own
            for number, nodes in open_nodes.items()
            if (own := [node for node in nodes if _may_split(trees[number][node], least_rows)])
        }
        if not active:
            break
        made = _histograms(cuts, label, preparations, trees, active)
        best = (
            table.mapInArrow(made, HISTOGRAM)
            .groupBy("training_set", "node", "feature")
            .applyInArrow(_best_cut(cuts, least_rows), BEST)
            .collect()
        )
        open_nodes = {number: [] for number in preparations}
        for number, nodes in active.items():
            for node in nodes:
                own = [
                    row for row in best
                    if row["training_set"] == number and row["node"] == node and row["gain"] > 1e-9
                ]
                if own:
                    row = min(own, key=lambda row: (-round(row["gain"], 9), row["feature"]))
                    open_nodes[number] += _split(trees[number], node, row, cuts)
    return trees


def _may_split(node: Node, least_rows: int) -> bool:
    return node.rows >= 2 * least_rows and 0 < node.positives < node.rows


def _split(tree: dict[int, Node], number: int, row: Any, cuts: Cuts) -> list[int]:
    """Split a node and give the numbers of its children."""
    node, feature = tree[number], FEATURE_ORDER[row["feature"]]
    level = cuts.levels[feature][row["bin"]] if feature in cuts.levels else None
    cut = None if level is not None else float(cuts.cuts[feature][row["bin"]])
    tree[number] = Node(node.rows, node.positives, feature, cut, level, row["gain"])
    left = Node(row["left_rows"], row["left_positives"])
    tree[2 * number] = left
    tree[2 * number + 1] = Node(node.rows - left.rows, node.positives - left.positives)
    return [2 * number, 2 * number + 1]


def set_sizes(rows: DataFrame, label: str, sets: Sequence[int]) -> dict[int, tuple[int, int]]:
    """Rows and positives of each training set."""
    per_fold = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    told = [(row["fold"], row["rows"], row["positives"]) for row in per_fold.collect()]
    return {
        number: (
            sum(rows for fold, rows, _ in told if fold != number),
            sum(positives for fold, _, positives in told if fold != number),
        )
        for number in sets
    }


