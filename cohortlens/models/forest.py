"""Fully grown trees and forests without shipping them to every task.

While a node holds more rows than a task takes, all trees grow together, level by level: one
pass makes the histograms of all open nodes. A node that fits goes out whole: each batch of
rows is packed once per tree and node, and the task that gets them grows the rest of the
subtree on exact values, to the last pure leaf, and scores the test rows that fall there at
once. Nothing but the few nodes above is ever sent to tasks or the driver, however deep the
trees are; what comes back are sums per test row and impurity shares per feature.

Rows are drawn with replacement by a Poisson weight that hashes row, tree and seed, so a
repeated task draws the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.models.boosting import Layout, in_blocks
from cohortlens.models.together import numbers
from cohortlens.session import materialize

#: Rows of a node (with their draws' weights) that one task grows to the leaves. The levels above
#: have about twice as many nodes as a tree has such parts.
LOCAL_ROWS = 500_000
#: Cuts per feature of the upper levels, and bytes of the histograms that a task holds in a pass.
UPPER_CUTS, PASS_BYTES = 256, 1 << 26
#: Rows of a block of bins, of a block of packed rows, and of a block whose scores are added up.
CODED_ROWS, PACKED_ROWS, SCORED_ROWS = 1 << 15, 1 << 17, 1 << 14
#: Counters that a split of a level takes for a feature at most; beyond them values are sorted.
SORTED_AT_ONCE = 1 << 20
#: Draws of a row above which the Poisson table ends.
MOST_DRAWS = 16
TRAINING, TEST = 0, 1

CODED = "lots binary, labels binary, codes binary"
PACKED = "tree int, node long, chunk long, part int, block long, kinds string, rows binary, weights binary, ids binary"
GROWN = "block long, tree int, places binary, told binary, ids binary"


@dataclass(frozen=True)
class Shape:
    """How a forest grows. ``classes`` is 0 for regression; ``subset`` are the features tried
    at a node, and ``draw`` says whether a tree draws its rows."""

    trees: int
    depth: int
    features: int
    classes: int
    subset: int
    seed: int
    draw: bool = True
    local_rows: int = LOCAL_ROWS

    @property
    def width(self) -> int:
        """Numbers that a leaf predicts: a mean, or a share per class."""
        return self.classes or 1


@dataclass(frozen=True)
class Forest:
    """What is known of a fitted forest."""

    importances: tuple[float, ...]
    nodes: int

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name other models use
        return DenseVector(self.importances)


@dataclass
class Split:
    """An inner node of the upper levels, or a leaf of them where ``feature`` is None; ``place``
    is that of the cut among those of the feature."""

    feature: int | None
    cut: float
    value: np.ndarray
    place: int = 0


def _poisson_table() -> np.ndarray:
    terms = np.cumprod(np.concatenate([[1.0], 1.0 / np.arange(1, MOST_DRAWS + 1)]))
    return np.cumsum(terms * np.exp(-1.0))


_DRAWS = _poisson_table()
#: The table in the whole numbers that a hash's upper 53 bits are, and the draws that their first
#: 12 bits tell; -1 where these do not suffice.
_EDGES = np.ceil(_DRAWS * float(1 << 53)).astype(np.uint64)
_ENDS = [np.searchsorted(_EDGES, (np.arange(1 << 12, dtype=np.uint64) << np.uint64(41)) + np.uint64(end), "right")
         for end in (0, (1 << 41) - 1)]
_TOLD = np.where(_ENDS[0] == _ENDS[1], _ENDS[0], -1).astype(np.int8)


def draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean 1, from a hash of both."""
    mixed = ids.astype(np.uint64)
    mixed += np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    mixed ^= np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed ^= mixed >> np.uint64(shift)
        mixed *= np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    mixed >>= np.uint64(11)
    drawn = _TOLD.take((mixed >> np.uint64(41)).astype(np.int64))
    unsure = np.flatnonzero(drawn < 0)
    drawn[unsure] = np.searchsorted(_EDGES, mixed[unsure], "right")
    return drawn


# --- impurity ------------------------------------------------------------------------


def _value(shape: Shape, weight: float, sums: np.ndarray) -> np.ndarray:
    return sums / weight


# --- a subtree on exact values -----------------------------------------------------------


@dataclass
class Subtree:
    """Flat arrays, level by level; ``feature`` is -1 in a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gains: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        open_rows = np.flatnonzero(self.feature[at] >= 0)
        while len(open_rows):
            node = at[open_rows]
            low = x[open_rows, self.feature[node]] <= self.cut[node]
            at[open_rows] = np.where(low, self.left[node], self.right[node])
            open_rows = open_rows[self.feature[at[open_rows]] >= 0]
        return self.value[at]


def _firsts(sorted_keys: np.ndarray) -> np.ndarray:
    """The place where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def _by_value(shape: Shape, key: np.ndarray, cells: int, weight: np.ndarray, target: np.ndarray):
    """Weight and target sums of each key that occurs, keys ascending: by counters where these
    are few, else by sorting. ``weight`` holds whole numbers; a value comes times its weight."""
    width = shape.width
    if cells * width <= min(8 * len(key), SORTED_AT_ONCE):
        if shape.classes:
            sums = np.bincount(key * width + target, weight, cells * width).reshape(-1, width)
            held = reduce(np.add, sums.T)
        else:
            held = np.bincount(key, weight, cells)
            sums = np.bincount(key, target, cells)[:, None]
        found = np.flatnonzero(held)
        return found, held[found], sums[found]
    if shape.classes:
        # Key, class and weight in one number, which sorts faster than places do.
        low, high = (MOST_DRAWS + 1).bit_length(), (width - 1).bit_length()
        packed = key << high
        packed |= target
        packed <<= low
        packed |= weight.astype(np.int64)
        packed.sort()
        weight = (packed & ((1 << low) - 1)).astype(np.float64)
        packed >>= low
        target = packed & ((1 << high) - 1)
        key = packed >> high
    else:
        # Key and place in one number; places keep the order of the rows in a key.
        low = (len(key) - 1).bit_length()
        if cells.bit_length() + low < 63:
            packed = key << low
            packed |= np.arange(len(key))
            packed.sort()
            order = packed & ((1 << low) - 1)
        else:
            order = np.argsort(key, kind="stable")
        key, weight, target = key.take(order), weight.take(order), target.take(order)
    starts = np.empty(len(key), bool)
    starts[0] = True
    np.not_equal(key[1:], key[:-1], out=starts[1:])
    begins = np.flatnonzero(starts)
    held = np.add.reduceat(weight, begins)
    if shape.classes:
        run = np.cumsum(starts)
        run -= 1
        sums = np.bincount(run * width + target, weight, len(begins) * width).reshape(-1, width)
    else:
        sums = np.add.reduceat(target, begins)[:, None]
    return key[begins], held, sums


def _cut_gains(shape: Shape, weight: np.ndarray, sums: np.ndarray, held: np.ndarray, left: np.ndarray) -> np.ndarray:
    """What cuts with ``held`` and ``left`` on their left take from the loss of their nodes."""
    rest = weight - held
    if shape.classes:
        squares = [np.einsum("ij,ij->i", part, part) for part in (left, sums - left, sums)]
        return squares[0] / held + squares[1] / rest - squares[2] / weight
    # Values are distances from their node's mean.
    return left[:, 0] ** 2 * weight / (held * rest)


@dataclass
class _Best:
    """The best split of each node so far; ``place`` settles ties between features."""

    gain: np.ndarray
    place: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def none(cls, nodes: int) -> _Best:
        ends = [np.zeros(nodes, np.int64) for _ in range(2)]
        return cls(np.full(nodes, -np.inf), np.full(nodes, np.inf), np.full(nodes, -1), *ends)

    def take(self, node, gain, place, feature, low, high) -> None:
        better = (gain > self.gain[node]) | ((gain == self.gain[node]) & (place < self.place[node]))
        node = node[better]
        self.gain[node], self.place[node], self.feature[node] = gain[better], place[better], feature[better]
        self.low[node], self.high[node] = low[better], high[better]


def _codes(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column in order, and the place of each row's value among them."""
    if column.dtype.kind == "i" and len(column):
        low = int(column.min())
        span = int(column.max()) - low + 1
        if span <= max(1 << 16, 2 * len(column)):
            off = column.astype(np.int64)
            off -= low
            held = np.zeros(span, bool)
            held[off] = True
            values = np.flatnonzero(held)
            codes = (np.cumsum(held) - 1).astype(_code_kind(len(values))).take(off)
            return (values + low).astype(np.float64), codes
    values, codes = np.unique(column, return_inverse=True)
    return values.astype(np.float64), codes.ravel().astype(_code_kind(len(values)))


def _code_kind(count: int) -> type:
    return np.uint8 if count <= 1 << 8 else np.uint16 if count <= 1 << 16 else np.int32


class _Codes:
    """The codes of all rows, a line per feature in the narrowest type, and the widths."""

    def __init__(self, columns: Sequence[np.ndarray]) -> None:
        self.values, codes = zip(*[_codes(column) for column in columns])
        self.widths = np.array([len(own) for own in self.values])
        self.lines = np.array(codes)
        self.rows = self.lines.shape[1]
        self.flat = self.lines.ravel()

    def of(self, feature: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The code of each row for the feature of its node."""
        if (feature == feature[0]).all():
            return self.lines[feature[0]].take(rows)
        place = (feature * self.rows).take(at)
        place += rows
        return self.flat.take(place)


def _try_features(shape: Shape, codes: _Codes, feature, place, at, rows, weight, target, totals, sums, best, names) -> None:
    """Split each node by one feature of its own, where that is better than its ``best``; the
    counters of all nodes lie one after another. ``names`` are the nodes' places in ``best``."""
    widths = codes.widths[feature]
    ends = np.cumsum(widths)
    start, cells = ends - widths, int(ends[-1])
    key = start.take(at)
    key += codes.of(feature, at, rows)
    found, held, part = _by_value(shape, key, cells, weight, target)
    node = np.searchsorted(ends, found, "right") if cells > 4 * len(found) else np.repeat(np.arange(len(widths)), widths)[found]
    gaps = np.flatnonzero(node[1:] == node[:-1])
    if not len(gaps):
        return
    code = found - start[node]
    # Sums from a node's first value on; up to a gap they are its left side.
    begins = _firsts(node)
    run = np.repeat(begins, np.diff(begins, append=len(node)))[gaps]
    above, left = np.cumsum(held), np.cumsum(part, axis=0)
    above = above[gaps] - (above - held)[run]
    left = left[gaps] - (left - part)[run]
    owner = node[gaps]
    gain = _cut_gains(shape, totals[owner], sums[owner], above, left)
    begins = _firsts(owner)
    top = np.maximum.reduceat(gain, begins)
    reached = np.flatnonzero(gain == np.repeat(top, np.diff(begins, append=len(owner))))
    reached = reached[_firsts(owner[reached])]
    chosen, cut = owner[reached], gaps[reached]
    best.take(names[chosen], gain[reached], place[chosen], feature[chosen], code[cut], code[cut + 1])


def _level_splits(shape: Shape, codes: _Codes, at, rows, weight, target, totals, sums, generator) -> _Best:
    """The best split of every node of a level over a random subset of features each; over the
    others where none of the subset splits."""
    nodes, best = len(totals), _Best.none(len(totals))
    names = np.arange(nodes)
    if shape.subset >= shape.features:
        place = np.broadcast_to(np.arange(shape.features, dtype=float), (nodes, shape.features))
        order = np.broadcast_to(np.arange(shape.features), (nodes, shape.features))
    else:
        place = generator.random((nodes, shape.features))
        order = np.argsort(place, axis=1)
    for turn in range(min(shape.subset, shape.features)):
        own = np.ascontiguousarray(order[:, turn])
        _try_features(shape, codes, own, place[names, own], at, rows, weight, target, totals, sums, best, names)
    waiting = np.flatnonzero(best.feature < 0)
    if len(waiting) and shape.subset < shape.features:
        number = np.full(nodes, -1)
        number[waiting] = np.arange(len(waiting))
        at = number.take(at)
        here = np.flatnonzero(at >= 0)
        held = (at[here], rows[here], weight[here], target[here], totals[waiting], sums[waiting])
        for turn in range(shape.subset, shape.features):
            own = order[waiting, turn]
            _try_features(shape, codes, own, place[waiting, own], *held, best, waiting)
    return best


def grow_subtree(
    shape: Shape, x: np.ndarray | Sequence[np.ndarray], labels: np.ndarray, weight: np.ndarray, depth: int,
    key: Sequence[int],
) -> Subtree:
    """Grow to pure leaves or ``depth`` levels; ``key`` seeds the choice of features. ``x`` is a
    matrix or its columns.

    All nodes of a level are split together, on the places of exact values in their order, so
    the work goes with rows and levels and not with nodes. Codes stay where they are: a level
    keeps the numbers of the rows that are not in leaves.
    """
    generator = np.random.default_rng([shape.seed, *key])
    codes = _Codes(x.T if isinstance(x, np.ndarray) else x)
    values, weight, rows = codes.values, weight.astype(np.float64), np.arange(codes.rows)
    # Values far from zero lose their digits in sums.
    base = 0.0 if shape.classes else float(np.average(labels, weights=weight))
    target = labels.astype(np.int64) if shape.classes else labels - base
    at, count, nodes = np.zeros(codes.rows, np.int64), 1, 0
    gains, levels = np.zeros(shape.features), []
    for level in range(depth + 1):
        totals = np.bincount(at, weight, count)
        if shape.classes:
            sums = np.bincount(at * shape.classes + target, weight, count * shape.classes)
        else:
            sums = np.bincount(at, weight * target, count)
        sums = sums.reshape(count, -1)
        mean = sums / totals[:, None]
        if shape.classes:
            impure = np.count_nonzero(sums, axis=1) > 1
        else:
            first = np.zeros(count, target.dtype)
            first[at] = target
            impure = np.bincount(at[target != first[at]], minlength=count) > 0
        feature, cut, child = np.full(count, -1), np.zeros(count), np.zeros(count, np.int64)
        told = (feature, cut, child, mean if shape.classes else mean + base)
        levels.append(told)
        nodes += count
        if level == depth or not impure.any():
            break
        if not impure.all():
            held = np.flatnonzero(impure[at])
            at, rows, weight, target = at[held], rows[held], weight[held], target[held]
            at = (np.cumsum(impure) - 1).take(at)
        centred = target if shape.classes else weight * (target - mean[impure, 0][at])
        whole = sums[impure] if shape.classes else np.zeros((int(impure.sum()), 1))
        best = _level_splits(shape, codes, at, rows, weight, centred, totals[impure], whole, generator)
        able = best.feature >= 0
        if not able.any():
            break
        split = np.flatnonzero(impure)[able]
        feature[split] = best.feature[able]
        for own in np.unique(feature[split]):
            picked = np.flatnonzero(able & (best.feature == own))
            low, high = values[own][best.low[picked]], values[own][best.high[picked]]
            middle = low + (high - low) / 2
            # Between neighbours in floating point the middle is one of them: cut at the lower.
            cut[np.flatnonzero(impure)[picked]] = np.where(middle < high, middle, low)
        gains += np.bincount(best.feature[able], np.maximum(best.gain[able], 0.0), shape.features)
        child[split] = nodes + 2 * np.arange(len(split))
        if not able.all():
            held = np.flatnonzero(able[at])
            at, rows, weight, target = at[held], rows[held], weight[held], target[held]
        right = codes.of(best.feature, at, rows) > best.low.take(at)
        at, count = (2 * (np.cumsum(able) - 1)).take(at) + right, 2 * len(split)
    feature, cut, left, value = (np.concatenate(parts) for parts in zip(*levels))
    return Subtree(feature, cut, left, left + 1, value, gains)


# --- upper levels ------------------------------------------------------------------------

Upper = Mapping[int, Mapping[int, Split]]


@dataclass(frozen=True)
class Paths:
    """The upper levels of a tree as steps that move rows from a slot on, in turn.

    A step takes the rows of a slot that lie above the cut of a feature to a new slot; the
    others stay. ``ends`` is the node below the upper levels of each slot; 1 where there are none.
    """

    steps: list[tuple[int, int, int, float, int]]
    ends: np.ndarray

    @classmethod
    def of(cls, tree: Mapping[int, Split]) -> Paths:
        slots, ends, steps = {1: 0}, [1], []
        for number in sorted(tree):
            split = tree[number]
            if split.feature is not None:
                slot, new = slots[number], len(ends)
                steps.append((slot, new, split.feature, split.cut, split.place))
                slots[2 * number], slots[2 * number + 1] = slot, new
                ends[slot] = 2 * number
                ends.append(2 * number + 1)
        return cls(steps, np.array(ends, np.int64))

    def slots(self, columns: Sequence[np.ndarray], coded: bool = False) -> np.ndarray:
        """The slot of each row, from values or their bins, a line per feature."""
        count = len(self.ends)
        slot = np.zeros(len(columns[0]), np.uint8 if count <= 1 << 8 else np.uint16 if count <= 1 << 16 else np.int32)
        for own, new, feature, cut, place in self.steps:
            above = columns[feature] > (columns[feature].dtype.type(place) if coded else cut)
            above &= slot == slot.dtype.type(own)
            slot += above * slot.dtype.type(new - own)
        return slot


def _batch(batch: pa.RecordBatch, shape: Shape) -> tuple[np.ndarray, ...]:
    flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
    return (
        batch.column("id").to_numpy(),
        batch.column("lot").to_numpy(),
        numbers(batch.column("label")),
        flat.reshape(-1, shape.features),
        batch.column("part").to_numpy(),
    )


def _weights(shape: Shape, lots: np.ndarray, tree: int) -> np.ndarray:
    return draws(lots, tree, shape.seed) if shape.draw else np.ones(len(lots), np.int8)


def _coder(shape: Shape, cuts: Sequence[np.ndarray]):
    """Lots, labels and bins of the training rows, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, CODED_ROWS):
            _, lots, labels, x, _ = _batch(batch, shape)
            codes = np.array([np.searchsorted(own, x[:, place], "left") for place, own in enumerate(cuts)], np.uint8)
            yield _table([(lots.tobytes(), labels.tobytes(), codes.tobytes())], CODED)

    return run


def _histograms(shape: Shape, layout: Layout, upper: Upper, nodes: Mapping[int, Sequence[int]]):
    """Per tree the weight of each class, or weight and target sums, per feature, open node and bin."""
    sums = shape.classes or 2
    paths = {tree: Paths.of(upper[tree]) for tree in nodes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {tree: [np.zeros(sums * len(own) * cells) for cells in layout.cells] for tree, own in nodes.items()}
        opened = {}
        for tree, own in nodes.items():
            number = {node: place for place, node in enumerate(own)}
            opened[tree] = np.array([number.get(node, -1) for node in paths[tree].ends.tolist()])
        for batch in batches:
            for at in range(batch.num_rows):
                lots, labels, codes = (batch.column(place)[at].as_buffer() for place in range(3))
                lots, labels = np.frombuffer(lots, np.int64), np.frombuffer(labels)
                codes = np.frombuffer(codes, np.uint8).reshape(shape.features, -1)
                lines = layout.shared(codes)
                told = labels.astype(np.int64) if shape.classes else labels
                for tree, own in nodes.items():
                    weight = _weights(shape, lots, tree)
                    node = opened[tree].take(paths[tree].slots(codes, coded=True))
                    here = np.flatnonzero((weight > 0) & (node >= 0))
                    node, weight, target = node[here], weight[here].astype(np.float64), told[here]
                    weighted = None if shape.classes else weight * target
                    for cells, line, total in zip(layout.cells, lines, totals[tree]):
                        key = node * cells
                        key += line.take(here)
                        if shape.classes:
                            key *= sums
                            key += target
                            total += np.bincount(key, weight, len(total))
                        else:
                            half = len(total) // 2
                            total[:half] += np.bincount(key, weight, half)
                            total[half:] += np.bincount(key, weighted, half)
        yield _table([(tree, _by_feature(layout, own, nodes[tree], shape)) for tree, own in totals.items()], UPPER_SUMS)

    return run


def _by_feature(layout: Layout, totals: Sequence[np.ndarray], nodes: Sequence[int], shape: Shape) -> bytes:
    """The sums of each feature: lines of sums, nodes and bins."""
    if shape.classes:
        held = [np.moveaxis(own.reshape(len(nodes), -1, shape.classes), 2, 0) for own in totals]
    else:
        held = [own.reshape(2, len(nodes), -1) for own in totals]
    return np.concatenate([own.ravel() for own in layout.apart(held)]).tobytes()


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string()}
    fields = [(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


UPPER_SUMS = "tree int, sums binary"
UPPER_BEST = "tree int, node long, feature int, gain double, place int, weight double, whole binary, left double"


def _upper_best(shape: Shape, layout: Layout, nodes: Mapping[int, Sequence[int]]):
    """The best cut of each feature at each open node of a tree."""

    def run(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        own, begin, rows = nodes[tree], 0, []
        sums = sum(np.frombuffer(data) for data in table.column("sums").to_pylist())
        for feature, width in enumerate(layout.widths):
            end = begin + (shape.classes or 2) * len(own) * width
            found, begin = sums[begin:end].reshape(-1, len(own), width), end
            for number, node in enumerate(own):
                told = found[:, number]
                weight, told = (told.sum(axis=0), told) if shape.classes else (told[0], told[1:])
                rows.append((tree, node, feature, *_best_upper_cut(shape, weight, told)))
        return pa.Table.from_batches([_table(rows, UPPER_BEST)])

    return run


def _best_upper_cut(shape: Shape, weight: np.ndarray, sums: np.ndarray) -> tuple:
    """Gain and place of the best cut by bins, the node's weight and sums, the weight on the left."""
    whole, total = weight.sum(), sums.sum(axis=1)
    held, left = np.cumsum(weight)[:-1], np.cumsum(sums, axis=1)[:, :-1]
    able = np.flatnonzero((held > 0) & (held < whole))
    if not len(able):
        return -1.0, 0, float(whole), total.tobytes(), 0.0
    held, left = held[able], left[:, able].T
    if not shape.classes:
        # Distances from the node's mean, as values far from zero lose their digits.
        left = left - held[:, None] * (total / whole)
    count = len(able)
    gain = _cut_gains(shape, np.full(count, whole), np.broadcast_to(total, (count, len(total))), held, left)
    best = int(np.argmax(gain))
    return float(gain[best]), int(able[best]), float(whole), total.tobytes(), float(held[best])


def _grow_upper(rows: DataFrame, shape: Shape) -> tuple[dict[int, dict[int, Split]], np.ndarray]:
    """Splits of nodes with more rows than a task takes, for all trees together, and what
    their features gained. Without such nodes no pass is made."""
    upper: dict[int, dict[int, Split]] = {tree: {} for tree in range(shape.trees)}
    gains = np.zeros((shape.trees, shape.features))
    training = rows.where(F.col("part") == TRAINING)
    if training.count() <= shape.local_rows:
        return upper, gains
    cuts = _feature_cuts(rows, shape)
    layout = Layout.of(cuts)
    coded = materialize(
        training.mapInArrow(_coder(shape, cuts), CODED).repartition(rows.sparkSession.sparkContext.defaultParallelism)
    )
    # Nodes whose counters a task holds at once.
    most = max(1, PASS_BYTES // (8 * (shape.classes or 2) * sum(layout.cells)))
    nodes = {tree: [1] for tree in range(shape.trees)}
    for _ in range(shape.depth):
        waiting = [(tree, node) for tree, own in nodes.items() for node in own]
        nodes = {tree: [] for tree in range(shape.trees)}
        level = {tree: dict(own) for tree, own in upper.items()}
        for start in range(0, len(waiting), most):
            taken = waiting[start : start + most]
            active: dict[int, list[int]] = {}
            for tree, node in taken:
                active.setdefault(tree, []).append(node)
            made = coded.mapInArrow(_histograms(shape, layout, level, active), UPPER_SUMS)
            best = made.groupBy("tree").applyInArrow(_upper_best(shape, layout, active), UPPER_BEST)
            found: dict[tuple[int, int], list] = {}
            for row in best.collect():
                found.setdefault((row["tree"], row["node"]), []).append(row)
            for tree, node in taken:
                nodes[tree] += _split_upper(shape, cuts, upper, gains, tree, node, found[tree, node])
    return upper, gains


def _split_upper(shape, cuts, upper, gains, tree, node, found) -> list[int]:
    """Split an upper node by the best tried feature; its children that are still too large."""
    weight = found[0]["weight"]
    value = _value(shape, weight, np.frombuffer(found[0]["whole"]))
    generator = np.random.default_rng([shape.seed, tree, node])
    shuffled = generator.permutation(shape.features).tolist()
    order = sorted(found, key=lambda row: shuffled.index(row["feature"]))
    chosen = None
    for tried in (order[: shape.subset], order[shape.subset :]):
        able = [row for row in tried if row["gain"] > 1e-12 * max(1.0, weight)]
        if able:
            chosen = max(able, key=lambda row: (row["gain"], -row["feature"]))
            break
    if chosen is None:
        # Rows that no cut tells apart: a leaf, however many they are.
        upper[tree][node] = Split(None, 0.0, value)
        return []
    feature, place = chosen["feature"], chosen["place"]
    upper[tree][node] = Split(feature, float(cuts[feature][place]), value, place)
    gains[tree, feature] += chosen["gain"]
    sides = ((2 * node, chosen["left"]), (2 * node + 1, weight - chosen["left"]))
    return [child for child, held in sides if held > shape.local_rows]


def _feature_cuts(rows: DataFrame, shape: Shape) -> list[np.ndarray]:
    """Quantiles of each feature as the possible cuts of the upper levels."""
    shares = [place / UPPER_CUTS for place in range(1, UPPER_CUTS)]
    marks = rows.where(F.col("part") == TRAINING).agg(
        *[F.percentile_approx(F.col("features")[place], shares, 10 * UPPER_CUTS) for place in range(shape.features)]
    )
    return [np.unique(np.array(found)) for found in marks.first()]


# --- subtrees ------------------------------------------------------------------------------


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest type that holds them exactly."""
    for kind in "bhif":
        with np.errstate(invalid="ignore", over="ignore"):
            small = values.astype(kind)
        if np.array_equal(small, values):
            return small
    return values


def _records(columns: Sequence[np.ndarray]) -> np.ndarray:
    """The columns side by side, so that a row is moved as one."""
    rows = np.empty(len(columns[0]), _record(" ".join(own.dtype.char for own in columns)))
    for name, own in zip(rows.dtype.names, columns):
        rows[name] = own
    return rows


def _record(kinds: str) -> np.dtype:
    return np.dtype([(f"c{place}", kind) for place, kind in enumerate(kinds.split())])


def _kinds(rows: np.ndarray) -> str:
    return " ".join(rows.dtype[place].char for place in range(len(rows.dtype)))


def _packer(shape: Shape, upper: Upper):
    """The rows of a block, packed once per tree and node: training rows with features, label and
    for values their lot, test rows with features and place in their block of scores."""
    paths = {tree: Paths.of(own) for tree, own in upper.items()}

    def pieces(tree: int, slot: np.ndarray, here: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Tree, node below the upper levels and rows of each slot that has any."""
        slot = slot[here]
        order = here[np.argsort(slot, kind="stable")]
        ends = np.cumsum(np.bincount(slot, minlength=len(paths[tree].ends)))
        for node, end, begin in zip(paths[tree].ends.tolist(), ends, np.append(0, ends)):
            if end > begin:
                yield tree, node, order[begin:end]

    def train(lots, labels, x) -> Iterator[tuple]:
        columns = [np.ascontiguousarray(own) for own in x.T]
        order = [] if shape.classes else [lots]
        rows = _records([*[_narrow(own) for own in columns], _narrow(labels), *order])
        kinds = _kinds(rows)
        for tree, own in paths.items():
            weight = _weights(shape, lots, tree)
            for _, node, here in pieces(tree, own.slots(columns), np.flatnonzero(weight)):
                if node not in upper[tree]:
                    told = (rows[here].tobytes(), weight[here].tobytes(), b"")
                    yield tree, node, 0, TRAINING, 0, kinds, *told

    def score(ids, x) -> Iterator[tuple]:
        columns = [np.ascontiguousarray(own) for own in x.T]
        rows = _records([*[_narrow(own) for own in columns], np.arange(len(ids)).astype(np.uint16)])
        kinds, block = _kinds(rows), int(ids[0])
        for tree, own in paths.items():
            for _, node, here in pieces(tree, own.slots(columns), np.arange(len(ids))):
                # Test rows in a leaf of the upper levels need not come together.
                chunk = block if node in upper[tree] else 0
                known = ids[here].tobytes() if tree == 0 else b""
                yield tree, node, chunk, TEST, block, kinds, rows[here].tobytes(), b"", known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, PACKED_ROWS):
            ids, lots, labels, x, part = _batch(batch, shape)
            own = part == TRAINING
            if own.any():
                yield from _tables(train(lots[own], labels[own], x[own]), PACKED)
            ids, x = ids[~own], x[~own]
            for begin in range(0, len(ids), SCORED_ROWS):
                here = slice(begin, begin + SCORED_ROWS)
                yield from _tables(score(ids[here], x[here]), PACKED)

    return run


def _tables(rows: Iterator[tuple], ddl: str, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Tables of so many bytes, or little more."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(own) for own in row if isinstance(own, bytes))
        if size > most:
            yield _table(held, ddl)
            held, size = [], 0
    if held:
        yield _table(held, ddl)


def _grower(shape: Shape, upper: Upper):
    """Grow a node's subtree and score its test rows; last a row with its gains and nodes."""

    def run(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        held = table.select(["part", "block", "kinds", "rows", "weights", "ids"]).to_pylist()
        known = [row for row in held if row["part"] == TRAINING]
        asked = [row for row in held if row["part"] == TEST]
        asked = [(row, np.frombuffer(row["rows"], _record(row["kinds"]))) for row in asked]
        split, rows = upper[tree].get(node), []
        value = None
        if split is not None:
            value = split.value
        elif not known:
            # No row was drawn here, so the node above speaks.
            above = upper[tree].get(node // 2)
            value = above.value if above is not None else np.full(shape.width, np.nan)
        else:
            packed = [np.frombuffer(row["rows"], _record(row["kinds"])) for row in known]
            weight = np.concatenate([np.frombuffer(row["weights"], np.int8) for row in known])
            columns = [np.concatenate([own[name] for own in packed]) for name in packed[0].dtype.names]
            *columns, labels = columns if shape.classes else columns[:-1]
            if not shape.classes:
                # Batches arrive in any order; sums follow the rows' own. Those of classes are whole.
                order = np.lexsort((labels, np.concatenate([own[packed[0].dtype.names[-1]] for own in packed])))
                columns, labels, weight = [own[order] for own in columns], labels[order], weight[order]
            depth = shape.depth - (node.bit_length() - 1)
            grown = grow_subtree(shape, columns, labels.astype(np.float64), weight, depth, (tree, node))
            gains = np.append(grown.gains, len(grown.feature))
            rows.append((-1 - tree, tree, b"", gains.tobytes(), b""))
        for row, own in asked:
            *columns, place = [own[name] for name in own.dtype.names]
            if value is not None:
                told = np.repeat(value[None, :], len(own), axis=0)
            else:
                told = grown.predict(np.stack(columns, axis=1))
            told = np.ascontiguousarray(told, np.float64)
            rows.append((row["block"], tree, place.tobytes(), told.tobytes(), row["ids"]))
        return pa.Table.from_batches([_table(rows, GROWN)])

    return run


SCORED = "id long, tree int, told array<double>"


def _add_up(shape: Shape):
    """The mean scores of a block of test rows over the trees, or the sums of a tree's gains."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        # Sums follow the order of the trees.
        held = sorted(table.to_pylist(), key=lambda row: row["tree"])
        if block < 0:
            # Subtrees arrive in any order; their sums do not depend on it.
            parts = np.sort([np.frombuffer(row["told"]) for row in held], axis=0)
            return _lists(None, held[0]["tree"], parts.sum(axis=0)[None, :])
        first = [row for row in held if row["ids"]]
        count = sum(len(row["ids"]) // 8 for row in first)
        ids, told = np.zeros(count, np.int64), np.zeros((count, shape.width))
        for row in first:
            ids[np.frombuffer(row["places"], np.uint16)] = np.frombuffer(row["ids"], np.int64)
        for row in held:
            told[np.frombuffer(row["places"], np.uint16)] += np.frombuffer(row["told"]).reshape(-1, shape.width)
        return _lists(ids, None, told / float(shape.trees))

    return run


def _lists(ids: np.ndarray | None, tree: int | None, told: np.ndarray) -> pa.Table:
    ends = np.arange(len(told) + 1, dtype=np.int32) * told.shape[1]
    columns = [
        pa.nulls(len(told), pa.int64()) if ids is None else pa.array(ids),
        pa.array([tree] * len(told), pa.int32()),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(told.ravel())),
    ]
    return pa.table(columns, names=["id", "tree", "told"])


def fit_and_score(rows: DataFrame, shape: Shape) -> tuple[DataFrame, Forest]:
    """Scores of the test rows of ``(id, lot, part, label, features)``, and the forest's summary.

    ``id`` tells rows apart, from 0 on; ``lot`` decides when a row is drawn and orders the training rows. Gives
    ``id`` and ``scores``, the mean over the trees: a value, or a share per class.
    Importances are those of the trees, each with sum 1, averaged.
    """
    upper, above = _grow_upper(rows, shape)
    found = materialize(
        rows.mapInArrow(_packer(shape, upper), PACKED)
        .groupBy("tree", "node", "chunk")
        .applyInArrow(_grower(shape, upper), GROWN)
        .groupBy("block")
        .applyInArrow(_add_up(shape), SCORED)
    )
    scores = found.where(F.col("id").isNotNull()).select("id", F.col("told").alias("scores"))
    gains, nodes = above, sum(len(own) for own in upper.values())
    for row in found.where(F.col("id").isNull()).collect():
        gains[row["tree"]] += row["told"][:-1]
        nodes += int(row["told"][-1])
    totals = gains.sum(axis=1, keepdims=True)
    shares = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0)
    mean = shares.mean(axis=0)
    return scores, Forest(tuple(map(float, mean / (mean.sum() or 1.0))), nodes)
