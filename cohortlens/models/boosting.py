"""Boosted trees of several classes fitted side by side, one pass of the rows per level.

Each class is told from the rest by logistic boosting: the first tree is fitted to the labels
(-1 and 1), each further one, shrunk by the step, to the gradient of the loss. A level of the
trees of all classes takes one aggregate of histograms. Rows are packed once, in blocks of
bins, and carry the margins of earlier rounds, which are written anew every few rounds; a pass
adds the trees since then. Features of few bins are counted together and told apart after.

Only histograms reach the driver, added up to a bounded number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.models.together import BUCKETS, numbers, value_cuts, with_bucket
from cohortlens.session import materialize

#: Rounds after which the margins of the rows are written.
KEPT_ROUNDS = 10
#: Gain below which a cut is none, relative to the rows of a node.
LEAST_GAIN = 1e-12
#: Counters that features of few bins share.
SHARED_CELLS = 1024
#: Rows of a block, but for a task's last.
BLOCK_ROWS = 1 << 15

PACKED = "labels binary, codes binary, margins binary"
SUMS = "bucket int, sums binary"


def shared_lines(widths: Sequence[int], most: int = SHARED_CELLS) -> list[list[int]]:
    """Features in groups whose bins, each with each, are at most so many; a wider feature stands alone."""
    lines: list[list[int]] = []
    for place in sorted(range(len(widths)), key=lambda place: (-widths[place], place)):
        for line in lines:
            if widths[place] * prod(widths[own] for own in line) <= most:
                line.append(place)
                break
        else:
            lines.append([place])
    return lines


@dataclass(frozen=True)
class Layout:
    """Bins per feature and the lines in which they are counted."""

    widths: list[int]
    lines: list[list[int]]

    @classmethod
    def of(cls, cuts: Sequence[np.ndarray]) -> Layout:
        widths = [len(own) + 1 for own in cuts]
        return cls(widths, shared_lines(widths))

    @property
    def cells(self) -> list[int]:
        return [prod(self.widths[own] for own in line) for line in self.lines]

    @property
    def kind(self) -> type:
        most = max(self.cells)
        return np.uint8 if most <= 256 else np.uint16 if most <= 65_536 else np.int32

    def shared(self, codes: np.ndarray) -> np.ndarray:
        """The cell of each row in each line."""
        found = np.zeros((len(self.lines), codes.shape[1]), self.kind)
        for cell, line in zip(found, self.lines):
            for own in line:
                cell *= self.kind(self.widths[own]) if self.widths[own] < np.iinfo(self.kind).max else 1
                cell += codes[own].astype(self.kind)
        return found

    def apart(self, totals: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Per feature its own sums of those of the lines, whose last axis is the cell."""
        found: list[np.ndarray] = [np.zeros(0)] * len(self.widths)
        for total, line in zip(totals, self.lines):
            lead = total.shape[:-1]
            whole = total.reshape(*lead, *[self.widths[own] for own in line])
            for at, own in enumerate(line):
                others = tuple(len(lead) + other for other in range(len(line)) if other != at)
                found[own] = whole.sum(axis=others) if others else whole
        return found


def in_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches joined until they hold so many rows."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.concat_batches(held)
            held, count = [], 0
    if count:
        yield pa.concat_batches(held)


@dataclass
class Tree:
    """A complete tree down to ``depth``, its nodes numbered 1, and 2n and 2n + 1 below n.

    Rows go left up to ``cut``; a node that does not split sends all of them left.
    """

    depth: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        nodes = 2 << depth
        return cls(depth, np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max), np.zeros(nodes))

    def places(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The place of each row (``codes`` has a line per feature) among the nodes so many levels down.

        All nodes of a level compare all rows in their narrow type, and the way down chooses.
        """
        place = np.zeros(codes.shape[1], np.uint8 if levels < 8 else np.int64)
        ways: list[np.ndarray] = []
        for level in range(levels):
            right = [self._right(codes, node) for node in range(1 << level, 2 << level)]
            for way in reversed(ways):
                right = [low ^ (way & (low ^ high)) for low, high in zip(right[::2], right[1::2])]
            ways += right
            place <<= 1
            place |= right[0]
        return place

    def _right(self, codes: np.ndarray, node: int) -> np.ndarray:
        if self.cut[node] >= np.iinfo(codes.dtype).max:
            return np.zeros(codes.shape[1], bool)
        return codes[self.feature[node]] > codes.dtype.type(self.cut[node])

    def leaves(self) -> np.ndarray:
        return self.value[1 << self.depth :]


def _codes(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """A line of bins per feature; bin n holds the values above cut n - 1 and up to cut n."""
    most = max(len(own) for own in cuts)
    kind = np.uint8 if most < 256 else np.uint16 if most < 65_536 else np.int32
    return np.array([np.searchsorted(own, x[:, place], "left") for place, own in enumerate(cuts)], kind)


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, features)


@dataclass
class Boosted:
    """Fitted trees: per round one tree per class."""

    cuts: list[np.ndarray]
    step: float
    rounds: list[list[Tree]] = field(default_factory=list)
    gains: np.ndarray | None = None

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name other models use
        total = self.gains.sum()
        return DenseVector((self.gains / total if total > 0 else self.gains).tolist())

    def steps(self, start: int = 0) -> list[list[tuple[Tree, np.ndarray]]]:
        """Per round from ``start`` on and class the tree and what its leaves add to the margin."""
        return [
            [(tree, (1.0 if number == 0 else self.step) * tree.leaves()) for tree in trees]
            for number, trees in enumerate(self.rounds[start:], start)
        ]

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The ``keep`` columns and ``margins``, one per class, of rows with an array ``features``."""
        cuts, classes, steps = self.cuts, len(self.rounds[0]), self.steps()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                told = np.zeros((classes, batch.num_rows))
                _add(told, _codes(_matrix(batch, len(cuts)), cuts), steps)
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * classes)
                lists = pa.ListArray.from_arrays(ends, pa.array(told.T.ravel()))
                columns = [batch.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*keep, "margins"])

        kept = df.select(*keep, F.array().cast("array<double>").alias("margins")).schema
        return df.select(*keep, "features").mapInArrow(run, kept)


def _add(margins: np.ndarray, codes: np.ndarray, steps: Sequence[Sequence[tuple[Tree, np.ndarray]]]) -> None:
    """Add what the trees of some rounds tell to the margins, a line per class."""
    for trees in steps:
        for own, (tree, leaves) in zip(margins, trees):
            own += leaves.take(tree.places(codes, tree.depth))


def probability(margin: Column) -> Column:
    """The share of a class at a margin of this loss, log(1 + exp(-2 y margin))."""
    return 1 / (1 + F.exp(-2 * margin))


def _packer(cuts: Sequence[np.ndarray], classes: int):
    """Blocks of labels, bins and margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, BLOCK_ROWS):
            codes = _codes(_matrix(batch, len(cuts)), cuts)
            labels = numbers(batch.column("label")).astype(np.int16)
            margins = np.zeros((classes, batch.num_rows))
            yield _blocks([(labels.tobytes(), codes.tobytes(), margins.tobytes())])

    return run


def _blocks(rows: Sequence[tuple[bytes, ...]]) -> pa.RecordBatch:
    names = [part.split()[0] for part in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(own, pa.binary()) for own in zip(*rows)], names=names)


def _unpacked(batch: pa.RecordBatch, layout: Layout, kind: np.dtype, classes: int, steps):
    """Labels, bins and current margins of each block, and its bytes."""
    for at in range(batch.num_rows):
        packed = [batch.column(place)[at].as_buffer() for place in range(3)]
        labels = np.frombuffer(packed[0], np.int16)
        codes = np.frombuffer(packed[1], kind).reshape(len(layout.widths), -1)
        margins = np.frombuffer(packed[2]).reshape(classes, -1).copy()
        _add(margins, codes, steps)
        yield labels, codes, margins, packed


def _advanced(layout: Layout, kind: np.dtype, classes: int, steps):
    """The blocks with the margins of all rounds so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, margins, packed in _unpacked(batch, layout, kind, classes, steps):
                yield _blocks([(packed[0].to_pybytes(), packed[1].to_pybytes(), margins.tobytes())])

    return run


def _told_from_rest(labels: np.ndarray, number: int, classes: int) -> np.ndarray:
    """Rows of the class as 1 and the others as -1; a single class is that of label 1."""
    return np.where(labels == (1 if classes == 1 else number), 1.0, -1.0)


def _histograms(layout: Layout, kind: np.dtype, classes: int, steps, first: bool, growing: Sequence[Tree], level: int):
    """Per class, feature and node the rows and the sums of the fitted values of each bin."""
    nodes = 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [[np.zeros((2, nodes * cells)) for cells in layout.cells] for _ in range(classes)]
        bucket = 0
        for batch in batches:
            if batch.num_rows:
                bucket = batch.column("bucket")[0].as_py()
            for labels, codes, margins, _ in _unpacked(batch, layout, kind, classes, steps):
                lines = layout.shared(codes)
                cells = lines.astype(np.int64) if not level else None
                for number, tree in enumerate(growing):
                    wanted = _told_from_rest(labels, number, classes)
                    if not first:
                        told = margins[number]
                        told *= wanted
                        told *= 2
                        np.exp(told, out=told)
                        told += 1
                        wanted *= 4
                        wanted /= told
                    at = tree.places(codes, level).astype(np.int64) if level else None
                    for place, (width, total) in enumerate(zip(layout.cells, totals[number])):
                        if level:
                            key = at * width
                            key += lines[place]
                        else:
                            key = cells[place]
                        # Above the first split all classes count the same rows.
                        if level or not number:
                            total[0] += np.bincount(key, minlength=nodes * width)
                        total[1] += np.bincount(key, wanted, nodes * width)
        for own in totals if not level else ():
            for total, shared in zip(own, totals[0]):
                total[0] = shared[0]
        told = [layout.apart([total.reshape(2, nodes, -1) for total in own]) for own in totals]
        sums = np.concatenate([own.ravel() for features in told for own in features])
        yield _sums([(bucket, sums.tobytes())])

    return run


def _sums(rows: Sequence[tuple[int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(own, kind) for own, kind in zip(zip(*rows), (pa.int32(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "sums"])


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(data) for data in table.column("sums").to_pylist())
    return pa.Table.from_batches([_sums([(table.column("bucket")[0].as_py(), total.tobytes())])])


def _totals(sums: Sequence[bytes], layout: Layout, classes: int, nodes: int) -> list[list[np.ndarray]]:
    """Per class and feature the sums of all tasks: two lines (rows and values), nodes and bins."""
    whole, begin, found = sum(np.frombuffer(data) for data in sums), 0, []
    for _ in range(classes):
        found.append([])
        for width in layout.widths:
            end = begin + 2 * nodes * width
            found[-1].append(whole[begin:end].reshape(2, nodes, width))
            begin = end
    return found


def _best_cut(held: np.ndarray, told: np.ndarray) -> tuple[float, int, float, float]:
    """Gain, bin, rows and sum on the left of the cut of a node by a feature that takes most from
    the squared error."""
    rows, whole = held.sum(), told.sum()
    held, left = np.cumsum(held)[:-1], np.cumsum(told)[:-1]
    rest = rows - held
    able = (held > 0) & (rest > 0)
    if not able.any():
        return -1.0, -1, rows, whole
    gain = left**2 / np.maximum(held, 1) + (whole - left) ** 2 / np.maximum(rest, 1) - whole**2 / rows
    best = int(np.argmax(np.where(able, gain, -1.0)))
    return float(gain[best]), best, held[best], left[best]


def _grow(tree: Tree, level: int, totals: Sequence[np.ndarray], gains: np.ndarray) -> None:
    """Set the nodes of a level to their best cut (the first feature on ties) and their
    children to their means."""
    for place in range(1 << level):
        node = (1 << level) + place
        rows, whole = totals[0][:, place].sum(axis=1)
        if level == 0:
            tree.value[node] = whole / rows
        found = [_best_cut(*total[:, place]) for total in totals]
        feature = max(range(len(found)), key=lambda own: (found[own][0], -own))
        gain, cut, left_rows, left = found[feature]
        # A child without rows or a cut passes its value on.
        tree.value[2 * node] = tree.value[2 * node + 1] = tree.value[node]
        if gain > LEAST_GAIN * max(rows, 1.0):
            tree.feature[node], tree.cut[node] = feature, cut
            tree.value[2 * node] = left / left_rows
            tree.value[2 * node + 1] = (whole - left) / (rows - left_rows)
            gains[feature] += gain


def fit_boosted(
    rows: DataFrame, features: Sequence[str], classes: int, rounds: int, depth: int, step: float, bins: int
) -> Boosted:
    """Boosted trees of ``(label, features)``, the array ``features`` in the order of the columns
    named. ``classes`` is 1 for labels 0 and 1."""
    found = value_cuts(rows, features, bins)
    model = Boosted([found[name] for name in features], step, gains=np.zeros(len(features)))
    layout = Layout.of(model.cuts)
    kind = _codes(np.zeros((0, len(features))), model.cuts).dtype
    # As many files as tasks that run at once: a pass is short.
    width = rows.sparkSession.sparkContext.defaultParallelism
    packed = rows.select("label", "features").mapInArrow(_packer(model.cuts, classes), PACKED)
    # Cached, as every pass reads them; what is lost is read again from where it is written.
    blocks, start = materialize(packed.repartition(width)).persist(), 0
    tasks = blocks.rdd.getNumPartitions()
    for number in range(rounds):
        growing = [Tree.empty(depth) for _ in range(classes)]
        table, steps = with_bucket(blocks), model.steps(start)
        for level in range(depth):
            made = table.mapInArrow(_histograms(layout, kind, classes, steps, number == 0, growing, level), SUMS)
            if tasks > 2 * BUCKETS:
                made = made.groupBy("bucket").applyInArrow(_add_up, SUMS)
            totals = _totals([row["sums"] for row in made.collect()], layout, classes, 1 << level)
            for tree, own in zip(growing, totals):
                _grow(tree, level, own, model.gains)
        model.rounds.append(growing)
        if (number + 1) % KEPT_ROUNDS == 0 and number + 1 < rounds:
            advanced = _advanced(layout, kind, classes, model.steps(start))
            later, start = materialize(blocks.mapInArrow(advanced, PACKED)).persist(), number + 1
            blocks.unpersist()
            blocks, tasks = later, later.rdd.getNumPartitions()
    blocks.unpersist()
    return model
