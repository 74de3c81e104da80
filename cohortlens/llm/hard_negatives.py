"""Hard negatives: rows of another label that score just below an anchor's positives.

Rows are ordered along a Hilbert curve over the dimensions that spread most, range-partitioned
by it (equal places by vec_id, so vectors that many rows share are cut too), and written to
Parquet in blocks. A block's row holds its ids, labels and integer components, and beside them
a zone map: the least and greatest component per dimension, the smallest vec_id and the labels.

For an anchor, interval arithmetic over a zone map bounds the inner products of all rows of a
block from both sides. Two searches read the blocks that the bounds do not rule out:

* positives: rows of the anchor's label. The best ones of the anchor's own block give a floor,
  and only blocks that can reach it are read. On the way the best rows of other labels seen
  are kept as hints.
* negatives: per positive a window of scores. Hints inside a window give its floor; only blocks
  whose bounds meet the window above the floor are read.

Anchors travel in batches to pages of zone maps, and those that need a block to its rows. Both
are joins on keys; each batch meets each page, as anchors are a query set in blocks. A task keeps
the best rows per anchor and passes those on alone, so nothing grows with a hot vector or label.

Defined results. Rows with a null label, a null vector, or a null or non-finite component take
no part. Shorter vectors are filled up with zeros. A null vec_id comes before all others and is
no anchor's. Rows that repeat a vec_id are rows of their own: each is an anchor, a positive or a
negative. An anchor is never its own positive. Scores have to fit 64 bits, else the search raises
ValueError. Other columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.session import materialize

#: Rows of a block, and of a range partition of blocks.
BLOCK_ROWS, RANGE_ROWS = 512, 8192
#: Anchors that travel together, and zone maps of a page.
BATCH_ANCHORS, PAGE_BLOCKS = 256, 512
#: Dimensions of the curve and bits of each: a key of 56 bits.
CURVE_DIMENSIONS, CURVE_BITS = 8, 7
#: Rows of other labels that the first search remembers per anchor.
HINTS = 16
#: Anchors whose best rows a task holds before it passes them on.
HELD_ANCHORS = 50_000
#: Scale from a component to its integer.
SCALE = 256
#: Bits of a slot that hold a row's place in its block.
PLACE_BITS = 20
NO_ID = -(2**63)

BLOCKS = (
    "block long, n int, ids binary, labels binary, components binary, "
    "low binary, high binary, least_id long, own_labels binary"
)
ANCHORS = "batch long, slots binary, ids binary, labels binary, components binary, floors binary"
REQUESTS = "block long, slots binary, labels binary, components binary, windows binary"
FOUND = "slot long, goal int, score long, id long"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
    )


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, "<i8").tobytes()


@dataclass(frozen=True)
class Shape:
    """What is known of all vectors: dimensions, and the range of each on the curve."""

    rows: int
    dimensions: int
    largest: int
    curve: tuple[int, ...]
    lows: tuple[float, ...]
    highs: tuple[float, ...]

    @property
    def exact_in_doubles(self) -> bool:
        return self.dimensions * self.largest**2 < 2**53

    def matrix(self, data: bytes) -> np.ndarray:
        """Components as rows, in a kind whose products are exact."""
        kind = np.dtype("<i4" if self.exact_in_doubles else "<i8")
        flat = np.frombuffer(data, kind).reshape(-1, self.dimensions)
        return flat.astype(np.float64) if self.exact_in_doubles else flat.astype(np.int64)

    def pack(self, matrix: np.ndarray) -> bytes:
        return np.ascontiguousarray(matrix, "<i4" if self.exact_in_doubles else "<i8").tobytes()


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part."""
    bad = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = embeddings.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)


def vector_shape(rows: DataFrame) -> Shape:
    """One row per dimension reaches the driver."""
    value = F.floor(F.lit(float(SCALE)) * F.col("x"))
    spread = rows.select(F.posexplode("vector").alias("dimension", "x")).groupBy("dimension").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"),
        F.max(F.abs(value)).alias("largest"), F.max(F.abs("x")).alias("far"),
    )
    count = rows.agg(F.count(F.lit(1))).first()[0]
    found = sorted(spread.collect(), key=lambda row: row["dimension"])
    if any(row["far"] * SCALE >= 2.0**62 for row in found):
        raise ValueError("components beyond 2**62 / 256: scores would not fit 64 bits")
    largest = max((int(row["largest"]) for row in found), default=0)
    if len(found) * largest**2 >= 2**63:
        raise ValueError("scores would not fit 64 bits")
    widest = sorted(found, key=lambda row: (-row["spread"], row["dimension"]))[:CURVE_DIMENSIONS]
    return Shape(
        count,
        max(1, len(found)),
        largest,
        tuple(row["dimension"] for row in widest),
        tuple(row["mean"] - 2 * row["spread"] for row in widest),
        tuple(row["mean"] + 2 * row["spread"] for row in widest),
    )


# --- the curve and the blocks -------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells (rows of non-negative coordinates below 2**bits) along the curve.

    Coordinates become the curve's transposed index by undoing its rotations from the top
    bit down, then a Gray code; the index is read off bit plane by bit plane.
    """
    x = cells.T.astype(np.int64).copy()
    dimensions = len(x)
    if not dimensions:
        return np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        here, below = 1 << bit, (1 << bit) - 1
        for axis in range(dimensions):
            inverted = (x[axis] & here) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(inverted, below, swapped)
            x[axis] ^= swapped
    for axis in range(1, dimensions):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    keys = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(dimensions):
            keys = keys << 1 | (x[axis] >> bit & 1)
    return keys


def _placer(shape: Shape):
    schema = _schema("key long, vec_id long, label long, components binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            vectors = batch.column("vector")
            cuts = vectors.offsets.to_numpy()
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(count), np.diff(cuts))
            dense = np.zeros((count, shape.dimensions))
            dense[row, np.arange(len(flat)) - (cuts[:-1] - cuts[0])[row]] = flat
            low, high = np.array(shape.lows), np.array(shape.highs)
            wide = np.where(high > low, high - low, 1.0)
            share = np.clip((dense[:, list(shape.curve)] - low) / wide, 0, 1)
            cells = np.minimum((share * (1 << CURVE_BITS)).astype(np.int64), (1 << CURVE_BITS) - 1)
            whole = np.floor(SCALE * dense)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hilbert_keys(cells, CURVE_BITS)),
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([shape.pack(one) for one in whole.astype(np.int64)], pa.binary()),
                ],
                schema=schema,
            )

    return run


def _blocker(shape: Shape, block_rows: int):
    schema = _schema(BLOCKS)

    def block(number: int, ids: np.ndarray, labels: np.ndarray, data: bytes) -> tuple:
        matrix = shape.matrix(data)
        return (
            number, len(ids), _packed(ids), _packed(labels), data,
            shape.pack(matrix.min(axis=0)), shape.pack(matrix.max(axis=0)),
            int(ids.min()), _packed(np.unique(labels)),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, number = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if number is None:
                number = batch.column("part")[0].as_py() << 32
            held.append(batch)
            rows += batch.num_rows
            while rows >= block_rows:
                table = pa.Table.from_batches(held).combine_chunks()
                yield _rows([block(number, *_columns(table.slice(0, block_rows)))], schema)
                number += 1
                held, rows = table.slice(block_rows).to_batches(), rows - block_rows
        if rows:
            yield _rows([block(number, *_columns(pa.Table.from_batches(held)))], schema)

    def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bytes]:
        return (
            table.column("vec_id").to_numpy(),
            table.column("label").to_numpy(),
            b"".join(table.column("components").to_pylist()),
        )

    return run


def candidate_blocks(rows: DataFrame, shape: Shape, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows in blocks along the curve, written to Parquet, each with its zone map."""
    placed = rows.mapInArrow(_placer(shape), "key long, vec_id long, label long, components binary")
    ranges = max(1, -(-shape.rows // RANGE_ROWS))
    order = ("key", "vec_id", "label")
    ordered = (
        placed.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id().cast("long"))
    )
    return materialize(ordered.mapInArrow(_blocker(shape, block_rows), BLOCKS))


# --- anchors and bounds -------------------------------------------------------------


def _best(scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """The places of the first rows by score down, then id."""
    if len(scores) > 4 * keep:
        # Whatever ties with the last place may still come first by its id.
        least = np.partition(scores, len(scores) - keep)[len(scores) - keep]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:keep]]


def _anchor_finder(shape: Shape, every: int, positives: int):
    """Batches of anchors with the score and id that a block must reach to matter."""
    schema = _schema(ANCHORS)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        slots, ids, labels, data, floors = zip(*rows)
        told = (
            slots[0], _packed(np.array(slots)), _packed(np.array(ids)), _packed(np.array(labels)),
            b"".join(data), _packed(np.array(floors)),
        )
        return _rows([told], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = _longs(row["ids"]), _longs(row["labels"])
                matrix = shape.matrix(row["components"])
                for place in np.flatnonzero((ids % every == 0) & (ids != NO_ID)).tolist():
                    scores = (matrix @ matrix[place]).astype(np.int64)
                    others = np.flatnonzero(labels == labels[place])
                    others = others[others != place]
                    best = others[_best(scores[others], ids[others], positives)]
                    full = len(best) == positives
                    floor = (scores[best[-1]], ids[best[-1]]) if full else (NO_ID, NO_ID)
                    held.append(
                        (
                            row["block"] << PLACE_BITS | place, ids[place], labels[place],
                            shape.pack(matrix[place]), floor,
                        )
                    )
                    if len(held) == BATCH_ANCHORS:
                        yield batch_of(held)
                        held = []
        if held:
            yield batch_of(held)

    return run


def zone_pages(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Zone maps in pages of about ``PAGE_BLOCKS``, and how many pages there are."""
    zones = blocks.select("block", "low", "high", "least_id", "own_labels")
    pages = max(1, -(-zones.count() // PAGE_BLOCKS))
    page = F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int")
    gathered = zones.groupBy(page.alias("page")).agg(
        F.collect_list(F.struct("block", "low", "high", "least_id", "own_labels")).alias("zones")
    )
    return gathered, pages


class _Bounds:
    """Bounds of a batch's scores over the blocks of a page."""

    def __init__(self, shape: Shape, zones: list[dict]):
        self.blocks = [zone["block"] for zone in zones]
        self.low = shape.matrix(b"".join(zone["low"] for zone in zones))
        self.high = shape.matrix(b"".join(zone["high"] for zone in zones))
        self.least = np.array([zone["least_id"] for zone in zones])
        self.labels = [set(_longs(zone["own_labels"]).tolist()) for zone in zones]

    def of(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score per anchor and block."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def holds(self, label: int, same: bool) -> np.ndarray:
        if same:
            return np.array([label in own for own in self.labels])
        return np.array([len(own) > 1 or label not in own for own in self.labels])


def _router(shape: Shape, same: bool):
    """Which anchors of a batch need which blocks of a page.

    ``windows`` has per anchor rows of (low, high, floor score, floor id); a block is needed
    if its bounds meet a window where it can still give a row before the floor's.
    """
    schema = _schema(REQUESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bounds = _Bounds(shape, row["zones"])
                anchors = shape.matrix(row["components"])
                slots, labels = _longs(row["slots"]), _longs(row["labels"])
                windows = _longs(row["windows"]).reshape(len(slots), -1, 4)
                least, greatest = bounds.of(anchors)
                has = {label: bounds.holds(label, same) for label in set(labels.tolist())}
                needed = np.zeros(least.shape, bool)
                for low, high, floor, floor_id in windows.transpose(1, 2, 0)[..., None]:
                    reach = (greatest > floor) | ((greatest == floor) & (bounds.least <= floor_id))
                    needed |= reach & (greatest >= low) & (least <= high) & (low <= high)
                needed &= np.array([has[label] for label in labels.tolist()])
                packed = shape.matrix(row["components"])
                for place in np.flatnonzero(needed.any(axis=0)).tolist():
                    own = np.flatnonzero(needed[:, place])
                    told = (
                        bounds.blocks[place], _packed(slots[own]), _packed(labels[own]),
                        shape.pack(packed[own]), _packed(windows[own]),
                    )
                    yield _rows([told], schema)

    return run


class _Kept:
    """The first rows per anchor and goal among those that a task has seen."""

    def __init__(self):
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def add(self, slot: int, goal: int, scores: np.ndarray, ids: np.ndarray, keep: int) -> None:
        if not len(scores):
            return
        known = self.found.get((slot, goal))
        if known is not None:
            if len(known[0]) == keep:
                able = scores >= known[0][-1]
                if not able.any():
                    return
                scores, ids = scores[able], ids[able]
            scores, ids = np.concatenate([known[0], scores]), np.concatenate([known[1], ids])
        best = _best(scores, ids, keep)
        self.found[slot, goal] = scores[best], ids[best]

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            counts = [len(scores) for scores, _ in self.found.values()]
            slots, goals = zip(*self.found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(slots), counts)),
                    pa.array(np.repeat(np.array(goals, np.int32), counts)),
                    pa.array(np.concatenate([scores for scores, _ in self.found.values()])),
                    pa.array(np.concatenate([ids for _, ids in self.found.values()])),
                ],
                schema=_schema(FOUND),
            )
            self.found.clear()


#: The goal of hints, and the first goal of the windows.
HINT, FIRST = -1, 0


def _scanner(shape: Shape, same: bool, keep: int):
    """Exact scores of the anchors that need a block against its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept()
        for batch in batches:
            for row in batch.to_pylist():
                ids, own = _longs(row["ids"]), _longs(row["own"])
                slots, labels = _longs(row["slots"]), _longs(row["labels"])
                windows = _longs(row["windows"]).reshape(len(slots), -1, 4)
                table = shape.matrix(row["components"]) @ shape.matrix(row["rows"]).T
                for at, slot in enumerate(slots.tolist()):
                    scores = table[at].astype(np.int64)
                    equal = own == labels[at]
                    if same:
                        other = np.flatnonzero(~equal)
                        kept.add(slot, HINT, scores[other], ids[other], HINTS)
                        if slot >> PLACE_BITS == row["block"]:
                            equal[slot & (1 << PLACE_BITS) - 1] = False
                        chosen = np.flatnonzero(equal)
                        kept.add(slot, FIRST, scores[chosen], ids[chosen], keep)
                        continue
                    for goal, (low, high, floor, _) in enumerate(windows[at].tolist()):
                        inside = np.flatnonzero(~equal & (scores >= max(low, floor)) & (scores <= high))
                        kept.add(slot, goal, scores[inside], ids[inside], keep)
                if len(kept.found) >= HELD_ANCHORS:
                    yield from kept.rows()
        yield from kept.rows()

    return run


def _search(
    batches: DataFrame, blocks: DataFrame, pages: DataFrame, count: int, shape: Shape,
    same: bool, keep: int,
) -> DataFrame:
    """``(slot, goal, score, id, place)``: the first rows per anchor and goal."""
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("page")
    routed = (
        batches.select("slots", "labels", "components", "windows", every)
        .join(pages, "page")
        .mapInArrow(_router(shape, same), REQUESTS)
    )
    data = blocks.select(
        "block", "ids", F.col("labels").alias("own"), F.col("components").alias("rows")
    )
    found = routed.join(data, "block").mapInArrow(_scanner(shape, same, keep), FOUND)
    order = W.partitionBy("slot", "goal").orderBy(F.col("score").desc(), "id")
    place = F.row_number().over(order)
    most = F.when(F.col("goal") == HINT, HINTS).otherwise(keep)
    # Ranks above the wider limit are cut before the shuffle, the narrower one after it.
    ranked = found.withColumn("place", place).where(F.col("place") <= max(keep, HINTS))
    return ranked.where(F.col("place") <= most)


def hard_negatives(
    rows: DataFrame, every: int, positives: int = 5, negatives: int = 5,
    least_percent: int = 80, most_percent: int = 100, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each anchor (a row whose vec_id is divisible by ``every``) and each of its first
    positives, the first rows of other labels whose score is between the given percentages
    of the positive's.

    ``rows`` are those of ``usable_rows``.
    """
    shape = vector_shape(rows)
    blocks = candidate_blocks(rows, shape, block_rows)
    pages, count = zone_pages(blocks)
    pages = materialize(pages)
    anchors = materialize(
        blocks.select("block", "ids", "labels", "components").mapInArrow(
            _anchor_finder(shape, every, positives), ANCHORS
        )
    )
    opened = anchors.mapInArrow(_open_windows, f"{ANCHORS}, windows binary")
    near = materialize(_search(opened, blocks, pages, count, shape, True, positives))
    windowed = _with_windows(anchors, near, negatives, least_percent, most_percent)
    far = _search(windowed, blocks, pages, count, shape, False, negatives)
    return _pairs(anchors, near, far)


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window per anchor without limits, above its floor."""
    for batch in batches:
        windows = []
        for floors in batch.column("floors").to_pylist():
            floor = _longs(floors).reshape(-1, 2)
            ends = np.full((len(floor), 2), [NO_ID, 2**63 - 1])
            windows.append(_packed(np.hstack([ends, floor])))
        yield batch.append_column("windows", pa.array(windows, pa.binary()))


def _with_windows(
    anchors: DataFrame, near: DataFrame, negatives: int, least: int, most: int
) -> DataFrame:
    """The anchors, each with the windows of its positives and their floors from hints."""
    hints = F.filter("found", lambda row: row["goal"] == HINT)
    own = F.filter("found", lambda row: row["goal"] == FIRST)
    # At most the positives and the hints of one anchor.
    gathered = near.groupBy("slot").agg(
        F.array_sort(F.collect_list(F.struct("goal", "place", "score", "id"))).alias("found")
    ).select("slot", own.alias("own"), hints.alias("hints"))
    slots = anchors.mapInArrow(_anchor_rows, "batch long, at int, slot long, label long, components binary")
    told = slots.join(gathered, "slot", "left")
    return told.groupBy("batch").agg(
        # As many as a batch has anchors.
        F.array_sort(
            F.collect_list(F.struct("at", "slot", "label", "components", "own", "hints"))
        ).alias("held")
    ).mapInArrow(
        _window_packer(negatives, least, most),
        "slots binary, labels binary, components binary, windows binary",
    )


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("batch", pa.int64()), ("at", pa.int32()), ("slot", pa.int64()), ("label", pa.int64()),
         ("components", pa.binary())]
    )
    for batch in batches:
        for row in batch.to_pylist():
            slots, labels = _longs(row["slots"]), _longs(row["labels"])
            width = len(row["components"]) // len(slots)
            parts = [row["components"][at * width : (at + 1) * width] for at in range(len(slots))]
            told = zip([row["batch"]] * len(slots), range(len(slots)), slots.tolist(), labels.tolist(), parts)
            yield _rows(list(told), schema)


def _window_packer(negatives: int, least: int, most: int):
    schema = _schema("slots binary, labels binary, components binary, windows binary")

    def windows(row: dict, width: int) -> list[tuple]:
        found = []
        for positive in row["own"] or ():
            score = positive["score"]
            # least * p <= 100 * n <= most * p, in whole numbers.
            low, high = -(-least * score // 100), most * score // 100
            inside = [hint for hint in row["hints"] or () if low <= hint["score"] <= high]
            full = len(inside) >= negatives
            last = inside[negatives - 1] if full else None
            found.append((low, high, last["score"], last["id"]) if full else (low, high, NO_ID, 2**63 - 1))
        # A closed window holds the place of a positive that is missing.
        return found + [(1, 0, 0, 0)] * (width - len(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = row["held"]
                width = max(1, max(len(anchor["own"] or ()) for anchor in held))
                told = (
                    _packed(np.array([anchor["slot"] for anchor in held])),
                    _packed(np.array([anchor["label"] for anchor in held])),
                    b"".join(anchor["components"] for anchor in held),
                    _packed(np.array([windows(anchor, width) for anchor in held])),
                )
                yield _rows([told], schema)

    return run


def _pairs(anchors: DataFrame, near: DataFrame, far: DataFrame) -> DataFrame:
    """The found rows with the ids of their anchors and positives."""
    owners = anchors.mapInArrow(_anchor_ids, "slot long, anchor_id long")
    positive = near.where(F.col("goal") == FIRST).select(
        "slot",
        (F.col("place") - 1).alias("goal"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    named = lambda name: F.when(F.col(name) != NO_ID, F.col(name)).alias(name)
    return (
        far.join(positive, ["slot", "goal"])
        .join(owners, "slot")
        .select(
            "anchor_id",
            "positive_id",
            F.col("place").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        .withColumns({"positive_id": named("positive_id"), "negative_id": named("negative_id")})
    )


def _anchor_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema("slot long, anchor_id long")
    for batch in batches:
        for slots, ids in zip(batch.column("slots").to_pylist(), batch.column("ids").to_pylist()):
            yield _rows(list(zip(_longs(slots).tolist(), _longs(ids).tolist())), schema)
