"""Near-duplicate groups from SetSketch registers, verified on full shingle sets.

A document's set is that of its distinct word shingles. Register i of its sketch keeps
the smallest of independent exponentials, one per shingle, rounded on an exponential
grid and truncated to 16 bits: ``K_i = floor(1 - log_b(min))``. Registers of a union are
the larger ones of both, so sketches merge, and two documents share a register with a
probability of their Jaccard similarity at least, so bands of registers are locality
sensitive. The exponentials of all registers are one Poisson process with random
register marks, cut off where with high probability every register is filled, and
prolonged for the documents where one is not.

Work stays in proportion to the documents:

* documents with equal sets are one class, represented by its smallest doc_id;
* a bucket (equal registers in a band) never makes all its pairs. First all its members
  are tested against one pivot, and verified links join most of a group of copies;
* a bucket whose members are in one group by then is done. The others form cells with
  the buckets that share members. There a pair of two groups is compared if it shares one
  of the rarest shingles of both sets, at a place that leaves room for enough common ones.
  Sets at the limit always do, whatever the order of rarity, so no link is lost; and sets
  that share a template only, with too much text of their own, never meet. A cell's largest
  group is not compared with itself;
* every pair is first estimated by the likelihood of its register comparisons given both
  set sizes, and verified on the full sets unless that is far too low.

A null or empty text has an empty set and is linked with nothing. Fewer words than a
shingle make one shorter shingle. Rows with equal doc_id are one document: their sets
are in one group, and n_shingles is that of the largest. Rows without a doc_id are not
compared; each gives a row with null component_id and kept.
Empty tables give empty results. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.decontamination import bounded
from cohortlens.llm.memory import batchwise
from cohortlens.llm.units import pack, unpack
from cohortlens.llm.words import (
    WHITE_SPACE_WORDS,
    lower_ascii,
    mix,
    span_hashes,
    spans,
    text_buffer,
    window_hashes,
    window_starts,
)
from cohortlens.session import materialize

SHINGLE = 2
#: Verified links have 100 * intersection >= SIMILAR_PERCENT * union.
SIMILAR_PERCENT = 80
#: Bands and registers per band: a pair at the limit is missed once in 10**7.
BANDS = 40
BAND_REGISTERS = 5
REGISTERS = BANDS * BAND_REGISTERS
#: The grid's base.
GRID = 1.001
#: Pairs with a lower estimate are not verified: over six deviations below the limit.
LEAST_ESTIMATE = 0.62
#: Sets whose rarest shingles are picked at once.
SETS = 64
#: Counters that say which shingles are rare: a MB of levels, sent to every task.
COUNTERS, COUNTERS_PER_ROW = 1 << 20, 1 << 14
LINK = "a long, b long"
#: Rows of a link or label table that one file holds.
ROWS_PER_FILE = 500_000

#: Text bytes that are sketched at once, and draws that are made at once.
TEXT_BYTES = 1 << 19
DRAWS = 1 << 17

_ONE = 2.0**-64
_STEP = 0x9E3779B97F4A7C15


def _arrivals(state: np.ndarray, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws ``first`` to ``first + count`` of each shingle's process: marks and waiting times."""
    step = np.arange(first + 1, first + count + 1, dtype=np.uint64) * np.uint64(_STEP)
    draws = mix(state[:, None] + step)
    waits = -np.log((draws.astype(np.float64) + 1.0) * _ONE) / REGISTERS
    return draws, waits


def _lower(flat: np.ndarray, sets: np.ndarray, hashes: np.ndarray, limit: np.ndarray, count: int):
    """Lower register minima by the shingles' arrivals up to their sets' limits."""
    state, number, arrived, first = mix(hashes), sets, np.zeros(len(hashes)), 0
    while len(state):
        draws, waits = _arrivals(state, first, count)
        times = np.cumsum(waits, axis=1)
        times += arrived[:, None]
        bound = limit[number]
        soon = times <= bound[:, None]
        marks = (mix(draws[soon] ^ np.uint64(0xA5A5A5A5)) >> np.uint64(32)) * np.uint64(REGISTERS)
        owner = np.repeat(number, soon.sum(axis=1))
        place = owner * REGISTERS + (marks >> np.uint64(32)).astype(np.int64)
        np.minimum.at(flat, place, times[soon])
        going = soon[:, -1]
        state, number, arrived = state[going], number[going], times[going, -1]
        first += count


def _fill(minima: np.ndarray, sets: np.ndarray, hashes: np.ndarray, limit: np.ndarray) -> None:
    """Lower all sets' minima; shingles of sets of about one size are handled together."""
    expected = limit[sets] * REGISTERS
    size_class = np.ceil(np.log2(np.maximum(expected, 4))).astype(int)
    for level in np.unique(size_class):
        count = int(2**level + 2 * 2 ** (level / 2))
        chosen = np.flatnonzero(size_class == level)
        for low in range(0, len(chosen), max(1, DRAWS // count)):
            part = chosen[low : low + max(1, DRAWS // count)]
            _lower(minima.reshape(-1), sets[part], hashes[part], limit, count)


def registers(sets: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The registers of several sets: ``sets`` names each distinct hash's set. Empty sets get 0."""
    minima = np.full((len(sizes), REGISTERS), np.inf)
    limit = (np.log(REGISTERS) + 3) / np.maximum(sizes, 1)
    _fill(minima, sets, hashes, limit)
    while True:
        # A later arrival cannot replace an earlier one, so starting again changes no register.
        open_sets = np.flatnonzero((sizes > 0) & np.isinf(minima).any(axis=1))
        if not len(open_sets):
            break
        limit = limit * 2
        chosen = np.isin(sets, open_sets)
        _fill(minima, sets[chosen], hashes[chosen], limit)
    found = np.zeros(minima.shape, np.uint16)
    held = np.isfinite(minima)
    # The grid covers minima from about 1e-26 to 1e2.
    level = np.floor(1 - np.log(minima[held]) / np.log(GRID)) + 5000
    found[held] = np.clip(level, 1, 65535).astype(np.uint16)
    return found


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set numbers and distinct hashes of all shingles, ordered by set and hash; set sizes."""
    buffer, offsets = text_buffer(texts)
    buffer = lower_ascii(buffer)
    starts, ends, text_of = spans(buffer, offsets, WHITE_SPACE_WORDS)
    words = span_hashes(buffer, starts, ends)
    opening = window_starts(text_of, SHINGLE)
    hashes = [window_hashes(words, SHINGLE)[opening]]
    number = [text_of[opening]]
    counts = np.bincount(text_of, minlength=len(texts))
    first = np.cumsum(counts) - counts
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        hashes.append(window_hashes(words, size, seed=9)[first[short]])
        number.append(short)
    hashes, number = np.concatenate(hashes), np.concatenate(number)
    order = np.lexsort((hashes, number))
    hashes, number = hashes[order], number[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (number[1:] != number[:-1])
    hashes, number = hashes[new], number[new]
    return number, hashes, np.bincount(number, minlength=len(texts))


def _sums(values: np.ndarray, number: np.ndarray, count: int) -> np.ndarray:
    totals = np.zeros(count, np.uint64)
    np.add.at(totals, number, values)
    return totals.view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in bounded(whole, "_text", TEXT_BYTES):
            number, hashes, sizes = shingle_sets(batch.column("_text"))
            found = registers(number, hashes, sizes)
            bands = found.reshape(-1, BAND_REGISTERS).astype(np.uint64)
            band = np.tile(np.arange(BANDS, dtype=np.uint64), batch.num_rows)
            key = mix(band + np.uint64(1))
            for column in bands.T:
                key = mix(key ^ column)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS
            count = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": batch.column("doc"),
                    "size": pa.array(sizes.astype(np.int64)),
                    "print_1": pa.array(_sums(mix(hashes), number, count)),
                    "print_2": pa.array(_sums(mix(hashes + np.uint64(77)), number, count)),
                    "bands": pa.ListArray.from_arrays(
                        pa.array(offsets), pa.array(key.view(np.int64))
                    ),
                }
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in bounded(whole, "_text", TEXT_BYTES):
            number, hashes, sizes = shingle_sets(batch.column("_text"))
            found = registers(number, hashes, sizes)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            packed = [
                _pack_set(hashes[low:high])
                for low, high in zip(edges[:-1], edges[1:], strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": batch.column("doc"),
                    "registers": pa.array([row.tobytes() for row in found], pa.binary()),
                    "shingles": pa.array(packed, pa.binary()),
                }
            )


def _pack_set(hashes: np.ndarray) -> bytes:
    """Ascending hashes, as differences."""
    return pack(np.diff(hashes, prepend=np.uint64(0)))


def _unpack_set(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


_SHARES = np.linspace(0.0, 1.0, 201)


def _log_b_probability(share: np.ndarray) -> np.ndarray:
    """p_b(x) = -log_b(1 - x (b - 1) / b): how often one register exceeds the other."""
    share = np.clip(share, 1e-12, 1.0)
    return -np.log1p(-share * (GRID - 1) / GRID) / np.log(GRID)


def estimate(left: np.ndarray, right: np.ndarray, left_size: int, right_size: int) -> float:
    """The Jaccard similarity of two sets of known sizes with the largest likelihood."""
    above, below = int((left > right).sum()), int((left < right).sum())
    equal = len(left) - above - below
    u = left_size / (left_size + right_size)
    v = 1 - u
    shares = _SHARES[_SHARES <= min(u / v, v / u) + 1e-9]
    more = _log_b_probability(u - v * shares)
    less = _log_b_probability(v - u * shares)
    same = np.clip(1 - more - less, 1e-12, 1.0)
    likelihood = above * np.log(more) + below * np.log(less) + equal * np.log(same)
    return float(shares[np.argmax(likelihood)])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("registers_a", "registers_b", "shingles_a", "shingles_b")
        linked = np.zeros(batch.num_rows, bool)
        for place, (ra, rb, sa, sb) in enumerate(
            zip(*[batch.column(name).to_pylist() for name in names], strict=True)
        ):
            sizes = len(sa) // 8, len(sb) // 8
            if 100 * min(sizes) < SIMILAR_PERCENT * max(sizes):
                continue
            sketches = np.frombuffer(ra, np.uint16), np.frombuffer(rb, np.uint16)
            if estimate(*sketches, *sizes) < LEAST_ESTIMATE:
                continue
            both = np.concatenate([_unpack_set(sa), _unpack_set(sb)])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            linked[place] = 100 * shared >= SIMILAR_PERCENT * (sum(sizes) - shared)
        chosen = pa.array(linked)
        yield pa.RecordBatch.from_pydict(
            {name: batch.column(name).filter(chosen) for name in ("a", "b")}
        )


def components(links: DataFrame) -> DataFrame:
    """``doc`` and ``component``, the smallest doc reachable, of all docs with a link.

    ``links`` has columns a and b. Every round points each vertex to its smallest
    neighbour, follows the pointers to their ends, and contracts the links to those ends;
    so vertices at least halve, and tables shrink.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = materialize(ordered.distinct())
    # Tables shrink from here on; few rows are kept in few files.
    parts = max(1, -(-links.count() // ROWS_PER_FILE))

    def kept(df: DataFrame) -> DataFrame:
        return materialize(df.coalesce(parts))

    ends = links.select(F.col("a").alias("doc")).union(links.select("b")).distinct()
    labels = kept(ends.withColumn("component", F.col("doc")))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        pointer = both.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("to"))
        pointer = kept(pointer.select("doc", F.least("doc", "to").alias("to")))
        while True:
            nearer = pointer.select(F.col("doc").alias("to"), F.col("to").alias("far"))
            pointer = kept(
                pointer.join(nearer, "to").select(
                    "doc", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")
                )
            )
            if pointer.where("moved").isEmpty():
                break
        pointer = pointer.select("doc", "to")
        step = pointer.select(F.col("doc").alias("component"), F.col("to").alias("_to"))
        labels = kept(
            labels.join(step, "component", "left").select(
                "doc", F.coalesce("_to", "component").alias("component")
            )
        )
        to_a = pointer.select(F.col("doc").alias("a"), F.col("to").alias("_a"))
        to_b = pointer.select(F.col("doc").alias("b"), F.col("to").alias("_b"))
        links = kept(
            links.join(to_a, "a")
            .join(to_b, "b")
            .where(F.col("_a") != F.col("_b"))
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .distinct()
        )
    return labels


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    named = docs.select(F.col("doc_id").cast("long").alias("doc"), text)
    sketched = materialize(
        named.mapInArrow(
            batchwise(_sketched),
            "doc long, size long, print_1 long, print_2 long, bands array<long>",
        )
    )
    content = ["print_1", "print_2", "size"]
    held = sketched.where((F.col("size") > 0) & F.col("doc").isNotNull())
    classes = held.groupBy(*content).agg(F.min("doc").alias("class"))
    members = materialize(
        held.select("doc", *content).join(classes, content).select("doc", "class").distinct()
    )
    leads = held.join(
        classes.select(*content, F.col("class").alias("doc")), [*content, "doc"], "left_semi"
    ).select("doc", "bands")
    banded = materialize(
        leads.select("doc", F.explode("bands").alias("bucket"))
    )
    crowded = banded.groupBy("bucket").agg(F.min("doc").alias("_low"), F.max("doc").alias("_high"))
    crowded = crowded.where(F.col("_low") != F.col("_high")).select("bucket")
    buckets = materialize(
        banded.join(crowded, "bucket").select("bucket", "doc")
    )
    links = _links(named, buckets)
    # Rows of one doc_id with different texts are one document: their classes are linked.
    same_doc = members.select(F.col("doc").alias("a"), F.col("class").alias("b"))
    found = components(links.union(same_doc.where(F.col("a") != F.col("b"))))
    named_rows = sketched.where(F.col("doc").isNotNull())
    sizes = named_rows.groupBy("doc").agg(F.max("size").alias("n_shingles"))
    sizes = sizes.unionByName(
        sketched.where(F.col("doc").isNull()).select("doc", F.col("size").alias("n_shingles"))
    )
    return (
        sizes.join(found, "doc", "left")
        .select(
            F.col("doc").alias("doc_id"),
            "n_shingles",
            F.coalesce("component", "doc").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _links(named: DataFrame, buckets: DataFrame) -> DataFrame:
    """Verified links among the members of the buckets, enough of them to join whatever any
    sequence of links joins."""
    empty = named.sparkSession.createDataFrame([], LINK)
    if buckets.isEmpty():
        return empty
    involved = buckets.select("doc").distinct()
    sets = materialize(
        named.join(involved, "doc", "left_semi").mapInArrow(
            batchwise(_set_rows), "doc long, registers binary, shingles binary"
        )
    )
    # The pivot comes from an aggregate that combines on the map side; only the join back
    # meets a hot bucket whole, and Spark can split that.
    pivots = buckets.groupBy("bucket").agg(F.min("doc").alias("a"))
    both = materialize(
        buckets.join(pivots, "bucket")
        .where(F.col("doc") != F.col("a"))
        .select("a", F.col("doc").alias("b"))
        .distinct()
    )
    found = materialize(_compare(both, sets))
    group = components(found)
    grouped = buckets.join(group, "doc", "left").select(
        "bucket", "doc", F.coalesce("component", "doc").alias("component")
    )
    ends = grouped.groupBy("bucket").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high")
    )
    mixed = ends.where(F.col("_low") != F.col("_high")).select("bucket")
    rest = materialize(grouped.join(mixed, "bucket", "left_semi"))
    if rest.isEmpty():
        return found
    pairs = materialize(_candidates(rest, sets))
    return materialize(found.union(_compare(pairs, sets)))


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets pass the estimate and are verified."""
    for side in "ab":
        own = [F.col(name).alias(f"{name}_{side}") for name in ("registers", "shingles")]
        pairs = pairs.join(sets.select(F.col("doc").alias(side), *own), side)
    return pairs.mapInArrow(batchwise(_verified), LINK)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) % np.uint64(COUNTERS)).astype(np.int64)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for data in batch.column("shingles").to_pylist():
            np.add.at(counts, _slots(_unpack_set(data)), 1)
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict(
        {"slot": pa.array(slots), "n": pa.array(counts[slots])}
    )


def _slot_levels(table: pa.Table) -> pa.Table:
    """The bit lengths of the counters of one row, one byte each."""
    slots, counts = table.column("slot").to_numpy(), table.column("n").to_numpy()
    levels = np.zeros(COUNTERS_PER_ROW, np.uint8)
    levels[slots % COUNTERS_PER_ROW] = np.frexp(counts.astype(np.float64))[1]
    row = int(slots[0]) // COUNTERS_PER_ROW
    return pa.table({"row": pa.array([row], pa.int64()), "levels": [levels.tobytes()]})


def _rarity(held: DataFrame) -> bytes:
    """How common the shingles of each counter are, on a logarithmic scale.

    The counters' number is fixed. Shingles that share one seem more common than they are,
    which changes what is compared first, never what is found.
    """
    counts = held.select("shingles").mapInArrow(batchwise(_slot_counts), "slot long, n long")
    counts = counts.groupBy("slot").agg(F.sum("n").alias("n"))
    rows = counts.groupBy(F.expr(f"slot div {COUNTERS_PER_ROW}")).applyInArrow(
        _slot_levels, "row long, levels binary"
    )
    levels = np.zeros((COUNTERS // COUNTERS_PER_ROW, COUNTERS_PER_ROW), np.uint8)
    for row in rows.collect():
        levels[row["row"]] = np.frombuffer(row["levels"], np.uint8)
    return levels.tobytes()


def _asked(size: int) -> int:
    """Rarest shingles of which a set shares one with any smaller one that it is linked to."""
    return size - -(-SIMILAR_PERCENT * size // 100) + 1


def _offered(size: int) -> int:
    """Rarest shingles of which a set shares one with any larger one that it is linked to."""
    return size - -(-2 * SIMILAR_PERCENT * size // (100 + SIMILAR_PERCENT)) + 1


def _rarest(rarity: bytes):
    """Rows of each set's rarest shingles: place in the order of rarity, and if it is offered."""
    columns = ("cell", "doc", "component", "home")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(rarity, np.uint8)
        for whole in batches:
            for low in range(0, whole.num_rows, SETS):
                batch = whole.slice(low, SETS)
                sets = [_unpack_set(data) for data in batch.column("shingles").to_pylist()]
                order = [np.lexsort((one, levels[_slots(one)]))[: _asked(len(one))] for one in sets]
                counts = np.array([len(one) for one in order], np.int64)
                sizes = np.array([len(one) for one in sets], np.int64)
                offered = np.array([_offered(len(one)) for one in sets], np.int64)
                row = np.repeat(np.arange(len(sets)), counts)
                place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                chosen = [one[rare] for one, rare in zip(sets, order, strict=True)]
                shingles = np.concatenate([np.zeros(0, np.uint64), *chosen])
                yield pa.RecordBatch.from_pydict(
                    {name: batch.column(name).take(pa.array(row)) for name in columns}
                    | {
                        "shingle": pa.array(shingles.view(np.int64)),
                        "size": pa.array(sizes[row]),
                        "place": pa.array(place),
                        "offered": pa.array(place < offered[row]),
                    }
                )

    return rows


def _candidates(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of a cell's members in different groups that can be similar enough.

    Shingles are ordered by rarity. Of two linked sets the smaller holds one of its first
    ``_offered`` among the first ``_asked`` of the larger; and after the first shingle that
    they share, both have enough left to reach the limit.
    """
    low = rest.groupBy("bucket").agg(F.min("doc").alias("a"))
    stars = rest.join(low, "bucket").select("a", F.col("doc").alias("b"))
    cells = components(stars).withColumnRenamed("component", "cell")
    members = materialize(rest.select("doc", "component").distinct().join(cells, "doc"))
    groups = members.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("n"))
    homes = groups.groupBy("cell").agg(F.max(F.struct("n", "component"))["component"].alias("_home"))
    held = members.join(homes, "cell").join(sets.select("doc", "shingles"), "doc").select(
        "cell", "doc", "component", (F.col("component") == F.col("_home")).alias("home"), "shingles"
    )
    rare = materialize(
        held.mapInArrow(
            batchwise(_rarest(_rarity(held))),
            "cell long, doc long, component long, home boolean, shingle long,"
            " size long, place long, offered boolean",
        )
    )
    # A shingle that only one group holds, or that no other group offers, gives no pair.
    shared = rare.groupBy("cell", "shingle").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.bool_or("offered").alias("_offered"),
    )
    shared = shared.where((F.col("_low") != F.col("_high")) & F.col("_offered"))
    rare = materialize(rare.join(shared.select("cell", "shingle"), ["cell", "shingle"], "left_semi"))

    def side(rows: DataFrame, name: str) -> DataFrame:
        own = ("doc", "component", "size", "place")
        return rows.select("cell", "shingle", *[F.col(one).alias(f"{one}_{name}") for one in own])

    offers = rare.where("offered")
    # Askers are the larger sets, equal sizes by doc_id; no home asks a home.
    possible = F.expr(
        f"""component_a != component_b
        AND (size_b < size_a OR size_b = size_a AND doc_b < doc_a)
        AND 100 * size_b >= {SIMILAR_PERCENT} * size_a
        AND {100 + SIMILAR_PERCENT} * least(size_a - place_a, size_b - place_b)
            >= {SIMILAR_PERCENT} * (size_a + size_b)"""
    )

    def met(asking: DataFrame, offering: DataFrame) -> DataFrame:
        both = side(asking, "a").join(side(offering, "b"), ["cell", "shingle"])
        return both.where(possible).select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))

    strangers = ~F.col("home")
    pairs = met(rare.where(strangers), offers).union(met(rare.where("home"), offers.where(strangers)))
    return pairs.distinct()


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with its own columns."""
    groups = near_groups(docs.select("doc_id", "text")).where("kept").select(
        F.col("doc_id").alias("_kept_id")
    )
    same = docs["doc_id"].cast("long").eqNullSafe(groups["_kept_id"])
    return docs.join(groups, same, "left_semi")
