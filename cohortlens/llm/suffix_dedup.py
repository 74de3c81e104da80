"""Removal of repeated byte strings by suffix order, built column by column.

No task can hold the suffixes of all documents, so Spark first brings together what can
be equal. The start of every ``SIZE``-byte string belongs to the *segment* of starts whose
strings share one occurrence of their smallest ``CORE``-byte substring (by hash). Equal
strings have equal cores, so only segments whose core occurs twice can hold one:

1. a string reaches well beyond its core to one side, so units sketch their cores with
   either side; slices answer which are shared, and which are in many units, and units
   cut their segments to the strings that may occur twice;
2. equal segments are grouped by 128 bits of hash: in all but the first every string
   comes earlier, and only the first one's bytes travel on, once;
3. slices, by core, take the bytes of those first segments as a collection of sequences
   and construct its Burrows-Wheeler transform and common prefixes column-wise: each
   round inserts one symbol of every sequence, from the last, at the place that the
   symbol's rank in the transform so far gives, rewriting the runs of symbols, common
   prefixes and suffix owners in sequence. Neighbours with a common prefix of ``SIZE``
   bytes are equal strings, and all but the earliest are marked;
4. units remove the bytes covered by marked strings.

A core in many units might gather in one slice: its segments are cut into single strings,
dealt by their own hash. The runs of a slice stand in memory, front to back, as slices are
bounded; Spark's exchanges are the files between the steps.

Documents are judged on the input. A null or empty text has no bytes, and one shorter than
``SIZE`` keeps all. Rows that repeat doc_id and text are one document and get the same
result; see ``units`` for null and equal doc_ids. An empty table gives an empty result.
Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.memory import tablewise
from cohortlens.llm.units import (
    MESSAGE_DDL,
    SLICE_CELLS,
    Unit,
    answer,
    by_slice,
    cells_of,
    filled_cells,
    in_units,
    later_entries,
    later_than_first,
    messages,
    pack,
    pack_ascending,
    pack_by_text,
    read_messages,
    result_schema,
    send_first,
    slice_of,
    text_bytes,
    unpack,
    unpack_ascending,
    unpack_by_text,
    with_columns_back,
)
from cohortlens.llm.words import Rolling, covered, mix, runs, span_hashes
from cohortlens.session import shuffle_width

SIZE = 100
CORE = 50
#: Text bytes per segment, low on purpose, and segments that a slice of cores holds about.
BYTES_PER_SEGMENT = 25
SLICE_SEGMENTS = SLICE_CELLS // 16
#: Text bytes of the whole table for each slice of sequences.
SEQUENCE_SLICE_BYTES = 2 << 20
#: Slices of the construction that a task takes at most.
TASK_SLICES = 16
#: A core in more units than this is dealt string by string.
MANY_UNITS = 64
#: Starts that are cut into segments at once, and sequences of a collection, about.
SEGMENT_PIECE = 1 << 17
COLLECTION = 2000

_PLACE_BITS = np.uint64(18)
_PLACE = np.uint64((1 << 18) - 1)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values


class _Segments:
    """The segments of a unit's text: first start, number of starts, hash of the core.

    The core of a string is its substring with the smallest hash, the leftmost of equal
    ones, so equal strings choose alike. Texts are cut into pieces of starts; a cut may
    divide a segment, which only makes two of it.

    A string reaches beyond its core by half of ``size - core`` bytes at least, to the
    left or to the right: ``sides`` are hashes of the core with so many bytes of either
    side, 0 where a segment has no string that reaches so far.
    """

    def __init__(self, unit: Unit, size: int, core: int):
        ends = unit.offsets[1:]
        found = [
            self._piece(unit.buffer, low, size, core, ends)
            for low in range(0, max(0, len(unit.buffer) - size + 1), SEGMENT_PIECE)
        ]
        columns = zip(*found, strict=True) if found else [[np.zeros(0, np.int64)]] * 6
        self.first, self.count, self.place, *hashes = map(np.concatenate, columns)
        self.core, *self.sides = [column.astype(np.uint64) for column in hashes]
        self.document = np.searchsorted(unit.offsets, self.first, "right") - 1
        #: The last start whose string reaches left.
        self.turn = self.place - (size - core) // 2

    @staticmethod
    def _piece(buffer: np.ndarray, low: int, size: int, core: int, ends: np.ndarray):
        part = Rolling(buffer[low : low + SEGMENT_PIECE + size - 1])
        hashes = part.all(core)
        places = np.arange(len(hashes), dtype=np.uint64)
        keyed = (hashes >> _PLACE_BITS << _PLACE_BITS) | places
        smallest = (_sliding_minimum(keyed, size - core + 1) & _PLACE).astype(np.int64)
        # Strings that cross a document's end are none.
        inner = ends[(ends > low) & (ends < low + part.count)] - low
        crossing = np.bincount(np.maximum(inner - size + 1, 0), minlength=part.count + 1).astype(int)
        crossing -= np.bincount(inner, minlength=part.count + 1)
        inside = np.cumsum(crossing[: len(smallest)]) == 0
        opens = inside.copy()
        opens[1:] &= (smallest[1:] != smallest[:-1]) | ~inside[:-1]
        first = np.flatnonzero(opens)
        closes = inside.copy()
        closes[:-1] &= opens[1:] | ~inside[1:]
        last = np.flatnonzero(closes)
        place = smallest[first]
        reach = (size - core) // 2
        other = size - core - reach
        sides = np.zeros((2, len(first)), np.uint64)
        # The leftmost string reaches left, the rightmost one right.
        left = first <= place - reach
        right = last + size >= place + core + other
        sides[0, left] = part.at(place[left] - reach, core + reach)
        sides[1, right] = mix(part.at(place[right], core + other))
        return first + low, last - first + 1, place + low, hashes[place], *sides


def _sketch(size: int, core: int, slices: int):
    def run(table: pa.Table) -> pa.Table:
        unit = Unit(table)
        number = table.column("_unit")[0].as_py()
        segments = _Segments(unit, size, core)
        cells = cells_of(_side_hashes(segments), 0, slices)
        return messages(
            [
                (part, number, pack_ascending(own.astype(np.int64)))
                for part, own in filled_cells(cells, slices)
            ]
        )

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Count the units of each cell; answer two bits per cell: shared, and in many units."""
    received = [(*row[:2], unpack_ascending(row[2])) for row in read_messages(table)]
    counts = np.zeros(SLICE_CELLS, np.uint32)
    for _, _, cells in received:
        counts[cells] += 1
    return messages(
        [
            (
                part,
                unit,
                np.packbits(np.stack([counts[cells] > 1, counts[cells] > MANY_UNITS])).tobytes(),
            )
            for part, unit, cells in received
        ]
    )


def _side_hashes(segments: _Segments) -> np.ndarray:
    """What a unit sketches: cores with their left sides, then those with their right ones."""
    return np.concatenate([side[side > 0] for side in segments.sides])


def _flags(hashes: np.ndarray, heard: dict[int, bytes], slices: int):
    """Per hash: may it occur twice, and is it in many units?"""
    cells = cells_of(hashes, 0, slices)
    _, place, here = np.unique(cells, return_inverse=True, return_counts=True)
    bits = [
        np.unpackbits(np.frombuffer(heard[part], np.uint8), count=2 * len(own)).reshape(2, -1)
        for part, own in filled_cells(cells, slices)
    ]
    shared, many = np.concatenate(bits, axis=1) if bits else np.zeros((2, 0), np.uint8)
    return ((shared > 0) | (here > 1))[place], (many > 0)[place]


def _cut_to_shared(
    segments: _Segments, heard: dict[int, bytes], slices: int
) -> tuple[np.ndarray, np.ndarray]:
    """Cut the segments to the strings that may occur twice.

    Starts up to the turn reach left and need a shared left side, those behind it a shared
    right one. Returns for both kinds which segments have a side in many units.
    """
    shared, many = _flags(_side_hashes(segments), heard, slices)
    sides = [side > 0 for side in segments.sides]
    flags = np.zeros((2, 2, len(segments.first)), bool)
    cut = int(sides[0].sum())
    for number, (own, found) in enumerate(zip(sides, (slice(0, cut), slice(cut, None)))):
        flags[number, 0, own], flags[number, 1, own] = shared[found], many[found]
    (left, left_many), (right, right_many) = flags
    last = segments.first + segments.count - 1
    segments.first = np.where(left, segments.first, np.maximum(segments.first, segments.turn + 1))
    last = np.where(right, last, np.minimum(last, segments.turn))
    segments.count = np.where(left | right, np.maximum(last - segments.first + 1, 0), 0)
    return left_many, right_many


def _pass_on(unit: int, *columns: np.ndarray) -> tuple[int, int, bytes]:
    """A message to the unit itself, which slices do not read."""
    packed = [pack_ascending(column) for column in columns]
    head = np.array([len(data) for data in packed], np.int64).tobytes()
    return -1 - unit, unit, head + b"".join(packed)


def _passed_on(data: bytes, count: int) -> list[np.ndarray]:
    cuts = np.cumsum([8 * count, *np.frombuffer(data[: 8 * count], np.int64)])
    return [unpack_ascending(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _segment_entries(size: int, core: int, slices: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        unit = Unit(table)
        number = table.column("_unit")[0].as_py()
        segments = _Segments(unit, size, core)
        heard = {part: data for part, _, data in read_messages(answers)}
        many = _cut_to_shared(segments, heard, slices)
        entry = np.flatnonzero(segments.count)
        starts = segments.first[entry]
        ends = starts + segments.count[entry] + size - 1
        hashes = tuple(span_hashes(unit.buffer, starts, ends, lane) for lane in (0, 1))
        positions = unit.positions(segments.document[entry], starts)
        sent = send_first(number, entry, hashes, positions, slices)
        # The unit's own message also says which segments were looked at, and how they were cut.
        own = _pass_on(
            number,
            unpack_ascending(sent.column("data")[0].as_py()),
            entry,
            *map(np.flatnonzero, many),
            starts,
            ends,
        )
        return messages([own, *[row for row in read_messages(sent) if row[0] >= 0]])

    return run


def _heard(answers: pa.Table, columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    """What a unit passed on to itself, and the entries that slices answered."""
    passed, told = [np.zeros(0, np.int64)] * columns, [np.zeros(0, np.int64)]
    for part, _, data in read_messages(answers):
        if part < 0:
            passed = _passed_on(data, columns)
        else:
            told.append(unpack_ascending(data))
    return passed, np.concatenate(told)


def _each(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run's number and places, ``counts`` of them from its start on."""
    number = np.repeat(np.arange(len(starts)), counts)
    return number, starts[number] + np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)


def _sequences(size: int, core: int, slices: int):
    """The bytes of segments that come first, to the slice of their core."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        unit = Unit(table)
        number = table.column("_unit")[0].as_py()
        segments = _Segments(unit, size, core)
        (local, looked_at, left_many, right_many, starts, ends), told = _heard(answers, 6)
        later = np.union1d(local, told)
        again = np.isin(looked_at, later)
        lead, first, last = looked_at[~again], starts[~again], ends[~again] - size
        turn = np.clip(segments.turn[lead], first - 1, last)
        left_many, right_many = np.isin(lead, left_many), np.isin(lead, right_many)
        # Strings with a side in many units go one by one, each to its own slice.
        low = np.where(left_many, turn + 1, first)
        high = np.where(right_many, turn, last)
        whole = np.flatnonzero(low <= high)
        single, singles = _each(
            np.concatenate([first, turn + 1]),
            np.concatenate(
                [np.where(left_many, turn - first + 1, 0), np.where(right_many, last - turn, 0)]
            ),
        )
        single %= max(1, len(lead))
        order = np.argsort(singles, kind="stable")
        single, singles = single[order], singles[order]
        begin = np.concatenate([low[whole], singles])
        length = np.concatenate(
            [high[whole] - low[whole] + size, np.full(len(singles), size, np.int64)]
        )
        own_hash = span_hashes(unit.buffer, singles, singles + size)
        key = np.concatenate([segments.core[lead[whole]], own_hash])
        document = segments.document[np.concatenate([lead[whole], lead[single]])]
        order = np.argsort(begin, kind="stable")
        begin, length, key, document = (
            column[order] for column in (begin, length, key, document)
        )
        positions = unit.positions(document, begin)
        sent = [_pass_on(number, starts[again], ends[again])]
        data = unit.buffer.tobytes()
        for part, own in by_slice(slice_of(key, slices)):
            spans = zip(begin[own].tolist(), length[own].tolist(), strict=True)
            text = b"".join([data[low : low + count] for low, count in spans])
            packed = [pack_ascending(begin[own]), pack(length[own].astype(np.uint32))]
            packed.append(pack(key[own]))
            packed += [pack_by_text(column[own]) for column in positions]
            head = np.array([len(own)], np.int64).tobytes()
            sent.append((part, number, head + b"".join([*packed, text])))
        return messages(sent)

    return run


class ColumnWise:
    """Burrows-Wheeler transform and common prefixes of a collection of byte sequences.

    ``symbols``, ``common`` (with the suffix before, in bytes) and ``suffix`` (owner and
    length) are runs over all suffixes in order, end markers first. Byte 255 does not
    occur in UTF-8, so symbols are bytes plus one, and 0 stands before a whole sequence.
    """

    def __init__(self, text: np.ndarray, lengths: np.ndarray):
        count = len(lengths)
        self.text, self.lengths, self.ends = text, lengths, np.cumsum(lengths)
        self.symbols = text[self.ends - 1] + np.uint8(1)
        self.common = np.zeros(count, np.int16 if lengths.max() < 2**15 else np.int32)
        # A suffix's number has its length in the lower bits; narrow numbers move faster.
        self.bits = int(lengths.max()).bit_length()
        wide = count << self.bits >= 2**31
        self.suffix = (np.arange(count) << self.bits).astype(np.int64 if wide else np.int32)
        place = np.arange(count)
        for column in range(1, int(lengths.max()) + 1):
            place = self._insert(place, column)

    def _insert(self, place: np.ndarray, column: int) -> np.ndarray:
        """One round: the suffix of ``column`` bytes of every sequence that has one.

        ``place`` has the rows of the round before whose sequences go on; so does the result.
        """
        markers, total = len(self.lengths), len(self.symbols)
        order = np.argsort(self.symbols, kind="stable")
        whole = total - int(np.count_nonzero(self.symbols))
        grown = np.zeros(total, bool)
        grown[place] = True
        # The rank of a symbol in the transform is where its suffix belongs.
        ranks = np.flatnonzero(grown[order])
        into = ranks - whole + markers
        rows = markers + total - whole
        kept = np.ones(rows, bool)
        kept[into] = False
        common = np.empty(rows, self.common.dtype)
        common[kept] = self.common
        # The new suffix and the one behind it get common prefixes with the ones before.
        near = np.union1d(ranks, ranks[ranks + 1 < total] + 1)
        before, here = order[np.maximum(near - 1, 0)], order[near]
        same = (near > 0) & (self.symbols[before] == self.symbols[here])
        found = np.zeros(len(near), common.dtype)
        found[same] = 1 + self._least(before[same], here[same])
        common[near - whole + markers] = found
        owner = self.suffix[order[ranks]] >> self.bits
        before = self.ends[owner] - column - 1
        goes_on = before >= self.ends[owner] - self.lengths[owner]
        symbol = np.where(goes_on, self.text[np.maximum(before, 0)] + np.uint8(1), 0)
        symbols = np.empty(rows, np.uint8)
        symbols[kept], symbols[into] = self.symbols, symbol
        suffix = np.empty(rows, self.suffix.dtype)
        suffix[kept], suffix[into] = self.suffix, owner << self.bits | column
        self.symbols, self.common, self.suffix = symbols, common, suffix
        return into[goes_on]

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least common prefix over the rows after ``low`` up to ``high``."""
        order = np.argsort(-high)
        edges = np.empty(2 * len(high), np.int64)
        edges[0::2] = low[order] + 1
        edges[1::2] = high[order] + 1
        held = np.append(self.common, self.common.dtype.type(0))
        found = np.empty(len(high), held.dtype)
        if len(high):
            found[order] = np.minimum.reduceat(held, edges)[::2]
        return found

    def groups(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, offset in it and group number of each suffix whose first ``size`` bytes
        another suffix has too."""
        opens = self.common < size
        number = np.cumsum(opens)
        rows = np.bincount(number)
        shared = rows[number] > 1
        owner = (self.suffix[shared] >> self.bits).astype(np.int64)
        left = self.suffix[shared] & ((1 << self.bits) - 1)
        return owner, self.lengths[owner] - left, number[shared]


def _collections(key: np.ndarray) -> list[np.ndarray]:
    """Places of the sequences, by collection: equal keys stay together, and a collection is
    small enough for its runs to stay in a processor's cache."""
    order = np.argsort(key, kind="stable")
    opens = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
    sizes = np.diff(np.append(opens, len(order)))
    number = (np.cumsum(sizes) - sizes) // COLLECTION
    begins = opens[np.flatnonzero(np.diff(number, prepend=-1))]
    # A sequence alone with its key has no equal string elsewhere.
    alone = np.repeat(sizes == 1, sizes)
    parts = np.split(np.arange(len(order)), begins[1:])
    found = [order[part[~alone[part]]] for part in parts]
    return [own for own in found if len(own)] or [order[:1]]


def _strings_to_remove(size: int):
    def run(table: pa.Table) -> pa.Table:
        received = read_messages(table)
        part = received[0][0]
        if part < 0:
            return messages(received)
        columns, texts = [], []
        for _, unit, data in received:
            count = int(np.frombuffer(data[:8], np.int64)[0])
            cuts = 8 + count * np.cumsum([0, 4, 4, 8, 8, 8, 8])
            packed = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            texts.append(data[cuts[-1] :])
            columns.append(
                (
                    np.full(count, unit),
                    unpack_ascending(packed[0]),
                    unpack(packed[1], np.uint32).astype(np.int64),
                    unpack(packed[2], np.uint64),
                    *map(unpack_by_text, packed[3:]),
                )
            )
        columns = list(map(np.concatenate, zip(*columns, strict=True)))
        units, code, lengths, key, ids, copies, begin = columns
        text = np.frombuffer(b"".join(texts), np.uint8)
        at = np.cumsum(lengths) - lengths
        gone = []
        for own in _collections(key):
            held = np.concatenate([text[low : low + count] for low, count in zip(at[own], lengths[own])])
            owner, offset, group = ColumnWise(held, lengths[own]).groups(size)
            owner = own[owner]
            later = later_than_first((group,), (ids[owner], copies[owner], begin[owner] + offset))
            gone.append((units[owner[later]], code[owner[later]] + offset[later]))
        return answer(part, *map(np.concatenate, zip(*gone, strict=True)))

    return run


def _removed(size: int, as_text: bool):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        unit = Unit(table)
        (again, ends), codes = _heard(answers, 2)
        starts = np.concatenate([again, codes])
        lengths = np.concatenate([ends - again, np.full(len(codes), size, np.int64)])
        gone = covered(len(unit.buffer), starts, lengths)
        sizes, lost, pieces, kept = [], [], [], []
        for low, high in zip(unit.offsets[:-1], unit.offsets[1:], strict=True):
            own = gone[low:high]
            sizes.append(high - low)
            lost.append(int(own.sum()))
            pieces.append([{"start": a, "end": b} for a, b in zip(*runs(own), strict=True)])
            left = unit.buffer[low:high][~own].tobytes()
            kept.append(left.decode(errors="ignore") if as_text else left)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        result = {
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "removed": pa.array(pieces, span),
            "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
        }
        rows = pa.array(unit.document_of_row)
        return pa.table(
            {name: unit.rows.column(name) for name in ("_id", "_rest")}
            | {name: column.take(rows) for name, column in result.items()}
        )

    return run


def remove_repeated_bytes(
    docs: DataFrame,
    columns: Sequence[str] = (),
    as_text: bool = False,
    size: int = SIZE,
    core: int = CORE,
) -> DataFrame:
    """Remove each byte covered by a string of ``size`` bytes that also starts earlier.

    Returns doc_id, the carried ``columns`` as struct ``carried``, n_bytes, n_removed,
    removed (maximal runs, the end exclusive) and kept: the remaining bytes, which may
    cut a character, or with ``as_text`` a string without such parts of characters.
    """
    if not 2 <= core <= size:
        raise ValueError("a core must be a part of the strings")
    total = text_bytes(docs)
    slices = max(1, -(-total // (BYTES_PER_SEGMENT * SLICE_SEGMENTS)))
    bytes_slices = max(1, -(-total // SEQUENCE_SLICE_BYTES))
    docs = in_units(docs, total, columns)
    by_unit = docs.groupBy("_unit")

    def to_units(slice_work, sent):
        return sent.groupBy("_slice").applyInArrow(tablewise(slice_work), MESSAGE_DDL).groupBy("_unit")

    def by_units(unit_work, answers, schema=MESSAGE_DDL):
        return by_unit.cogroup(answers).applyInArrow(tablewise(unit_work), schema)

    shared = to_units(_merge, by_unit.applyInArrow(tablewise(_sketch(size, core, slices)), MESSAGE_DDL))
    later = to_units(later_entries, by_units(_segment_entries(size, core, slices), shared))
    # Construction takes more time than its bytes suggest, so its slices are not gathered by
    # size but dealt out evenly, a bounded number to each task.
    tasks = max(shuffle_width(docs.sparkSession), -(-bytes_slices // TASK_SLICES))
    sequences = by_units(_sequences(size, core, bytes_slices), later).repartitionById(
        tasks, "_slice"
    )
    marked = to_units(_strings_to_remove(size), sequences)
    schema = result_schema(
        docs,
        "n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, "
        f"kept {'string' if as_text else 'binary'}",
    )
    done = by_units(_removed(size, as_text), marked, schema)
    return with_columns_back(done, columns, ["n_bytes", "n_removed", "removed", "kept"])
