"""Documents in bounded units, and arrays sent between units and slices of a hash space.

Operators that look for repeated content deal the documents into *units* of about
``UNIT_BYTES`` of text by a hash of each document, and the content's hash space into
*slices*. A unit sends each slice one packed array; the slice answers every unit that
wrote to it. No row per word or window is made, nothing is collected or broadcast,
and content that a third of all documents share costs each unit one entry. Every
pass reads the same exchange of documents, which Spark reuses within one plan.

A document is a (doc_id, text) pair: rows that repeat both are one document, whose
result each of them gets; equal doc_ids with different texts are documents ordered by
a hash of the text. A null doc_id comes before all others.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.words import mix, text_buffer

UNIT_BYTES = 4 << 20
NO_ID = -(2**63)


def text_bytes(docs: DataFrame) -> int:
    """All text in bytes, in one scan that keeps nothing."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def in_units(
    docs: DataFrame, total_bytes: int, columns: Sequence[str] = (), unit_bytes: int = UNIT_BYTES
) -> DataFrame:
    """Documents with their unit, order keys, text, and ``columns`` in the struct ``_rest``."""
    units = max(1, -(-total_bytes // unit_bytes))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    copy = F.xxhash64(text)
    rest = F.struct(F.col("doc_id").isNull().alias("_no_id"), *[F.col(name) for name in columns])
    return docs.select(
        F.pmod(F.xxhash64(key, copy), F.lit(units)).cast("int").alias("_unit"),
        key.alias("_id"),
        copy.alias("_copy"),
        text.alias("_text"),
        rest.alias("_rest"),
    )


def result_schema(units: DataFrame, results: str) -> T.StructType:
    """The document's id and carried columns, then the results given as DDL."""
    carried = T.StructType([units.schema["_id"], units.schema["_rest"]])
    return T.StructType([*carried, *T.StructType.fromDDL(results)])


def with_columns_back(done: DataFrame, columns: Sequence[str], results: Sequence[str]) -> DataFrame:
    """doc_id, the carried columns as the struct ``carried``, and the results."""
    carried = F.struct(*[F.col("_rest")[name].alias(name) for name in columns])
    return done.select(
        F.when(~F.col("_rest._no_id"), F.col("_id")).alias("doc_id"),
        *([carried.alias("carried")] if columns else []),
        *results,
    )


class Unit:
    """The distinct documents of a unit in ascending order, and where each row's went."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table, [("_id", "ascending"), ("_copy", "ascending")])
        self.rows = table.take(order)
        ids = self.rows.column("_id").to_numpy()
        copies = self.rows.column("_copy").to_numpy()
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (copies[1:] != copies[:-1])
        self.first = np.flatnonzero(new)
        self.document_of_row = np.cumsum(new) - 1
        self.ids, self.copies = ids[self.first], copies[self.first]
        self.buffer, self.offsets = text_buffer(self.rows.column("_text").take(self.first))

    def positions(self, document: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """Order keys of places in the unit's text: id, copy and place in the document."""
        return self.ids[document], self.copies[document], place - self.offsets[document]


def pack(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, which the shuffle's compression handles better."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending integers below 2**32 by their differences."""
    return pack(np.diff(values, prepend=0).astype(np.uint32))


def unpack_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint32).astype(np.int64))


def pack_by_text(values: np.ndarray) -> bytes:
    """Any 64-bit integers, by wrapping differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_by_text(data: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    """An even deal of 64-bit hashes into slices, by their upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


def by_slice(slices_of_entries: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each slice with its entries' places, in their order."""
    order = np.argsort(slices_of_entries, kind="stable")
    ordered = slices_of_entries[order]
    present, begins = np.unique(ordered, return_index=True)
    if not len(present):
        return []
    return list(zip(present.tolist(), np.split(order, begins[1:]), strict=True))


MESSAGE = pa.schema(
    [pa.field("_slice", pa.int32()), pa.field("_unit", pa.int32()), pa.field("data", pa.binary())]
)
MESSAGE_DDL = "_slice int, _unit int, data binary"


def messages(rows: Sequence[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.table(
        [pa.array(column, field.type) for column, field in zip(columns, MESSAGE, strict=True)],
        schema=MESSAGE,
    )


def read_messages(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """The messages of one slice or unit, in a fixed order."""
    rows = zip(*[table.column(name).to_pylist() for name in MESSAGE.names], strict=True)
    return sorted(rows, key=lambda row: row[:2])


#: Cells of a slice's sketch row.
SLICE_CELLS = 1 << 22


def cells_of(hashes: np.ndarray, row: int, slices: int) -> np.ndarray:
    """The sketch cell of each window in one row, numbered through all slices."""
    spread = mix(hashes + np.uint64(row))
    cell = spread & np.uint64(SLICE_CELLS - 1)
    return slice_of(spread, slices) * np.uint64(SLICE_CELLS) + cell


def filled_cells(cells: np.ndarray, slices: int) -> list[tuple[int, np.ndarray]]:
    """Per slice, the ascending cells that are filled."""
    filled = np.unique(cells)
    edges = np.searchsorted(filled, np.arange(slices + 1, dtype=np.uint64) * np.uint64(SLICE_CELLS))
    return [
        (number, filled[edges[number] : edges[number + 1]] - np.uint64(number * SLICE_CELLS))
        for number in np.flatnonzero(np.diff(edges)).tolist()
    ]


def _first_of_each(hashes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which entries are the first with their two hashes."""
    first, second = hashes
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    a, b = first[order], second[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    leads = np.zeros(len(order), bool)
    leads[order[new]] = True
    return leads


def send_first(
    unit: int,
    entry: np.ndarray,
    hashes: tuple[np.ndarray, np.ndarray],
    positions: tuple[np.ndarray, ...],
    slices: int,
) -> pa.Table:
    """Messages with a unit's entries, ascending in position, to be grouped by two hashes.

    Only the first entry of each group in the unit travels. The others are known to come
    later; they go with a message to the unit itself, which no slice reads.
    """
    leads = _first_of_each(hashes)
    lead = np.flatnonzero(leads)
    sent = [(-1 - unit, unit, pack_ascending(entry[~leads]))]
    for part, chosen in by_slice(slice_of(hashes[0][lead], slices)):
        own = lead[chosen]
        packed = [pack_ascending(entry[own]), pack(hashes[0][own]), pack(hashes[1][own])]
        packed += [pack_by_text(column[own]) for column in positions]
        sent.append((part, unit, b"".join(packed)))
    return messages(sent)


def read_columns(data: bytes, widths: Sequence[int]) -> list[bytes]:
    """The packed columns of a message, given the bytes of one value of each."""
    cuts = np.cumsum([0, *widths]) * (len(data) // sum(widths))
    return [data[low:high] for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


def later_than_first(groups: Sequence[np.ndarray], positions: Sequence[np.ndarray]) -> np.ndarray:
    """The entries that have the same group values as one with an earlier position."""
    order = np.lexsort((*positions[::-1], *groups[::-1]))
    again = np.zeros(len(order), bool)
    again[1:] = np.logical_and.reduce(
        [group[order][1:] == group[order][:-1] for group in groups]
    )
    return np.sort(order[again])


def answer(part: int, units: np.ndarray, entries: np.ndarray) -> pa.Table:
    """Messages that give each unit its entries among the given ones."""
    return messages(
        [
            (part, unit, pack_ascending(np.sort(entries[chosen])))
            for unit, chosen in by_slice(units)
        ]
    )


def later_entries(table: pa.Table) -> pa.Table:
    """The entries of a slice that also come earlier, back to their units."""
    received = read_messages(table)
    part = received[0][0]
    if part < 0:
        return messages(received)
    columns = []
    for _, unit, data in received:
        entry, first, second, *positions = read_columns(data, (4, 8, 8, 8, 8, 8))
        entry = unpack_ascending(entry)
        hashes = unpack(first, np.uint64), unpack(second, np.uint64)
        columns.append(
            (np.full(len(entry), unit), entry, *hashes, *map(unpack_by_text, positions))
        )
    units, entry, first, second, *positions = map(np.concatenate, zip(*columns, strict=True))
    gone = later_than_first((first, second), positions)
    return answer(part, units[gone], entry[gone])
