"""Removal of repeated word windows, prefiltered by a count-min sketch.

Each unit of documents counts its windows into a count-min sketch of ``DEPTH`` rows
whose cells are dealt into slices. The merged sketches overestimate how often a
window occurs, so a window estimated to occur once does; each unit learns, as one
bit per cell it had filled, which of its cells are shared. A second pass groups only
the windows estimated repeated, exactly, by 128 bits of hash, and tells each unit
which of its windows also start earlier. Nothing is lost: the sketch only saves work.

Windows of a document are judged on the input. A null or empty text has no words. A
text shorter than a window keeps all its words. Rows that repeat doc_id and text are
one document and get the same result; see ``units`` for null and equal doc_ids. An
empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.units import (
    MESSAGE_DDL,
    SLICE_CELLS,
    Unit,
    cells_of,
    filled_cells,
    in_units,
    later_entries,
    messages,
    pack_ascending,
    read_messages,
    result_schema,
    send_first,
    text_bytes,
    unpack_ascending,
    with_columns_back,
)
from cohortlens.llm.words import (
    WHITE_SPACE_WORDS,
    covered,
    runs,
    span_hashes,
    spans,
    window_hashes,
    window_starts,
)

WINDOW = 20
#: Rows of the count-min sketch.
DEPTH = 2
#: Windows that a slice holds about, a quarter of the cells in each of its sketch rows.
SLICE_ENTRIES = SLICE_CELLS // 4
#: Text bytes per window, low on purpose: it only sets how many slices there are.
BYTES_PER_WINDOW = 6


class _Windows:
    """All windows of a unit, in the order of their documents and starts."""

    def __init__(self, unit: Unit, size: int):
        self.starts, self.ends, self.document = spans(
            unit.buffer, unit.offsets, WHITE_SPACE_WORDS
        )
        self.opening = window_starts(self.document, size)

    def hashes(self, unit: Unit, size: int) -> tuple[np.ndarray, np.ndarray]:
        words = span_hashes(unit.buffer, self.starts, self.ends)
        return tuple(window_hashes(words, size, seed)[self.opening] for seed in (1, 2))


def _sketch(size: int, slices: int):
    def run(table: pa.Table) -> pa.Table:
        unit = Unit(table)
        first, _ = _Windows(unit, size).hashes(unit, size)
        number = table.column("_unit")[0].as_py()
        return messages(
            [
                (row * slices + part, number, pack_ascending(cells.astype(np.int64)))
                for row in range(DEPTH)
                for part, cells in filled_cells(cells_of(first, row, slices), slices)
            ]
        )

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Add up one slice's sketches; answer each unit with one bit per cell it filled."""
    received = [(*row[:2], unpack_ascending(row[2])) for row in read_messages(table)]
    counts = np.zeros(SLICE_CELLS, np.uint8)
    for _, _, cells in received:
        counts[cells] = np.minimum(counts[cells] + 1, 2)
    return messages(
        [
            (part, number, np.packbits(counts[cells] > 1).tobytes())
            for part, number, cells in received
        ]
    )


def _estimated_repeated(
    hashes: np.ndarray, answers: dict[int, bytes], slices: int
) -> np.ndarray:
    """Windows that every sketch row counts twice or more, here or in any other unit."""
    repeated = np.ones(len(hashes), bool)
    for row in range(DEPTH):
        cells = cells_of(hashes, row, slices)
        filled, place, here = np.unique(cells, return_inverse=True, return_counts=True)
        shared = [
            np.unpackbits(np.frombuffer(answers[row * slices + part], np.uint8), count=len(own))
            for part, own in filled_cells(cells, slices)
        ]
        shared = np.concatenate(shared) if shared else np.zeros(0, np.uint8)
        repeated &= ((shared > 0) | (here > 1))[place]
    return repeated


def _entries(size: int, slices: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        unit = Unit(table)
        windows = _Windows(unit, size)
        first, second = windows.hashes(unit, size)
        heard = {part: data for part, _, data in read_messages(answers)}
        entry = np.flatnonzero(_estimated_repeated(first, heard, slices))
        number = table.column("_unit")[0].as_py()
        opening = windows.opening[entry]
        return send_first(
            number,
            entry,
            (first[entry], second[entry]),
            unit.positions(windows.document[opening], windows.starts[opening]),
            slices,
        )

    return run


def _removed(size: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        unit = Unit(table)
        windows = _Windows(unit, size)
        gone = [unpack_ascending(data) for _, _, data in read_messages(answers)]
        gone = np.concatenate(gone) if gone else np.zeros(0, np.int64)
        removed = covered(len(windows.starts), windows.opening[gone], size)
        kept, words, lost, places = [], [], [], []
        edges = np.searchsorted(windows.document, np.arange(len(unit.first) + 1))
        whole = unit.buffer.tobytes()
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            own = removed[low:high]
            left = np.flatnonzero(~own) + low
            words.append(high - low)
            lost.append(int(own.sum()))
            starts, ends = runs(own)
            places.append([{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)])
            kept.append(
                b" ".join(
                    whole[a:b]
                    for a, b in zip(
                        windows.starts[left].tolist(), windows.ends[left].tolist(), strict=True
                    )
                ).decode()
            )
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        result = {
            "n_words": pa.array(words, pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "kept_text": pa.array(kept, pa.string()),
            "removed": pa.array(places, span),
        }
        rows = pa.array(unit.document_of_row)
        return pa.table(
            {name: unit.rows.column(name) for name in ("_id", "_rest")}
            | {name: column.take(rows) for name, column in result.items()}
        )

    return run


def remove_repeated_windows(
    docs: DataFrame, columns: Sequence[str] = (), size: int = WINDOW
) -> DataFrame:
    """Remove each word that lies in a window of ``size`` words which also starts earlier.

    Returns doc_id, the carried ``columns`` as struct ``carried``, n_words, n_removed,
    kept_text (remaining words joined by one space) and removed (runs of removed words,
    the end exclusive).
    """
    total = text_bytes(docs)
    slices = max(1, -(-total // (BYTES_PER_WINDOW * SLICE_ENTRIES)))
    docs = in_units(docs, total, columns)
    by_unit = docs.groupBy("_unit")
    sketches = by_unit.applyInArrow(_sketch(size, slices), MESSAGE_DDL)
    answers = sketches.groupBy("_slice").applyInArrow(_merge, MESSAGE_DDL)
    entries = by_unit.cogroup(answers.groupBy("_unit")).applyInArrow(
        _entries(size, slices), MESSAGE_DDL
    )
    later = entries.groupBy("_slice").applyInArrow(later_entries, MESSAGE_DDL)
    schema = result_schema(
        docs, "n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"
    )
    done = by_unit.cogroup(later.groupBy("_unit")).applyInArrow(_removed(size), schema)
    return with_columns_back(done, columns, ["n_words", "n_removed", "kept_text", "removed"])
