"""Words, spans and hashes of whole text columns, as numpy arrays over the Arrow buffers.

Texts are never copied into Python strings here: a column is one byte buffer and
an array of offsets, and every function works on all its texts at once. Long
buffers are hashed in pieces of ``PIECE`` bytes, so the working memory beyond the
buffer does not depend on the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE = 1 << 18


def _mask(kept) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[byte for byte in range(256) if kept(byte)]] = True
    return table


#: Words are runs of bytes that are not ASCII white space (space, tab to carriage return).
WHITE_SPACE_WORDS = _mask(lambda byte: byte != 0x20 and not 0x09 <= byte <= 0x0D)
#: Words are runs of ASCII digits, ASCII letters and bytes beyond ASCII.
LETTER_DIGIT_WORDS = _mask(
    lambda byte: byte >= 0x80 or chr(byte).isdigit() or chr(byte).isalpha()
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_LEFT = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWERS: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, made once per process."""
    if not _POWERS:
        _POWERS.extend([_powers(_BASE, PIECE + 1), _powers(pow(_BASE, -1, 2**64), PIECE + 1)])
    return _POWERS


#: Random values of the bytes, for two independent hashes.
_BYTE_VALUES = np.random.default_rng(7).integers(1, 2**63, (2, 256)).astype(np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one-to-one."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the offsets of each; null is empty."""
    # Large strings first: joined chunks of plain ones may not pass 2 GB.
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.large_binary()
    column = pc.fill_null(column.cast(binary), pa.scalar(b"", binary))
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def lower_ascii(buffer: np.ndarray) -> np.ndarray:
    return _LOWER[buffer]


def spans(
    buffer: np.ndarray, offsets: np.ndarray, kept: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of kept bytes within one text."""
    inside = kept[buffer]
    if not len(inside):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    edges = offsets[(offsets > 0) & (offsets < len(buffer))]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(
    buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0
) -> np.ndarray:
    """A 64-bit hash of each span's bytes; ``lane`` 0 and 1 are independent.

    Starts and ends must ascend; spans may overlap. Polynomial prefix sums give all spans
    of a piece at once; the length is mixed in. A span longer than a piece is hashed by
    xxHash.
    """
    power, inverse = _power_tables()
    found = np.empty(len(starts), np.uint64)
    place = 0
    while place < len(starts):
        base = int(starts[place])
        stop = int(np.searchsorted(ends, base + PIECE, "right"))
        if stop <= place:
            whole = buffer[base : int(ends[place])].tobytes()
            found[place] = xxhash.xxh3_64_intdigest(whole, seed=lane)
            place += 1
            continue
        part = buffer[base : int(ends[stop - 1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[lane][part] * power[: len(part)], out=sums[1:])
        low, high = starts[place:stop] - base, ends[place:stop] - base
        found[place:stop] = (sums[high] - sums[low]) * inverse[low]
        place = stop
    return mix(found ^ ((ends - starts).astype(np.uint64) * _LEFT))


def _of_length(width: int) -> np.uint64:
    return np.uint64(width * int(_LEFT) & (2**64 - 1))


class Rolling:
    """Hashes of the substrings of at most a piece of bytes, as ``span_hashes`` has them."""

    def __init__(self, buffer: np.ndarray):
        power, self._inverse = _power_tables()
        self.count = len(buffer)
        self._sums = np.zeros(self.count + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[0][buffer] * power[: self.count], out=self._sums[1:])

    def all(self, width: int) -> np.ndarray:
        """Of each ``width`` consecutive bytes."""
        count = max(0, self.count - width + 1)
        found = (self._sums[width:] - self._sums[:count]) * self._inverse[:count]
        return mix(found ^ _of_length(width))

    def at(self, places: np.ndarray, width: int) -> np.ndarray:
        """Of ``width`` bytes from the given places on."""
        found = (self._sums[places + width] - self._sums[places]) * self._inverse[places]
        return mix(found ^ _of_length(width))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _LEFT + right)


def window_hashes(items: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of each ``size`` consecutive items, by doubling; order matters.

    Entry i covers items i to i + size - 1, also across texts: callers drop
    the windows that cross an end.
    """
    if len(items) < size:
        return np.zeros(0, np.uint64)
    level, width = mix(items + np.uint64(seed * _BASE & (2**64 - 1))), 1
    whole, covered = None, 0
    while True:
        if size & width:
            if whole is None:
                whole = level
            else:
                count = len(level) - covered
                whole = _join(whole[:count], level[covered : covered + count])
            covered += width
        if covered == size:
            return whole[: len(items) - size + 1]
        level = _join(level[:-width], level[width:])
        width *= 2


def window_starts(text_of: np.ndarray, size: int) -> np.ndarray:
    """The numbers of the words that open a window of ``size`` words inside one text."""
    if len(text_of) < size:
        return np.zeros(0, np.int64)
    return np.flatnonzero(text_of[: len(text_of) - size + 1] == text_of[size - 1 :])


def covered(count: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of ``count`` places lie in one of the given runs."""
    change = np.bincount(starts, minlength=count + 1).astype(np.int64)
    change -= np.bincount(np.asarray(starts) + lengths, minlength=count + 1)
    return np.cumsum(change[:count]) > 0


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    change = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)
