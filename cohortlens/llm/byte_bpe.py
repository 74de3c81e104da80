"""Byte-level BPE encoding by a queue of merge ranks, and decoding.

A pre-token is a linked list of parts. Every pair of neighbours that can merge waits
in the bucket of its merge rank, and a bitmap in levels marks the buckets that are
not empty: the lowest set bit of the upper level names a block, that of the block the
lowest rank. Taking the next merge and queueing a new pair cost the same however
long the pre-token is, where a scan for the lowest rank would cost its whole length.
Entries of parts that have merged meanwhile are stale and skipped.

All distinct pre-tokens of a batch that no memory holds lie in one linked list, with walls
between them, and one queue runs over it: a bucket then holds the places of a rank in all of
them, which merge at once, overlapping ones from the left. That is the order of the merges in
each pre-token as long as a merge brings up no lower rank; where a rank file lets that happen,
the pre-token is encoded again on its own, place by place.

Texts are cut by the tokenizer's pattern, and each distinct pre-token is encoded once
per worker as long as a bounded memory holds it. Rank files are read by path in the
tasks. A null or empty text has no ids. Rows are handled one by one, so repeated rows,
ties and other columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.decontamination import bounded
from cohortlens.llm.memory import batchwise, holds

#: Bits of a rank that the lower level of the bitmap holds.
BLOCK_BITS = 10
BLOCK_MASK = (1 << BLOCK_BITS) - 1
#: Bits that hold an id, and what stands in the place of a part that has merged.
ID_BITS = 32
GONE = -1
#: What stands between two pre-tokens, and the rank of a pair that does not merge.
WALL = -2
NONE = np.iinfo(np.int32).max
#: Pieces of text after which a worker's memory is emptied, and the longest that it keeps.
MEMORY_ENTRIES = 400_000
MEMORY_LONGEST = 64
#: Text of a batch, and pre-tokens of one linked list, in bytes: what a worker holds at once is
#: some hundred times as much.
BATCH_BYTES = 1 << 20
LIST_BYTES = 1 << 20


class RankQueue:
    """Places in a text by merge rank; ``pop`` gives the places of the lowest rank.

    Ranks are buckets of places. ``top`` has a bit for each block of ranks in use, each
    block a bit for each rank in use.
    """

    __slots__ = ("buckets", "blocks", "top")

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.blocks: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, place: int) -> None:
        buckets = self.buckets
        if rank in buckets:
            buckets[rank].append(place)
            return
        buckets[rank] = [place]
        block, bit = rank >> BLOCK_BITS, 1 << (rank & BLOCK_MASK)
        blocks = self.blocks
        if block in blocks:
            blocks[block] |= bit
        else:
            blocks[block] = bit
            self.top |= 1 << block

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and all its places from the left; its bucket is emptied."""
        top = self.top
        block = (top & -top).bit_length() - 1
        blocks = self.blocks
        bits = blocks[block]
        rank = block << BLOCK_BITS | (bits & -bits).bit_length() - 1
        bits &= bits - 1
        if bits:
            blocks[block] = bits
        else:
            del blocks[block]
            self.top = top & (top - 1)
        places = self.buckets.pop(rank)
        if len(places) > 1:
            places.sort()
        return rank, places


class BatchQueue:
    """Places in a list by merge rank, pushed as arrays; ``pop`` gives those of the lowest rank.

    The upper level of the bitmap has a bit for each block of ranks that places wait in. Only
    the lowest block is dealt out to buckets per rank, under the lower level of the bitmap.
    """

    __slots__ = ("pushed", "waiting", "top", "block", "bits", "buckets")

    def __init__(self):
        self.pushed: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.top = 0
        self.block, self.bits = -1, 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, places: np.ndarray) -> None:
        blocks = ranks >> BLOCK_BITS
        here = blocks == self.block
        if here.any():
            self._deal(ranks[here], places[here])
            ranks, places = ranks[~here], places[~here]
        if len(ranks):
            self.pushed.append((ranks, places))

    def _deal(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Into the buckets of the open block."""
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        begins = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, own in zip(ranks[begins].tolist(), np.split(places, begins[1:])):
            self.buckets.setdefault(rank, []).append(own)
            self.bits |= 1 << (rank & BLOCK_MASK)

    def _open(self) -> None:
        """Sort what was pushed into blocks and deal out the lowest of them."""
        if self.pushed:
            ranks, places = (np.concatenate(own) for own in zip(*self.pushed))
            self.pushed.clear()
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            blocks = ranks >> BLOCK_BITS
            begins = np.flatnonzero(np.diff(blocks, prepend=-1))
            parts = zip(np.split(ranks, begins[1:]), np.split(places, begins[1:]))
            for block, part in zip(blocks[begins].tolist(), parts):
                self.waiting.setdefault(block, []).append(part)
                self.top |= 1 << block
        if self.top:
            self.block = (self.top & -self.top).bit_length() - 1
            self.top &= self.top - 1
            ranks, places = (np.concatenate(own) for own in zip(*self.waiting.pop(self.block)))
            self._deal(ranks, places)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its places from the left, each once; None when all is done."""
        if not self.bits:
            self.block = -1
            self._open()
            if not self.bits:
                return None
        rank = self.block << BLOCK_BITS | (self.bits & -self.bits).bit_length() - 1
        self.bits &= self.bits - 1
        own = self.buckets.pop(rank)
        places = own[0] if len(own) == 1 else np.concatenate(own)
        return rank, np.unique(places) if len(places) > 1 else places


def _every_other(places: np.ndarray, right: np.ndarray) -> np.ndarray | None:
    """Which places merge where one's right part is the next one's left; None if nowhere."""
    meets = right[:-1] == places[1:]
    if not meets.any():
        return None
    index = np.arange(len(places))
    opens = np.concatenate([[True], ~meets])
    return (index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0


class ByteBpe:
    """The merges of a rank file; ``ranks`` maps each token's bytes to its id and rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.of_byte = [ranks[bytes([value])] for value in range(256)]
        self.merges = self._all_merges()
        self.memory: dict[str, bytes] = {}
        self.most: int | None = None
        # The merges as sorted arrays, those of two bytes by both, and all tokens in one buffer.
        self._pairs = np.array(sorted(self.merges), np.int64)
        self._merged = np.array([self.merges[pair] for pair in self._pairs.tolist()], np.int32)
        self._byte_ids = np.array(self.of_byte, np.int32)
        both = self._byte_ids.astype(np.int64)
        self._byte_pairs = self._look_up((both[:, None] << ID_BITS | both).ravel())
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        self._lengths = lengths
        self._begins = np.cumsum(lengths) - lengths
        self._bytes = np.frombuffer(b"".join(token for _, token in sorted(self.tokens.items())), np.uint8)

    def _look_up(self, pairs: np.ndarray) -> np.ndarray:
        """The rank that each pair of ids merges at."""
        if not len(self._pairs):
            return np.full(len(pairs), NONE, np.int32)
        at = np.searchsorted(self._pairs, pairs)
        at[at == len(self._pairs)] = 0
        return np.where(self._pairs[at] == pairs, self._merged[at], NONE)

    def _all_merges(self) -> dict[int, int]:
        """The id that two ids merge into, by both in one number: every cut of every token."""
        ranks = self.ranks
        return {
            ranks[token[:cut]] << ID_BITS | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids: list[int] = [self.of_byte[value] for value in piece]
        count = len(ids)
        following = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        merge = self.merges.get
        queue = RankQueue()
        push = queue.push
        for place in range(count - 1):
            merged = merge(ids[place] << ID_BITS | ids[place + 1])
            if merged is not None:
                push(merged, place)
        while queue.top:
            rank, places = queue.pop()
            for at, place in enumerate(places):
                right = following[place]
                # Stale if this part is gone, is the last, or no longer makes this pair.
                if right >= count or merge(ids[place] << ID_BITS | ids[right]) != rank:
                    continue
                ids[place], ids[right] = rank, GONE
                after = following[right]
                following[place] = after
                # The part that went takes part in no pair any more.
                following[right] = count
                lower = False
                if after < count:
                    before[after] = place
                    merged = merge(rank << ID_BITS | ids[after])
                    if merged is not None:
                        push(merged, place)
                        lower = merged < rank
                prior = before[place]
                if prior >= 0:
                    merged = merge(ids[prior] << ID_BITS | rank)
                    if merged is not None:
                        push(merged, prior)
                        lower |= merged < rank
                if lower:
                    # A lower rank came up: it goes first, the rest of this bucket waits.
                    for waiting in places[at + 1 :]:
                        push(rank, waiting)
                    break
        return [part for part in ids if part != GONE]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of pre-tokens, none of them empty, by one queue over all of them."""
        lengths = np.array([len(piece) for piece in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        # A wall stands before each pre-token and behind the last.
        at = np.arange(len(data)) + np.repeat(np.arange(1, len(pieces) + 1), lengths)
        count = len(data) + len(pieces) + 1
        ids = np.full(count, WALL, np.int32)
        ids[at] = self._byte_ids[data]
        ends = np.cumsum(lengths) + np.arange(1, len(pieces) + 1)
        following = np.arange(1, count + 1, dtype=np.int32)
        before = np.arange(-1, count - 1, dtype=np.int32)
        pair = np.full(count, NONE, np.int32)
        pair[at[:-1]] = self._byte_pairs[data[:-1].astype(np.int64) << 8 | data[1:]]
        pair[ends - 1] = NONE
        again: set[int] = set()
        queue = BatchQueue()
        start = np.flatnonzero(pair != NONE)
        queue.push(pair[start], start)
        while (popped := queue.pop()) is not None:
            rank, places = popped
            # Stale if this part is gone or begins another pair meanwhile.
            places = places[pair[places] == rank]
            if not len(places):
                continue
            right = following[places]
            if len(places) > 1 and (kept := _every_other(places, right)) is not None:
                places, right = places[kept], right[kept]
            after = following[right]
            if len(places) > 1 and (beside := np.flatnonzero(after[:-1] == places[1:])).size:
                # Until the next place merges too, the new part stands before its left part.
                between = self._look_up(rank << ID_BITS | ids[after[beside]].astype(np.int64))
                sooner = places[beside[between < rank]]
                again.update(np.searchsorted(ends, sooner, "right").tolist())
            ids[places], ids[right], pair[right] = rank, GONE, NONE
            following[places], before[after] = after, places
            around = np.concatenate([before[places], places])
            ranks = self._look_up(ids[around].astype(np.int64) << ID_BITS | ids[following[around]])
            pair[around] = ranks
            merges = ranks != NONE
            ranks, around = ranks[merges], around[merges]
            if len(ranks):
                if ranks.min() < rank:
                    again.update(np.searchsorted(ends, around[ranks < rank], "right").tolist())
                queue.push(ranks, around)
        alive = ids >= 0
        cuts = np.concatenate([[0], np.cumsum(alive)[ends - 1]])
        packed = ids[alive].astype("<u4").tobytes()
        found = [packed[4 * low : 4 * high] for low, high in zip(cuts.tolist(), cuts[1:].tolist())]
        for number in again:
            found[number] = array("I", self.encode_piece(pieces[number])).tobytes()
        return found

    def _cut(self, text: str) -> list[str]:
        """Stretches of a text that are looked up whole.

        A single space before a word always opens a match of the pattern, so where no two
        spaces meet, the text is cut there; else each match is a stretch.
        """
        if "  " in text:
            return self.pattern.findall(text)
        first, *others = text.split(" ")
        return [first, *[" " + other for other in others]]

    def _learn(self, stretches: Iterable[str]) -> None:
        """Encode stretches that the memory lacks, all their new pre-tokens together."""
        memory, ranks = self.memory, self.ranks
        cut = {stretch: self.pattern.findall(stretch) for stretch in stretches}
        new: list[tuple[str, bytes]] = []
        for piece in {piece for pieces in cut.values() for piece in pieces}.difference(memory):
            data = piece.encode()
            whole = ranks.get(data)
            if whole is None:
                new.append((piece, data))
            else:
                memory[piece] = whole.to_bytes(4, "little")
        start, size = 0, 0
        for end, (_, data) in enumerate(new, 1):
            size += len(data)
            if size >= LIST_BYTES or end == len(new):
                part = new[start:end]
                ids = self.encode_pieces([data for _, data in part])
                memory.update(zip([piece for piece, _ in part], ids))
                start, size = end, 0
        for stretch, pieces in cut.items():
            if len(pieces) != 1 or pieces[0] != stretch:
                memory[stretch] = b"".join([memory[piece] for piece in pieces])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        memory = self.memory
        if len(memory) >= (self.most or MEMORY_ENTRIES):
            memory.clear()
        cut = [self._cut(text) for text in texts]
        missing: set[str] = set()
        for stretches in cut:
            missing.update(stretches)
        missing.difference_update(memory)
        self._learn(missing)
        known = memory.__getitem__
        found = [b"".join(map(known, stretches)) for stretches in cut]
        for stretch in [key for key in missing if len(key) > MEMORY_LONGEST]:
            del memory[stretch]
        return found

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode_batch(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that packed ids stand for, gathered from one buffer of all tokens."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        lengths = self._lengths[flat]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._begins[flat] - (ends - lengths), lengths)
        data = self._bytes[places].tobytes()
        cuts = np.cumsum([0, *[len(own) // 4 for own in ids]])
        edges = np.concatenate([[0], ends])[cuts].tolist()
        return [data[low:high] for low, high in zip(edges, edges[1:])]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_batch([ids])[0]


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """The tokenizer of a rank file, read once per worker."""
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe.from_file(path, pattern)
        holds(__name__, _LOADED.clear)
    return _LOADED[key]


def _encoding(path: Callable[[], str], pattern: str, entries: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path(), pattern)
        bpe.most = entries
        for whole in batches:
            if "_text" not in whole.schema.names:
                row = whole.column("row")
                whole = pa.RecordBatch.from_arrays([row, row.field("text")], ["row", "_text"])
            for batch in bounded(whole, "_text", BATCH_BYTES):
                ids = bpe.encode_batch([text or "" for text in batch.column("_text").to_pylist()])
                decoded = bpe.decode_batch(ids)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": batch.column("row"),
                        "ids": pa.array(ids, pa.binary()),
                        "decoded": pa.array(decoded, pa.binary()),
                    }
                )

    return batchwise(run, __name__)


def encode_and_decode(
    docs: DataFrame, path: Callable[[], str], pattern: str, entries: int | None = None
) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``; ``ids``, little-endian unsigned 32-bit
    integers; and ``decoded``, the bytes that those ids stand for.

    ``path`` is called in the tasks and gives the rank file's place on that machine. A worker's
    memory is emptied beyond ``entries`` pieces of text, ``MEMORY_ENTRIES`` where none are given.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    # A text that the row holds as it is travels once: batches are sent whole, so a second
    # copy would be held by the executor and by the worker.
    held = dict(docs.dtypes).get("text") == "string"
    apart = [] if held else [F.col("text").cast("string").alias("_text")]
    schema = T.StructType(
        [
            T.StructField("row", docs.schema, False),
            *T.StructType.fromDDL("ids binary, decoded binary"),
        ]
    )
    return docs.select(row.alias("row"), *apart).mapInArrow(
        _encoding(path, pattern, entries), schema
    )
