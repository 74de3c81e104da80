"""Removal of benchmark passages from training documents.

The benchmark's normalised word windows become a sorted table of hashes that is
broadcast; tasks scan their documents' windows against it, verify every hit word by
word, and mark the words it covers. The table is broadcast in blocks of at most
``BLOCK_BYTES``: a benchmark beyond that is scanned in several passes over the
documents, whose hits are united, so what is broadcast never grows.

Words are runs of letters, digits and bytes beyond ASCII after lower-casing A-Z. A
window is ``WINDOW`` consecutive item words; an item with fewer, but some, is one
window by itself. A null or empty text has no words, and an item without words has no
windows. Items may repeat; an item_id that several rows share counts once. Rows that
repeat a doc_id are judged each on their own. A null item_id is never counted. Empty
tables give no hits or no rows. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.words import (
    LETTER_DIGIT_WORDS,
    covered,
    lower_ascii,
    runs,
    span_hashes,
    spans,
    text_buffer,
    window_hashes,
    window_starts,
)
from cohortlens.operators.joins import key_filter
from cohortlens.session import materialize

WINDOW = 10
#: Most bytes of benchmark text whose windows are broadcast at once.
BLOCK_BYTES = 16 << 20
#: Longer items than this part of a block are cut; parts that items are dealt into per block.
PIECES, PARTS = 64, 64
#: Text bytes that a task handles at once; a longer text is handled by itself.
BATCH_BYTES = 4 << 20

SPAN = "array<struct<start:int,end:int>>"


class Passages:
    """The windows of some benchmark items, by size: hashes, and the words to verify."""

    def __init__(self, item_ids: Sequence[str], texts: Sequence[str | None], size: int):
        buffer, offsets = text_buffer(pa.array(texts, pa.string()))
        buffer = lower_ascii(buffer)
        starts, ends, item = spans(buffer, offsets, LETTER_DIGIT_WORDS)
        words = span_hashes(buffer, starts, ends)
        counts = np.bincount(item, minlength=len(texts))
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.item_ids = list(item_ids)
        self.starts, self.ends, self.text = starts, ends, buffer.tobytes()
        self.by_size = {}
        for length in sorted({min(int(count), size) for count in counts if count}):
            if length == size:
                opening = window_starts(item, size)
            else:
                opening = first[counts == length]
            hashes = window_hashes(words, length)[opening]
            order = np.argsort(hashes, kind="stable")
            self.by_size[length] = (hashes[order], opening[order], item[opening[order]])

    def words_of(self, opening: int, size: int) -> list[bytes]:
        place = slice(opening, opening + size)
        return [
            self.text[a:b]
            for a, b in zip(self.starts[place].tolist(), self.ends[place].tolist(), strict=True)
        ]


def _scan(texts: pa.Array, passages: Passages) -> list[tuple[int, np.ndarray, set[int]]]:
    """Per text: its number of words, which of them are hit, and the items that hit."""
    buffer, offsets = text_buffer(texts)
    buffer = lower_ascii(buffer)
    starts, ends, text_of = spans(buffer, offsets, LETTER_DIGIT_WORDS)
    hashes = span_hashes(buffer, starts, ends)
    hit = np.zeros(len(starts), bool)
    items: list[set[int]] = [set() for _ in range(len(texts))]
    for size, (known, opening, item) in passages.by_size.items():
        places = window_starts(text_of, size)
        windows = window_hashes(hashes, size)[places]
        low = np.searchsorted(known, windows, "left")
        high = np.searchsorted(known, windows, "right")
        found = np.flatnonzero(high > low)
        proven = []
        for number in found.tolist():
            place = int(places[number])
            words = [
                buffer[starts[i] : ends[i]].tobytes() for i in range(place, place + size)
            ]
            equal = [
                entry
                for entry in range(int(low[number]), int(high[number]))
                if passages.words_of(int(opening[entry]), size) == words
            ]
            if equal:
                proven.append(place)
                items[text_of[place]].update(item[equal].tolist())
        if proven:
            hit |= covered(len(hit), np.array(proven), size)
    edges = np.searchsorted(text_of, np.arange(len(texts) + 1))
    return [
        (int(high - low), hit[low:high], items[number])
        for number, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True))
    ]


def bounded(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``most`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = text_buffer(batch.column(column))
    group = offsets[:-1] // most
    begins = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    for low, high in zip(begins, [*begins[1:], batch.num_rows], strict=True):
        yield batch.slice(int(low), int(high - low))


def _hits(passages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = passages.value
        for whole in batches:
            for batch in bounded(whole, "_text"):
                found = _scan(batch.column("_text"), known)
                places = [runs(hit) for _, hit, _ in found]
                ids = [sorted({known.item_ids[i] for i in items} - {None}) for _, _, items in found]
                columns = {
                    "n_words": pa.array([count for count, _, _ in found], pa.int64()),
                    "hits": pa.array(
                        [
                            [{"start": a, "end": b} for a, b in zip(low, high, strict=True)]
                            for low, high in places
                        ],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                    "item_ids": pa.array(ids, pa.list_(pa.string())),
                }
                carried = {
                    name: batch.column(name) for name in batch.schema.names if name != "_text"
                }
                yield pa.RecordBatch.from_pydict(carried | columns)

    return run


def _pieces(text: str | None, most: int, size: int) -> list[str | None]:
    """A text of more than ``most`` bytes in pieces of as many, or of ``size`` words if those
    are longer, that overlap by ``size - 1`` words: each window is in a piece."""
    if text is None or len(text.encode()) <= most:
        return [text]
    buffer, offsets = text_buffer(pa.array([text], pa.string()))
    starts, ends, _ = spans(lower_ascii(buffer), offsets, LETTER_DIGIT_WORDS)
    pieces, low, high = [], 0, 0
    while high < len(starts):
        fitting = int(np.searchsorted(ends, starts[low] + most, "right"))
        high = min(max(fitting, low + size), len(starts))
        pieces.append(buffer[starts[low] : ends[high - 1]].tobytes().decode())
        low = high - size + 1
    return pieces


def _cutting(most: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(name).to_pylist() for name in ("item_id", "text")], strict=True)
            for item_id, text in rows:
                pieces = _pieces(text, most, size)
                columns = {"item_id": [item_id] * len(pieces), "text": pieces}
                yield pa.RecordBatch.from_pydict(
                    {name: pa.array(column, pa.string()) for name, column in columns.items()}
                )

    return run


def _blocks(benchmark: DataFrame, size: int) -> list[DataFrame]:
    """The distinct items, long ones in pieces, in blocks of ``BLOCK_BYTES`` at most; only a
    run of ``size`` words beyond that makes a larger one."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    ).distinct()
    held = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(16)
    total, longest = items.agg(F.coalesce(F.sum(held), F.lit(0)), F.max(held)).first()
    if total <= BLOCK_BYTES:
        return [items] if total else []
    most = max(1, BLOCK_BYTES // PIECES)
    if longest > most:
        items = items.mapInArrow(_cutting(most, size), items.schema).distinct()
    items = materialize(items)
    buckets = PARTS * -(-total // BLOCK_BYTES)
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets)))
    ranges: list[list[int]] = []
    filled = 0
    for part, part_bytes in sorted(map(tuple, dealt.groupBy("_part").agg(F.sum(held)).collect())):
        if not ranges or filled + part_bytes > BLOCK_BYTES:
            ranges.append([part, part])
            filled = 0
        ranges[-1][1] = part
        filled += part_bytes
    return [dealt.where(F.col("_part").between(low, high)) for low, high in ranges]


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, n_words, ``hits`` (runs of hit words,
    the end exclusive) and ``item_ids`` (as sorted strings).

    The result has one row per document. A benchmark of several blocks takes one scan of
    the documents each, which gives the hits alone, and one that adds them to the rows.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    schema = T.StructType(
        [T.StructField("row", docs.schema, False)]
        + list(T.StructType.fromDDL(f"n_words long, hits {SPAN}, item_ids array<string>"))
    )
    blocks = _blocks(benchmark, size)
    if len(blocks) <= 1:
        items = blocks[0].collect() if blocks else []
        known = Passages([item[0] for item in items], [item[1] for item in items], size)
        keyed = docs.select(row.alias("row"), text)
        return keyed.mapInArrow(_hits(spark.sparkContext.broadcast(known)), schema)
    # Hits hang on the text alone: they travel under its digest, and no text with them.
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    told = T.StructType([T.StructField("digest", T.BinaryType()), *schema[1:]])
    parts = []
    for block in blocks:
        items = block.select("item_id", "text").collect()
        known = Passages([item[0] for item in items], [item[1] for item in items], size)
        scanned = docs.select(digest, text).mapInArrow(_hits(spark.sparkContext.broadcast(known)), told)
        parts.append(scanned.where(F.size("hits") > 0))
    united = (
        reduce(DataFrame.unionAll, parts)
        .groupBy("digest")
        .agg(
            F.flatten(F.collect_set("hits")).alias("_hits"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("_items"),
        )
    )
    found = materialize(united.select("digest", _union_runs("_hits").alias("_hits"), "_items"))
    nothing = spark.sparkContext.broadcast(Passages([], [], size))
    counted = docs.select(row.alias("row"), digest, text).mapInArrow(
        _hits(nothing), T.StructType([schema[0], told[0], *schema[1:]])
    )
    columns = ["row", "n_words", "hits", "item_ids"]
    # Only rows that can have hits meet them; the others are not moved.
    able = key_filter(found, ["digest"])
    asked = counted if able is None else counted.where(able)
    joined = asked.join(found, "digest", "left").select(
        "row",
        "n_words",
        F.coalesce("_hits", "hits").alias("hits"),
        F.coalesce("_items", "item_ids").alias("item_ids"),
    )
    return joined if able is None else joined.unionByName(counted.where(~able).select(*columns))


def _union_runs(column: str):
    """Runs that may overlap, as runs that do not."""
    ordered = F.sort_array(column)
    empty = F.expr(f"cast(array() as {SPAN})")

    def add(done, run):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (run["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        longer = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], run["end"]).alias("end")
        )
        return F.when(
            joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        ).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(ordered, empty, add)


def hit_words(column: str = "hits"):
    """How many words the runs of a column cover."""
    return F.aggregate(
        column, F.lit(0).cast("long"), lambda total, run: total + run["end"] - run["start"]
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    return (
        find_passages(docs, benchmark, size).where(F.size("hits") == 0).select("row.*")
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in bounded(whole, "_text"):
            buffer, offsets = text_buffer(batch.column("_text"))
            starts, ends, text_of = spans(lower_ascii(buffer), offsets, LETTER_DIGIT_WORDS)
            first = np.searchsorted(text_of, np.arange(batch.num_rows))
            kept = []
            for number, hits in enumerate(batch.column("hits").to_pylist()):
                low, high = int(offsets[number]), int(offsets[number + 1])
                pieces, at = [], low
                for run in hits:
                    pieces.append(buffer[at : starts[first[number] + run["start"]]].tobytes())
                    at = int(ends[first[number] + run["end"] - 1])
                kept.append(b"".join([*pieces, buffer[at:high].tobytes()]).decode())
            carried = {name: batch.column(name) for name in batch.schema.names if name != "_text"}
            yield pa.RecordBatch.from_pydict(carried | {"kept_text": pa.array(kept, pa.string())})


def remove_passages(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``find_passages`` with kept_text: the text without the hit words and what lies between
    the words of one run. Other bytes stay as they are."""
    found = find_passages(docs, benchmark, size)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("_text")
    schema = T.StructType([*found.schema, *T.StructType.fromDDL("kept_text string")])
    return found.select("*", text).mapInArrow(_cut, schema)
