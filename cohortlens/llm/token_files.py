"""Token ids as Parquet list columns, written in document order and read selectively.

The documents are range-partitioned and sorted by doc_id *before* they are encoded, so
that only texts are sampled and moved, and each task encodes and writes one range. The
files hold ``shard``, ``doc_id``, ``place`` (in the shard), ``n_tokens`` and the list column
``ids``; the ids are dictionary-encoded with a page dictionary of bounded size, or
delta-encoded. Row groups and pages have set sizes, and page indexes are written, so a
reader of some documents or of the metadata columns alone reads only their pages.

A null or empty text has no ids but the end id. Rows are ordered by doc_id, nulls first,
then text; rows that repeat both follow each other. An empty table gives files without
rows. Other columns are left out unless named in ``columns``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cohortlens.llm.decontamination import bounded
from cohortlens.llm.units import text_bytes
from cohortlens.llm.words import WHITE_SPACE_WORDS, span_hashes, spans, text_buffer
from cohortlens.session import shuffle_width

#: Parquet settings: bytes of a row group and of a page, of a page dictionary.
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
DICTIONARY_BYTES = 1 << 20
#: Text of a range of documents, which one task encodes and writes.
RANGE_BYTES = 128 << 20
#: Distinct stretches of text whose ids a worker remembers at most.
MEMORY_ENTRIES = 2_000_000
#: Characters that are encoded at once to learn new stretches.
LEARN_CHARS = 1 << 15


class StretchEncoder:
    """Ids of whole texts by the tokenizers library, each distinct stretch between spaces once.

    The tokenizer must cut at ASCII white space whatever stands around it and give the
    white space no id, so that a text's ids are those of its stretches in turn. Stretches
    are told apart by 64 bits of hash; the memory is a sorted array of hashes and a flat
    array of ids, so that it holds millions of them, and is emptied when it is full.
    """

    def __init__(self, path: str):
        # One thread per task: Spark's slots are the parallelism.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The stretches' ids and their numbers, from one encoding with spaces between.

        A token belongs to the stretch in which it starts.
        """
        whole = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        begins = np.cumsum([0, *[len(part) + 1 for part in parts]])
        starts = np.array([start for start, _ in whole.offsets], np.int64)
        return np.array(whole.ids, np.uint32), np.diff(np.searchsorted(starts, begins))

    def _learn(self, hashes: np.ndarray, parts: list[str]) -> None:
        """Add stretches, given in ascending order of their hashes."""
        if len(self.hashes) + len(hashes) > MEMORY_ENTRIES:
            raise MemoryError("the stretches at hand must fit in the memory")
        ids, counts = [], []
        low = size = 0
        for place, part in enumerate(parts):
            size += len(part)
            if size >= LEARN_CHARS or place + 1 == len(parts):
                found = self._encoded(parts[low : place + 1])
                ids.append(found[0])
                counts.append(found[1])
                low, size = place + 1, 0
        counts = np.concatenate(counts)
        begins = np.cumsum(counts) - counts + len(self.ids)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begins = np.insert(self.begins, at, begins)
        self.counts = np.insert(self.counts, at, counts)
        self.ids = np.concatenate([self.ids, *ids])

    def _knows(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        buffer, offsets = text_buffer(texts)
        starts, ends, text = spans(buffer, offsets, WHITE_SPACE_WORDS)
        of_words = span_hashes(buffer, starts, ends)
        hashes = np.unique(of_words)
        if len(hashes) > MEMORY_ENTRIES:
            # So many different stretches are taken in two halves of the texts, or, within
            # one text, of its stretches.
            return self._halves(texts, buffer, starts)
        place = np.searchsorted(hashes, of_words)
        known = self._knows(hashes)
        if len(self.hashes) + int((~known).sum()) > MEMORY_ENTRIES:
            self._forget()
            known[:] = False
        unknown = np.flatnonzero(~known[place])
        if len(unknown):
            new, first = np.unique(place[unknown], return_index=True)
            first = unknown[first]
            spelled = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            self._learn(hashes[new], [buffer[a:b].tobytes().decode() for a, b in spelled])
        entry = np.searchsorted(self.hashes, hashes)[place]
        counts = self.counts[entry]
        edges = np.concatenate([[0], np.cumsum(counts)])
        into = np.repeat(self.begins[entry] - edges[:-1], counts) + np.arange(edges[-1])
        words = np.searchsorted(text, np.arange(len(texts) + 1))
        return self.ids[into], np.diff(edges[words])

    def _halves(self, texts: pa.Array, buffer: np.ndarray, starts: np.ndarray):
        if len(texts) > 1:
            middle = len(texts) // 2
            parts = [self.encode(texts.slice(0, middle)), self.encode(texts.slice(middle))]
            return tuple(map(np.concatenate, zip(*parts, strict=True)))
        cut = int(starts[len(starts) // 2])
        halves = [buffer[:cut].tobytes().decode(), buffer[cut:].tobytes().decode()]
        ids, counts = self.encode(pa.array(halves))
        return ids, np.array([counts.sum()])


_ENCODERS: dict[str, StretchEncoder] = {}


def encoder(path: str) -> StretchEncoder:
    """The encoder of a tokenizer file, read once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = StretchEncoder(path)
    return _ENCODERS[path]


def _encoding(path: Callable[[], str], end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, place = encoder(path()), 0
        for whole in batches:
            for batch in bounded(whole, "_text"):
                ids, counts = own.encode(batch.column("_text"))
                # Each text's end id goes behind its own ids.
                flat = np.insert(ids.view(np.int32), np.cumsum(counts), np.int32(end_id))
                counts = counts + 1
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                carried = {
                    name: batch.column(name) for name in batch.schema.names if name != "_text"
                }
                yield pa.RecordBatch.from_pydict(
                    carried
                    | {
                        "place": pa.array(np.arange(place, place + batch.num_rows)),
                        "n_tokens": pa.array(counts),
                        "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    }
                )
                place += batch.num_rows

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: Callable[[], str],
    end_id: int,
    columns: Sequence[str] = (),
    encoding: str = "dictionary",
) -> None:
    """Write the ids of all texts in ascending doc_id order below ``path``.

    ``tokenizer`` is called in the tasks and gives the tokenizer file's place there.
    ``encoding`` is ``dictionary`` or ``delta``.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A range is a task, so there are more of them where there is more text.
    ranges = max(shuffle_width(docs.sparkSession), -(-text_bytes(docs) // RANGE_BYTES))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"), *columns)
        .repartitionByRange(ranges, "doc_id", F.xxhash64("_text"))
        .sortWithinPartitions("doc_id", F.xxhash64("_text"))
        .withColumn("shard", F.spark_partition_id())
    )
    plain = ordered.select("shard", "doc_id", "_text", *columns)
    schema = T.StructType(
        [field for field in plain.schema if field.name != "_text"]
        + list(T.StructType.fromDDL("place long, n_tokens long, ids array<int>"))
    )
    (
        plain.mapInArrow(_encoding(tokenizer, end_id), schema)
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "v2")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; filters on doc_id and narrower selections reach the scan."""
    return spark.read.parquet(path)


def document_starts(files: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (by default the files' metadata) with start: the ids before the document.

    ``rows`` must hold shard, place and n_tokens of the files' rows. Sums per shard are one
    row per written range.
    """
    rows = files.drop("ids") if rows is None else rows
    earlier = W.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    sums = files.groupBy("shard").agg(F.sum("n_tokens").alias("_sum"))
    offsets = sums.select("shard", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = W.partitionBy("shard").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(offsets, "shard")
        .select(*rows.columns, (F.col("_base") + F.col("_inside")).alias("start"))
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        edges = lists.offsets.to_numpy()
        found = [
            zlib.crc32(flat[low:high].tobytes())
            for low, high in zip(edges[:-1], edges[1:], strict=True)
        ]
        rest = {name: batch.column(name) for name in batch.schema.names if name != "ids"}
        yield pa.RecordBatch.from_pydict(rest | {"ids_crc32": pa.array(found, pa.int64())})


def checksums(files: DataFrame) -> DataFrame:
    """The files' metadata with ids_crc32 over the ids read back, as little-endian integers."""
    kept = [field for field in files.schema if field.name != "ids"]
    schema = T.StructType([*kept, *T.StructType.fromDDL("ids_crc32 long")])
    return files.mapInArrow(_checksums, schema)
