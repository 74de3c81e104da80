"""Token counts of whole texts; huge ones in overlapping chunks that resynchronise.

A text of more than ``HUGE`` characters is encoded in chunks that overlap. The
encodings of two neighbours are spliced at a boundary that both have inside the
overlap and that is proven stable: the character before it is ASCII white space, where
the tokenizer cuts whatever stands around it, and from there on both chunks have the
same tokens at the same offsets to the end of the overlap. Without such a boundary the
overlap is doubled, and beyond a chunk's length the chunk itself, until one is found
or the text ends. Other texts are counted from their stretches between spaces, each
distinct one encoded once per worker.

A null or empty text has 0 bytes and 0 tokens. Rows are counted one by one, so repeated
rows, ties and other columns make no difference. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cohortlens.llm.decontamination import bounded
from cohortlens.llm.token_files import encoder

#: Characters beyond which a text is counted in chunks, of a chunk, and of an overlap.
HUGE = 32_768
CHUNK = 16_384
OVERLAP = 128

_WHITE = " \t\n\x0b\x0c\r"


def _offsets(tokenizer: Tokenizer, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """Start, end and id of each token of a chunk, placed in the whole text."""
    encoded = tokenizer.encode(text[start:end], add_special_tokens=False)
    return [
        (start + low, start + high, number)
        for (low, high), number in zip(encoded.offsets, encoded.ids, strict=True)
    ]


def _splice(text: str, left: list, right: list, low: int, high: int) -> int | None:
    """The first stable boundary of two chunks' tokens within ``low`` to ``high``.

    Both chunks must agree from there to the last white space of the overlap; what
    follows it is a word that the left chunk cuts off.
    """
    edge = max(text.rfind(mark, low, high) for mark in _WHITE)
    opened = {start for start, _, _ in left}
    for boundary, _, _ in right:
        if not low < boundary < high or text[boundary - 1] not in _WHITE:
            continue
        inner = [
            [token for token in tokens if boundary <= token[0] and token[1] <= edge]
            for tokens in (left, right)
        ]
        if boundary in opened and inner[0] == inner[1]:
            return boundary
    return None


def count_huge(
    tokenizer: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> int:
    """The number of tokens of a whole text, from overlapping chunks."""
    total, start, counted_to = 0, 0, 0
    size = chunk
    left = _offsets(tokenizer, text, 0, min(size, len(text)))
    while start + size < len(text):
        end = start + size
        width, boundary = overlap, None
        while boundary is None and width < size:
            begin = end - width
            right = _offsets(tokenizer, text, begin, min(begin + chunk, len(text)))
            # A right chunk must reach beyond the left one.
            if begin + chunk > end or begin + chunk >= len(text):
                boundary = _splice(text, left, right, begin, end)
            width *= 2
        if boundary is None:
            size *= 2
            left = _offsets(tokenizer, text, start, min(start + size, len(text)))
            continue
        total += sum(counted_to <= low < boundary for low, _, _ in left)
        start, size, counted_to, left = begin, chunk, boundary, right
    return total + sum(low >= counted_to for low, _, _ in left)


def _counting(path: Callable[[], str], huge: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path())
        for whole in batches:
            for batch in bounded(whole, "_text"):
                texts = batch.column("_text")
                long = np.array(pc.utf8_length(texts)) > huge
                counts = np.zeros(len(texts), np.int64)
                counts[~long] = own.encode(texts.filter(pa.array(~long)))[1]
                for place in np.flatnonzero(long).tolist():
                    counts[place] = count_huge(own.tokenizer, texts[place].as_py())
                yield pa.RecordBatch.from_pydict(
                    {"row": batch.column("row"), "n_tokens": pa.array(counts, pa.int64())}
                )

    return run


def count_tokens(docs: DataFrame, path: Callable[[], str], huge: int = HUGE) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, n_bytes and n_tokens.

    ``path`` is called in the tasks and gives the tokenizer file's place there. The tokenizer
    must cut at ASCII white space and give it no token.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    schema = T.StructType(
        [T.StructField("row", docs.schema, False), *T.StructType.fromDDL("n_tokens long")]
    )
    counted = docs.select(row.alias("row"), text).mapInArrow(_counting(path, huge), schema)
    size = F.coalesce(F.octet_length(F.col("row.text").cast("string")), F.lit(0)).cast("long")
    return counted.select("row", size.alias("n_bytes"), "n_tokens")
