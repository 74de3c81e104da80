"""Line-first quality rules: judge each line, drop the failures, then the document.

A line fails if it is

* badly punctuated: ten words or more without one that ends a sentence, unless its
  sentence ends in a later line of the paragraph and has ``MOST_SENTENCE_WORDS`` at most;
  or three in ten of its words ending in a doubled mark (``!!``, ``??``, ``**``);
* full of symbols: at least three of its words, and three in ten, hold one of
  ``# * $ % & | < >``;
* navigation: at least three separators ``|``, ``>``, ``»`` or ``·`` standing as
  words, and one such for every four words;
* boilerplate: it holds a phrase of ``BOILERPLATE`` and is at most 60 words long;
* stuttering: ten words or more, half of them equal to the word before.

A document is rejected if ``base_failed`` (fewer than ten words, or more than a fifth of
them in 5-word windows that the text holds twice or more) or if its failing lines hold
more than ``MOST_LOST`` of its word characters.

A word ends a sentence by one of ``. ! ? : ;`` at its end, closing quotes and brackets
aside, or by a mark of another script anywhere in it, as some scripts put no space after
theirs. Scripts that write no marks, such as Thai, are judged like the others. A paragraph
is a run of lines with words, as hard-wrapped text has them; a line of more than
``WRAP_CHARS`` characters is one by itself.

Words are runs without ASCII white space; lines are cut at line feeds. A null or empty
text has no words and is rejected as too short. Rows are judged one by one, so repeated
rows, ties and other columns make no difference. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.decontamination import bounded
from cohortlens.llm.memory import batchwise
from cohortlens.llm.words import (
    WHITE_SPACE_WORDS,
    covered,
    span_hashes,
    spans,
    text_buffer,
    window_hashes,
    window_starts,
)

FEWEST_WORDS = 10
REPEAT_WINDOW = 5
#: A document fails if it has more repeated words than this share.
MOST_REPEATED_PERCENT = 20
MOST_LOST_PERCENT = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?:;")] = True
#: Closing quotes and brackets that may follow a sentence's end, so many at most.
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b"\"')]}")] = True
_WIDE_CLOSING = [mark.encode() for mark in "”“’‘»«›‹」』〉》】〕）］｝｣"]
MOST_CLOSING = 4
_DOUBLED = np.zeros(256, bool)
_DOUBLED[list(b"!?*#$%&")] = True
_SEPARATORS = {b"|", b">", b"<", "»".encode(), "·".encode(), "•".encode()}

BOILERPLATE = re.compile(
    rb"all rights reserved|cookie policy|privacy policy|terms of (use|service)|"
    rb"accept (all )?cookies|enable javascript|subscribe to our|sign up for our|"
    rb"lorem ipsum|click here|copyright \(c\)|spdx-license-identifier|"
    rb"licensed under the|permission is hereby granted",
    re.IGNORECASE,
)
BOILERPLATE_MOST_WORDS = 60

#: Longer lines are not taken for lines of a wrapped paragraph.
WRAP_CHARS = 200
#: A mark speaks for the earlier lines of a stretch of so many words at most.
MOST_SENTENCE_WORDS = 200

#: Code points, as ranges, of the marks beyond ASCII that end sentences (Unicode's
#: Sentence_Terminal), and of other scripts' colons, semicolons, ellipses and shads.
SENTENCE_MARKS = (
    "37E 387 589 61B 61D-61F 6D4 700-702 7F9 837 839 83D-83E 964-965 F0D-F11 104A-104B 1362 "
    "1364-1368 166E 1735-1736 17D4-17D6 1803-1804 1809 1944-1945 1AA8-1AAB 1B5A-1B5B 1B5E-1B5F "
    "1B7D-1B7E 1C3B-1C3C 1C7E-1C7F 2026 203C-203D 2047-2049 2CF9-2CFB 2E2E 2E3C 2E53-2E54 3002 "
    "A4FF A60E-A60F A6F3 A6F7 A876-A877 A8CE-A8CF A92F A9C8-A9C9 AA5D-AA5F AAF0-AAF1 ABEB FE12 "
    "FE15-FE16 FE52 FE54-FE57 FF01 FF0E FF1A-FF1B FF1F FF61 10A56-10A57 10F55-10F59 10F86-10F89 "
    "11047-11048 110BE-110C1 11141-11143 111C5-111C6 111CD 111DE-111DF 11238-11239 1123B-1123C "
    "112A9 1144B-1144C 115C2-115C3 115C9-115D7 11641-11642 1173C-1173E 11944 11946 11A42-11A43 "
    "11A9B-11A9C 11C41-11C42 11EF7-11EF8 11F43-11F44 16A6E-16A6F 16AF5 16B37-16B38 16B44 16E98 "
    "1BC9F 1DA88"
)


def _any_of(sequences: set[bytes]) -> bytes:
    """A pattern that matches the given byte sequences, by their common beginnings."""
    if sequences == {b""}:
        return b""
    heads = sorted({sequence[0] for sequence in sequences})
    tails = [_any_of({one[1:] for one in sequences if one[0] == head}) for head in heads]
    ways = [re.escape(bytes([head])) + tail for head, tail in zip(heads, tails, strict=True)]
    if not any(tails):
        return b"[" + b"".join(ways) + b"]"
    return b"(?:" + b"|".join(ways) + b")"


def _marks() -> re.Pattern[bytes]:
    ranges = [part.split("-") for part in SENTENCE_MARKS.split()]
    points = [range(int(ends[0], 16), int(ends[-1], 16) + 1) for ends in ranges]
    return re.compile(_any_of({chr(point).encode() for part in points for point in part}))


_WIDE_MARKS = _marks()

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lost_chars long, cleaned_text string"
)


def _sum_by(groups: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(groups, weights=values, minlength=count).astype(np.int64)


class _Lines:
    """The words of some texts, their lines, and what the rules say of each line."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray):
        texts = len(offsets) - 1
        self.starts, self.ends, self.text_of = spans(buffer, offsets, WHITE_SPACE_WORDS)
        breaks = np.flatnonzero(buffer == 0x0A)
        self.line_starts = np.union1d(offsets[:-1], breaks + 1)
        # A break at a text's very end opens a line that belongs to that text.
        self.line_starts = self.line_starts[self.line_starts <= len(buffer)]
        self.line_of = np.searchsorted(self.line_starts, self.starts, "right") - 1
        self.hashes = span_hashes(buffer, self.starts, self.ends)
        # Characters are the bytes that do not continue one.
        leading = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
        self.chars = leading[self.ends] - leading[self.starts]
        self.line_chars = np.diff(leading[np.append(self.line_starts, len(buffer))])
        self.opens_text = np.isin(self.line_starts, offsets[:-1])
        symbol = np.concatenate([[0], np.cumsum(SYMBOLS[buffer])])
        self.n_symbols = symbol[offsets[1:]] - symbol[offsets[:-1]]
        self.has_symbol = symbol[self.ends] > symbol[self.starts]
        self.n_words = np.bincount(self.text_of, minlength=texts)

    def repeated_words(self) -> np.ndarray:
        """Words in a window that their text holds twice or more."""
        opening = window_starts(self.text_of, REPEAT_WINDOW)
        windows = window_hashes(self.hashes, REPEAT_WINDOW)[opening]
        text = self.text_of[opening]
        order = np.lexsort((windows, text))
        same = (windows[order][1:] == windows[order][:-1]) & (text[order][1:] == text[order][:-1])
        twice = np.zeros(len(opening), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        return covered(len(self.starts), opening[twice], REPEAT_WINDOW)

    def failing(self, buffer: np.ndarray) -> np.ndarray:
        """Per word: does its line fail?"""
        lines = len(self.line_starts)
        line, words = self.line_of, np.bincount(self.line_of, minlength=lines)
        data = buffer.tobytes()
        last = buffer[self.ends - 1]
        before = buffer[np.maximum(self.ends - 2, self.starts)]
        longer = self.ends - self.starts > 1
        doubled = longer & _DOUBLED[last] & (last == before)
        shouted = _sum_by(line, doubled, lines)
        symbols = _sum_by(line, self.has_symbol, lines)
        bars = _sum_by(line, np.isin(self.hashes, _separators()), lines)
        echo = np.zeros(len(line), bool)
        echo[1:] = (self.hashes[1:] == self.hashes[:-1]) & (line[1:] == line[:-1])
        echoes = _sum_by(line, echo, lines)
        fails = (words >= 10) & self.unmarked(self.ending(buffer, data), words)
        fails |= (words > 0) & (10 * shouted >= 3 * np.maximum(words, 1))
        fails |= (symbols >= 3) & (10 * symbols >= 3 * words)
        fails |= (bars >= 3) & (4 * bars >= words)
        fails |= (words >= 10) & (2 * echoes >= words)
        for match in BOILERPLATE.finditer(data):
            hit = int(np.searchsorted(self.line_starts, match.start(), "right")) - 1
            fails[hit] |= words[hit] <= BOILERPLATE_MOST_WORDS
        return fails

    def ending(self, buffer: np.ndarray, data: bytes) -> np.ndarray:
        """Per word: does it end a sentence?"""
        stops = _before_closing(buffer, self.starts, self.ends)
        ends = _SENTENCE_END[buffer[stops - 1]]
        wide = np.array([match.start() for match in _WIDE_MARKS.finditer(data)], np.int64)
        ends[np.searchsorted(self.starts, wide, "right") - 1] = True
        return ends

    def unmarked(self, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Per line: no sentence ends in it, nor does its own in a later line."""
        line = self.line_of
        alone = (words == 0) | (self.line_chars > WRAP_CHARS)
        begins = self.opens_text | alone
        begins[1:] |= alone[:-1]
        paragraph = np.cumsum(begins)[line]
        # Stretches run to a mark or the paragraph's end; a line without marks lies in one.
        closes = ends.copy()
        closes[:-1] |= paragraph[1:] != paragraph[:-1]
        closes[-1:] = True
        last = np.flatnonzero(closes)
        length = np.diff(last, prepend=-1)
        fine = np.repeat(ends[last] & (length <= MOST_SENTENCE_WORDS), length)
        return _sum_by(line, ends | fine, len(words)) == 0


def _before_closing(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each word ends without the quotes and brackets that close it."""
    stops, going = ends.copy(), np.arange(len(ends))
    for _ in range(MOST_CLOSING):
        stop = stops[going]
        room = stop - starts[going]
        cut = _CLOSING[buffer[stop - 1]].astype(np.int64)
        wide = np.flatnonzero((buffer[stop - 1] >= 0x80) & (room > 1))
        for mark in _WIDE_CLOSING:
            # A place before the buffer counts from its end; such a word has no room anyway.
            at = stop[wide] - len(mark)
            same = [buffer[at + step] == byte for step, byte in enumerate(mark)]
            cut[wide[np.logical_and.reduce(same)]] = len(mark)
        cut[cut >= room] = 0
        stops[going] -= cut
        going = going[cut > 0]
    return stops


def _hashes_of(words: set[bytes]) -> np.ndarray:
    buffer, offsets = text_buffer(pa.array([word.decode() for word in sorted(words)]))
    return span_hashes(buffer, offsets[:-1], offsets[1:])


def _separators() -> np.ndarray:
    return _hashes_of(_SEPARATORS)


def _duplicate_lines(
    buffer: np.ndarray, offsets: np.ndarray, lines: _Lines
) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    starts = lines.line_starts
    text = np.searchsorted(offsets, starts, "right") - 1
    # Empty texts share their offset with the next one; only lines with a word count.
    held = np.zeros(len(starts), bool)
    held[lines.line_of] = True
    text = text[held]
    ends = np.append(starts[1:], len(buffer))[held]
    starts = starts[held]
    stops = offsets[1:][text]
    ends = np.where(ends < stops, ends - 1, stops)
    ends = ends - ((ends > starts) & (ends == stops) & (buffer[np.maximum(ends - 1, 0)] == 0x0A))
    hashes = span_hashes(buffer, starts, ends)
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][1:][same], minlength=len(offsets) - 1)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in bounded(whole, "_text"):
            buffer, offsets = text_buffer(batch.column("_text"))
            texts = batch.num_rows
            lines = _Lines(buffer, offsets)
            fails = lines.failing(buffer)
            lost = fails[lines.line_of]
            cleaned = _without(buffer, offsets, lines.line_starts, fails)
            results = {
                "n_words": lines.n_words,
                "word_chars": _sum_by(lines.text_of, lines.chars, texts),
                "n_symbols": lines.n_symbols,
                "n_dup_lines": _duplicate_lines(buffer, offsets, lines),
                "n_repeat_words": _sum_by(lines.text_of, lines.repeated_words(), texts),
                "lost_chars": _sum_by(lines.text_of, lines.chars * lost, texts),
            }
            carried = {name: batch.column(name) for name in batch.schema.names if name != "_text"}
            counted = {name: pa.array(found, pa.int64()) for name, found in results.items()}
            yield pa.RecordBatch.from_pydict(
                carried | counted | {"cleaned_text": pa.array(cleaned, pa.string())}
            )


def _without(
    buffer: np.ndarray, offsets: np.ndarray, line_starts: np.ndarray, fails: np.ndarray
) -> list[str]:
    """Each text without its failing lines."""
    kept = []
    data = buffer.tobytes()
    low = np.searchsorted(line_starts, offsets[:-1], "left")
    high = np.searchsorted(line_starts, offsets[1:], "left")
    for number, (start, end) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        text = data[start:end]
        own = fails[low[number] : high[number]]
        if own.any():
            lines = text.split(b"\n")
            text = b"\n".join(
                line for place, line in enumerate(lines) if place >= len(own) or not own[place]
            )
        kept.append(text.decode())
    return kept


def judge(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, then the counts, lost_chars (word
    characters in failing lines), cleaned_text, base_failed and kept."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    schema = T.StructType(
        [T.StructField("row", docs.schema, False), *T.StructType.fromDDL(RESULT)]
    )
    judged = docs.select(row.alias("row"), text).mapInArrow(batchwise(_judge), schema)
    repeats = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    base = (F.col("n_words") < FEWEST_WORDS) | repeats
    loses = 100 * F.col("lost_chars") > MOST_LOST_PERCENT * F.col("word_chars")
    return judged.withColumn("base_failed", base).withColumn("kept", ~base & ~loses)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns; text is without the failing lines,
    and n_chars, if there is one, follows."""
    passed = judge(docs).where("kept")

    def column(name: str):
        kind = docs.schema[name].dataType
        if name == "text":
            return F.col("cleaned_text").cast(kind).alias(name)
        if name == "n_chars":
            return F.char_length("cleaned_text").cast(kind).alias(name)
        return F.col("row")[name].alias(name)

    return passed.select(*[column(name) for name in docs.columns])
