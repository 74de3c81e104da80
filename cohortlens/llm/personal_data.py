"""Personal data in texts: patterns propose, checksums confirm, context adjusts the score.

A pattern proposes spans of a kind. Where the kind has a checksum it has to hold (Luhn for
card numbers, modulo 97 for bank accounts); other kinds have limits on their digits. What is
left starts from the kind's own score; words of the kind near the span raise it, words that
speak against it lower it. Emails, addresses, cards and phone numbers in international form
are found by their pattern and check alone, whatever the score; of the other kinds only
spans that reach the threshold are kept, and only where they touch no span of the former.

Every pattern takes time in proportion to the text: runs are taken whole and never tried
again from within. Positions are code points, ends exclusive. A null or empty text has no
spans. Rows are handled one by one, so repeated rows, ties and other columns make no
difference; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.decontamination import bounded

#: Score from which on a span of the kinds that need one is kept.
THRESHOLD = 0.5
#: Code points before and behind a span in which words count, and what one word is worth.
BEFORE, BEHIND = 48, 24
RAISED, LOWERED = 0.4, 0.3

SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("score", T.DoubleType())
    .add("plain", T.BooleanType())
)
_ARROW_SPANS = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
            ("score", pa.float64()), ("plain", pa.bool_()),
        ]
    )
)


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    plain: bool


# --- checks ----------------------------------------------------------------------


def digits_of(found: str) -> str:
    return "".join(c for c in found if c in string.digits)


def passes_luhn(digits: str) -> bool:
    """Every second digit from the right doubled, digit sums added: a multiple of ten."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def passes_mod_97(account: str) -> bool:
    """The first four characters moved behind, letters as 10 to 35: 1 modulo 97."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _is_card(found: str) -> bool:
    digits = digits_of(found)
    return 12 <= len(digits) <= 19 and passes_luhn(digits)


def _is_address(found: str) -> bool:
    # Long runs of digits never become numbers: only their last three are read.
    parts = [part.lstrip("0") for part in found.split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def _is_phone(found: str) -> bool:
    return 9 <= len(digits_of(found)) <= 15


def _is_security_number(found: str) -> bool:
    area, group, serial = found.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


# --- proposals -------------------------------------------------------------------

LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the run before it back to the last match, and the domain behind it."""
    ended, at = 0, text.find("@")
    while at >= 0:
        # The run holds no @, so it reaches back to the previous one at most.
        low = max(ended, text.rfind("@", ended, at) + 1)
        start = low + len(text[low:at].rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            ended = domain.end()
            yield start, ended
        at = text.find("@", max(at + 1, ended))


def _by(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    finder = re.compile(pattern).finditer
    return lambda text: (found.span() for found in finder(text))


_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")


def accounts(text: str) -> Iterator[tuple[int, int]]:
    """International bank account numbers: the longest beginning that the checksum confirms."""
    for found in _ACCOUNT.finditer(text):
        start, end = found.span()
        for stop in range(end, start + 14, -1):
            whole = stop == len(text) or not text[stop].isalnum()
            if whole and text[stop - 1] != " ":
                plain = text[start:stop].replace(" ", "")
                if 15 <= len(plain) <= 34 and passes_mod_97(plain):
                    yield start, stop
                    break


def _anything(found: str) -> bool:
    return True


@dataclass(frozen=True)
class Kind:
    """How spans of a kind are proposed, checked and scored."""

    name: str
    propose: Callable[[str], Iterator[tuple[int, int]]]
    check: Callable[[str], bool]
    score: float
    #: Whether pattern and check alone decide.
    plain: bool = False
    raising: tuple[str, ...] = ()
    lowering: tuple[str, ...] = ()


_PHONE_WORDS = (
    "phone", "tel", "telephone", "call", "mobile", "cell", "fax", "contact", "whatsapp",
    "téléphone", "appelez", "portable", "telefon", "handy", "anruf", "teléfono", "móvil", "llame",
)
_CARD_WORDS = ("card", "visa", "mastercard", "credit", "debit", "carte", "karte", "tarjeta")

#: The kinds in the order that breaks ties between spans that start together.
KINDS = (
    Kind("email", emails, _anything, 0.9, True, ("email", "mail", "e-mail", "contact", "correo")),
    Kind(
        "ip", _by(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), _is_address, 0.6, True,
        ("ip", "address", "host", "server", "login", "from"), ("version", "release", "section", "v"),
    ),
    Kind(
        "card", _by(r"[0-9](?:[\x20-]?[0-9])++"), _is_card, 0.7, True,
        _CARD_WORDS, ("isbn", "order", "serial", "tracking"),
    ),
    Kind("phone", _by(r"\+[0-9][\x20().0-9-]+[0-9]"), _is_phone, 0.8, True, _PHONE_WORDS),
    Kind(
        "account", accounts, _anything, 0.7, False,
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
    ),
    Kind(
        "security_number", _by(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
        _is_security_number, 0.3, False, ("ssn", "social", "security", "taxpayer", "itin"),
    ),
    Kind(
        "local_phone",
        _by(r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[ ./-][0-9]{3,4}[ .-]?[0-9]{2,5}(?![0-9]|[.-][0-9])"),
        _is_phone, 0.2, False, _PHONE_WORDS, ("isbn", "order", "serial", "version", "section"),
    ),
)
RANK = {kind.name: place for place, kind in enumerate(KINDS)}

_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def _score(kind: Kind, text: str, start: int, end: int) -> float:
    """The kind's own score, raised or lowered by the words around the span."""
    around = text[max(0, start - BEFORE) : start] + " " + text[end : end + BEHIND]
    near = set(_WORDS.findall(around.lower()))
    score = kind.score
    score += RAISED * any(word in near for word in kind.raising)
    score -= LOWERED * any(word in near for word in kind.lowering)
    return min(1.0, max(0.0, round(score, 6)))


def find_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans by start, then kind."""
    if not any(c in text for c in "@0123456789"):
        return []
    sure, others = [], []
    for kind in KINDS:
        for start, end in kind.propose(text):
            if not kind.check(text[start:end]):
                continue
            score = _score(kind, text, start, end)
            if kind.plain:
                sure.append(Span(kind.name, start, end, score, True))
            elif score >= threshold:
                others.append(Span(kind.name, start, end, score, False))
    kept = _apart(sure, others) if others else []
    return sorted([*sure, *kept], key=lambda span: (span.start, RANK[span.kind]))


def _apart(sure: list[Span], others: list[Span]) -> list[Span]:
    """The other spans that touch no sure one, and of those that touch each other the best."""
    taken = sorted((span.start, span.end) for span in sure)
    ordered = sorted(others, key=lambda span: (span.start, span.end))
    free, place = [], 0
    for span in ordered:
        while place < len(taken) and taken[place][1] <= span.start:
            place += 1
        # Sure spans of different kinds may overlap, so all that open before the end count.
        touches = any(
            low < span.end and span.start < high for low, high in taken[place : place + len(KINDS)]
        )
        if not touches:
            free.append(span)
    kept: list[Span] = []
    for span in free:
        if kept and span.start < kept[-1].end:
            if span.score > kept[-1].score:
                kept[-1] = span
        else:
            kept.append(span)
    return kept


def redacted(text: str, spans: list[Span]) -> str:
    """The text with a mark in the place of each span; spans that overlap share the first's."""
    parts, done = [], 0
    for span in spans:
        if span.start >= done:
            parts += [text[done : span.start], f"[{span.kind.upper()}]"]
        done = max(done, span.end)
    return "".join([*parts, text[done:]])


# --- tables ----------------------------------------------------------------------


def _finder(threshold: float, redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, "_text"):
                texts = batch.column("_text").to_pylist()
                found = [find_spans(text, threshold) for text in texts]
                columns = {
                    "row": batch.column("row"),
                    "spans": pa.array([[span._asdict() for span in spans] for spans in found], _ARROW_SPANS),
                }
                if redact:
                    columns["redacted"] = pa.array(
                        [redacted(text, spans) for text, spans in zip(texts, found)], pa.string()
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return run


def find_personal_data(
    docs: DataFrame, threshold: float = THRESHOLD, redact: bool = False
) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``; ``spans`` with kind, place, score, and
    whether pattern and check alone decide; with ``redact`` also the text without them."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    schema = T.StructType(
        [T.StructField("row", docs.schema, False), T.StructField("spans", SPANS, False)]
    )
    if redact:
        schema.add("redacted", T.StringType(), False)
    return docs.select(row.alias("row"), text).mapInArrow(_finder(threshold, redact), schema)


def count_of(kind: str) -> Column:
    """How many spans of a plain kind a row has."""
    return F.size(F.filter("spans", lambda s: s["plain"] & (s["kind"] == kind))).cast("long")


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def plain_spans() -> Column:
    return F.filter("spans", lambda s: s["plain"])
