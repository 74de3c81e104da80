"""Main text of HTML pages by a recurrent labeller of their blocks.

A page is cut into its leaf sequence: the texts between block-level tags, each with the
path of open tags above it. A bidirectional LSTM in numpy reads one vector per block
(hashed tag path with classes, hashed words, a few counts) and labels each block with
the whole page in view; the blocks labelled main are the page's text.

It is fitted on at most ``SAMPLE_PAGES`` pages, those with the smallest hashes of
page_id and url among the pages that name a main element (``article``, ``main``, a role
main, or a class or id of ``MAIN_NAMES``), whose blocks are labelled by it. A page that
names none, or whose main elements hold no block, is unlabelled and not fitted on. Half of
the fitting pages are disguised: elements that give the label away become plain ``div``s,
so that the labeller also learns to judge by words, counts and neighbours. Where no
sampled page is labelled, blocks of prose and their neighbours stand in for labels. All
pages are then labelled, whole. A table whose sample holds no block keeps no text, nor
does one whose sample has neither a main element nor prose.

A null or empty page gives an empty text. Pages are judged one by one, so repeated rows
and ties make no difference; other columns may have any name.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.decontamination import bounded

#: Pages that the labeller is fitted on at most, and blocks of each that are read for it.
SAMPLE_PAGES = 256
SAMPLE_BLOCKS = 400

PATH_SIZE, WORD_SIZE, COUNT_SIZE = 64, 32, 8
INPUT = PATH_SIZE + WORD_SIZE + COUNT_SIZE
HIDDEN = 16
EPOCHS = 10
#: Steps of a fit at least: few labelled pages are gone through more often.
LEAST_STEPS = 60
#: Blocks that one batch of pages holds at most, padding included.
BATCH_BLOCKS = 20_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|textarea|select)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE
)
_NAMES = re.compile(r"[a-z]+")

#: Tags that stand inside a line of text and do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp "
    "rt s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Tags without content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that a block cannot be main text in, and names that mark such elements.
ASIDE_TAGS = frozenset(
    "nav header footer aside form menu dialog button head title figcaption".split()
)
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments consent cookie cookies "
    "footer menu nav navbar navigation newsletter notice popup promo related share sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_TAGS = frozenset("article main".split())
#: Whole classes and ids, ``_`` read as ``-``, of elements that hold main text.
MAIN_NAMES = frozenset(
    "article article-body article-content article-text articlebody blog-post body-content "
    "bodycontent content content-body content-main contentbody entry entry-body entry-content main "
    "main-content maincontent mw-content-text page-content post post-body post-content postbody "
    "site-content story-body story-content".split()
)
#: How surely an element is a main one: by its tag or role, or by its name.
BY_ELEMENT, BY_NAME = 2, 1
#: Words of a block of prose at least, and words in links of one at most, in percent.
PROSE_WORDS, PROSE_LINKED_PERCENT = 10, 33
#: Elements whose names speak of the whole page.
PAGE_TAGS = frozenset("html body".split())
#: Elements whose start ends an open one of the same kind.
SELF_ENDING = frozenset("p li dt dd tr td th option".split())


class Block:
    """A block's text and the tags above it, outermost first, with their names and how
    surely they are main elements."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[tuple[str, tuple[str, ...], int], ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def _element(tag: str, attributes: str) -> tuple[str, tuple[str, ...], int]:
    """The tag, the words of its names, and how surely it is a main element."""
    found: list[str] = []
    sure = BY_ELEMENT if tag in MAIN_TAGS else 0
    if "=" in attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            value = (match[2] or match[3] or match[4] or "").lower()
            found.extend(_NAMES.findall(value))
            if match[1].lower() == "role":
                sure = max(sure, BY_ELEMENT * ("main" in value.split()))
            elif tag not in PAGE_TAGS:
                named = not MAIN_NAMES.isdisjoint(value.replace("_", "-").split())
                sure = max(sure, BY_NAME * named)
    return tag, tuple(found), sure


def blocks(page: str) -> list[Block]:
    """The page's non-empty blocks in order, white space turned to single spaces."""
    found: list[Block] = []
    path: list[tuple[str, tuple[str, ...], int]] = []
    pieces: list[str] = []
    links = linked = 0

    def add(raw: str) -> int:
        text = references.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        return len(text.split()) if links else 0

    def flush() -> int:
        words = "".join(pieces).split()
        pieces.clear()
        if words:
            found.append(Block(" ".join(words), tuple(path), linked))
        return 0

    at = 0
    for match in _TOKEN.finditer(page):
        if match.start() > at:
            linked += add(page[at : match.start()])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if match["close"] else 1
        if tag in INLINE:
            continue
        linked = flush()
        if match["close"]:
            for depth in range(len(path) - 1, -1, -1):
                if path[depth][0] == tag:
                    del path[depth:]
                    break
        elif tag not in VOID and not match["attributes"].endswith("/"):
            if tag in SELF_ENDING and path and path[-1][0] == tag:
                path.pop()
            path.append(_element(tag, match["attributes"]))
    if at < len(page):
        linked += add(page[at:])
    flush()
    return found


def _is_aside(tag: str, names: tuple[str, ...]) -> bool:
    return tag in ASIDE_TAGS or not ASIDE_NAMES.isdisjoint(names)


def is_main(block: Block, least: int = BY_NAME) -> bool:
    """The label that a block's elements give it, if they are main ones that surely."""
    inside = False
    for tag, names, sure in block.path:
        if _is_aside(tag, names):
            return False
        inside |= sure >= least
    return inside


def known_labels(page: list[Block]) -> np.ndarray | None:
    """The labels of a page's blocks by its surest main elements; none if it has none."""
    for least in (BY_ELEMENT, BY_NAME):
        labels = np.array([is_main(block, least) for block in page], np.float32)
        if labels.any():
            return labels
    return None


def prose_labels(page: list[Block]) -> np.ndarray | None:
    """Labels where no main element is known: prose outside of asides, and what stands beside
    it in the same element without being a link."""
    free = [not any(_is_aside(tag, names) for tag, names, _ in block.path) for block in page]
    linked = [
        100 * block.linked > PROSE_LINKED_PERCENT * len(block.text.split(" ")) for block in page
    ]
    beside = {
        block.path[:-1]
        for block, out, link in zip(page, free, linked, strict=True)
        if out and not link and len(block.text.split(" ")) >= PROSE_WORDS
    }
    labels = np.array(
        [
            out and not link and block.path[:-1] in beside
            for block, out, link in zip(page, free, linked, strict=True)
        ],
        np.float32,
    )
    return labels if labels.any() else None


def _slot(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % size


_PATHS: dict[tuple, np.ndarray] = {}


def _path_vector(path: tuple) -> np.ndarray:
    known = _PATHS.get(path)
    if known is None:
        known = np.zeros(PATH_SIZE, np.float32)
        for tag, names, _ in path:
            known[_slot(tag, PATH_SIZE)] = 1
            for name in names:
                known[_slot(f".{name}", PATH_SIZE)] = 1
        if len(_PATHS) >= 10_000:
            _PATHS.clear()
        _PATHS[path] = known
    return known


def features(page: list[Block]) -> np.ndarray:
    """One row per block."""
    rows = np.zeros((len(page), INPUT), np.float32)
    for place, block in enumerate(page):
        row = rows[place]
        row[:PATH_SIZE] = _path_vector(block.path)
        words = block.text.split(" ")
        slots = [_slot(word, WORD_SIZE) for word in words]
        held = np.bincount(slots, minlength=WORD_SIZE)
        row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = held / np.sqrt(np.dot(held, held))
        text = block.text
        row[-COUNT_SIZE:] = (
            np.log1p(len(words)) / 5,
            min(1.0, block.linked / len(words)),
            min(1.0, sum(map(text.count, ".!?")) / len(words)),
            min(1.0, sum(map(text.count, "|©·»")) / len(words)),
            place / len(page),
            1.0 / (1 + place),
            1.0 / (len(page) - place),
            text[-1] in ".!?…”\"",
        )
    return rows


def disguised(page: list[Block], random: np.random.Generator) -> list[Block]:
    """The page with the elements that give labels away turned into plain divs."""
    hide_main, hide_aside = random.random() < 0.8, random.random() < 0.5
    result = []
    for block in page:
        path = []
        for tag, names, sure in block.path:
            hidden = (sure and hide_main) or (_is_aside(tag, names) and hide_aside)
            path.append(("div", (), 0) if hidden else (tag, names, sure))
        result.append(Block(block.text, tuple(path), block.linked))
    return result


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


class Lstm:
    """One direction: weights for the input, the state, and a bias, of four gates each."""

    def __init__(self, random: np.random.Generator):
        self.inward = random.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * HIDDEN)).astype(np.float32)
        self.onward = random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.bias = np.zeros(4 * HIDDEN, np.float32)
        self.bias[HIDDEN : 2 * HIDDEN] = 1

    def weights(self) -> list[np.ndarray]:
        return [self.inward, self.onward, self.bias]

    def run(self, rows: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States of ``rows`` (steps, pages, INPUT); where ``mask`` is 0 the state stays."""
        steps, pages, _ = rows.shape
        moved = rows.reshape(-1, INPUT) @ self.inward
        moved = moved.reshape(steps, pages, -1) + self.bias
        state = np.zeros((pages, HIDDEN), np.float32)
        cell = np.zeros((pages, HIDDEN), np.float32)
        states = np.zeros((steps, pages, HIDDEN), np.float32)
        memory = []
        for step in range(steps):
            gates = moved[step] + state @ self.onward
            opened = _sigmoid(gates[:, : 3 * HIDDEN])
            take, hold, show = np.split(opened, 3, axis=1)
            fresh = np.tanh(gates[:, 3 * HIDDEN :])
            on = mask[step][:, None]
            new_cell = hold * cell + take * fresh
            squashed = np.tanh(new_cell)
            if keep:
                memory.append((state, cell, take, hold, show, fresh, squashed))
            cell = on * new_cell + (1 - on) * cell
            state = on * show * squashed + (1 - on) * state
            states[step] = state
        return states, memory

    def gradients(self, rows, mask, memory, back) -> list[np.ndarray]:
        """Of the weights, given those of the states."""
        steps, pages, _ = rows.shape
        gates_back = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
        onward = np.zeros_like(self.onward)
        state_back = np.zeros((pages, HIDDEN), np.float32)
        cell_back = np.zeros((pages, HIDDEN), np.float32)
        for step in range(steps - 1, -1, -1):
            state, cell, take, hold, show, fresh, squashed = memory[step]
            on = mask[step][:, None]
            total = state_back + back[step]
            inner = cell_back * on + total * on * show * (1 - squashed**2)
            own = np.concatenate(
                [
                    inner * fresh * take * (1 - take),
                    inner * cell * hold * (1 - hold),
                    total * on * squashed * show * (1 - show),
                    inner * take * (1 - fresh**2),
                ],
                axis=1,
            )
            gates_back[step] = own
            onward += state.T @ own
            state_back = own @ self.onward.T + total * (1 - on)
            cell_back = inner * hold + cell_back * (1 - on)
        flat = gates_back.reshape(-1, 4 * HIDDEN)
        return [rows.reshape(-1, INPUT).T @ flat, onward, flat.sum(axis=0)]


class Labeller:
    """A bidirectional LSTM with one logistic output per block."""

    def __init__(self, seed: int = 5):
        random = np.random.default_rng(seed)
        self.ahead, self.back = Lstm(random), Lstm(random)
        self.out = random.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights(), *self.back.weights(), self.out, self.offset]

    def chances(self, rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of each block (steps, pages) to be main text."""
        ahead, _ = self.ahead.run(rows, mask)
        back, _ = self.back.run(rows[::-1], mask[::-1])
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return _sigmoid(both @ self.out + self.offset)

    def _gradients(self, rows, mask, labels) -> list[np.ndarray]:
        ahead, memory_ahead = self.ahead.run(rows, mask, keep=True)
        back, memory_back = self.back.run(rows[::-1], mask[::-1], keep=True)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        error = (_sigmoid(both @ self.out + self.offset) - labels) * mask / mask.sum()
        down = error[..., None] * self.out
        out = (error[..., None] * both).sum(axis=(0, 1))
        return [
            *self.ahead.gradients(rows, mask, memory_ahead, down[..., :HIDDEN]),
            *self.back.gradients(
                rows[::-1], mask[::-1], memory_back, down[::-1, :, HIDDEN:]
            ),
            out,
            np.array([error.sum()], np.float32),
        ]

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Labeller:
        """Adam on batches of pages of about one length."""
        random = np.random.default_rng(11)
        first = [np.zeros_like(weight) for weight in self.weights()]
        second = [np.zeros_like(weight) for weight in self.weights()]
        batches = [
            padded([pages[i][0] for i in group], [pages[i][1] for i in group])
            for group in batched([len(page[0]) for page in pages], BATCH_BLOCKS // 20)
        ]
        step = 0
        for _ in range(max(epochs, -(-LEAST_STEPS // max(1, len(batches))))):
            for number in random.permutation(len(batches)):
                step += 1
                gradients = self._gradients(*batches[number])
                for weight, gradient, a, b in zip(
                    self.weights(), gradients, first, second, strict=True
                ):
                    a += 0.1 * (gradient - a)
                    b += 0.001 * (gradient**2 - b)
                    rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    weight -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
        return self


def batched(lengths: list[int], most: int) -> list[list[int]]:
    """Pages of about one length, at most ``most`` blocks with padding, one page at least."""
    groups: list[list[int]] = []
    for number in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        if not lengths[number]:
            continue
        if groups and lengths[number] * (len(groups[-1]) + 1) <= most:
            groups[-1].append(number)
        else:
            groups.append([number])
    return groups


def padded(rows: list[np.ndarray], labels: list[np.ndarray] | None = None):
    """Pages side by side: rows (steps, pages, INPUT), mask and labels (steps, pages)."""
    steps = max(len(page) for page in rows)
    held = np.zeros((steps, len(rows), INPUT), np.float32)
    mask = np.zeros((steps, len(rows)), np.float32)
    known = np.zeros((steps, len(rows)), np.float32)
    for number, page in enumerate(rows):
        held[: len(page), number] = page
        mask[: len(page), number] = 1
        if labels is not None:
            known[: len(page), number] = labels[number]
    return held, mask, known


def fit_labeller(pages: list[str]) -> Labeller | None:
    """A labeller fitted on the labelled pages as they are and, half of them, disguised."""
    random = np.random.default_rng(3)
    sample = [found for page in pages if (found := blocks(page)[:SAMPLE_BLOCKS])]
    labelled = [(found, known_labels(found)) for found in sample]
    if all(labels is None for _, labels in labelled):
        labelled = [(found, prose_labels(found)) for found in sample]
    known = []
    for found, labels in labelled:
        if labels is None:
            continue
        known.append((features(found), labels))
        if random.random() < 0.5:
            known.append((features(disguised(found, random)), labels))
    return Labeller().fit(known) if known else None


def main_texts(pages: list[str], labeller: Labeller | None) -> list[str]:
    found = [blocks(page) for page in pages]
    texts = [""] * len(pages)
    if labeller is None:
        return texts
    for group in batched([len(page) for page in found], BATCH_BLOCKS):
        rows, mask, _ = padded([features(found[number]) for number in group])
        main = labeller.chances(rows, mask) > 0.5
        for column, number in enumerate(group):
            chosen = main[: len(found[number]), column]
            texts[number] = " ".join(
                block.text for block, yes in zip(found[number], chosen, strict=True) if yes
            )
    return texts


def _extracting(labeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = labeller.value
        for whole in batches:
            for batch in bounded(whole, "_text"):
                texts = main_texts(batch.column("_text").to_pylist(), fitted)
                yield pa.RecordBatch.from_pydict(
                    {"row": batch.column("row"), "main_text": pa.array(texts, pa.string())}
                )

    return run


def _naming_main() -> str:
    """A pattern of pages with a main element, as Spark and Python read it."""
    names = "|".join(sorted(name.replace("-", "[-_]") for name in MAIN_NAMES))
    tags = "|".join(sorted(MAIN_TAGS))
    value = "|".join(
        rf"{quote}(?:[^{quote}<>]*\s)?(?:{names})(?:\s[^{quote}<>]*)?{quote}" for quote in "\"'"
    )
    return (
        rf"(?i)<(?:{tags})(?=[\s/>])"
        rf"|(?<![\w-])(?:class|id|role)\s*=\s*(?:{value}|(?:{names})(?=[\s/>]))"
    )


def extract_main_text(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """All columns of ``pages`` as the struct ``row``, and main_text."""
    spark = pages.sparkSession
    text = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("_text")
    spread = F.xxhash64("page_id", "url")
    names_main = F.coalesce(F.col("html").cast("string").rlike(_naming_main()), F.lit(False))
    # Keys first: the pages they name are few, whatever the number of tasks and pages.
    keys = pages.select((~names_main).alias("_other"), spread.alias("_spread")).distinct()
    chosen = [row["_spread"] for row in keys.orderBy("_other", "_spread").limit(sample_pages).collect()]
    found = (
        pages.where(spread.isin(chosen))
        .groupBy(spread.alias("_spread"))
        .agg(F.min(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("_text"))
    )
    texts = {row["_spread"]: row["_text"] for row in found.collect()}
    labeller = fit_labeller([texts[key] for key in dict.fromkeys(chosen)])
    row = F.struct(*[F.col(f"`{name}`") for name in pages.columns])
    schema = T.StructType(
        [T.StructField("row", pages.schema, False), *T.StructType.fromDDL("main_text string")]
    )
    shared = spark.sparkContext.broadcast(labeller)
    return pages.select(row.alias("row"), text).mapInArrow(_extracting(shared), schema)
