"""Plain Python versions of the operators' results, written from their contracts.

Documents are (doc_id, text) pairs with distinct ids.
"""

import base64
import hashlib
import re
import struct
import zlib

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LETTERS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def raw(text) -> bytes:
    return (text or "").encode()


def token_files(docs, path=None):
    own = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
    found, start = {}, 0
    for doc_id, text in sorted(docs):
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        found[doc_id] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return found


def token_counts(docs):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for doc_id, text in docs:
        count = len(own.encode(text or "", add_special_tokens=False).ids)
        found[doc_id] = (len(raw(text)), count, count > 2048)
    return found


def shingles(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw(text)))
    if len(words) < 2:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:]))


def near_groups(docs):
    sets = {doc_id: shingles(text) for doc_id, text in docs}
    ids = sorted(sets, key=lambda i: len(sets[i]))
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for place, a in enumerate(ids):
        for b in ids[place + 1 :]:
            if 100 * len(sets[a]) < 80 * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def lower_words(text):
    return LETTERS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw(text)))


def passages(docs, items, size=10):
    windows = {}
    for item_id, text in items:
        words = lower_words(text)
        if words:
            width = min(size, len(words))
            for start in range(len(words) - width + 1):
                windows.setdefault(tuple(words[start : start + width]), set()).add(str(item_id))
    found = {}
    for doc_id, text in docs:
        words, hit, names = lower_words(text), set(), set()
        for width in {len(window) for window in windows}:
            for start in range(len(words) - width + 1):
                owners = windows.get(tuple(words[start : start + width]))
                if owners:
                    hit.update(range(start, start + width))
                    names |= owners
        joined = ",".join(sorted(names)).encode()
        found[doc_id] = (len(words), len(hit), len(names), sha(joined), bool(hit))
    return found


def remove_windows(docs, size=20):
    seen, found = set(), {}
    for doc_id, text in sorted(docs):
        words = WORD.findall(raw(text))
        gone = [False] * len(words)
        for start in range(len(words) - size + 1):
            window = b" ".join(words[start : start + size])
            if window in seen:
                gone[start : start + size] = [True] * size
            seen.add(window)
        kept = b" ".join(word for word, out in zip(words, gone) if not out)
        found[doc_id] = (len(words), sum(gone), sha(kept))
    return found


def remove_bytes(docs, size=100):
    seen, found = set(), {}
    for doc_id, text in sorted(docs):
        data = raw(text)
        gone = bytearray(len(data))
        for start in range(len(data) - size + 1):
            piece = data[start : start + size]
            if piece in seen:
                gone[start : start + size] = b"\1" * size
            seen.add(piece)
        kept = bytes(byte for byte, out in zip(data, gone) if not out)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        found[doc_id] = (len(data), sum(gone), spans, sha(kept))
    return found


def byte_bpe(docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    found = {}
    for doc_id, text in docs:
        ids = own.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        found[doc_id] = (len(ids), sha(packed), sha(raw(text)))
    return found


def quality_counts(docs):
    found = {}
    for doc_id, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, duplicates = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                duplicates += line in seen
                seen.add(line)
        places = {}
        for start in range(len(words) - 4):
            places.setdefault(tuple(words[start : start + 5]), []).append(start)
        repeated = {
            start + step for all_ in places.values() if len(all_) > 1 for start in all_ for step in range(5)
        }
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        found[doc_id] = (
            len(words),
            sum(map(len, words)),
            len(re.findall(r"[#*$%&|<>]", text)),
            duplicates,
            len(repeated),
            failed,
        )
    return found


BOILERPLATE = re.compile(
    r"all rights reserved|cookie policy|privacy policy|terms of (use|service)|"
    r"accept (all )?cookies|enable javascript|subscribe to our|sign up for our|"
    r"lorem ipsum|click here|copyright \(c\)|spdx-license-identifier|"
    r"licensed under the|permission is hereby granted",
    re.IGNORECASE,
)


def line_fails(line):
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    if not words:
        return False

    def ends(word):
        if word in ("…", "。", "！", "？") or word[-1] in ".!?:;":
            return True
        return len(word) > 1 and word[-1] in "\"')]}" and word[-2] in ".!?:;"

    count = len(words)
    doubled = sum(len(w) > 1 and w[-1] in "!?*#$%&" and w[-1] == w[-2] for w in words)
    symbols = sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words)
    bars = sum(w in ("|", ">", "<", "»", "·", "•") for w in words)
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    return (
        (count >= 10 and not any(map(ends, words)))
        or 10 * doubled >= 3 * count
        or (symbols >= 3 and 10 * symbols >= 3 * count)
        or (bars >= 3 and 4 * bars >= count)
        or (count >= 10 and 2 * echoes >= count)
        or (count <= 60 and bool(BOILERPLATE.search(line)))
    )


def keeps(text):
    """The line-first verdict on one text."""
    failed = quality_counts([(0, text)])[0][5]
    lost = total = 0
    for line in (text or "").split("\n"):
        chars = sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
        total += chars
        lost += chars * line_fails(line)
    return not failed and 100 * lost <= 50 * total


def kept_bytes(docs, size=100):
    """{doc_id: the bytes that remain}."""
    seen, found = set(), {}
    for doc_id, text in sorted(docs):
        data = raw(text)
        gone = bytearray(len(data))
        for start in range(len(data) - size + 1):
            piece = data[start : start + size]
            if piece in seen:
                gone[start : start + size] = b"\1" * size
            seen.add(piece)
        found[doc_id] = bytes(byte for byte, out in zip(data, gone) if not out)
    return found


def pipeline(docs, items):
    docs = [(i, t) for i, t in docs if keeps(t)]
    groups = near_groups(docs)
    docs = [(i, t) for i, t in docs if groups[i][2]]
    docs = [(i, data.decode(errors="ignore")) for i, data in kept_bytes(docs).items()]
    hits = passages(docs, items)
    return byte_bpe([(i, t) for i, t in docs if not hits[i][4]])


# --- personal data, hard negatives, conversations ----------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (2 if place % 2 else 1) for place, d in enumerate(digits[::-1])]
    return sum(sum(divmod(value, 10)) for value in doubled) % 10 == 0


def plain_spans(text):
    text = text or ""
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    for m in ADDRESS.finditer(text):
        if all(part.strip("0123456789") == "" and len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255
               for part in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for kind, pattern, low, high in (("card", CARD, 12, 19), ("phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                found.append((kind, m.start(), m.end()))
    order = ("email", "ip", "card", "phone")
    return sorted(found, key=lambda span: (span[1], order.index(span[0])))


def personal_data(docs):
    found = {}
    for doc_id, text in docs:
        spans = plain_spans(text)
        counts = [sum(kind == own for own, _, _ in spans) for kind in ("email", "ip", "card", "phone")]
        told = ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)
        found[doc_id] = (*counts, sha(told.encode()))
    return found


def hard_negatives(rows, every=100, keep=5):
    """``rows``: (vec_id, embedding, label) after any change of labels."""
    import math

    usable = [
        (vec_id, [math.floor(256 * float(x)) for x in vector], label)
        for vec_id, vector, label in rows
        if label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    found = []
    key = lambda row: (-row[0], row[1] is not None, row[1] or 0)
    for place, (anchor, vector, label) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, other)), vec_id, own)
            for at, (vec_id, other, own) in enumerate(usable)
            if at != place
        ]
        positives = sorted((row for row in scored if row[2] == label), key=key)[:keep]
        others = sorted((row for row in scored if row[2] != label), key=key)
        for score, positive, _ in positives:
            window = [row for row in others if 80 * score <= 100 * row[0] <= 100 * score][:keep]
            for rank, (negative_score, negative, _) in enumerate(window, 1):
                found.append((anchor, positive, rank, negative, score, negative_score))
    return found


def conversation_trie(rows):
    """``rows``: (conv_id, turn, role, text). The tuples of every node."""
    told = lambda role, text: f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append(
                (turn is not None, turn or 0, hashlib.sha256(told(role, text)).digest(), role or "", text or "")
            )
    own = {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) + (node not in children)
        own_saving = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = saved.get(node, 0) + own_saving
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    found = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if rebuilt[c] == node)
        found.append(
            (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
             children.get(node, 0), leaves[node], saved[node], sha(",".join(map(str, ends)).encode()))
        )
    return found
