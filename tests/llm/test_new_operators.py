"""Personal data, hard negatives and the conversation trie against brute force."""

import collections
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import byte_bpe, conversation_trie, hard_negatives, personal_data, queries
from tests.llm import brute, cases

FOLDER = "/root/testdata/sf0.001"


def multiset(rows):
    return collections.Counter(map(tuple, rows))


def need_tables():
    if not Path(FOLDER).exists():
        pytest.skip("needs the driver tables")


# --- personal data ----------------------------------------------------------------

PERSONAL = [
    "a@b.c@d.e x.y_z@k.l.m a@b@c.d @x.y a@ b@c d@e.", "a@b..c a@-.- %@a.b.", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0255",
    "9" * 6000 + ".1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112", "5" * 40 + " 12 34",
    "+1 (212) 555-0100, +49.30.123456, +1, +12 3(((, +1+22 333 444 555", "+" * 50 + "1" * 12,
    "a" * 5000 + "@" + "b" * 5000 + ".c", "x@" * 3000, "é@ä.de ü+a@b.de 🙂1.2.3.4🙂", "1.1.1.1@2.2.2.2",
    "١٢٣.١.١.١ 1.2.3.4", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "-4111111111111111-", None, "",
]


@pytest.mark.parametrize("text", PERSONAL)
def test_plain_spans_equal_the_patterns(text):
    found = [span[:3] for span in personal_data.find_spans(text or "") if span.plain]
    assert found == brute.plain_spans(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+ 0149()%_é\n", max_size=60))
def test_plain_spans_equal_the_patterns_on_any_text(text):
    found = [span[:3] for span in personal_data.find_spans(text) if span.plain]
    assert found == brute.plain_spans(text)


def kinds(text):
    return [(span.kind, text[span.start : span.end]) for span in personal_data.find_spans(text)]


def test_checksums_and_context_decide():
    account = "DE89 3704 0044 0532 0130 00"
    assert kinds(f"pay {account} AND more") == [("account", account)]
    assert kinds("pay DE89 3704 0044 0532 0130 01 now") == []
    assert kinds("number 123-45-6789 here") == []
    assert kinds("her SSN is 123-45-6789.") == [("security_number", "123-45-6789")]
    assert kinds("her SSN is 666-45-6789.") == []
    assert kinds("call 030 1234 5678") == [("local_phone", "030 1234 5678")]
    assert kinds("in 030 1234 5678 cases") == []
    near, far = (personal_data.find_spans(text)[0].score for text in ("host 1.2.3.4", "version 1.2.3.4"))
    assert near > far
    # Spans found by pattern and check stay, and others do not touch them.
    assert kinds("phone +44 020 1234 5679") == [("phone", "+44 020 1234 5679")]


def test_personal_data_is_replaced(spark):
    docs = [(1, "mail a@b.de or +1 212 555 0100"), (2, None), (3, "1.2.3.4@x.y"), (1, "mail a@b.de or +1 212 555 0100")]
    df = cases.frame(spark, docs).withColumn("spans", F.lit("own")).withColumn("_text", F.lit(1))
    rows = personal_data.find_personal_data(df, redact=True).collect()
    found = {row["row"]["doc_id"]: row["redacted"] for row in rows}
    assert found == {1: "mail [EMAIL] or [PHONE]", 2: "", 3: "[EMAIL]"}
    assert len(rows) == 4 and rows[0]["row"]["spans"] == "own"


def test_personal_data_of_long_texts_takes_linear_time():
    for part in ("1", "a.", "1.", "1 ", "(", "+1(", "a@", "AB12"):
        personal_data.find_spans(part * 200_000)


def write(spark, df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_personal_data_query(spark, tmp_path):
    docs = list(enumerate(PERSONAL)) + [(100 + i, t) for i, t in cases.hostile(10)]
    folder = write(spark, cases.frame(spark, docs), tmp_path / "t", "documents")
    found = cases.results(queries.op11_personal_data(spark, folder))
    assert {key: row[:5] for key, row in found.items()} == brute.personal_data(docs)
    need_tables()
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    wanted = brute.personal_data(list(zip(table["doc_id"], table["text"])))
    found = cases.results(queries.op11_personal_data(spark, FOLDER))
    assert {key: row[:5] for key, row in found.items()} == wanted
    assert sum(sum(row[:4]) for row in wanted.values()) > 0
    empty = write(spark, cases.frame(spark, []), tmp_path / "e", "documents")
    assert queries.op11_personal_data(spark, empty).collect() == []


# --- hard negatives ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, slot string, batch string"


def vector_rows(count=400, dimensions=12, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dimensions))
    rows = []
    for number in range(count):
        vector = centers[number % 6] + 0.4 * rng.normal(size=dimensions)
        rows.append((number, vector.astype(np.float32).tolist(), int(rng.integers(0, 4)), "s", "b"))
    hot = [0.5] * dimensions
    rows += [(1000 + number, hot, number % 2, None, None) for number in range(150)]
    rows += [
        (50, rows[50][1], 1, "", ""), (50, rows[50][1], 1, "", ""), (None, rows[3][1], 1, "", ""), (2000, None, 1, "", ""),
        (2010, hot, None, "", ""), (2020, [None] * dimensions, 1, "", ""), (2030, [float("nan")] * dimensions, 2, "", ""),
        (2040, [float("inf")] + [0.0] * (dimensions - 1), 2, "", ""), (2050, [1.0, -1.0], 3, "", ""), (2060, [], 2, "", ""),
        (2070, [0.0] * dimensions, 2, "", ""), (2080, [-50.0] * dimensions, 1, "", ""),
    ]
    return rows


@pytest.mark.parametrize("block_rows", [7, 64, 1000])
def test_hard_negatives_equal_brute_force(spark, block_rows):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = hard_negatives.hard_negatives(hard_negatives.usable_rows(df), 10, block_rows=block_rows)
    wanted = brute.hard_negatives([row[:3] for row in rows], 10)
    assert len(wanted) > 300 and multiset(found.collect()) == multiset(wanted)


def test_hard_negatives_read_only_blocks_that_can_matter(spark):
    rng = np.random.default_rng(3)
    rows = [
        (number, (np.array([np.cos(t), np.sin(t)]) * 9 + rng.normal(size=2) * 0.01).tolist(), number % 2, "", "")
        for number, t in enumerate(rng.random(3000) * 6.283)
    ]
    table = hard_negatives.usable_rows(spark.createDataFrame(rows, VECTORS))
    shape = hard_negatives.vector_shape(table)
    blocks = hard_negatives.candidate_blocks(table, shape, 50)
    pages, count = hard_negatives.zone_pages(blocks)
    anchors = blocks.select("block", "ids", "labels", "components").mapInArrow(
        hard_negatives._anchor_finder(shape, 100, 5), hard_negatives.ANCHORS
    )
    opened = anchors.mapInArrow(hard_negatives._open_windows, f"{hard_negatives.ANCHORS}, windows binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("page")
    routed = opened.select("slots", "labels", "components", "windows", every).join(pages, "page").mapInArrow(
        hard_negatives._router(shape, True), hard_negatives.REQUESTS
    )
    met = routed.select((F.octet_length("slots") / 8).alias("n")).agg(F.sum("n")).first()[0]
    assert 0 < met < 0.2 * 30 * blocks.count()
    found = hard_negatives.hard_negatives(table, 100, block_rows=50)
    assert multiset(found.collect()) == multiset(brute.hard_negatives([row[:3] for row in rows], 100))


def test_hilbert_neighbours_are_one_step_apart():
    for dimensions, bits in ((1, 3), (2, 4), (3, 3), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
        cells = np.stack([axis.ravel() for axis in axes], axis=1)
        keys = hard_negatives.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_large_components_stay_exact_and_too_large_ones_are_refused(spark):
    rng = np.random.default_rng(5)
    rows = [(n, (rng.normal(size=3) * 2.0**19).tolist(), n % 2, "", "") for n in range(60)]
    rows += [(100 + n, rows[0][1], n % 2, "", "") for n in range(4)]
    kind = VECTORS.replace("float", "double")
    found = hard_negatives.hard_negatives(
        hard_negatives.usable_rows(spark.createDataFrame(rows, kind)), 5, block_rows=9
    )
    assert multiset(found.collect()) == multiset(brute.hard_negatives([row[:3] for row in rows], 5))
    large = spark.createDataFrame([(1, [1e30], 1, "", "")], kind)
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.hard_negatives(hard_negatives.usable_rows(large), 5)


def test_hard_negatives_query(spark, tmp_path):
    need_tables()
    table = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pydict()
    rows = [
        (vec_id, vector, (label + 1) % 10 if vec_id % 7 == 0 else label)
        for vec_id, vector, label in zip(table["vec_id"], table["embedding"], table["label"])
    ]
    found = queries.op12_hard_negatives(spark, FOLDER)
    assert multiset(found.collect()) == multiset(brute.hard_negatives(rows))
    empty = spark.createDataFrame([], VECTORS)
    assert queries.op12_hard_negatives(spark, write(spark, empty, tmp_path, "embeddings")).collect() == []


# --- conversations ----------------------------------------------------------------

TURNS = "conv_id long, turn int, role string, text string, number long, shard int"


def turn_rows(count=120, seed=2):
    generator = random.Random(seed)
    rows = []
    for conv in range(count):
        if conv % 15 == 0 and conv:
            continue  # absent first conversations
        for turn in range(generator.randint(1, 11)):
            text = "hello" if turn == 0 and conv % 3 else f"{generator.choice('abé')}{generator.randint(0, 2)}"
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text, 1, 2))
    for conv in range(300, 360):
        rows += [(conv, turn, "user", f"same {turn}", 1, 2) for turn in range(4)]
    rows += [
        (400, None, None, None, 1, 2), (400, None, "user", "x", 1, 2), (400, 3, "user", "x", 1, 2), (400, 3, "user", "x", 1, 2),
        (400, 3, "user", "w", 1, 2), (None, 1, "user", "lost", 1, 2), (401, 1, "", "", 1, 2), (402, 1, "a", "", 1, 2),
        (403, 1, "", "a", 1, 2), (500, 0, "user", "z" * 5000, 1, 2),
    ]
    rows += [(505, turn, "user", f"long {turn % 7}", 1, 2) for turn in range(600)]
    rows += [(506, turn, "user", f"long {turn % 7}", 1, 2) for turn in range(500)]
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_trie_equals_brute_force(spark, tmp_path, partitions):
    rows = turn_rows()
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    folder = write(spark, spark.createDataFrame(rows, TURNS).repartition(3), tmp_path, "conversations")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        found = queries.op13_conversation_trie(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    wanted = brute.conversation_trie([row[:4] for row in rows])
    assert len(found) == len(wanted) and multiset(found) == multiset(wanted)


def test_trie_of_driver_tables_and_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], TURNS)
    assert queries.op13_conversation_trie(spark, write(spark, empty, tmp_path, "conversations")).collect() == []
    need_tables()
    table = pq.read_table(f"{FOLDER}/conversations.parquet").to_pydict()
    rows = list(zip(table["conv_id"], table["turn"], table["role"], table["text"]))
    found = queries.op13_conversation_trie(spark, FOLDER).collect()
    assert multiset(found) == multiset(brute.conversation_trie(rows))


def test_median_order_keeps_siblings_balanced():
    tree = conversation_trie.TernaryTree()
    for place in conversation_trie.median_order(1023):
        tree.insert([place], [1], [place])
    deepest, level = 0, [tree.equal[0]]
    while level:
        deepest += 1
        level = [link for node in level for link in (tree.lower[node], tree.higher[node]) if link]
    assert deepest == 10 and sorted(conversation_trie.median_order(7)) == list(range(7))


# --- one queue over many pre-tokens ------------------------------------------------


def test_batch_queue_gives_ranks_in_order():
    generator = np.random.default_rng(2)
    queue, pushed, found = byte_bpe.BatchQueue(), collections.Counter(), []
    floor = 0
    for round_number in range(40):
        ranks = generator.integers(floor, 50_000, 300)
        places = generator.integers(0, 10_000, 300)
        queue.push(ranks, places)
        pushed.update(set(zip(ranks.tolist(), places.tolist())))
        for _ in range(20):
            rank, own = queue.pop()
            assert rank >= floor and (np.diff(own) > 0).all()
            floor = rank
            found += [(rank, place) for place in own.tolist()]
    while (popped := queue.pop()) is not None:
        found += [(popped[0], place) for place in popped[1].tolist()]
    assert set(found) == set(pushed) and [rank for rank, _ in found] == sorted(rank for rank, _ in found)


def test_rank_files_whose_merges_bring_up_lower_ranks():
    """Ranks at random: a merge can make a pair of lower rank, and pairs overlap."""
    generator = random.Random(6)
    for _ in range(20):
        tokens = {bytes([value]) for value in range(256)}
        tokens |= {bytes(generator.choices(b"ab", k=generator.randint(2, 5))) for _ in range(25)}
        order = sorted(tokens)
        generator.shuffle(order)
        ranks = {token: rank for rank, token in enumerate(order)}
        own = byte_bpe.ByteBpe(ranks, r"[ab]+|[^ab]+")
        library = tiktoken.Encoding("own", pat_str=r"[ab]+|[^ab]+", mergeable_ranks=ranks, special_tokens={})
        pieces = ["".join(generator.choices("ab", k=generator.randint(1, 40))) for _ in range(60)]
        found = own.encode_pieces([piece.encode() for piece in pieces])
        for piece, ids in zip(pieces, found):
            if piece.encode() not in ranks:
                assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(piece)
        text = " ".join(pieces)
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_lists_are_cut_into_bounded_parts(monkeypatch):
    own = byte_bpe.ByteBpe.from_file(queries.byte_bpe(), public_tokenizers.PATTERN)
    texts = [text or "" for _, text in cases.hostile(15)] + ["xyzzy" * 4000, ""]
    whole = own.encode_batch(texts)
    monkeypatch.setattr(byte_bpe, "LIST_BYTES", 50)
    small = byte_bpe.ByteBpe(own.ranks, public_tokenizers.PATTERN)
    assert small.encode_batch(texts) == whole
    assert small.decode_batch(whole) == [text.encode() for text in texts]
    assert all(len(key) <= byte_bpe.MEMORY_LONGEST for key in small.memory)
