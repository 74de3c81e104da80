"""The operators' own interfaces: methods, odd rows, extra columns, and real outputs."""

import random
import textwrap

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortlens.llm import byte_bpe, decontamination, html_extraction, near_dedup
from cohortlens.llm import quality_rules, sharding, suffix_dedup, token_counts, token_files
from cohortlens.llm import queries, units, window_dedup, words
from tests.llm import brute, cases


def clashing(df):
    """Extra columns named like the operators' own."""
    names = ("row", "ids", "hits", "kept", "removed", "_text", "_id", "_unit", "n_words", "data")
    return df.select("*", *[F.lit(name).alias(name) for name in names])


# --- hashes and messages ----------------------------------------------------------


def test_spans_and_hashes_follow_the_bytes():
    column = pa.array(["a bb  a bb c", "", None, "bb c", "x" * (words.PIECE + 5) + " a"])
    buffer, offsets = words.text_buffer(column)
    starts, ends, text = words.spans(buffer, offsets, words.WHITE_SPACE_WORDS)
    found = [buffer[a:b].tobytes() for a, b in zip(starts, ends)]
    assert found[:7] == [b"a", b"bb", b"a", b"bb", b"c", b"bb", b"c"]
    assert text.tolist() == [0, 0, 0, 0, 0, 3, 3, 4, 4]
    for lane in (0, 1):
        hashes = words.span_hashes(buffer, starts, ends, lane)
        assert len(set(hashes.tolist())) == len(set(found))
        assert hashes[0] == hashes[2] == hashes[8] and hashes[4] == hashes[6]


@pytest.mark.parametrize("size", [1, 2, 5, 10, 20])
def test_window_hashes_are_those_of_the_sequence(size):
    items = np.array([3, 1, 2] * 20 + [2, 1, 3], np.uint64)
    hashes = words.window_hashes(items, size)
    told = [tuple(items[i : i + size].tolist()) for i in range(len(items) - size + 1)]
    assert len(hashes) == len(told)
    assert len(set(zip(told, hashes.tolist()))) == len(set(told)) == len(set(hashes.tolist()))


def test_packed_numbers_come_back():
    ascending = np.array([0, 5, 5, 2**31])
    assert (units.unpack_ascending(units.pack_ascending(ascending)) == ascending).all()
    wild = np.array([-(2**63), 2**63 - 1, 0, -7])
    assert (units.unpack_by_text(units.pack_by_text(wild)) == wild).all()
    assert len(units.unpack_ascending(units.pack_ascending(ascending[:0]))) == 0


# --- repeats ----------------------------------------------------------------------


@pytest.mark.parametrize("remove", [window_dedup.remove_repeated_windows, suffix_dedup.remove_repeated_bytes])
def test_repeats_keep_columns_and_rows(spark, remove):
    docs = cases.hostile()
    docs += [docs[0], docs[0], (None, docs[1][1]), (None, None), (5, "another text of one doc_id " * 8)]
    df = clashing(cases.frame(spark, docs))
    extra = [name for name in df.columns if name not in ("doc_id", "text")]
    rows = remove(df, extra).collect()
    assert len(rows) == len(docs)
    assert sorted(str(row["doc_id"]) for row in rows) == sorted(str(i) for i, _ in docs)
    assert {row["carried"]["hits"] for row in rows} == {"hits"}
    # A row that repeats another is the same document; a null doc_id comes before all others.
    same = [row for row in rows if row["doc_id"] == docs[0][0]]
    assert len({tuple(row)[2:4] for row in same}) == 1
    assert next(row for row in rows if row["doc_id"] == 1)["n_removed"] > 0


def test_removed_runs_give_the_kept_text(spark):
    docs = dict(cases.hostile())
    for row in window_dedup.remove_repeated_windows(cases.frame(spark, docs.items())).collect():
        found = brute.WORD.findall(brute.raw(docs[row["doc_id"]]))
        for run in reversed(row["removed"]):
            del found[run["start"] : run["end"]]
        assert b" ".join(found).decode() == row["kept_text"]


@pytest.mark.parametrize("hot", [0, 1])
def test_cores_in_many_units_go_string_by_string(spark, monkeypatch, hot):
    docs = cases.hostile(40)
    wanted = brute.remove_bytes(docs)
    rows = cases.frame(spark, docs)
    total = units.text_bytes(rows)
    monkeypatch.setattr(suffix_dedup, "text_bytes", lambda _: total)
    monkeypatch.setattr(units.in_units, "__defaults__", ((), max(1, total // 12)))
    flags = suffix_dedup._flags

    def some_hot(hashes, heard, slices):
        shared, _ = flags(hashes, heard, slices)
        return shared, shared & (hashes % np.uint64(2) == hot)

    monkeypatch.setattr(suffix_dedup, "_flags", some_hot)
    found = suffix_dedup.remove_repeated_bytes(rows).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed"), F.sha2("kept", 256)
    )
    assert cases.results(found) == wanted


def test_construction_equals_sorted_suffixes():
    generator = random.Random(3)
    for _ in range(60):
        texts = [bytes(generator.choice(b"aab") for _ in range(generator.randint(1, 12))) for _ in range(7)]
        lengths = np.array(list(map(len, texts)))
        built = suffix_dedup.ColumnWise(np.frombuffer(b"".join(texts), np.uint8), lengths)
        suffixes = sorted(
            (tuple(text[k:]) + (-1,), number, k) for number, text in enumerate(texts) for k in range(len(text) + 1)
        )
        owner = built.suffix >> built.bits
        left = built.suffix & ((1 << built.bits) - 1)
        assert list(zip(owner, lengths[owner] - left)) == [(number, k) for _, number, k in suffixes]
        before = [0 if k == 0 else texts[number][k - 1] + 1 for _, number, k in suffixes]
        assert built.symbols.tolist() == before
        for place in range(1, len(suffixes)):
            a, b = suffixes[place - 1][0][:-1], suffixes[place][0][:-1]
            common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert built.common[place] == common


# --- near duplicates --------------------------------------------------------------


def test_sketches_merge_and_estimate():
    generator = np.random.default_rng(1)
    shared, left, right = (generator.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    sets = [np.concatenate([shared, left]), np.concatenate([shared, right]), np.concatenate([shared, left, right])]
    number = np.repeat(np.arange(3), [len(one) for one in sets])
    sizes = np.array([len(one) for one in sets])
    found = near_dedup.registers(number, np.concatenate(sets), sizes)
    assert (np.maximum(found[0], found[1]) == found[2]).all()
    assert abs(near_dedup.estimate(found[0], found[1], 900, 900) - 0.8) < 0.12


def test_small_sets_fill_all_registers():
    number, hashes, sizes = near_dedup.shingle_sets(pa.array(["one", "one two", "", None, "a b a b a"]))
    assert sizes.tolist() == [1, 1, 0, 0, 2]
    found = near_dedup.registers(number, hashes, sizes)
    assert (found[[0, 1, 4]] > 0).all() and (found[[2, 3]] == 0).all()


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, n) for n in range(101, 120)] + [(7, 7), (9, 8)]
    found = dict(near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 120)} == {100}


def test_groups_are_joined_across_pivots(spark):
    """Chains of edits, whose ends are not linked themselves, and a crowd of unlike members."""
    generator = random.Random(8)
    base = [generator.choice(cases.VOCABULARY) + str(n) for n in range(200)]
    docs = []
    for number in range(12):
        words_ = list(base)
        for place in range(8 * number):
            words_[place] = f"new{place}"
        docs.append((number, " ".join(words_)))
    docs += [(100 + n, " ".join(base[100:] + [f"tail{n}{k}" for k in range(60)])) for n in range(25)]
    found = cases.results(near_dedup.near_groups(cases.frame(spark, docs)))
    assert {key: row[:3] for key, row in found.items()} == brute.near_groups(docs)


def test_rarest_shingles_of_linked_sets_meet():
    """Whatever the order, at the limit and just above it, and for the smallest sets."""
    generator = np.random.default_rng(5)
    checked = 0
    for _ in range(4000):
        size = int(generator.integers(1, 60))
        common = generator.integers(-(-8 * size // 9), size + 1)
        larger, smaller = int(generator.integers(common, size + 8)), int(common + generator.integers(0, 4))
        larger, smaller = max(larger, smaller), min(larger, smaller)
        if smaller < common or 100 * common < 80 * (larger + smaller - common):
            continue
        checked += 1
        places = generator.permutation(larger + smaller - common)
        a = np.sort(places[:larger]).tolist()
        b = np.sort(np.concatenate([places[:common], places[larger:]])).tolist()
        met = set(a[: near_dedup._asked(larger)]) & set(b[: near_dedup._offered(smaller)])
        assert any(
            180 * min(larger - a.index(one), smaller - b.index(one)) >= 80 * (larger + smaller)
            for one in met
        )
    assert checked > 500


def test_a_common_template_is_not_compared_in_pairs(spark, monkeypatch):
    """Documents of one template, alike at 0.5 to 0.79: few pairs are looked at, no link is lost."""
    generator = random.Random(3)
    template = [generator.choice(cases.VOCABULARY) + str(n) for n in range(200)]
    docs = []
    for number in range(150):
        own = [f"own{number}x{k}" for k in range(generator.choice((25, 30, 40, 70)))]
        docs.append((number, " ".join(template + own)))
        if number % 10 == 0:
            docs.append((1000 + number, " ".join(template + own[:-2])))
    looked_at = []
    candidates = near_dedup._candidates

    def counted(rest, sets):
        pairs = candidates(rest, sets)
        looked_at.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dedup, "_candidates", counted)
    found = cases.results(near_dedup.near_groups(cases.frame(spark, docs)))
    assert {key: row[:3] for key, row in found.items()} == brute.near_groups(docs)
    assert looked_at and sum(looked_at) <= 3 * len(docs)


def test_near_groups_of_odd_ids(spark):
    text = cases.sentence(random.Random(1), 50)
    docs = [(3, text), (3, text), (None, text), (None, text), (9, text + " end"), (4, "alone here")]
    rows = near_dedup.near_groups(cases.frame(spark, docs)).collect()
    told = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in rows)
    assert told == [("3", 3, True), ("4", 4, True), ("9", 3, False), ("None", None, True), ("None", None, True)]


# --- passages ---------------------------------------------------------------------


def test_blocks_of_the_benchmark_are_united(spark, monkeypatch):
    items = [(str(n), " ".join(f"{n}w{k}" for k in range(25))) for n in range(30)] + [("s", "tiny item")]
    docs = [(n, "start " + items[n][1] + " middle " + items[n + 1][1] + " Tiny, ITEM end") for n in range(20)]
    docs += [(50, "clean text"), (51, None), (51, None)]
    df = clashing(cases.frame(spark, docs))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    whole = decontamination.find_passages(df, benchmark)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 1500)
    parts = decontamination.find_passages(df, benchmark)
    key = ["row.doc_id", "n_words", "hits", "item_ids"]
    assert sorted(map(str, whole.select(key).collect())) == sorted(map(str, parts.select(key).collect()))
    kept = decontamination.drop_contaminated(df, benchmark)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [50, 51, 51]


def test_blocks_of_repeated_and_long_items_are_bounded(spark, monkeypatch):
    long = " ".join(f"é{k}w" for k in range(2000))
    items = [("r", " ".join(f"r{k}" for k in range(40)))] * 100 + [("l", long), ("s", "tiny item")]
    words = long.split(" ")
    docs = [(n, "x " + " ".join(words[n * 90 : n * 90 + 10]) + " y") for n in range(22)]
    docs += [(90, "a TINY item"), (91, " ".join(words[5:14])), (92, items[0][1]), (93, None)]
    df = cases.frame(spark, docs)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    key = ["row.doc_id", "n_words", "hits", "item_ids"]
    whole = decontamination.find_passages(df, benchmark).select(key).collect()
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 6_000)
    blocks = [block.collect() for block in decontamination._blocks(benchmark, 10)]
    assert 1 < len(blocks) < 20
    assert all(sum(len(brute.raw(row["text"])) for row in block) <= 6_000 for block in blocks)
    parts = decontamination.find_passages(df, benchmark).select(key).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))


def test_cut_passages_leave_the_rest(spark):
    passage = " ".join(f"w{n}" for n in range(10))
    docs = [(1, f"Before, it. {passage}! after (é) \n end"), (2, "nothing"), (3, None)]
    benchmark = spark.createDataFrame([("x", passage)], "item_id string, text string")
    found = decontamination.remove_passages(cases.frame(spark, docs), benchmark)
    kept = {row["row"]["doc_id"]: row["kept_text"] for row in found.collect()}
    assert kept == {1: "Before, it. ! after (é) \n end", 2: "nothing", 3: ""}


# --- quality ----------------------------------------------------------------------


def test_lines_and_verdicts_equal_brute_force(spark):
    docs = cases.hostile() + [
        (900, "Home | About | News | Contact | Help\n" + cases.PASSAGE + ".\nAll rights reserved."),
        (901, "Buy!! now!! cheap!! pills!! here!! today!! only!! for!! you!! friend!!"),
        (902, "A plain sentence that ends. And another one, which ends as well, too."),
    ]
    rows = quality_rules.judge(clashing(cases.frame(spark, docs))).collect()
    assert {r["row"]["doc_id"]: r["kept"] for r in rows} == {i: brute.keeps(t) for i, t in docs}
    for row in rows:
        lines = (row["row"]["text"] or "").split("\n")
        assert row["cleaned_text"] == "\n".join(line for line in lines if not brute.line_fails(line))
    good = quality_rules.keep_good(clashing(cases.frame(spark, docs)))
    assert good.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_the_stage_passes_texts_without_failing_lines(spark):
    prose = "\n".join(cases.sentence(random.Random(n), 20) for n in range(9))
    docs = clashing(cases.frame(spark, [(1, prose + "\nAll rights reserved."), (2, "too short"), (3, prose)]))
    left = corpus_pipeline.quality_rules(spark, docs, "")
    assert left.dtypes == docs.dtypes
    found = {row["doc_id"]: (row["text"], row["n_chars"], row["source"], row["kept"]) for row in left.collect()}
    assert found == {1: (prose, len(prose), "s1", "kept"), 3: (prose, len(prose), "s0", "kept")}


def test_wrapped_and_foreign_prose_is_kept(spark):
    generator = random.Random(8)
    plain = [cases.sentence(generator, 27) for _ in range(12)]
    wrapped = textwrap.fill(" ".join(plain), 72)
    foreign = {
        n: "\n".join(line[:-1] + mark for line in plain)
        for n, mark in enumerate(("।", " ॥", "؟", "۔", "።", "།", "။", "។", "。」", ".”", "!»", "?’)", ";\""), 10)
    }
    dense = " ".join(plain).replace(". ", "。")
    good = {1: wrapped, 2: "Head\n\n" + wrapped.replace("\n", "\r\n"), 3: wrapped.replace(".", "।"), 4: dense}
    no_marks = wrapped.replace(".", "")
    one_mark = "\n".join(" ".join(f"item{n}x{k}" for k in range(11)) for n in range(60)) + "\nNow."
    long_line = " ".join(f"tag{n}" for n in range(90))
    bad = {
        30: no_marks, 31: no_marks + "\n\nA mark, but elsewhere.", 32: one_mark,
        33: long_line + "\nA mark, but not in the long line.", 34: "\n".join(plain).replace(".", "”"),
    }
    docs = list((good | foreign | bad).items())
    rows = quality_rules.judge(cases.frame(spark, docs)).collect()
    assert {row["row"]["doc_id"] for row in rows if row["kept"]} == {*good, *foreign}
    cleaned = {row["row"]["doc_id"]: row["cleaned_text"] for row in rows}
    assert all(cleaned[n] == text for n, text in (good | foreign).items())
    assert cleaned[33] == "A mark, but not in the long line."


def test_no_word_is_all_closing_marks(spark):
    docs = [(n, text) for n, text in enumerate(["»", "é»", "”", "a»", ")" * 90, "x." + ")" * 4])]
    assert quality_rules.judge(cases.frame(spark, docs, 1)).count() == len(docs)


# --- tokens -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe.from_file(queries.byte_bpe(), public_tokenizers.PATTERN)


def test_queue_gives_ranks_in_order():
    queue, generator = byte_bpe.RankQueue(), random.Random(2)
    pushed = [(generator.randrange(50_000), place) for place in range(500)] + [(7, 3), (7, 1)]
    for rank, place in pushed:
        queue.push(rank, place)
    found = []
    while queue.top:
        rank, places = queue.pop()
        found += [(rank, place) for place in places]
    assert found == sorted(pushed)


def test_long_pieces_are_encoded_as_by_the_library(bpe):
    generator = random.Random(5)
    texts = ["a" * 20_000, "ab" * 5_000, "the" * 3_000, "é" * 2_000]
    texts += ["".join(generator.choice("aeinrst") for _ in range(4_000)) for _ in range(5)]
    wanted = brute.byte_bpe(list(enumerate(texts)))
    for number, text in enumerate(texts):
        ids = bpe.encode(text)
        assert brute.sha(ids) == wanted[number][1] and bpe.decode(ids) == text.encode()


def test_a_full_memory_changes_nothing(bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMORY_ENTRIES", 3)
    monkeypatch.setattr(token_files, "MEMORY_ENTRIES", 120)
    docs = cases.hostile(12)
    wanted = brute.byte_bpe(docs)
    small = byte_bpe.ByteBpe(bpe.ranks, public_tokenizers.PATTERN)
    assert all(brute.sha(small.encode(t or "")) == wanted[i][1] for i, t in docs)
    own = token_files.StretchEncoder(queries.word_bpe())
    counts = brute.token_counts(docs)
    for _ in range(2):
        ids, found = own.encode(pa.array([t for _, t in docs]))
        assert found.tolist() == [counts[i][1] for i, _ in docs] and len(ids) == found.sum()
    many = pa.array([" ".join(f"k{n}" for n in range(400))])
    wanted = own.tokenizer.encode(many[0].as_py(), add_special_tokens=False).ids
    assert own.encode(many)[0].tolist() == wanted
    assert own.encode(pa.array([], pa.string()))[1].tolist() == []


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (100, 30), (700, 8)])
def test_chunks_resynchronise(chunk, overlap):
    own = Tokenizer.from_file(queries.word_bpe())
    for _, text in cases.hostile(10):
        text = text or ""
        if len(text) < 6000:
            wanted = len(own.encode(text, add_special_tokens=False).ids)
            assert token_counts.count_huge(own, text, chunk, overlap) == wanted


def test_huge_texts_are_counted_in_chunks(spark):
    docs = [(1, "word " * 9_000), (2, "x" * 40_000), (3, ("y" * 700 + " ") * 60), (4, None)]
    found = token_counts.count_tokens(clashing(cases.frame(spark, docs)), queries.word_bpe)
    told = {r["row"]["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in found.collect()}
    assert told == {key: row[:2] for key, row in brute.token_counts(docs).items()}


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_are_ordered_and_read_by_part(spark, tmp_path, encoding):
    docs = cases.hostile(30)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(
        cases.frame(spark, docs), path, queries.word_bpe, 1, columns=["lang"], encoding=encoding
    )
    files = token_files.read_token_files(spark, path)
    rows = files.orderBy("shard", "place").collect()
    assert [row["doc_id"] for row in rows] == [i for i, _ in docs]
    assert all(row["ids"][-1] == 1 and len(row["ids"]) == row["n_tokens"] for row in rows)
    assert {row["lang"] for row in rows} == {"xx"}
    plan = files.where("doc_id = 3").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in plan and "ids:" not in plan.split("ReadSchema")[1]
    with pytest.raises(ValueError):
        token_files.write_token_files(cases.frame(spark, docs), path, queries.word_bpe, 1, encoding="x")


# --- shards and pages -------------------------------------------------------------


def shard_order(spark, df, path, **options):
    sharding.write_shards(df, path, 5, seed=3, **options)
    rows = sharding.read_shards(spark, path, df.schema).orderBy("shard", "slot").collect()
    return [(row["shard"], row["slot"], row["doc_id"], row["text"]) for row in rows]


def test_shards_are_native_repeatable_and_ordered(spark, tmp_path):
    docs = cases.hostile(50) + [(0, cases.hostile(20)[0][1]), (None, None), (None, None)]
    docs += [(7, "one row " * 20)] * 300 + [(8, "near " * 10 + str(n)) for n in range(100)]
    df = cases.frame(spark, docs)
    plan = sharding.shuffled(df, 3, 10_000, 500)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    orders = []
    for number, adaptive in enumerate(("true", "false", "true", "false")):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            laid = df.repartition(number + 2)
            orders.append(shard_order(spark, laid, str(tmp_path / f"s{number}"), bucket_bytes=6_000))
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
    assert orders[0] == orders[1] == orders[2] == orders[3] and len(orders[0]) == len(docs)
    assert [row[2] for row in orders[0]] != sorted((i for i, _ in docs), key=str)
    assert sorted(map(str, (row[2:] for row in orders[0]))) == sorted(map(str, docs))


def test_copies_of_one_row_are_spread_over_buckets(spark):
    df = cases.frame(spark, [(1, "the same text")] * 900 + [(n, f"text {n}") for n in range(100)])
    rows = sharding.shuffled(df, 5, 21_000, 2_000).collect()
    assert sorted(row["index"] for row in rows) == list(range(1000))
    others = sorted(row["index"] for row in rows if row["row"]["text"] != "the same text")
    assert len(others) == 100 and max(np.diff(others)) < 120


def test_shards_carry_own_shards_and_slots(spark, tmp_path):
    df = cases.frame(spark, cases.hostile(20)).withColumns({"slot": F.lit("mine"), "shard": F.lit(99), "row": F.lit(1)})
    sharding.write_shards(df, str(tmp_path / "x"), 3, bucket_bytes=3_000)
    rows = sharding.read_shards(spark, str(tmp_path / "x"), df.schema).collect()
    assert len(rows) == df.count() and {row["shard"] for row in rows} == {0, 1, 2}
    assert all((row["row"]["slot"], row["row"]["shard"], row["row"]["row"]) == ("mine", 99, 1) for row in rows)


def test_shards_carry_columns_of_any_name(spark, tmp_path):
    names = ("_key", "_bucket", "_index", "index", "row", "_row", "_rows", "_before")
    df = cases.frame(spark, cases.hostile(20)).select("*", *[F.lit(name).alias(name) for name in names])
    sharding.write_shards(df, str(tmp_path / "s"), 3, seed=3, bucket_bytes=3_000)
    rows = sharding.read_shards(spark, str(tmp_path / "s"), df.schema).collect()
    assert len(rows) == df.count() and all(row[name] == name for row in rows for name in names)


def test_blocks_of_a_page():
    page = (
        "<title>T</title><nav class='menu x'><a href=1>one</a> <a>two</a></nav><article><h1>Head</h1>"
        "<p><b>Bo</b>ld &amp; x<br>next<p>second<script>var a='<p>no</p>'</script></article>"
        "<!-- <p>no</p> --><div class=\"cookie-notice\">accept</div><footer>&copy; f</footer> tail"
    )
    found = html_extraction.blocks(page)
    assert [block.text for block in found] == [
        "T", "one two", "Head", "Bold & x", "next", "second", "accept", "© f", "tail",
    ]
    assert [html_extraction.is_main(block) for block in found] == [False] * 2 + [True] * 4 + [False] * 3
    assert html_extraction.blocks("") == [] and html_extraction.blocks("<p") != []


def test_gradients_are_those_of_the_loss():
    model = html_extraction.Labeller(1)
    generator = np.random.default_rng(0)
    rows = generator.normal(size=(5, 3, html_extraction.INPUT)).astype(np.float32)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], np.float32)
    labels = (generator.random((5, 3)) < 0.5).astype(np.float32)

    def loss():
        p = np.clip(model.chances(rows, mask).astype(float), 1e-9, 1 - 1e-9)
        return -(mask * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / mask.sum()

    for weight, gradient in zip(model.weights(), model._gradients(rows, mask, labels)):
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before, step = weight[place], 1e-2
        weight[place] = before + step
        above = loss()
        weight[place] = before - step
        slope = (above - loss()) / (2 * step)
        weight[place] = before
        assert abs(slope - gradient[place]) < 0.05 * abs(gradient[place]) + 1e-4


def test_disguised_pages_are_labelled_by_context():
    generator = random.Random(4)

    def page():
        body = "".join(f"<p>{cases.sentence(generator, 30)}</p>" for _ in range(generator.randint(3, 9)))
        menu = "".join(f"<li><a href=x>{generator.choice(cases.VOCABULARY)}</a></li>" for _ in range(6))
        return f"<nav><ul>{menu}</ul></nav><article><h1>A head</h1>{body}</article><footer>© all | of | it</footer>"

    pages = [page() for _ in range(60)]
    labeller = html_extraction.fit_labeller(pages[:40])
    held_out, seed = [html_extraction.blocks(text) for text in pages[40:]], np.random.default_rng(9)
    right = total = 0
    for blocks in held_out:
        hidden = html_extraction.disguised(blocks, seed)
        rows, mask, _ = html_extraction.padded([html_extraction.features(hidden)])
        guessed = labeller.chances(rows, mask)[:, 0] > 0.5
        right += sum(g == html_extraction.is_main(b) for g, b in zip(guessed, blocks))
        total += len(blocks)
    assert right >= 0.95 * total


def laid_out(generator, top, bottom, menu, foot):
    """A page, and its main text as a reader would mark it."""
    body = [cases.sentence(generator, 30) for _ in range(generator.randint(3, 9))]
    links = "".join(f"<li><a href=x>{generator.choice(cases.VOCABULARY)}</a></li>" for _ in range(6))
    page = (
        f"{menu[0]}<ul>{links}</ul>{menu[1]}{top}<h1>A head</h1>"
        + "".join(f"<p>{line}</p>" for line in body)
        + f"{bottom}{foot[0]}© all | of | it{foot[1]}"
    )
    return page, " ".join(["A head", *body])


ARTICLE = ("<article>", "</article>", ("<nav>", "</nav>"), ("<footer>", "</footer>"))
DIVS = (("<div class=t1>", "</div>"), ("<div class=t9>", "</div>"))


@pytest.mark.parametrize(
    "layouts",
    [
        {("<div class='t4'>", "</div>", *DIVS): 60},
        {("<div id=content>", "</div>", *DIVS): 60},
        {("<div role='main'>", "</div>", *DIVS): 60},
        {("<div class='box entry_content'>", "</div>", *DIVS): 60},
        {ARTICLE: 12, ("<div class='t4'>", "</div>", *DIVS): 300},
        {ARTICLE: 30, ("<div id=\"content\">", "</div>", *DIVS): 60},
    ],
)
def test_pages_of_divs_give_the_text_a_reader_marks(spark, layouts):
    generator = random.Random(6)
    made = [laid_out(generator, *layout) for layout, count in layouts.items() for _ in range(count)]
    rows = [(n, f"u{n}", page) for n, (page, _) in enumerate(made)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {row["row"]["page_id"]: row["main_text"] for row in html_extraction.extract_main_text(frame).collect()}
    same = [found[n] == text for n, (_, text) in enumerate(made)]
    assert sum(same) >= 0.95 * len(same)


def test_labels_come_from_the_surest_main_elements():
    def labels(page):
        known = html_extraction.known_labels(html_extraction.blocks(page))
        return known if known is None else known.astype(bool).tolist()

    assert labels("<p>a</p><div class=x><p>b</p></div>") is None
    assert labels("<article></article><div data-id=content>b</div><body class=content>c</body>") is None
    assert labels("<div>a</div><div id=content>b<p class=share>c</div>") == [False, True, False]
    assert labels("<div id=content>a<div role=main>b</div></div>") == [False, True]
    assert labels("<div class=related-post>a</div><article class=related>b</article><div class='x Post_Body'>c") == [
        False, False, True,
    ]


# --- pipeline ---------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = cases.hostile()
    items = [("1", cases.PASSAGE), ("2", "no such words in any of the documents at all here now")]
    cases.frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cases.results(corpus_pipeline.run(spark, str(tmp_path))) == brute.pipeline(docs, items)


def test_stages_keep_the_columns(spark, tmp_path):
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (cases.frame(spark, cases.hostile(20)), cases.frame(spark, []), clashing(cases.frame(spark, cases.hostile(10)))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, str(tmp_path))
            assert left.dtypes == docs.dtypes
        assert set(corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).columns) >= {"doc_id"}


def test_workers_keep_nothing_of_other_operators(monkeypatch):
    from cohortlens.llm import memory

    given, emptied = [], []
    monkeypatch.setattr(memory, "give_back", lambda: given.append(1))
    monkeypatch.setattr(memory, "_CACHES", {})
    memory.holds("one", lambda: emptied.append("one"))
    assert list(memory.batchwise(lambda batches: (2 * batch for batch in batches), "one")(iter([1, 2]))) == [2, 4]
    assert not emptied and len(given) == 1
    assert memory.tablewise(lambda table: table + 1)(1) == 2 and emptied == ["one"]
    assert memory.tablewise(lambda table, answers: table + answers)(1, 2) == 3 and len(given) == 3


def test_byte_bpe_sends_a_text_once(spark):
    """A batch goes to the worker whole, so a second copy of its texts would be held there too."""
    docs = spark.createDataFrame(cases.hostile(12), "doc_id long, text string")
    docs = docs.unionByName(spark.createDataFrame([(901, None), (902, "")], docs.schema))

    def encoded(frame):
        return byte_bpe.encode_and_decode(frame, queries.byte_bpe, public_tokenizers.PATTERN)

    plan = encoded(docs)._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "_text" not in plan
    rows = encoded(docs).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert bytes(row.decoded) == (row.text or "").encode()
    few = byte_bpe.encode_and_decode(docs, queries.byte_bpe, public_tokenizers.PATTERN, 3)
    assert {(r.row.doc_id, bytes(r.ids)) for r in few.collect()} == {(r.doc_id, bytes(r.ids)) for r in rows}
    # A text that has to be cast still goes beside its row, which keeps the column as it is.
    numbers = docs.select("doc_id", F.col("doc_id").alias("text"))
    for row in encoded(numbers).select("row", "decoded").collect():
        assert bytes(row.decoded) == str(row.row.doc_id).encode() and row.row.text == row.row.doc_id
