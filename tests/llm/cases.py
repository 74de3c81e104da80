"""Small hostile documents that every operator has to survive with a defined result."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def sentence(generator, words):
    return " ".join(generator.choice(VOCABULARY) for _ in range(words)) + "."


VOCABULARY = [a + b for a in ("ka", "to", "mi", "re", "sü", "é", "ж") for b in ("n", "la", "ry", "so")]
PASSAGE = " ".join(f"passage{number}" for number in range(60))


def hostile(count=60, seed=4):
    """(doc_id, text) pairs: prose, copies, near copies, shared passages, and odd texts."""
    generator = random.Random(seed)
    texts = ["\n".join(sentence(generator, generator.randint(3, 60)) for _ in range(6)) for _ in range(count)]
    for number in range(0, count, 5):
        texts[number] += " " + PASSAGE
    texts[7] = texts[3]
    texts[8] = texts[3] + " one more word"
    for number in range(20, min(32, count)):
        words = texts[19].split(" ")
        words[generator.randrange(len(words))] = f"edit{number}"
        texts[number] = " ".join(words)
    odd = [
        None, "", " ", "\n\n\n", "word", "two words", "é", "\x00\x01", "a" * 5000, "ab " * 3000,
        "  two  spaces   three\t tabs \n lines\r\n", "<|endoftext|> special <|startoftext|>",
        " no-break em space\x1cseparator\x85next", "́combining first é",
        "ſtraße İstanbul ΣΑΣ ﬁ", "日本語のテキスト。" * 40, "🙂" * 50, "'s 't're don't I'LL",
        PASSAGE + "\n" + PASSAGE, "x " * 9, "| " * 40, "same same " * 30,
    ]
    return list(enumerate(texts + odd))


def frame(spark, docs, parts=3):
    rows = [(i, t, "xx", f"s{(i or 0) % 3}", len(t or "")) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def results(df, key="doc_id"):
    """{key: the other columns}; one row per key."""
    rows = df.collect()
    found = {row[key]: tuple(v for name, v in row.asDict().items() if name != key) for row in rows}
    assert len(found) == len(rows)
    return found
