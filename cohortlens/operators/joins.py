"""Equi-joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.contract import KEYS

SALTS = 8
# Rows of a key that one task takes, and the most keys that can be called hot.
HOT_ROWS = 1_000_000
MOST_HOT = 1_000


def _row_salt(columns: Sequence[str], salts: int | Column) -> Column:
    """A salt from the row's content, so a retried task repeats it.

    Rows equal in ``columns`` share a salt, so these should tell most rows of a
    key apart, and be few: every column named here has to be read.
    """
    salts = F.lit(salts) if isinstance(salts, int) else salts
    return F.pmod(F.xxhash64(*[F.col(name) for name in columns]), salts).cast("int")


def dimension_join(
    fact: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str] = KEYS,
    salts: int = SALTS,
) -> DataFrame:
    """Join a fact to a small dimension holding one row per key.

    Below ``spark.sql.autoBroadcastJoinThreshold`` Spark broadcasts the dimension
    by itself. Above it the copies per salt spread a hot key over ``salts`` tasks.
    """
    spread = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        fact.withColumn("_salt", _row_salt(salt_by, salts))
        .join(spread, [*on, "_salt"], how)
        .drop("_salt")
    )


def hot_keys(
    df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, most: int = MOST_HOT
) -> DataFrame:
    """Keys with at least ``hot_rows`` rows and one ``most``-th of all rows, and their salts.

    There are at most ``most`` of them however many rows there are; a key gets one salt
    for each ``hot_rows`` of its rows.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(
        (F.col("_rows") >= hot_rows) & (F.col("_rows") * F.lit(most) >= total)
    ).select(*on, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_salts"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str] = KEYS,
    hot_rows: int = HOT_ROWS,
    most: int = MOST_HOT,
) -> DataFrame:
    """Join a skewed left side to a large right side holding one row per key.

    Only hot keys are salted on the left and copied on the right, as often as their rows
    need, so a hot key's tasks stay bounded and the right side hardly grows. How the short
    list of hot keys is joined is left to Spark.
    """
    hot = hot_keys(left, on, hot_rows, most)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted = (
        left.join(hot, list(on), "left")
        .withColumn("_salt", _row_salt(salt_by, salts))
        .drop("_salts")
    )
    spread = (
        right.join(hot, list(on), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


#: Bits per key and hashes of a key filter: it lets about one in a hundred other keys pass.
BITS_PER_KEY, HASHES = 12, 5
#: Keys up to which a filter is made: it goes to every task, at 1.5 bytes a key.
MOST_FILTER_KEYS = 32_000_000
#: Words of a key filter that one task puts in order.
FILTER_CHUNK = 4_096


def _bit(whole: Column, turn: int) -> Column:
    bit = F.shiftrightunsigned(whole, 6 * turn).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def _word_and_mask(on: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a filter that holds a key, and the key's bits in it, from one hash."""
    whole = F.xxhash64(*[F.col(name) for name in on])
    # What a condition names more than once is computed as often, and keys may be expressions
    # of their own: with the hash in every bit the code outgrows what the JVM compiles. A
    # lambda's variable is computed once.
    bits = F.transform(
        F.array(whole),
        lambda known: reduce(Column.bitwiseOR, [_bit(known, turn) for turn in range(HASHES)]),
    )
    return F.shiftrightunsigned(whole, 6 * HASHES) % F.lit(words), F.get(bits, F.lit(0))


def key_filter(keys: DataFrame, on: Sequence[str], most: int = MOST_FILTER_KEYS) -> Column | None:
    """A condition that holds for every row whose key is in ``keys``, and for few others.

    A Bloom filter as wide as the number of keys asks for, computed once and tested at the
    scan, before rows are shuffled. All bits of a key lie in one word, so a row reads one.
    None where there are more keys than a filter is made for.
    """
    count = keys.select(*on).distinct().count()
    if not count:
        return F.lit(False)
    if count > most:
        return None
    words = -(-count * BITS_PER_KEY // 64)
    word, mask = _word_and_mask(on, words)
    # A key that comes twice sets the same bits.
    filled = keys.select(word.alias("word"), mask.alias("mask"))
    empty = keys.sparkSession.range(words).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask")
    )
    table = filled.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))

    def listed(entries: Column, value: str) -> Column:
        return F.transform(F.array_sort(entries), lambda entry: entry[value])

    # Chunks of words are ordered side by side. What is left is one list as long as the filter,
    # whose size is bounded above.
    chunks = table.groupBy(F.expr(f"word div {FILTER_CHUNK}").alias("chunk")).agg(
        listed(F.collect_list(F.struct("word", "mask")), "mask").alias("masks")
    )
    entries = F.collect_list(F.struct("chunk", "masks"))
    found = chunks.agg(F.flatten(listed(entries, "masks")).alias("words")).scalar()
    held = F.get(found, word.cast("int"))
    return F.bitwise_not(held).bitwiseAND(mask) == 0
