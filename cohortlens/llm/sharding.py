"""Sharding by a two-pass external shuffle, in DataFrame functions only.

The first pass scatters the rows evenly into buckets by a seeded hash of their content, as many
as it takes to hold one in memory. The second shuffles each bucket with ``shuffle``, Spark's
Fisher-Yates on arrays, and writes it: a bucket's rows follow those of all earlier buckets,
and the sequence is cut into shards whose row counts differ by one at most, so a bucket
reaches few shards and nothing is moved a second time.

The order depends on rows and seed alone, not on the input's layout: a bucket is a task of its
own, numbered like it, so its draws start from the seed and the bucket's number, and it is
sorted before it is shuffled.

Law ``rows``: counts at most one apart. Rows equal in all columns are one row with a count where
together they would fill a good part of a bucket; the copies are made again behind the count,
each with a hash of its own, so they spread over all buckets. Other copies need nothing of the
kind. A null text counts no bytes, a null doc_id hashes like a value. With fewer rows than
shards, some shards stay empty. An empty table gives an empty result. Other columns are written
along in one struct under any names; columns of a map type have no order and are refused by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import materialize

#: Text bytes of a bucket, about; a task holds one as an array. Larger tables on larger
#: machines take larger buckets, as each is a task.
BUCKET_BYTES = 32 << 20
#: The part of a bucket that copies of one row may fill before they are spread.
HOT_PART = 8
#: Buckets up to which all offsets are sent to every task: 16 bytes each.
MOST_SENT_OFFSETS = 1 << 20
#: Buckets whose offsets one window adds up.
BUCKET_GROUP = 4096
#: What a row counts besides its text.
ROW_BYTES = 8


def _size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def _offsets(buckets: DataFrame) -> DataFrame:
    """Rows in earlier buckets, in two steps, so that no window holds all buckets."""
    group = F.col("_bucket").cast("long") / F.lit(BUCKET_GROUP)
    counts = buckets.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumn("_group", F.floor(group))
    inside = W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(0)).orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    groups = counts.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    groups = groups.select("_group", F.coalesce(F.sum("_rows").over(every), F.lit(0)).alias("_base"))
    return (
        counts.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(groups, "_group")
        .select("_bucket", (F.col("_base") + F.col("_inside")).alias("_before"))
    )


def _spread_copies(rows: DataFrame, bucket_bytes: int) -> DataFrame:
    """``(_digest, _copy, row)`` of ``(_digest, _bytes, row)``: copies of hot rows numbered,
    all others 0.

    Digests are counted before they move. There are few hot rows however many copies they
    have: each fills a good part of a bucket.
    """
    counts = rows.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_copies"), F.max("_bytes").alias("_bytes")
    )
    filled = F.col("_copies") * F.col("_bytes") * F.lit(HOT_PART)
    hot = materialize(
        counts.where((F.col("_copies") > 1) & (filled > F.lit(bucket_bytes))).select("_digest", "_copies")
    )
    others = rows.join(hot, "_digest", "left_anti").select("_digest", F.lit(0).cast("long").alias("_copy"), "row")
    # One of the copies stands for all; equal rows are combined before the shuffle.
    copies = (
        rows.join(hot, "_digest")
        .groupBy("_digest", "_copies")
        .agg(F.max("row").alias("row"))
        .select("_digest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"), "row")
    )
    return others.unionByName(copies)


def shuffled(
    docs: DataFrame, seed: int, total_bytes: int, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows as the struct ``row``, and ``index``, their place from 0 in one random order
    of the whole table."""
    buckets = max(1, -(-total_bytes // bucket_bytes))
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(
        F.unhex(F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)).alias("_digest"),
        _size().alias("_bytes"),
        row.alias("row"),
    )
    key = F.xxhash64(F.lit(seed), F.col("_digest"), F.col("_copy"))
    dealt = _spread_copies(rows, bucket_bytes).select(
        key.alias("_key"), F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)).cast("int").alias("_bucket"), "row"
    )
    held = (
        dealt.repartitionById(buckets, "_bucket")
        .groupBy("_bucket")
        .agg(F.collect_list(F.struct("_key", "row")).alias("_rows"))
    )
    mixed = held.select("_bucket", F.shuffle(F.sort_array("_rows"), seed).alias("_rows"))
    offsets = materialize(_offsets(dealt.select("_bucket")))
    if buckets <= MOST_SENT_OFFSETS:
        # One row per bucket. Joined by a shuffle, the full buckets would move once more.
        offsets = F.broadcast(offsets)
    placed = mixed.join(offsets, "_bucket")
    return placed.select("_before", F.posexplode("_rows").alias("_place", "_row")).select(
        F.col("_row.row").alias("row"), (F.col("_before") + F.col("_place")).alias("index")
    )


def write_shards(
    docs: DataFrame, path: str, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Write all rows below ``path`` in folders ``shard=0`` to ``shards - 1``, each as the
    struct ``row``.

    ``slot`` numbers a shard's rows from 0 without gaps, and files hold ascending slots.
    """
    rows, total = docs.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(_size()), F.lit(0))
    ).first()
    ordered = shuffled(docs, seed, total, bucket_bytes).withColumn(
        "shard", F.expr(f"cast(index * {shards} div {max(rows, 1)} as int)")
    )
    begins = F.expr(f"(shard * cast({rows} as bigint) + {shards - 1}) div {shards}")
    (
        ordered.select("row", (F.col("index") - begins).alias("slot"), "shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The written rows with shard and slot; ``columns`` are those that were written.

    Columns that are themselves named shard or slot are in the struct ``row``; all others
    stand beside it.
    """
    own = {"row": columns, "slot": T.LongType(), "shard": T.IntegerType()}
    schema = T.StructType([T.StructField(name, kind) for name, kind in own.items()])
    read = spark.read.schema(schema).parquet(path)
    clash = {name for name in columns.names if name.lower() in ("slot", "shard", "row")}
    plain = [F.col("row")[name].alias(name) for name in columns.names if name not in clash]
    whole = ["row"] if clash - {"row"} else [F.col("row")["row"].alias("row")] if clash else []
    return read.select(*plain, *whole, "slot", "shard")


def digest(shards: DataFrame) -> DataFrame:
    """Per row: its size, checksum and place."""
    return shards.select(
        "doc_id",
        _size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
