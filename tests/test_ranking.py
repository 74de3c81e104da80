import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.operators import joins, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; a third of them share one value."""
    rng = np.random.default_rng(7)
    value = rng.integers(0, 400, 5000)
    value[:1700] = 0
    frame = pd.DataFrame(
        {"id": rng.permutation(5000), "g": np.where(rng.random(5000) < 0.8, "hot", "cold"), "v": value}
    )
    return spark.createDataFrame(frame).cache()


def test_global_row_number_equals_window(skewed):
    ranked = ranking.global_row_number(skewed, ["v", "id"], "rn")
    assert ranked.where("rn_total <> 5000").count() == 0
    mine = ranked.select("id", "rn")
    plain = skewed.select("id", F.row_number().over(W.orderBy("v", "id")).alias("plain"))
    assert mine.join(plain, "id").where("rn <> plain").count() == 0
    assert mine.count() == 5000


def test_running_totals_equal_window(skewed):
    counts = skewed.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    mine = ranking.running_totals(counts, ["g"], [F.col("v").desc()], ["n"])
    order = W.partitionBy("g").orderBy(F.col("v").desc()).rowsBetween(W.unboundedPreceding, -1)
    plain = counts.select("g", "v", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("plain"))
    assert mine.join(plain, ["g", "v"]).where("n_before <> plain").count() == 0
    assert mine.count() == counts.count()


def test_running_totals_without_groups(skewed):
    counts = skewed.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    got = ranking.running_totals(counts, [], ["v"], ["n"]).orderBy("v").toPandas()
    assert got["n_before"].tolist() == (got["n"].cumsum() - got["n"]).tolist()


def test_percentiles_equal_builtin(skewed):
    shares = {"a": 0.05, "b": 0.5, "c": 0.81}
    mine = ranking.exact_percentiles(skewed, ["g"], "v", shares)
    plain = skewed.groupBy("g").agg(
        *[F.percentile("v", share).alias(f"p{name}") for name, share in shares.items()]
    )
    row = mine.join(plain, "g").collect()
    assert len(row) == 2
    for r in row:
        for name in shares:
            assert r[name] == pytest.approx(r[f"p{name}"])


def test_percentiles_skip_nulls_and_keep_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None)], "g string, v double")
    got = {r["g"]: r["m"] for r in ranking.exact_percentiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {"a": 1.5, "b": None}


@pytest.mark.parametrize("bins", [4, 5])
@pytest.mark.parametrize("rows", [1, 2, 5, 6, 7, 10, 399])
def test_equal_frequency_bins_match_quantile_cut(spark, bins, rows):
    got = (
        spark.range(1, rows + 1)
        .select(ranking.equal_frequency_bin(F.col("id"), F.lit(rows), bins).alias("b"))
        .toPandas()["b"]
    )
    if rows > 1:
        want = pd.qcut(pd.Series(range(1, rows + 1)), q=bins, labels=False) + 1
        assert got.tolist() == want.tolist()
    sizes = (
        spark.range(1, bins + 1)
        .select(ranking.equal_frequency_size(F.col("id"), F.lit(rows), F.lit(bins)).alias("n"))
        .toPandas()["n"]
    )
    assert sizes.tolist() == [int((got == b).sum()) for b in range(1, bins + 1)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, skewed, how):
    right = spark.range(0, 300).select(F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    if how in ("left_semi", "left_anti"):
        right = right.select("v")
    mine = joins.skew_join(skewed, right, ["v"], how, ["id"], hot_rows=500)
    plain = skewed.join(right, "v", how)
    assert joins.hot_keys(skewed, ["v"], 500).count() == 1
    assert sorted(map(str, mine.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dimension_join_without_broadcast(spark, skewed, how):
    right = spark.range(0, 300).select(F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mine = joins.dimension_join(skewed, right, ["v"], how, ["id"])
        plain = skewed.join(right, "v", how)
        assert sorted(map(str, mine.select(*plain.columns).collect())) == sorted(
            map(str, plain.collect())
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
