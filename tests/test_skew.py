"""The two-tier join: same rows as a plain join, and a hot key spread over tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators.skew import heavy_keys, skew_join

HOT = 30_000


@pytest.fixture(scope="module")
def sides(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 9000))
    left = spark.range(HOT).select(key.alias("card"), (F.col("id") % 11).alias("a"), F.col("id").alias("n"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("k2", 4), (None, 5), ("nobody", 6)], "card string, b int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "left_outer"])
def test_same_rows_as_a_plain_join(sides, how):
    left, right = sides
    found = skew_join(left, right, "card", how, parts=16)
    plain = left.join(right, "card", how)
    assert found.columns == plain.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_two_keys_and_refused_kinds(spark, sides):
    left, right = sides
    r = right.withColumn("a", F.lit(3).cast("long"))
    assert Counter(map(tuple, skew_join(left, r, ["card", "a"], parts=8, spread=["n"]).collect())) == Counter(map(tuple, left.join(r, ["card", "a"]).collect()))
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            skew_join(left, right, "card", how, parts=8)
    nothing = left.where("n < 0")
    assert skew_join(nothing, right, "card", parts=8).count() == 0
    assert skew_join(left, right.where("b > 99"), "card", "left", parts=8).count() == HOT


def test_heavy_keys(sides):
    found = {r.card: r["_parts"] for r in heavy_keys(sides[0], ["card"], 24).collect()}
    assert found == {"hot": 8}


def test_no_task_above_twice_the_mean(spark, sides):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        left, right = sides
        every = right.unionByName(left.where("card <> 'hot'").select("card", F.lit(0).alias("b")).distinct())
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        one = every.dropDuplicates(["card"])
        plain, split = sizes(left.join(one, "card").select("n")), sizes(skew_join(left, one, "card", parts=48).select("n"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert max(plain) > 3 * sum(plain) / 12
    assert len(split) == 12 and max(split) < 2 * sum(split) / 12
