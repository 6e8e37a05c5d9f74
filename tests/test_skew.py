from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quillspark.operators import skew


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, how):
    big = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("unused", 5), (None, 6)], "key string, x int")
    assert skew.hot_keys(big, "key", 500) == ["hot"]
    got, want = skew.salted_join(big, small, "key", ["id"], how, rows=500), big.join(small, "key", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_pairs(spark):
    rows = [("a", k) for k in range(40)] + [("b", 100), ("b", 101), ("c", 7)]
    df = spark.createDataFrame(rows, "key string, id bigint")
    blocks = skew.id_blocks(df, "key", "id", size=6).collect()
    assert sorted((r["key"], i) for r in blocks for i in r["ids"]) == sorted(rows) and max(len(r["ids"]) for r in blocks) < 20
    before, skew.BLOCK = skew.BLOCK, 6
    try:
        got = sorted(tuple(r) for r in skew.pairs_within(df, "key", "id", "x", "y").collect())
        assert got == sorted([*combinations(range(40), 2), (100, 101)])
        linked = spark.createDataFrame([("a", "b"), ("b", "c")], "p string, q string")
        got = sorted(tuple(r) for r in skew.pairs_between(linked, "p", "q", df, "key", "id", "x", "y").collect())
        assert got == sorted([(k, b) for k in range(40) for b in (100, 101)] + [(7, 100), (7, 101)])
    finally:
        skew.BLOCK = before
    assert skew.pairs_within(df.limit(0), "key", "id", "x", "y").count() == 0


def test_one_row_for_each_key(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 5), (1, "a", None), (2, None, None)], "k int, x string, y int")
    assert sorted(map(tuple, skew.pick_one(df, "k", "x", "y").collect())) == [(1, "a", 5), (2, None, None)]


def test_adaptive_execution_splits_a_hot_specification(spark):
    """The joins of tasks with specifications are left to adaptive execution: a partition of one key is split."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tasks = spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("s"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        specs = spark.range(997).select(F.col("id").alias("s"), F.sha2(F.col("id").cast("string"), 512).alias("style"))
        joined = tasks.join(specs, "s")
        assert joined.agg(F.count("style")).first()[0] == 60_000
        joined.write.format("noop").mode("overwrite").save()
        done = joined.groupBy("id").count()
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
