"""Join helper: broadcast behind proof, salted fallback without AQE skew splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.joins import join_small, skew_splitting_on
from starloom.session import Staged


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_salted_join_equals_plain_join_for_inner_and_left(spark):
    # A third of the rows share one key; one key has no partner.
    big = spark.range(0, 3000).select(
        F.col("id").alias("_row_ord"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"))
    small = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(1, 50)],
                                  "key string, v int")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert not skew_splitting_on(spark)
        for how in ("inner", "left"):
            salted = join_small(big, Staged(small, 10**9, 10**12), "key", how,
                                salt_by=["_row_ord"])
            assert "_salt" in salted._jdf.queryExecution().executedPlan().toString()
            assert _rows(salted) == _rows(big.join(small, "key", how)), how
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_small_side_is_broadcast_only_when_proven(spark):
    big = spark.range(100).select(F.col("id").alias("k"))
    small = spark.range(10).select(F.col("id").alias("k"))
    plan = join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
