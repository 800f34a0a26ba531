"""A hot key: AQE splits it in every branch that holds it, whatever the key's type."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from fieldbook.operators.joins import anti_join, full_outer_join
from fieldbook.operators.linkage import link_members

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def session_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split(spark):
    # a third of the left rows share key 0
    left = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("lk"), F.col("id").alias("lv"))
    right = spark.range(20000).select((F.col("id") * 2).alias("rk"), F.col("id").alias("rv"))
    with session_conf(spark, SKEW_CONF):
        ours = full_outer_join(left, right, "lk", "rk")
        plain = left.join(right, F.col("lk") == F.col("rk"), "full")
        ours_plan, plain_plan = _final_plan(ours), _final_plan(plain)
        assert sorted(ours.collect(), key=str) == sorted(plain.collect(), key=str)
    assert "SortMergeJoin(skew=true)" in ours_plan
    assert "SortMergeJoin(skew=true)" not in plain_plan


def _sides(spark, kind):
    # a third of the left rows share key 0
    left = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast(kind).alias("lk"), F.col("id").alias("lv"))
    right = spark.range(20000).select((F.col("id") * 2 + 1).cast(kind).alias("rk"), F.col("id").alias("rv"))
    return left, right


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_an_anti_join_splits_a_hot_key(spark, kind, null_safe):
    left, right = _sides(spark, kind)
    with session_conf(spark, SKEW_CONF):
        ours = anti_join(left, right, "lk", "rk", null_safe)
        plan = _final_plan(ours)
        assert ours.count() == left.join(right, F.col("lk") == F.col("rk"), "left_anti").count()
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_each_branch_with_the_hot_key_is_split(spark, kind):
    left, right = _sides(spark, kind)
    right = right.unionByName(spark.sql(f"SELECT CAST(0 AS {kind}) AS rk, -1L AS rv"))
    with session_conf(spark, SKEW_CONF):
        plan = _final_plan(full_outer_join(left, right, "lk", "rk"))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("SortMergeJoin(skew=true)") >= 2  # the inner join and the left side's anti join


def test_the_shared_phone_rule_splits_a_hot_phone(spark):
    roster = spark.range(6000).selectExpr(
        "CAST(id AS STRING) AS roster_no", "CAST(if(id % 3 = 0, 7, 100 + id) AS DOUBLE) AS phone_number",
        "'n' || if(id % 3 = 0, 0, id) AS roster_name", "'active' AS final_status")
    contact = spark.range(3000).selectExpr(
        "'u' || id AS uuid", "CAST(id AS STRING) AS submission_no", "'n' || id AS contact_name",
        "CAST(100 + id AS STRING) AS phone_text", "'' AS data_status", "'yes' AS located")
    with session_conf(spark, SKEW_CONF):
        plan = _final_plan(link_members(roster, contact))
    assert "SortMergeJoin(skew=true)" in plan.split("== Initial Plan ==")[0]
