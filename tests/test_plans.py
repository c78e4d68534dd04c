"""Shapes of physical plans that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

from stillroom.operators import changes as ch
from stillroom.plans import PLANS, load_all
from stillroom.sources.files import load_parquet

SF_DIR = os.environ.get("STILLROOM_SF_DIR", "/root/testdata/sf0.001")
load_all()

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", sorted(n for n in PLANS if not n.startswith("stream_")))
def test_no_cross_join_and_no_python_rows(spark, name):
    plan = physical(PLANS[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "PythonUDF"):
        assert operator not in plan


@needs_data
def test_range_and_columns_reach_the_scan(spark):
    plan = physical(PLANS["window_extract"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-25T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    plan = physical(PLANS["external_join_group_sum"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in plan


@needs_data
def test_counts_read_no_columns(spark):
    assert "ReadSchema: struct<>" in physical(PLANS["external_parquet_count"](spark, SF_DIR))


@pytest.fixture()
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("hot_key", [7, None])
def test_hot_target_key_is_split(spark, path, small_partitions, hot_key):
    """A third of the target under one key, or without one: its partition is divided over several tasks in every key join."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(hot_key).cast("long")).otherwise(F.col("id"))
    rows = spark.range(0, 30000, numPartitions=8).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    rows.write.parquet(path("t"))
    target = load_parquet(spark, path("t"))
    changed = spark.range(100).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    results = {
        "delete": ch.delete_matching(target, changed.select("k"), [["k", "k"]]),
        "update": ch.update_from(target, changed, [["k", "k"]]),
        "upsert": ch.upsert(target, changed, [["k", "k"]]),
    }
    hit = rows.filter("k < 100").count()
    for name, df in results.items():
        values = df.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == "new").alias("new"))
        counted = df.collect()
        assert "skew=true" in physical(df), name
        n, new = values.first()
        assert n == len(counted)
        if name == "delete":
            assert n == 30000 - hit
        else:
            assert new == hit + (100 - target.filter("k < 100").select("k").distinct().count() if name == "upsert" else 0)
