"""Plans have to stay what they were written for."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from casebook import queries as Q
from tidegate.operators import merge
from tidegate.plans import warehouse
from tidegate.session import written
from tidegate.sources.extract import incremental_extract

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    df.collect()
    return plan_of(df)


@pytest.fixture
def conf(spark):
    before = {}

    def change(**values):
        for key, value in values.items():
            name = f"spark.sql.{key.replace('__', '.')}"
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["step_elapsed", "span_totals", "keep_history", "rpo_check"])
def test_windows_are_partitioned(spark, name):
    plan = plan_of(Q.QUERIES[name](spark, FOLDER))
    assert "Window" in plan and "Exchange SinglePartition" not in plan


def test_cutoff_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    plan = plan_of(incremental_extract(orders, Q.EXTRACT_CTX, "o_orderdate").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,1998-11-27T12:00" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_small_load_does_not_shuffle_the_target(spark):
    target = written(Q._target(spark, FOLDER), "target")
    work = written(Q._checked(spark, FOLDER), "checked")
    plan = plan_of(merge.update_from(target, work, Q.ORDERS, Q.CTX))
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan


def test_checked_rows_are_not_shuffled(spark):
    plan = plan_of(Q._checked(spark, FOLDER))
    assert "Exchange hash" not in plan and plan.count("FileScan") <= 3


def test_hot_target_key_is_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__advisoryPartitionSizeInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    work = written(Q._checked(spark, FOLDER), "checked")
    base = Q._target(spark, FOLDER)
    hot = spark.range(0, 40_000, 1, 8).select(F.lit(1).cast("bigint").alias("o_orderkey"), F.uuid().alias("note"))
    target = written(base.unionByName(hot, allowMissingColumns=True), "hot")
    merged = merge.update_from(target, work, Q.ORDERS, Q.CTX)
    plan = final_plan_of(merged)
    assert "skew=true" in plan
    assert merged.count() == target.count()


def test_mart_sums_facts_first(spark):
    plan = plan_of(Q.QUERIES["build_mart"](spark, FOLDER))
    join = plan.index("HashJoin [__key")
    assert "HashAggregate(keys=[o_custkey" in plan[join:].replace("__key", "o_custkey")


def test_row_filter_is_a_semi_join(spark):
    rows = spark.read.parquet(f"{FOLDER}/customer.parquet")
    allowed = spark.createDataFrame([("p", 1), ("p", 1), ("q", 2)], "principal string, c_nationkey int")
    found = warehouse.row_level_filter(rows, allowed, "p", ["c_nationkey"])
    assert "LeftSemi" in plan_of(found)
    assert found.count() == rows.where("c_nationkey = 1").count()


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() > 0 and set(rows.columns) == set(Q._target(spark, FOLDER).columns)
    assert set(oracle_sql()) <= set(queries())
