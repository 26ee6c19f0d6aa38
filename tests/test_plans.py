"""The physical plans: what must be there at scale, and what must not."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from depotflow import registry
from depotflow.operators.dedup import keep_first
from depotflow.operators.joins import with_dimension
from depotflow.operators.latest import on_last_date
from depotflow.session import size_shuffles, tune
from depotflow.sources.order_tables import OrderTables

FOLDER = "/root/testdata/sf0.001"
BUILD = registry.queries()


@contextmanager
def settings(spark, **values):
    for k, v in values.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k in values:
            spark.conf.unset(k.replace("__", "."))
        tune(spark)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(BUILD) - {"export_manifest", "view_row_counts"}))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    text = plan(BUILD[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text


def test_copies_are_dropped_before_the_exchange(spark):
    text = plan(keep_first(spark.range(10).withColumn("v", F.col("id") % 3), ["v"], ["id"]))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "Final" in before and "WindowGroupLimit" in after and "Partial" in after


def test_scan_reads_only_the_needed_columns(spark):
    text = plan(OrderTables(spark, FOLDER).fact_sales().groupBy("year").agg(F.sum("quantity")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "customer.parquet" not in text and "part.parquet" not in text


def test_last_date_filter_reaches_the_scan(spark):
    orders = OrderTables(spark, FOLDER).table("orders")
    text = plan(on_last_date(orders, "o_orderdate"))
    assert "EqualTo(o_orderdate,ScalarSubquery" in text


def test_distinct_counts_fold_without_an_extra_exchange(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(BUILD["measures_sales_by_year_and_mode"](spark, FOLDER))
    # Two exchanges feed the join, one the distinct expansion, one the final totals.
    assert text.count("Exchange hashpartitioning") == 4


def test_correction_triggers_run_once(spark):
    df = BUILD["clean_accounts"](spark, FOLDER)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedSubquery" in final


def test_hot_dimension_key_is_split(spark):
    rows = 400_000
    fact = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
        F.concat(F.lit("payload"), F.col("id").cast("string")).alias("p"),
    )
    dim = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="128k",
    ):
        joined = with_dimension(fact, dim, "k", ["name"])
        out = joined.groupBy("k", "name").agg(F.count(F.lit(1)).alias("n"))
        top = {r.k: r.n for r in out.collect()}
        assert "skew=true" in plan(out).split("== Initial Plan ==")[0]
    assert sum(top.values()) == rows and top[7] > rows // 3


def test_shuffle_sizing(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 << 40) == 819_200
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
