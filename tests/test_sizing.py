"""Shuffles sized by the input, joins in the order that shuffles least, one sort for windows of one key."""

from __future__ import annotations

from depotflow.plans.measures import monthly_time_intelligence
from depotflow.session import PARTITION_BYTES, size_for_tables, with_settings
from depotflow.sources.order_tables import OrderTables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_stored_bytes_and_are_never_lowered(spark, tmp_path):
    (tmp_path / "lineitem.parquet").mkdir()
    (tmp_path / "lineitem.parquet" / "part-0").write_bytes(b"x" * (PARTITION_BYTES * 11 + 1))
    (tmp_path / "orders.parquet").write_bytes(b"x" * 5)
    paths = [str(tmp_path / name) for name in ("lineitem.parquet", "orders.parquet", "absent.parquet")]
    with with_settings(spark, {"spark.sql.shuffle.partitions": "8"}):
        assert size_for_tables(spark, paths) == 12
        assert spark.conf.get("spark.sql.shuffle.partitions") == "12"
        assert size_for_tables(spark, paths[1:]) == 12
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_windows_by_month_share_one_sort(spark):
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        sales = OrderTables(spark, FOLDER).fact_sales().select("customer_id", "date", "net_amount").localCheckpoint()
        text = plan(monthly_time_intelligence(sales, ["customer_id"]))
    # One for the gaps, one for the shifts and the mean.
    assert text.count("Sort [") == 2


def test_sales_lines_meet_their_orders_last(spark):
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(OrderTables(spark, FOLDER).fact_sales(customer=True, route=True, product=True))
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 5 and "l_orderkey" in joins[0]
    # The lines are shuffled twice: by part as they are, and by order.
    assert sum("Exchange hashpartitioning(l_orderkey" in line for line in text.splitlines()) == 1
    assert "Exchange hashpartitioning(customer_id" in text.split("l_orderkey", 1)[1]
