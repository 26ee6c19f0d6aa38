"""What a run that stores and exports many tables leaves on disk, and what it shuffles."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from depotflow.operators.dedup import keep_first
from depotflow.operators.rollup import rollup
from depotflow.plans import accounts_kpis, sales_kpis
from depotflow.plans.sales_cleaning import clean_sales
from depotflow.plans.warehouse import marts, store_star
from depotflow.registry.kpis import FY_BASE, FY_CURRENT, YEARS
from depotflow.registry.warehouse import star_tables, stored_star
from depotflow.session import with_settings
from depotflow.sources import files
from depotflow.sources.order_tables import SALES_RULES, OrderTables

FOLDER = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def counted(spark, rows=5000):
    return spark.range(rows).selectExpr("id % 7 AS k", "id % 90 AS v").groupBy("k").agg(F.sum("v").alias("v"))


def test_writes_and_exports_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    counted(spark).collect()
    assert len(shuffle_files(spark) - before) > 0  # as any other run leaves them
    before = shuffle_files(spark)
    assert files.write_table(counted(spark), str(tmp_path / "t"), None) == 7
    exports = {name: lambda: counted(spark) for name in "abcdef"}
    out = files.export_all(spark, exports, str(tmp_path / "e"), workers=3)
    deadline = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < deadline:  # removed in the background
        time.sleep(0.2)
    assert not left
    assert {r.status for r in out.collect()} == {"exported"}
    assert sorted(counted(spark).collect()) == sorted(files.read_table(spark, str(tmp_path / "t")).collect())


def test_settings_come_back(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    files.write_table(counted(spark), str(tmp_path / "t"), None)
    files.export_all(spark, {"bad": lambda: spark.table("no_such"), "a": lambda: counted(spark)}, str(tmp_path / "e"))
    assert spark.conf.get(key) == before


ROWS = [("x", 1, 10, "1.5"), ("x", 1, 11, "2.5"), ("x", 2, None, "4"), (None, None, 10, "8"), (None, 1, 10, None), ("y", None, None, "-1")]


@pytest.mark.parametrize("keys", [["k"], ["k", "a"], []])
def test_ids_counted_apart_give_the_same(spark, keys):
    df = spark.createDataFrame(ROWS, "k string, a int, b int, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))
    measures = {"n": ("rows",), "as": ("distinct", "a"), "t": ("sum", "v"), "bs": ("distinct", "b"), "m": ("avg", "v")}
    only = {"bs": ("distinct", "b")}
    for wanted in (measures, only):
        one, other = (rollup(df, keys, wanted, apart=apart) for apart in (False, True))
        assert one.columns == other.columns == [*keys, *wanted]
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def exchanged(df) -> list[str]:
    """The columns of every exchange of the plan."""
    text = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = text.split(") Exchange\n")[1:]
    return [p.split("\n", 1)[0] for p in parts]


def test_amounts_do_not_travel_with_ids(spark, tmp_path):
    t = OrderTables(spark, FOLDER)
    files.write_table(t.fact_sales(), str(tmp_path / "s"))
    files.write_table(t.fact_accounts(), str(tmp_path / "a"))
    sales, accounts = (files.read_table(spark, str(tmp_path / n)) for n in "sa")
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for view, id_ in (
            (sales_kpis.monthly_sales(sales, stored=True), "invoice_number"),
            (accounts_kpis.billing_collections(accounts, stored=True), "customer_id"),
            (accounts_kpis.receivables_aging(accounts, stored=True), "customer_id"),
            (accounts_kpis.customer_type_efficiency(accounts, stored=True), "customer_id"),
        ):
            with_ids = [columns for columns in exchanged(view) if id_ in columns]
            assert len(with_ids) == 1 and "sum" not in with_ids[0]


def test_lines_are_shuffled_narrow(spark):
    t = OrderTables(spark, FOLDER)
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not [columns for columns in exchanged(t.production_runs()) if "qty#" in columns]
        orders = [c for c in exchanged(t.fact_sales(customer=True, product=True)) if "payment_mode" in c]
    assert orders and not [c for c in orders if "month" in c or "quarter" in c or "financial_year" in c]


def test_stored_files_are_zstd(spark, tmp_path):
    files.write_table(counted(spark), str(tmp_path / "t"), None)
    assert list((tmp_path / "t").glob("v-*/part-*.zstd.parquet"))


def test_cleaned_rows_are_stored_without_another_exchange(spark):
    t = OrderTables(spark, FOLDER)
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        sales = clean_sales(t.raw_sales(), t.RAW_SALES_ORDER, SALES_RULES, within=["invoice_number"])
        for fact, id_ in ((sales, "sale_id#"), (t.fact_accounts(within=["customer_id"]), "transaction_id#")):
            assert exchanged(fact) and not [columns for columns in exchanged(fact) if id_ in columns]


def test_the_stored_star_is_the_star(spark, tmp_path):
    t = OrderTables(spark, FOLDER)
    star, plain = stored_star(t, str(tmp_path)), star_tables(t)
    assert list(star) == list(plain)
    for name, df in plain.items():
        assert sorted(star[name].columns) == sorted(df.columns)
        got, want = (sorted(map(str, d.select(*df.columns).collect())) for d in (star[name], df))
        assert got == want, name
    plain_views, views = (marts(star, FY_BASE, FY_CURRENT, YEARS, stored) for stored in (False, True))
    for name in ("vw_sales_monthly", "vw_billing_collections", "vw_receivables_aging", "vw_custtype_efficiency"):
        got, want = views[name](), plain_views[name]()
        assert got.columns == want.columns and got.collect() == want.collect(), name


@pytest.mark.parametrize("apart", [False, True])
def test_copies_that_lie_apart_are_settled(spark, tmp_path, apart):
    rows = [("a", 1, 5), ("a", 1, 4), ("b", 1, 9), ("c", 2, 7), ("c", 2, 7), (None, 3, 3)]
    rows += [("a", 2, 3), ("b", 3, 10), (None, 1, 2), ("d", 2, 1)] if apart else []
    df = spark.createDataFrame(rows, "id string, place int, v int").withColumn("financial_year", F.lit("FY"))
    within = keep_first(df, ["place", "id"], ["v"])
    stored, report = store_star(spark, {"t": within}, str(tmp_path), {"t": ("id", ["v"])})
    want = keep_first(df, ["id"], ["v"])
    got = stored["t"].select(*df.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert report.first().verified and report.first().expected_rows == (5 if apart else 4)
    assert len(list((tmp_path / "t").glob("v-*"))) == (2 if apart else 1)
