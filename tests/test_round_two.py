"""Numbers of any size, single rounding, gap months, pruned scans, lazy tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depotflow import contracts, registry, session
from depotflow.functions.numeric import percent, to_number
from depotflow.operators.slicers import slice_rows
from depotflow.plans.accounts_cleaning import clean_accounts
from depotflow.plans.inventory_cleaning import clean_inventory
from depotflow.plans.inventory_kpis import monthly_turnover
from depotflow.plans.measures import monthly_time_intelligence
from depotflow.plans.production_cleaning import clean_production
from depotflow.plans.quality import quality_report, quality_summary
from depotflow.plans.sales_cleaning import clean_sales
from depotflow.plans.sales_kpis import year_over_year
from depotflow.sources.order_tables import OrderTables

FOLDER = "/root/testdata/sf0.001"
LARGE = ["100000000000000", "200000000000000", "100000000000000000000", "0.00001"]


def text_rows(spark, contract, rows):
    full = [{c: None for c in contract.columns} | r for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in contract.columns) for r in full], contract.raw_schema())


def test_large_and_small_sales_stay(spark):
    rows = [
        {"sale_id": str(i), "date": "2024-01-01", "quantity": "1", "unit_price": v, "net_amount": v, "category": "Ghee"}
        for i, v in enumerate(LARGE)
    ]
    got = {r.sale_id: r for r in clean_sales(text_rows(spark, contracts.SALES, rows), ["sale_id"]).collect()}
    assert [float(got[str(i)].net_amount) for i in range(4)] == [float(v) for v in LARGE]
    assert {r.data_quality_flag for r in got.values()} == {"OK"}


def test_large_stock_is_no_stockout(spark):
    rows = [
        {"inventory_id": str(i), "date": "2024-01-01", "product_id": "p", "opening_stock": v, "closing_stock": v}
        for i, v in enumerate(LARGE)
    ]
    got = {r.inventory_id: r for r in clean_inventory(text_rows(spark, contracts.INVENTORY, rows), ["inventory_id"]).collect()}
    assert [float(got[str(i)].closing_stock) for i in range(4)] == [float(v) for v in LARGE]
    assert all(r.stock_status != "Stockout" for r in got.values())


def test_large_production_and_invoices_stay(spark):
    runs = [
        {"production_id": str(i), "date": "2024-01-01", "category": "Ghee", "planned_qty": v, "actual_qty": v, "wastage_qty": "0"}
        for i, v in enumerate(LARGE)
    ]
    got = clean_production(text_rows(spark, contracts.PRODUCTION, runs), ["production_id"]).collect()
    assert sorted(float(r.actual_qty) for r in got) == sorted(map(float, LARGE))
    bills = [{"transaction_id": str(i), "invoice_date": "2024-01-01", "invoice_amount": v, "amount_paid": "0", "outstanding_balance": v} for i, v in enumerate(LARGE)]
    got = clean_accounts(text_rows(spark, contracts.ACCOUNTS, bills), ["transaction_id"]).collect()
    assert sorted(float(r.outstanding_balance) for r in got) == sorted(map(float, LARGE))


def test_a_number_beyond_the_decimal_is_an_error_not_a_gap(spark):
    df = spark.createDataFrame([("1e40",)], "x string")
    with pytest.raises(Exception, match="out of range"):
        df.select(to_number(F.col("x"))).collect()
    odd = spark.createDataFrame([("NaN",), ("abc",), (None,), ("-5",)], "x string")
    assert [r[0] for r in odd.select(to_number(F.col("x"))).collect()][:3] == [None, None, None]


def test_rounding_happens_once(spark):
    one = spark.createDataFrame([(12344999996, 10**11)], "a long, b long")
    assert float(one.select(percent(F.col("a"), F.col("b"))).first()[0]) == 12.34


def test_turnover_of_fractional_stock(spark):
    rows = [(2024, 1, "January", "p", "P", "Ghee", 1.4, 1.4, 1.0)] * 2
    stock = spark.createDataFrame(rows, "year int, month int, month_name string, product_id string, product_name string, category string, opening_stock double, closing_stock double, dispatched_qty double")
    got = monthly_turnover(stock).first()
    assert float(got.avg_inventory) == 1.40 and float(got.turnover_ratio_exact) == 1.43


def test_months_without_sales_are_rows(spark):
    rows = [(dt.date(2023, 5, 3), 10), (dt.date(2024, 4, 1), 4), (dt.date(2024, 6, 1), 6)]
    got = {str(r.month_start): r for r in monthly_time_intelligence(spark.createDataFrame(rows, "date date, net_amount int")).collect()}
    assert len(got) == 14
    gap = got["2024-05-01"]
    assert gap.revenue is None and gap.revenue_smly == 10 and float(gap.revenue_3m_rolling_avg) == 4.0
    assert float(got["2024-06-01"].revenue_3m_rolling_avg) == 5.0 and got["2024-06-01"].revenue_mom_pct is None


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]


def test_financial_years_reach_the_scan(spark):
    sales = OrderTables(spark, FOLDER).fact_sales()
    for df in (
        year_over_year(sales, "FY1996-97", "FY1997-98"),
        slice_rows(sales, financial_year=["FY1996-97"]).groupBy("month").count(),
    ):
        assert any("GreaterThan" in line and "LessThan" in line for line in pushed(df)), pushed(df)


def test_building_a_table_starts_no_job(spark):
    tracker, group = spark.sparkContext.statusTracker(), "no-job"
    spark.sparkContext.setJobGroup(group, group)
    try:
        OrderTables(spark, FOLDER).fact_inventory()
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_triggers_read_orders_without_customers(spark):
    plan = OrderTables(spark, FOLDER).fact_accounts()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("c_custkey") and sum("Relation" in line and "c_custkey" in line for line in plan.splitlines()) == 1


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_absent_tables_and_date_formats(spark):
    kinds = {"id": "text", "day": "date", "amount": "number"}
    df = spark.createDataFrame([("a", "31-12-2024", "1e30"), ("b", "nope", "x")], "id string, day string, amount string")
    plain = contracts.TableContract("t", kinds, frozenset(), 1)
    dated = contracts.TableContract("t", kinds, frozenset(), 1, ("dd-MM-yyyy",))
    bad = lambda c: {(r.check_name, r.column_name): r.bad_count for r in quality_report(df, c).collect()}
    assert bad(plain)["dates", "day"] == 2 and bad(dated)["dates", "day"] == 1 and bad(dated)["numbers", "amount"] == 1
    got = {r.table_name: r for r in quality_summary({"t": quality_report(df, plain), "gone": None}).collect()}
    assert got["t"].ingested and not got["gone"].ingested and got["gone"].checks == 0


def test_twins_import_no_rules():
    import inspect

    from depotflow.registry import sqltext

    assert "import" not in inspect.getsource(sqltext).replace("from __future__ import annotations", "")
    assert len(registry.oracle_sql()) == len(registry.queries())
