"""Time intelligence by key, rule-violation rows, summaries and reports from one run of their input."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest

from depotflow import contracts
from depotflow.operators.timeline import dense, rolling_mean, shifted, to_date_totals
from depotflow.plans.cleaning import Finding, finding_counts, finding_rows, first_of_each, flagged
from depotflow.plans.inventory_cleaning import InventoryRules, inventory_rule_violations
from depotflow.plans.measures import monthly_time_intelligence, revenue_to_date
from depotflow.plans.quality import inventory_cleaning_summary, quality_report, sales_cleaning_summary
from depotflow.plans.sales_cleaning import SalesRules, sales_rule_counts, sales_rule_violations
from depotflow.plans.sales_kpis import monthly_sales
from depotflow.plans.worksheets import revenue_card
from depotflow.registry import queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet \[{table[0]}_", plan))


def sale(day, net, route, category="a"):
    return (dt.date.fromisoformat(day), Decimal(net), route, category)


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        sale("2023-03-30", 10, "x"), sale("2023-04-02", 5, "x"), sale("2023-04-02", 1, "x"), sale("2023-07-01", 4, "x"),
        sale("2024-04-09", 8, "x"), sale("2023-05-05", 7, "y"), sale("2023-01-01", 2, None), sale("2023-03-01", 6, None),
    ]
    return spark.createDataFrame(rows, "date date, net_amount decimal(18,2), route_name string, category string")


def test_months_of_each_key_are_dense_and_matched_by_date(sales):
    out = monthly_time_intelligence(sales, ["route_name"])
    got = {(r["route_name"], r["month_start"].isoformat()[:7]): r for r in out.collect()}
    months = lambda key: sorted(m for k, m in got if k == key)
    assert months("x")[0] == "2023-03" and months("x")[-1] == "2024-04" and len(months("x")) == 14
    assert months("y") == ["2023-05"] and months(None) == ["2023-01", "2023-02", "2023-03"]
    assert got["x", "2023-05"]["revenue"] is None and got["x", "2023-05"]["revenue_previous_month"] == 6
    assert got["x", "2024-04"]["revenue_smly"] == 6 and got["x", "2024-04"]["revenue_previous_month"] is None
    assert float(got["x", "2024-04"]["revenue_yoy_pct"]) == 33.33
    assert float(got["x", "2023-05"]["revenue_3m_rolling_avg"]) == 8  # March 10 and April 6 have a value
    assert got[None, "2023-03"]["revenue_previous_month"] is None and got[None, "2023-03"]["revenue"] == 6


def test_days_of_each_key_run_through_gaps_and_years(sales):
    got = {(r["route_name"], str(r["date_key"])): r for r in revenue_to_date(sales, ["route_name", "category"]).collect()}
    assert got["x", "2023-03-31"]["revenue"] is None and got["x", "2023-03-31"]["revenue_ytd"] == 10
    assert (got["x", "2023-04-02"]["revenue_mtd"], got["x", "2023-04-02"]["revenue_ytd"]) == (6, 6)
    assert (got["x", "2023-07-01"]["revenue_mtd"], got["x", "2024-03-31"]["revenue_ytd"]) == (4, 10)
    assert len([k for k in got if k[0] is None]) == 60


def test_windows_of_keys_are_partitioned_and_share_their_exchange(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "add_months(date'2020-01-01', cast(id % 40 AS int)) AS month_start", "id AS v")
    totals = df.groupBy("k", "month_start").agg(F.sum("v").alias("v"))
    out = rolling_mean(shifted(dense(totals, ["k"], "month_start", "v", "month"), "v", 1, "p", ["k"]), "v", 3, "m", ["k"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2  # folding, then all windows


def test_empty_and_single(spark, sales):
    none = sales.where("false")
    assert monthly_time_intelligence(none, ["route_name"]).collect() == []
    assert revenue_to_date(none, ["route_name"]).collect() == []
    one = dense(sales.where("route_name = 'y'").select("route_name", "date", "net_amount"), ["route_name"], "date", "net_amount", "day")
    assert [tuple(r) for r in one.collect()] == [("y", dt.date(2023, 5, 5), Decimal(7))]
    assert to_date_totals(one.withColumnRenamed("date", "date_key"), "net_amount", "m", "y", ["route_name"]).count() == 1


def test_findings_unfold_in_place(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (2, -3, None), (None, -1, "b")], "id long, v int, t string")
    rules = {
        "negative": Finding(F.col("v") < 0, value=F.col("v"), expected=F.lit(0)),
        "not_a": Finding(F.coalesce(F.col("t") != "a", F.lit(True)), text=F.col("t")),
    }
    out = finding_rows(rows, "id", rules)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(
        [(2, "negative", None, -3.0, 0.0), (2, "not_a", None, None, None), (None, "negative", None, -1.0, 0.0), (None, "not_a", "b", None, None)],
        key=key,
    )
    assert tuple(finding_counts(rows, rules).first()) == (2, 2)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("job", ["sales", "production", "inventory", "accounts"])
def test_violations_equal_counts(spark, job):
    rows = queries()[f"{job}_rule_violations"](spark, SF)
    counts = queries()[f"{job}_rule_counts"](spark, SF).first().asDict()
    found = {r["rule"]: r["count"] for r in rows.groupBy("rule").count().collect()}
    assert {k: v for k, v in counts.items() if v} == found
    if job != "inventory":  # the ledger is stored first
        assert scans(rows, "lineitem" if job in ("sales", "production") else "orders") == 1


def test_violation_values(spark):
    raw = spark.createDataFrame(
        [("s1", "2023-05-01", "Ghee", "Cash", "Retailer", "R", "2", "10", "25", "1", "24")],
        "sale_id string, date string, category string, payment_mode string, customer_type string, route_name string, "
        "quantity string, unit_price string, gross_amount string, discount string, net_amount string",
    )
    rules = SalesRules(routes=frozenset({"R"}))
    assert [tuple(r) for r in sales_rule_violations(raw, rules).collect()] == [
        ("s1", "gross_not_quantity_times_price", None, 25.0, 20.0)
    ]
    assert sum(sales_rule_counts(raw, rules).first()) == 1
    stock = spark.createDataFrame([("i", "2023-05-01", "1", "2", "9", "0", "1")], "inventory_id string, date string, opening_stock string, received_qty string, dispatched_qty string, closing_stock string, reorder_level string")
    got = sorted(tuple(r)[1:] for r in inventory_rule_violations(stock, InventoryRules()).collect())
    assert got == [("closing_not_balanced", None, 0.0, -6.0), ("over_dispatched", None, 9.0, 3.0)]


RAW = [
    ("a", "2023-05-01", "2", "10", 1), ("a", "2023-05-02", "2", "30", 2), ("a", "x", "2", "5", 0), (None, "2023-05-01", "1", "1", 1),
    (None, "2023-05-01", "1", "2", 0), ("b", "2020-01-01", "1", "1", 0), ("c", None, "1", "1", 0), ("d", "2023-06-01", "abc", "1", 0),
    ("e", "2023-06-01", "1", "7", None),
]


def raw_sales(spark, rows=RAW):
    df = spark.createDataFrame(rows, "sale_id string, date string, quantity string, net_amount string, place int")
    more = {c: F.lit("1") for c in ("unit_price", "gross_amount", "discount")}
    return df.withColumns(more | {"customer_id": F.lit(1), "product_id": F.col("place")})


def test_sales_summary_tells_why_rows_go(spark):
    row = sales_cleaning_summary(raw_sales(spark), ["place"]).first()
    assert (row["input_rows"], row["output_rows"], row["dropped_rows"]) == (9, 3, 6)
    assert [row[f"dropped_{r}"] for r in ("bad_date", "outside_dates", "missing_value", "duplicate")] == [2, 1, 1, 2]
    # First copies: a of place 1, the null id of place 0, e.
    assert (row["total_net_revenue"], row["unique_customers"], row["unique_products"]) == (10 + 2 + 7, 1, 2)
    assert (str(row["first_date"]), str(row["last_date"])) == ("2023-05-01", "2023-06-01")


def test_numbers_outside_the_window_are_not_parsed(spark):
    raw = raw_sales(spark, [("a", "2020-01-01", "1e40", "1", 0), ("b", "2023-05-01", "1", "1", 0)])
    assert sales_cleaning_summary(raw, ["place"]).first()["output_rows"] == 1


def test_fold_keeps_the_first_usable_copy(spark):
    rows = flagged(raw_sales(spark), ["quantity", "net_amount"], ["date"], "date", dt.date(2023, 4, 1), dt.date(2025, 3, 31), ["quantity"])
    out = first_of_each(rows, "sale_id", ["place"], ["net_amount"], {"big": F.col("net_amount") > 20})
    got = {r["sale_id"]: r for r in out.collect()}
    assert (got["a"]["net_amount"], got["a"]["kept"], got["a"]["dropped_duplicate"], got["a"]["dropped_bad_date"]) == (10, 1, 1, 1)
    assert got["a"]["big"] and not got[None]["big"]  # any copy, not the first alone
    assert (got["b"]["kept"], got["b"]["net_amount"], got["b"]["dropped_outside_dates"]) == (0, None, 1)


def test_stock_summary_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "inventory_id string, date string, product_id string, category string, opening_stock string, received_qty string, dispatched_qty string, closing_stock string, reorder_level string")
    row = inventory_cleaning_summary(empty, ["date"]).first()
    assert (row["input_rows"], row["output_rows"], row["dropped_rows"], row["stockout_rows"]) == (0, 0, 0, 0)


@pytest.mark.parametrize("name", ["clean_sales_summary", "clean_production_summary", "quality_sales_one_pass"])
def test_one_scan(spark, name):
    assert scans(queries()[name](spark, SF), "lineitem") == 1


def test_one_pass_report_counts_copies_as_two_do(spark):
    rows = [("a", "1"), ("a", "-2"), (None, "x"), (None, None), ("b", "3")]
    df = spark.createDataFrame(rows, "sale_id string, quantity string")
    two, one = (quality_report(df, contracts.SALES, one_pass=p).collect() for p in (False, True))
    assert sorted(map(str, two)) == sorted(map(str, one))
    assert next(r for r in one if r["check_name"] == "duplicates")["bad_count"] == 2


def test_revenue_card_runs_its_input_once(spark):
    card = queries()["card_total_revenue"](spark, SF)
    assert scans(card, "lineitem") == 1 and scans(card, "orders") == 1


def test_revenue_card_against_the_month_mart(spark):
    schema = "year int, month int, month_name string, quarter string, financial_year string, customer_id long, " \
        "invoice_number long, quantity int, gross_amount decimal(20,4), discount decimal(20,4), net_amount decimal(20,4)"
    may, june = (2024, 5, "May", "Q1", "2024-25"), (2024, 6, "June", "Q1", "2024-25")
    rows = [(*may, 1, 10, "1.005"), (*may, 1, 10, "2.001"), (*may, 2, 11, "0.001"), (*june, 1, 10, "3.339"), (*june, None, None, "4")]
    rows = [(*r[:7], 1, Decimal(r[7]), Decimal(0), Decimal(r[7])) for r in rows]
    sales = spark.createDataFrame(rows, schema)
    monthly = monthly_sales(sales).toPandas()
    assert revenue_card(sales).first().asDict() == {
        "total_revenue": monthly["net_revenue"].sum(), "max_unique_customers": 2, "total_invoices": 2,
    }
    assert tuple(revenue_card(sales.limit(0)).first()) == (None, None, 0)
