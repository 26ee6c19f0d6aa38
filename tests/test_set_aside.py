"""Numbers that the decimal cannot hold: the job goes on, the row is flagged, nothing counts as missing."""

from __future__ import annotations

import datetime as dt

from depotflow import contracts
from depotflow.plans.accounts_cleaning import clean_accounts
from depotflow.plans.cleaning import numbers_set_aside
from depotflow.plans.inventory_cleaning import clean_inventory
from depotflow.plans.production_cleaning import clean_production
from depotflow.plans.quality import (
    accounts_cleaning_summary,
    inventory_cleaning_summary,
    production_cleaning_summary,
    quality_report,
    sales_cleaning_summary,
)
from depotflow.plans.sales_cleaning import clean_sales

HUGE = "1e40"


def raw(spark, contract, rows):
    """Text rows of a raw table; unnamed columns are null."""
    columns = contract.columns
    return spark.createDataFrame([[r.get(c) for c in columns] for r in rows], ", ".join(f"`{c}` string" for c in columns))


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


SALE = {"date": "2023-05-01", "customer_id": "1", "product_id": "2", "category": "Curd", "unit_price": "2", "quantity": "3", "net_amount": "6"}


def test_sales_keep_the_row(spark):
    rows = [SALE | {"sale_id": "a"}, SALE | {"sale_id": "b", "net_amount": HUGE}, SALE | {"sale_id": "c", "net_amount": "x"}]
    df = raw(spark, contracts.SALES, rows)
    got = by_id(clean_sales(df, ["sale_id"], keep_set_aside=True), "sale_id")
    assert sorted(got) == ["a", "b"]  # c has no amount; b has one
    assert got["b"]["data_quality_flag"] == "NUMBER_SET_ASIDE" and got["a"]["data_quality_flag"] == "OK"
    assert got["b"]["net_amount"] is None and got["b"]["revenue_band"] is None and got["a"]["set_aside"] is None
    assert [tuple(x) for x in got["b"]["set_aside"]] == [("net_amount", HUGE, "too large")]
    assert "set_aside" not in clean_sales(df, ["sale_id"]).columns
    row = sales_cleaning_summary(df, ["sale_id"]).first()
    assert (row["output_rows"], row["dropped_missing_value"], row["total_net_revenue"]) == (2, 1, 6)
    lines = {(r["check_name"], r["column_name"]): r for r in quality_report(df, contracts.SALES).collect()}
    assert lines["set_aside", "net_amount"]["bad_count"] == 1 and not lines["set_aside", "net_amount"]["passed"]
    assert ("set_aside", "quantity") not in lines and lines["numbers", "net_amount"]["bad_count"] == 1
    assert [tuple(r) for r in numbers_set_aside(df, "sale_id", ["quantity", "net_amount"]).collect()] == [("b", "net_amount", HUGE, "too large")]


def test_production_keeps_the_run(spark):
    run = {"date": "2023-05-01", "category": "Curd", "shift": "Morning", "planned_qty": "10", "actual_qty": "9", "wastage_qty": "1"}
    df = raw(spark, contracts.PRODUCTION, [run | {"production_id": "a", "actual_qty": HUGE}, run | {"production_id": "b"}])
    got = by_id(clean_production(df, ["production_id"]), "production_id")
    assert got["a"]["data_quality_flag"] == "NUMBER_SET_ASIDE" and got["a"]["production_efficiency_pct"] is None
    assert got["b"]["data_quality_flag"] != "NUMBER_SET_ASIDE" and got["b"]["production_efficiency_pct"] == 90
    assert production_cleaning_summary(df, ["production_id"]).first()["output_rows"] == 2


def test_stock_stays_unknown_instead_of_zero(spark):
    day = {"date": "2023-05-01", "product_id": "1", "category": "Curd", "opening_stock": "5", "received_qty": "1", "dispatched_qty": "2", "closing_stock": "4", "reorder_level": "1"}
    rows = [day | {"inventory_id": "a", "opening_stock": HUGE, "closing_stock": HUGE}, day | {"inventory_id": "b"}, day | {"inventory_id": "c", "received_qty": None, "closing_stock": "3"}]
    df = raw(spark, contracts.INVENTORY, rows)
    got = by_id(clean_inventory(df, ["inventory_id"], keep_set_aside=True), "inventory_id")
    assert got["a"]["closing_stock"] is None and got["a"]["stock_status"] is None and got["a"]["shelf_life_risk"] is None
    assert {x["column"] for x in got["a"]["set_aside"]} == {"opening_stock", "closing_stock"}
    assert got["b"]["stock_status"] == "OK" and got["c"]["received_qty"] == 0
    assert inventory_cleaning_summary(df, ["inventory_id"]).first()["ok_rows"] == 2


def test_invoices_with_an_unknown_amount_have_no_status(spark):
    bill = {"invoice_date": "2023-05-01", "due_date": "2023-06-01", "customer_id": "1", "invoice_amount": "10", "amount_paid": "10", "outstanding_balance": "0", "payment_date": "2023-05-09"}
    df = raw(spark, contracts.ACCOUNTS, [bill | {"transaction_id": "a", "invoice_amount": HUGE, "outstanding_balance": HUGE}, bill | {"transaction_id": "b"}])
    got = by_id(clean_accounts(df, ["transaction_id"]), "transaction_id")
    assert (got["a"]["payment_status"], got["a"]["aging_bucket"], got["a"]["days_overdue"]) == (None, None, None)
    assert (got["b"]["payment_status"], got["b"]["aging_bucket"]) == ("Paid", "Not OverDue")
    row = accounts_cleaning_summary(df, ["transaction_id"]).first()
    assert (row["output_rows"], row["paid_invoices"], row["total_billed"]) == (2, 1, 10)
    assert dt.date(2023, 5, 1) == got["a"]["invoice_date"]
