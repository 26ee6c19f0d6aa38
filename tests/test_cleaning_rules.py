"""One literal row per cleaning rule."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotflow.functions.calendar import financial_year
from depotflow.functions.numeric import floor_at_zero, right_closed_bin
from depotflow.functions.text import strip, title_case
from depotflow.plans.accounts_cleaning import clean_accounts, reconciled
from depotflow.plans.inventory_cleaning import balanced, clean_inventory
from depotflow.plans.production_cleaning import (
    BAND_EDGES as EFFICIENCY_EDGES,
    BAND_LABELS as EFFICIENCY_LABELS,
    clean_production,
)
from depotflow.plans.sales_cleaning import BAND_EDGES, BAND_LABELS, clean_sales, sales_rule_counts


def one(spark, column, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column(F.col("v")).alias("out")).first().out


SALE = dict(
    sale_id="S1", date="2024-05-10", year="2024", month="5", month_name="May", quarter="Q2",
    customer_id="C1", customer_name="Name", customer_type="Retailer", route_id="R01",
    route_name="Sector-7 Route", product_id="P01", product_name="Milk", category="Milk Bulk",
    unit="Litre", quantity="10", unit_price="60", gross_amount="600", discount="0",
    net_amount="600", payment_mode="Cash", invoice_number="I1",
)


def sales(spark, *changes):
    rows = [dict(SALE, sale_id=f"S{i}", **c) if "sale_id" not in c else dict(SALE, **c)
            for i, c in enumerate(changes)]
    schema = ", ".join(f"{k} string" for k in SALE) + ", pos int"
    return spark.createDataFrame([tuple(r.values()) + (i,) for i, r in enumerate(rows)], schema)


def cleaned_sales(spark, *changes):
    out = clean_sales(sales(spark, *changes), ["pos"]).orderBy("pos").collect()
    return {r.pos: r for r in out}


@pytest.mark.parametrize(
    "text, want",
    [
        ("\t hotel/restaurant ", "Hotel/Restaurant"),
        ("sector-7 route", "Sector-7 Route"),
        ("MILK  bulk", "Milk  Bulk"),
        ("they're", "They'Re"),
        ("  curd\n", "Curd"),
        (None, None),
    ],
)
def test_strip_and_title_case(spark, text, want):
    assert one(spark, lambda c: title_case(strip(c)), text) == want


@pytest.mark.parametrize(
    "day, label",
    [("2024-03-31", "FY2023-24"), ("2024-04-01", "FY2024-25"), ("1999-04-01", "FY1999-00"),
     ("2024-05-31", "FY2024-25"), ("2024-01-31", "FY2023-24")],
)
def test_financial_year(spark, day, label):
    assert one(spark, lambda c: financial_year(c.cast("date")), day) == label


@pytest.mark.parametrize(
    "net, label",
    [("0", None), ("-1", None), ("500", "<500"), ("500.01", "500-2K"), ("10000", "5K-10K"),
     ("10000.01", "10K+"), (None, None)],
)
def test_revenue_band(spark, net, label):
    got = one(spark, lambda c: right_closed_bin(c.cast("decimal(18,2)"), BAND_EDGES, BAND_LABELS), net)
    assert got == label


@pytest.mark.parametrize(
    "value, label",
    [("0", None), ("85", "Critical (<85%)"), ("110", "Excellent (>100%)"), ("110.01", None)],
)
def test_efficiency_band(spark, value, label):
    got = one(
        spark,
        lambda c: right_closed_bin(c.cast("decimal(18,2)"), EFFICIENCY_EDGES, EFFICIENCY_LABELS),
        value,
    )
    assert got == label


def test_floor_keeps_nulls(spark):
    assert one(spark, lambda c: floor_at_zero(c.cast("decimal(18,4)")), "-5") == 0
    assert one(spark, lambda c: floor_at_zero(c.cast("decimal(18,4)")), None) is None


def test_sales_dates(spark):
    got = cleaned_sales(
        spark, {"date": "not-a-date"}, {"date": "2023-03-31"}, {"date": "2023-04-01"},
        {"date": "2025-03-31"}, {"date": "2025-03-31 10:00"}, {"date": None},
    )
    assert sorted(got) == [2, 3]
    assert got[2].date == dt.date(2023, 4, 1)


def test_sales_numbers_and_flags(spark):
    got = cleaned_sales(
        spark,
        {"quantity": "abc"},
        {"discount": "abc"},
        {"category": None},
        {"category": "Cheese"},
        {"discount": "-1", "category": "Cheese"},
        {"net_amount": "0", "quantity": "-1"},
        {"quantity": "-2", "unit_price": "-3"},
        {"payment_mode": "Barter"},
        {"category": " milk PACKET "},
    )
    assert 0 not in got
    assert got[1].discount is None and got[1].data_quality_flag == "OK"
    assert [got[i].data_quality_flag for i in (2, 3, 4, 5, 6, 7, 8)] == [
        "INVALID_CATEGORY", "INVALID_CATEGORY", "NEGATIVE_DISCOUNT", "ZERO_OR_NEGATIVE_NET",
        "NEGATIVE_UNIT_PRICE", "OK", "OK",
    ]
    assert got[8].category == "Milk Packet" and got[8].day_of_week == "Friday"


def test_sales_keep_first_copy(spark):
    got = cleaned_sales(
        spark, {"sale_id": "A", "net_amount": "5"}, {"sale_id": "A", "net_amount": "7"},
        {"sale_id": None, "net_amount": "1"}, {"sale_id": None, "net_amount": "2"},
    )
    assert [r.net_amount for r in got.values()] == [5, 1]


def test_sales_rule_counts(spark):
    counts = sales_rule_counts(
        sales(spark, {}, {"gross_amount": "500"}, {"net_amount": "590"}, {"discount": "200", "net_amount": "400"},
              {"unit_price": "0"}, {"route_name": "nowhere"})
    ).first()
    assert counts.gross_not_quantity_times_price == 1
    assert counts.net_not_gross_less_discount == 2
    assert counts.discount_above_20_percent == 1
    assert counts.invalid_route == 1 and counts.invalid_category == 0


RUN = dict(
    production_id="B1", date="2024-05-10", category="ghee", planned_qty="100", actual_qty="95",
    wastage_qty="1", net_produced_qty="0", raw_milk_used_L="200",
)


def runs(spark, *changes):
    rows = [dict(RUN, production_id=f"B{i}", **c) for i, c in enumerate(changes)]
    df = spark.createDataFrame(
        [tuple(r.values()) + (i,) for i, r in enumerate(rows)],
        ", ".join(f"{k} string" for k in RUN) + ", pos int",
    )
    return df.withColumns(
        {"production_efficiency_%": F.lit("9"), "wastage_rate_%": F.lit("9"), "shift": F.lit(" morning")}
    )


def test_production_rules(spark):
    df = runs(
        spark,
        {"actual_qty": "10", "wastage_qty": "12"},
        {"planned_qty": "0"},
        {"planned_qty": "-5", "wastage_qty": None},
        {"actual_qty": "120", "wastage_qty": "13.2"},
        {"actual_qty": "120"},
        {"actual_qty": "none"},
        {"category": "Cheese"},
    )
    got = {r.pos: r for r in clean_production(df, ["pos"]).collect()}
    assert (got[0].wastage_qty, got[0].net_produced_qty) == (0, 10)
    assert got[1].production_efficiency_pct is None
    assert got[2].planned_qty == 0 and got[2].wastage_qty is None and got[2].net_produced_qty is None
    assert got[3].data_quality_flag == "HIGH_WASTAGE" and got[3].efficiency_band is None
    assert got[4].data_quality_flag == "OVER_PRODUCTION"
    assert 5 not in got
    assert got[6].data_quality_flag == "OK" and got[6].shift == "Morning"


STOCK = ("inventory_id string, date string, product_id string, category string, opening_stock string, "
         "received_qty string, dispatched_qty string, closing_stock string, reorder_level string")


def stock(spark, *rows):
    full = [(f"I{i}", "2024-05-10", f"P{i}", "Ghee", *map(str, r)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, STOCK)


def closing(spark, rows, scope="dataset"):
    df = stock(spark, *rows)
    df = df.select("inventory_id", *[F.col(c).cast("decimal(18,4)").alias(c) for c in
                   ("opening_stock", "received_qty", "dispatched_qty", "closing_stock", "reorder_level")])
    return [int(r.closing_stock) for r in balanced(df, scope).orderBy("inventory_id").collect()]


def test_balance_is_corrected_for_all_rows_or_none(spark):
    small = [(10, 0, 0, 10, 5), (10, 0, 0, 11, 5)]
    assert closing(spark, small) == [10, 11]
    assert closing(spark, [*small, (10, 0, 0, 12, 5)]) == [10, 10, 10]
    assert closing(spark, [*small, (10, 0, 0, 12, 5)], scope="row") == [10, 11, 10]


def test_over_dispatch_is_capped(spark):
    row = clean_inventory(stock(spark, (5, 5, 12, 0, 100)), ["date"]).first()
    assert (row.dispatched_qty, row.closing_stock, row.stock_status) == (10, 0, "Stockout")


def test_stock_status_ladder(spark):
    rows = [(c, 0, 0, c, 100) for c in (0, 50, 51, 99, 100)]
    got = clean_inventory(stock(spark, *rows), ["date"]).orderBy("inventory_id").collect()
    assert [r.stock_status for r in got] == ["Stockout", "Critical", "Low", "Low", "OK"]


def test_missing_and_negative_stock_counts_as_zero(spark):
    row = clean_inventory(stock(spark, ("x", -3, 0, 0, "")), ["date"]).first()
    assert (row.opening_stock, row.received_qty, row.reorder_level) == (0, 0, 0)


def test_days_of_stock_and_shelf_life(spark):
    df = stock(spark, (10, 0, 0, 10, 5), (1000, 0, 2, 998, 5)).withColumn(
        "category", F.when(F.col("product_id") == "P0", "Unknown").otherwise("Ghee")
    )
    got = {r.product_id: r for r in clean_inventory(df, ["date"]).collect()}
    assert got["P0"].days_of_stock == 10 and got["P0"].shelf_life_risk == "Safe"
    assert got["P0"].shelf_life_days is None
    assert got["P1"].days_of_stock == 499 and got["P1"].shelf_life_risk == "At Risk"


ACC = ("transaction_id string, invoice_date string, due_date string, payment_date string, "
       "invoice_amount string, amount_paid string, outstanding_balance string, credit_days string")


def accounts(spark, *rows):
    full = [(f"T{i}", "2024-05-10", *r, "15") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ACC)


def test_payment_status(spark):
    df = accounts(
        spark,
        ("2024-05-25", "2024-05-25", "100", "100", "0"),
        ("2024-05-25", "2024-05-26", "100", "100", "0"),
        (None, "2024-05-26", "100", "100", "0"),
        ("2024-05-25", None, "100", "100", "0"),
        ("2024-05-25", None, "100", "40", "60"),
    )
    got = clean_accounts(df, ["transaction_id"]).orderBy("transaction_id").collect()
    assert [r.payment_status for r in got] == ["Paid", "Paid Late", "Paid Late", "Paid", "OverDue"]
    assert got[1].days_to_payment == 16 and got[3].days_to_payment is None
    assert got[4].collection_efficiency_pct == 40


def test_overpayment_is_capped(spark):
    row = clean_accounts(
        accounts(spark, ("2024-05-25", "2024-05-20", "100", "120", "0")), ["transaction_id"]
    ).first()
    assert (row.amount_paid, row.outstanding_balance, row.collection_efficiency_pct) == (100, 0, 100)


def test_balance_trigger_rewrites_rows_within_tolerance(spark):
    df = accounts(spark, ("2024-05-25", None, "100", "0", "100.5"), ("2024-05-25", None, "100", "0", "90"))
    df = df.withColumns({c: F.col(c).cast("decimal(18,4)") for c in
                         ("invoice_amount", "amount_paid", "outstanding_balance")})

    def open_(scope):
        rows = reconciled(df, scope).orderBy("transaction_id").collect()
        return [r.outstanding_balance for r in rows]

    assert open_("dataset") == [100, 100]
    assert open_("row") == [Decimal("100.5"), 100]


def test_aging_buckets(spark):
    analysis = dt.date(2025, 3, 31)
    ages = [-5, 0, 30, 31, 60, 61, 90, 91, None]
    rows = [
        (None if a is None else str(analysis - dt.timedelta(days=a)), None, "100", "0", "100") for a in ages
    ]
    got = clean_accounts(accounts(spark, *rows), ["transaction_id"]).orderBy("transaction_id").collect()
    assert [r.days_overdue for r in got] == [0, 0, 30, 31, 60, 61, 90, 91, None]
    assert [r.aging_bucket for r in got] == [
        "1-30 Days", "1-30 Days", "1-30 Days", "31-60 Days", "31-60 Days", "61-90 Days",
        "61-90 Days", "90+ Days", "90+ Days",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_day_counts_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = accounts(
            spark,
            ("2025-03-01", None, "100", "0", "100"),
            ("2025-03-01 10:00", None, "100", "0", "100"),
            ("2024-05-20", "2024-12-01 23:00", "100", "100", "0"),
        )
        got = clean_accounts(df, ["transaction_id"]).orderBy("transaction_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.days_overdue for r in got] == [30, 29, 0]
    assert got[2].days_to_payment == 205
