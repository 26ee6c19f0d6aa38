"""Readers, writers, exports, dimensions and data quality."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depotflow import contracts
from depotflow.operators.dedup import keep_first
from depotflow.plans import dimensions
from depotflow.plans.quality import quality_report, quality_summary
from depotflow.plans.warehouse import export_list, store_star
from depotflow.sources import files


def test_first_copy_in_file_order_does_not_depend_on_splits(spark, tmp_path):
    lines = ["id,payload"] + [f"k{i % 97},{i}" for i in range(20_000)]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join(lines))
    seen = []
    for size in ("128m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            raw = files.with_scan_order(files.read_raw(spark, str(path)))
            first = keep_first(raw, ["id"], list(files.SCAN_ORDER))
            seen.append(({r.id: int(r.payload) for r in first.collect()}, raw.rdd.getNumPartitions()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0][0] == seen[1][0] == {f"k{i}": i for i in range(97)}
    assert seen[1][1] > seen[0][1]


def test_store_reads_back_partitioned_and_counted(spark, tmp_path):
    df = spark.createDataFrame([("FY2023-24", 1), ("FY2024-25", 2)], "financial_year string, v int")
    stored, report = store_star(spark, {"fact": df}, str(tmp_path))
    assert report.first().verified and report.first().loaded_rows == 2
    plan = stored["fact"].filter("financial_year = 'FY2023-24'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(financial_year" in plan


def test_export_skips_only_the_failing_item(spark, tmp_path):
    def broken():
        raise RuntimeError("no such view")

    good = spark.range(3)
    out = files.export_all(
        spark, {**export_list({"t": good}, {}), "bad": broken, "u": lambda: good}, str(tmp_path)
    )
    assert {r.name: r.status for r in out.collect()} == {"t": "exported", "bad": "skipped", "u": "exported"}
    assert files.read_raw(spark, str(tmp_path / "u")).count() == 3


def test_dates_survive_a_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 2, 29), None)], "a date, b date")
    files.write_csv(df, str(tmp_path / "x"))
    back = files.restore_dates(files.read_raw(spark, str(tmp_path / "x")), ["a", "b", "absent"])
    assert tuple(back.first()) == (dt.date(2024, 2, 29), None)


def test_calendar(spark):
    days = files.days(dt.date(2023, 4, 1), dt.date(2025, 3, 31), spark)
    cal = {r.date_key: r for r in dimensions.dim_date(days).collect()}
    assert len(cal) == 731
    leap = cal[dt.date(2024, 2, 29)]
    assert leap.is_month_end and leap.season == "Winter" and leap.financial_year == "FY2023-24"
    sunday = cal[dt.date(2023, 4, 2)]
    assert (sunday.day_number, sunday.day_of_week, sunday.is_weekend, sunday.quarter) == (0, "Sunday", True, "Q2")


def test_literal_dimensions(spark):
    assert dimensions.dim_product(spark).count() == 12
    routes = {r.route_id: r.route_name for r in dimensions.dim_route(spark).collect()}
    assert len(routes) == 8 and routes["R01"] == "Sector-7 Route"


def test_quality_report(spark):
    small = contracts.TableContract(
        "t", {"id": "text", "day": "date", "amount": "number", "gone": "text"}, frozenset({"id", "day"}), 5
    )
    df = spark.createDataFrame(
        [("a", "2024-01-01", "5"), ("a", "never", "-1"), (None, None, "x"), (None, "2024-01-03", None)],
        "id string, day string, amount string",
    )
    got = {(r.check_name, r.column_name): r for r in quality_report(df, small).collect()}
    assert got["required_column", "gone"].severity == "ERROR"
    assert not got["required_columns", "*"].passed
    assert got["row_count", "*"].bad_count == 1 and not got["row_count", "*"].passed
    assert got["nulls", "id"].severity == "ERROR" and got["nulls", "id"].bad_pct == 50
    assert got["nulls", "amount"].passed
    assert got["dates", "day"].bad_count == 1 and got["dates", "day"].max_value == "2024-01-03"
    assert got["numbers", "amount"].bad_count == 1
    assert got["negatives", "amount"].bad_count == 1
    assert got["duplicates", "id"].bad_count == 2  # second 'a' and second null
    summary = quality_summary({"t": quality_report(df, small)}).first()
    assert summary.ingested and summary.failed_checks > 0


def test_contract_ids_are_first_columns():
    assert [c.id_column for c in contracts.RAW_TABLES.values()] == [
        "sale_id", "production_id", "inventory_id", "transaction_id"
    ]
    assert contracts.DATE_COLUMNS["fact_accounts"] == ["invoice_date", "due_date", "payment_date"]


def test_preview_is_ordered(spark):
    assert [r.id for r in files.preview(spark.range(10), 2, F.col("id").desc()).collect()] == [9, 8]
