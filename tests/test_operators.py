"""Operators against brute force on small fixtures, including hot keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from depotflow.operators.dedup import keep_first
from depotflow.operators.latest import on_last_date, total_on_last_date
from depotflow.operators.ranking import dense_rank_all, top_rank, top_rows
from depotflow.operators.reshape import attribute, measures_as_rows, pivot_value, trend_line
from depotflow.operators.rollup import average_of_totals, rollup
from depotflow.operators.share import share_of_all, share_percent
from depotflow.operators.slicers import same_text, slice_rows
from depotflow.operators.timeline import (
    daily_totals,
    growth,
    previous_period,
    rolling_mean,
    shifted,
    to_date_totals,
)
from depotflow.plans import sales_kpis
from depotflow.plans.inventory_kpis import monthly_turnover
from depotflow.plans.measures import inventory_measures, revenue_to_date


def hot_rows(n=3000, seed=3):
    """Rows where one key and one value hold more than a third of everything."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(200)}", rng.randrange(40),
         0 if rng.random() < 0.4 else rng.randrange(500), i)
        for i in range(n)
    ]


def test_rollup_matches_direct_aggregation(spark):
    df = spark.createDataFrame(hot_rows(), "k string, a int, v int, i int")
    measures = {
        "n": ("rows",), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"),
        "m": ("avg", "v"), "da": ("distinct", "a"), "dv": ("distinct", "v"),
    }
    got = {r.k: tuple(r)[1:] for r in rollup(df, ["k"], measures).collect()}
    want = {
        r.k: tuple(r)[1:]
        for r in df.groupBy("k").agg(
            F.count("*"), F.sum("v"), F.min("v"), F.max("v"), F.avg("v"),
            F.count_distinct("a"), F.count_distinct("v"),
        ).collect()
    }
    assert got.keys() == want.keys()
    for k in got:
        assert got[k] == pytest.approx(want[k])


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_dense_rank_all(spark, slices):
    rows = [(f"c{i}", v) for i, (_, _, v, _) in enumerate(hot_rows())] + [("none", None)]
    df = spark.createDataFrame(rows, "c string, v int").withColumn("v", F.col("v").cast("decimal(12,2)"))
    got = {r.c: r["rank"] for r in dense_rank_all(df, "v", "rank", slices).collect()}
    order = {v: i for i, v in enumerate(sorted({v for _, v in rows if v is not None}, reverse=True), 1)}
    assert got == {c: order.get(v) for c, v in rows}


def test_dense_rank_and_rank_differ_on_ties(spark):
    df = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5)], "c string, v int")
    dense = {r.c: r.r for r in dense_rank_all(df, "v", "r").collect()}
    rank = {r.c: r.r for r in top_rank(df, "v", 3, "r").collect()}
    assert dense == {"a": 1, "b": 1, "c": 2}
    assert rank == {"a": 1, "b": 1, "c": 3}


def test_top_rank_returns_every_tie_at_the_threshold(spark):
    rows = [("top", 100)] + [(f"t{i}", 50) for i in range(500)] + [("low", 1)]
    df = spark.createDataFrame(rows, "c string, v int")
    got = top_rank(df, "v", 5, "r").collect()
    assert len(got) == 501 and {r.r for r in got} == {1, 2}


def test_top_rows_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "c string, v int")
    assert [r.c for r in top_rows(df, "v", 2, "c").collect()] == ["c", "a"]


def test_keep_first_with_a_hot_key_and_any_partitioning(spark):
    rows = hot_rows()
    want = {}
    for k, _, _, i in rows:
        want.setdefault(k, i)
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "k string, a int, v int, i int").repartition(parts)
        assert {r.k: r.i for r in keep_first(df, ["k"], ["i"]).collect()} == want


def days(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in rows], "date date, v int")


def test_last_date_overall_and_per_group(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("a", "2024-01-02", 3), ("b", "2024-01-01", 7)],
        "k string, date string, v int",
    )
    assert sorted(r.v for r in on_last_date(df).collect()) == [2, 3]
    got = {r.k: r.total for r in total_on_last_date(df, ["k"], "v", "total").collect()}
    assert got == {"a": 5, "b": 7}


def test_average_of_daily_totals(spark):
    df = days(spark, ("2024-01-01", 1), ("2024-01-01", 3), ("2024-01-02", 2))
    assert average_of_totals(df, [], "date", F.sum("v"), "m").first().m == 3


def test_running_totals_reset_at_month_and_financial_year(spark):
    df = days(spark, ("2024-03-30", 1), ("2024-03-31", 2), ("2024-04-02", 4))
    out = to_date_totals(daily_totals(df, "v", "v"), "v", "mtd", "ytd").orderBy("date_key").collect()
    assert [(str(r.date_key), r.v, r.mtd, r.ytd) for r in out] == [
        ("2024-03-30", 1, 1, 1), ("2024-03-31", 2, 3, 3), ("2024-04-01", None, None, None),
        ("2024-04-02", 4, 4, 4),
    ]


def test_month_shift_leaves_gaps_empty(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, m, 1), v) for m, v in ((1, 10), (2, 20), (4, 40))], "month_start date, v int"
    )
    out = shifted(df, "v", 1, "prev").orderBy("month_start").collect()
    assert [r.prev for r in out] == [None, 10, None]
    rolled = rolling_mean(df, "v", 3, "m").orderBy("month_start").collect()
    assert [r.m for r in rolled] == [10, 15, 30]


def test_growth_against_zero_or_missing_is_null(spark):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, 10)], "i int, v int")
    df = previous_period(df, "v", ["i"], "p").withColumn("g", growth(F.col("v"), F.col("p")))
    assert [r.g for r in df.orderBy("i").collect()] == [None, None, 100]


def test_shares(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "z", 4)], "g string, k string, v int")
    out = df.withColumn("all", share_percent("v")).withColumn("pane", share_percent("v", ["g"]))
    assert {r.k: (float(r["all"]), float(r.pane)) for r in out.collect()} == {
        "x": (12.5, 25), "y": (37.5, 75), "z": (50, 100)
    }
    whole = share_of_all(df, "v", "s").agg(F.sum("s")).first()[0]
    assert float(whole) == 100


def test_pivot_unpivot_trend_attribute(spark):
    df = spark.createDataFrame([("a", 2023, 1.0), ("a", 2024, 3.0), ("b", 2022, 5.0)], "k string, y int, v double")
    wide = {r.k: (r.y23, r.y24) for r in pivot_value(df, ["k"], "y", {2023: "y23", 2024: "y24"}, "v").collect()}
    assert wide == {"a": (1.0, 3.0), "b": (None, None)}
    line = {r.k: r for r in trend_line(df, ["k"], "y", "v").collect()}["a"]
    assert line.slope == pytest.approx(2) and line.intercept == pytest.approx(1 - 2 * 2023)
    long = measures_as_rows(df.withColumn("w", F.lit(9)), ["k"], ["v", "w"])
    assert long.count() == 6
    only = {r.k: r.only for r in df.groupBy("k").agg(attribute("y").alias("only")).collect()}
    assert only == {"a": None, "b": 2022}


def test_slicers(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert slice_rows(df, k=["a", "b"], v=None).count() == 2
    assert slice_rows(df, k="a").count() == 1
    assert df.filter(same_text("k", "A")).count() == 1


def sales(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, customer_name string, date date, month int, month_name string, "
        "financial_year string, net_amount int"
    ).withColumn("net_amount", F.col("net_amount").cast("decimal(12,2)"))


def test_year_over_year_needs_both_years(spark):
    rows = [("c", "n", dt.date(2023, 5, 1), 5, "May", "FY2023-24", 100),
            ("c", "n", dt.date(2024, 5, 1), 5, "May", "FY2024-25", 150),
            ("c", "n", dt.date(2023, 6, 1), 6, "June", "FY2023-24", 100)]
    out = sales_kpis.year_over_year(sales(spark, rows)).collect()
    assert len(out) == 1
    assert (float(out[0].absolute_change), float(out[0].yoy_growth_pct)) == (50.0, 50.0)
    assert "revenue_fy2023_24" in out[0].asDict()


@pytest.mark.parametrize(
    "revenue, tier, rank",
    [(900_000, "Platinum (>=9L)", 1), (899_999.99, "Gold (8.5L-9L)", 2),
     (650_000, "Bronze (6.5L-7.5L)", 4), (649_999, "Standard (<6L)", 5)],
)
def test_spend_tiers(spark, revenue, tier, rank):
    df = spark.createDataFrame([(float(revenue),)], "v double")
    got = df.select(sales_kpis.spend_tier(F.col("v")), sales_kpis.spend_tier_rank(F.col("v"))).first()
    assert tuple(got) == (tier, rank)


STOCK = ("year int, month int, month_name string, product_id string, product_name string, category string, "
         "date date, opening_stock int, closing_stock int, dispatched_qty int, stock_status string")


def test_turnover_with_odd_stock(spark):
    df = spark.createDataFrame(
        [(2024, 1, "January", "p", "n", "c", dt.date(2024, 1, 1), 2, 1, 6, "OK")], STOCK)
    row = monthly_turnover(df).first()
    assert (float(row.turnover_ratio), float(row.turnover_ratio_exact)) == (6.0, 4.0)
    assert row.movement_category == "Normal"


def test_turnover_without_stock_is_dead_stock(spark):
    df = spark.createDataFrame(
        [(2024, 1, "January", "p", "n", "c", dt.date(2024, 1, 1), 0, 0, 6, "Stockout")], STOCK)
    row = monthly_turnover(df).first()
    assert row.turnover_ratio is None and row.movement_category == "Dead Stock Risk"


def test_inventory_measures_use_daily_totals(spark):
    df = spark.createDataFrame(
        [(2024, 1, "January", p, p, "c", dt.date(2024, 1, d), o, c, s, st) for p, d, o, c, s, st in (
            ("p", 1, 10, 6, 4, "OK"), ("q", 1, 4, 0, 4, "Stockout"), ("p", 2, 6, 2, 4, "OK"))], STOCK)
    row = inventory_measures(df, []).first()
    assert row.current_closing_stock == 2 and row.stockout_days == 1
    assert float(row.avg_daily_dispatch) == 6.0  # (8 + 4) / 2 days
    assert float(row.days_of_stock) == pytest.approx(0.3333)
    assert float(row.stock_turnover_ratio) == pytest.approx(12 / ((20 / 2 + 8 / 2) / 2), abs=1e-4)


def test_revenue_to_date_is_dense(spark):
    rows = [("c", "n", dt.date(2024, 1, 30), 1, "January", "FY2023-24", 1),
            ("c", "n", dt.date(2024, 2, 2), 2, "February", "FY2023-24", 2)]
    assert revenue_to_date(sales(spark, rows)).count() == 4
