"""Safe replace, exports side by side, declared locales, ranks by range."""

from __future__ import annotations

import datetime as dt
import threading
from decimal import Decimal

import pytest

from depotflow.operators.ranking import dense_rank_all
from depotflow.plans.warehouse import store_star
from depotflow.sources import files
from pyspark.sql import functions as F


def years(spark, n):
    return spark.range(n).selectExpr("concat('FY', id % 3) AS financial_year", "id AS v")


def test_replace_commits_and_keeps_one_version_before(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert files.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, path)
    opened = []
    for n in (5, 7, 9):
        assert files.write_table(years(spark, n), path) == n
        opened.append(files.read_table(spark, path))
        assert opened[-1].count() == n
    assert opened[1].count() == 7  # still there for who opened it
    versions = [p.name for p in (tmp_path / "fact").iterdir() if p.name.startswith("v-")]
    assert len(versions) == 2 and (tmp_path / "fact" / files.POINTER).exists()
    assert not [p for p in (tmp_path / "fact").iterdir() if p.name.endswith(".pointer")]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    files.write_table(years(spark, 6), path)
    broken = years(spark, 50).withColumn("v", F.when(F.col("v") < 40, F.col("v")).otherwise(F.raise_error(F.lit("disk full"))))
    with pytest.raises(Exception, match="disk full"):
        files.write_table(broken, path)
    assert sorted(r.v for r in files.read_table(spark, path).collect()) == list(range(6))


def test_a_short_version_is_not_committed(spark, tmp_path):
    path = str(tmp_path / "fact")
    files.write_table(years(spark, 6), path)
    years(spark, 4).write.parquet(f"{path}/v-short")
    with pytest.raises(OSError, match="5 rows were written, 4 are stored"):
        files._commit(spark, path, "v-short", 5, years(spark, 1).schema)
    assert files.read_table(spark, path).count() == 6


def test_empty_table_and_report(spark, tmp_path):
    stored, report = store_star(spark, {"none": years(spark, 0).drop("financial_year")}, str(tmp_path))
    assert stored["none"].count() == 0 and report.first().verified


def test_exports_overlap_and_keep_their_order(spark, tmp_path):
    both = threading.Barrier(2, timeout=60)

    def waits():
        both.wait()  # passes only when two exports are under way
        return spark.range(2)

    def broken():
        raise RuntimeError("no such view")

    out = files.export_all(spark, {"a": waits, "bad": broken, "b": waits}, str(tmp_path), workers=3).collect()
    assert [(r.name, r.status) for r in out] == [("a", "exported"), ("bad", "skipped"), ("b", "exported")]
    assert [r.columns for r in out] == [1, None, 1]


@pytest.mark.parametrize(
    "locale, amount, date, pattern",
    [("en-IN", '"1,00,000.50"', "05-04-2024", "dd-MM-yyyy"), ("de-DE", '"100.000,50"', "05.04.2024", "dd.MM.yyyy")],
)
def test_declared_locale(spark, tmp_path, locale, amount, date, pattern):
    path = tmp_path / "in.csv"
    path.write_text(f"name,amount,real,since\na,{amount},{amount},{date}\nb,,,\n")
    schema = "name string, amount decimal(18,2), real double, since date"
    rows = files.read_typed(spark, str(path), schema, locale, pattern).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [("a", Decimal("100000.50"), 100000.5, dt.date(2024, 4, 5)), ("b", None, None, None)]


def test_range_ranks_do_not_grow_the_plan(spark):
    df = spark.range(3000).selectExpr("id AS c", "CASE WHEN id % 11 > 0 THEN (id * 7919) % 501 END AS v")
    few, many = (dense_rank_all(df, "v", "r", n) for n in (2, 200))
    size = lambda x: len(x._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(few) - size(many)) < 50
    order = {v: i + 1 for i, v in enumerate(sorted({r.v for r in df.collect() if r.v is not None}, reverse=True))}
    for out in (few, many, dense_rank_all(df, "v", "r")):
        got = out.collect()
        assert len(got) == 3000 and all(r.r == order.get(r.v) for r in got)
    assert dense_rank_all(df.where("v IS NULL"), "v", "r").where("r IS NOT NULL").count() == 0


def test_compressed_copies_are_read_back(spark, tmp_path):
    rows = spark.range(50).selectExpr("id", "concat('a\n', id) AS text")
    files.write_csv(rows, str(tmp_path / "c"), "gzip")
    parts = [p.name for p in (tmp_path / "c").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    back = files.read_raw(spark, str(tmp_path / "c"), multi_line=True)
    assert sorted(int(r.id) for r in back.collect()) == list(range(50)) and {r.text[:2] for r in back.collect()} == {"a\n"}


def test_a_stored_table_is_not_shuffled_for_its_years(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = years(spark, 90).repartition(4)
    for pack, most in ((False, 12), (True, 3)):
        path = str(tmp_path / str(pack))
        assert files.write_table(rows, path, pack=pack) == 90
        stored = list((tmp_path / str(pack)).glob("v-*/financial_year=*/part-*"))
        assert 3 <= len(stored) <= most and files.read_table(spark, path).count() == 90
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
