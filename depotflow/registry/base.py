"""Registration and the common output form of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from depotflow.session import size_for_tables, stored, tune
from depotflow.sources.order_tables import SCHEMAS, OrderTables


@dataclass(frozen=True)
class Entry:
    build: Callable[[OrderTables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build):
        if name in ENTRIES:
            raise ValueError(f"query {name} registered twice")
        ENTRIES[name] = Entry(build, sql)
        return build

    return register


def tidy(df: DataFrame) -> DataFrame:
    """Output types that two engines share exactly: whole numbers as bigint, decimals as
    double, dates as ISO text."""
    out = []
    for f in df.schema.fields:
        col, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
            col = col.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
            col = col.cast("string")
        out.append(col.alias(f.name))
    return df.select(*out)


class QueryTables(OrderTables):
    """Tables of one query run: a ledger that is read at all is read several times, so
    the run stores it at its first use."""

    @cached_property
    def stock_ledger(self) -> DataFrame:
        return stored(super().stock_ledger)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(entry: Entry):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            size_for_tables(tune(spark), [f"{folder}/{name}.parquet" for name in SCHEMAS])
            return tidy(entry.build(QueryTables(spark, folder)))

        return run

    return {name: runner(entry) for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql}
