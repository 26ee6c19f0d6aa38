"""Bind order-management tables (orders, lines, parts, customers) to the star schema.

Facts are built with the joins a caller asks for and no others, so a report that only
needs order attributes never shuffles on the part key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from depotflow.functions.calendar import month_name, period_columns, quarter_label
from depotflow.functions.numeric import MONEY, half_up
from depotflow.operators.joins import with_dimension
from depotflow.plans.accounts_cleaning import AccountsRules, clean_accounts
from depotflow.plans.inventory_cleaning import InventoryRules, clean_inventory
from depotflow.plans.production_cleaning import ProductionRules, clean_production
from depotflow.plans.sales_cleaning import SalesRules
from depotflow.session import stored

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
START = dt.date(1995, 1, 1)
END = dt.date(2001, 12, 31)
ANALYSIS_DATE = dt.date(2001, 8, 31)
CREDIT_DAYS = {"AUTOMOBILE": 0, "BUILDING": 15, "FURNITURE": 15, "HOUSEHOLD": 30, "MACHINERY": 45}
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SHELF_LIFE = {"ECONOMY": 2, "LARGE": 3, "MEDIUM": 7, "PROMO": 5, "SMALL": 180}

SALES_RULES = SalesRules(
    categories=frozenset(t.title() for t in PART_TYPES),
    payment_modes=frozenset({"1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"}),
    customer_types=frozenset(
        {"Automobile", "Building", "Furniture", "Household", "Machine/Tools"}
    ),
    routes=frozenset(f"Nation_{i}" for i in range(24)),
    start=dt.date(1996, 4, 1),
    end=dt.date(2000, 3, 31),
)
PRODUCTION_RULES = ProductionRules(
    categories=frozenset(t.title() for t in PART_TYPES), start=START, end=END
)
INVENTORY_RULES = InventoryRules(shelf_life_days=SHELF_LIFE, start=START, end=END)
ACCOUNTS_RULES = AccountsRules(start=START, end=END, analysis_date=ANALYSIS_DATE)


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


class OrderTables:
    """The source tables of one folder and the star tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        """Read with the declared schema, which saves the footer-reading job."""
        reader = self.spark.read.schema(SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    # Dimensions ---------------------------------------------------------------

    @cached_property
    def dim_route(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            F.col("n_nationkey").cast("bigint").alias("route_id"),
            F.col("n_name").alias("route_name"),
            F.col("r_name").alias("area"),
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        pairs = [F.lit(x) for kv in CREDIT_DAYS.items() for x in kv]
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            segment.alias("customer_type"),
            F.col("c_nationkey").cast("bigint").alias("route_id"),
            F.try_element_at(F.create_map(*pairs), segment).alias("credit_days"),
            _money("c_acctbal").alias("credit_limit"),
        )

    @cached_property
    def customers(self) -> tuple[DataFrame, str]:
        """Customer dimension with its route name, and its key."""
        routes = self.dim_route.select("route_id", "route_name")
        return self.dim_customer.join(routes, "route_id", "left"), "customer_id"

    @cached_property
    def products(self) -> tuple[DataFrame, str]:
        return self.dim_product, "product_id"

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            _money("p_retailprice").alias("standard_price"),
            F.col("p_size").alias("size"),
            F.col("p_brand").alias("brand"),
        )

    # Sales --------------------------------------------------------------------

    def fact_sales(
        self, customer: bool = False, route: bool = False, product: bool = False
    ) -> DataFrame:
        """One row per order line with the requested dimension attributes.

        Customers are joined to the orders, before these meet their lines, parts to the bare lines: where a
        dimension is too large to broadcast, no joined sales row is shuffled again.  Period columns and
        amounts are derived after the last join, so that only what they come from is shuffled.
        """
        orders = self.table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("payment_mode"),
        )
        lines = self.table("lineitem").withColumnRenamed("l_partkey", "product_id")
        order, borrowed = [], []
        if customer or route:
            borrowed += ["customer_name", "customer_type", "route_id"]
            orders = with_dimension(orders, self.dim_customer, "customer_id", borrowed)
            order.append("customer_id")
        if route:
            borrowed.append("route_name")
            orders = with_dimension(orders, self.dim_route, "route_id", ["route_name"])
            order.insert(0, "route_id")
        if product:
            named = ["product_name", "category", "standard_price"]
            borrowed += named
            lines = with_dimension(lines, self.dim_product, "product_id", named)
            order.insert(0, "product_id")
        rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumns(period_columns(F.col("date")))
        gross = _money("l_extendedprice")
        discount = F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2).cast(MONEY)
        rows = rows.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
            "date", "year", "month", "month_name", "quarter", "financial_year",
            "customer_id", "product_id",
            F.col("l_quantity").cast("bigint").alias("quantity"),
            half_up(gross.cast("double") / F.col("l_quantity"), 2).cast(MONEY).alias("unit_price"),
            gross.alias("gross_amount"),
            discount.alias("discount"),
            (gross - discount).cast(MONEY).alias("net_amount"),
            "payment_mode",
            F.col("l_orderkey").alias("invoice_number"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_returnflag").alias("return_flag"),
            *borrowed,
        )
        if not borrowed:
            return rows
        return rows.select(*order, *[c for c in rows.columns if c not in order])

    def raw_sales(self) -> DataFrame:
        """The sales lines as an untidy text export: padded and lower-case text,
        impossible dates, non-numbers and negatives, all tied to row attributes."""
        rows = self.fact_sales(customer=True, route=True, product=True)
        flag, line = F.col("return_flag"), F.col("line_number")
        text = {c: F.col(c).cast("string") for c in
                ("quantity", "unit_price", "gross_amount", "discount", "net_amount")}
        iso = F.col("date").cast("string")
        return rows.select(
            "sale_id",
            F.when((flag == "A") & (line == 6), F.concat(iso, F.lit(" 10:00:00")))
            .when((flag == "A") & (line == 5), "not-a-date")
            .otherwise(iso).alias("date"),
            "year", "month", "month_name", "quarter", "customer_id", "customer_name",
            F.when(F.col("customer_type") == "MACHINERY", "machine/tools")
            .otherwise(F.col("customer_type")).alias("customer_type"),
            "route_id", "route_name", "product_id", "product_name",
            F.when(flag == "R", F.concat(F.lit("\t "), F.lower("category"), F.lit(" \n")))
            .when((flag == "N") & (line == 7), "UNKNOWN RANGE")
            .otherwise(F.col("category")).alias("category"),
            F.lit("Piece").alias("unit"),
            F.when((flag == "A") & (line == 4), "abc")
            .when((flag == "A") & (line == 3), F.concat(F.lit("-"), text["quantity"]))
            .otherwise(text["quantity"]).alias("quantity"),
            F.when(flag == "R", F.col("standard_price").cast("string"))
            .otherwise(text["unit_price"]).alias("unit_price"),
            text["gross_amount"].alias("gross_amount"),
            F.when((flag == "N") & (line == 2), "-1")
            .when((flag == "N") & (line == 1), "n/a")
            .otherwise(text["discount"]).alias("discount"),
            F.when((flag == "R") & (line == 1), "0")
            .otherwise(text["net_amount"]).alias("net_amount"),
            F.concat(F.lit(" "), F.col("payment_mode"), F.lit(" ")).alias("payment_mode"),
            "invoice_number",
        )

    RAW_SALES_ORDER = ("product_id", "gross_amount", "quantity", "discount")

    # Production ---------------------------------------------------------------

    def production_runs(self) -> DataFrame:
        """Quantities per day, category and shift.

        A quantity is shuffled as the double it is stored as, which takes fewer bytes than its wide decimal.
        """
        orders = self.table("orders").select(
            "o_orderkey", F.col("o_orderdate").cast("date").alias("date")
        )
        parts = self.table("part").select("p_partkey", F.col("p_type").alias("category"), "p_size")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_returnflag", "l_quantity",
            F.col("l_discount").cast("decimal(4,2)").alias("shortfall"),
            F.col("l_tax").cast("decimal(4,2)").alias("waste"),
        )
        rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
            parts, lines.l_partkey == parts.p_partkey
        )
        rows = rows.withColumn("qty", F.col("l_quantity").cast("decimal(20,4)"))
        qty = F.col("qty")
        return rows.groupBy(
            "date", "category",
            F.when(F.col("l_returnflag") == "A", "Morning").otherwise("Evening").alias("shift"),
        ).agg(
            F.sum("qty").cast("decimal(38,4)").alias("planned_qty"),
            F.sum(qty * (F.lit(1) - F.col("shortfall"))).cast("decimal(38,4)").alias("actual_qty"),
            F.sum(qty * F.col("waste")).cast("decimal(38,4)").alias("wastage_qty"),
            F.sum(qty * F.col("p_size")).cast("decimal(38,4)").alias("raw_milk_used_L"),
        )

    def _production_export(self, run_id: Column) -> DataFrame:
        day = F.col("date")
        return self.production_runs().withColumns(
            {
                "production_id": run_id,
                "year": F.year(day), "month": F.month(day),
                "month_name": month_name(day), "quarter": quarter_label(day),
                "net_produced_qty": F.lit(None).cast("decimal(38,4)"),
                "production_efficiency_%": F.lit(None).cast("decimal(38,4)"),
                "wastage_rate_%": F.lit(None).cast("decimal(38,4)"),
                "batch_number": F.concat_ws("/", F.col("date").cast("string"), F.col("shift")),
            }
        )

    def fact_production(self) -> DataFrame:
        runs = self._production_export(F.concat_ws("|", F.col("date").cast("string"), "category", "shift"))
        return clean_production(runs, ["category"], PRODUCTION_RULES)

    def raw_production(self) -> DataFrame:
        """Production runs as an untidy export; ids collide for categories that share
        their first letter."""
        short = F.concat_ws("|", F.col("date").cast("string"), F.left("category", F.lit(1)), "shift")
        runs = self._production_export(short)
        planned, actual, wasted = (F.col(c) for c in ("planned_qty", "actual_qty", "wastage_qty"))
        morning_promo = (F.col("category") == "PROMO") & (F.col("shift") == "Morning")
        return runs.withColumns(
            {
                "date": F.col("date").cast("string"),
                "category": F.when(F.col("category") == "LARGE", "oversize").otherwise(
                    F.concat(F.lit(" "), F.lower("category"))
                ),
                "shift": F.when(F.col("shift") == "Morning", "\tMORNING ").otherwise("evening"),
                "planned_qty": F.when(morning_promo & (planned > 40), (-planned).cast("string"))
                .otherwise(planned.cast("string")),
                "actual_qty": F.when(planned == 50, "n/a").otherwise(actual.cast("string")),
                "wastage_qty": F.when(planned < 5, (actual * 2).cast("decimal(38,4)").cast("string"))
                .otherwise(wasted.cast("string")),
                "raw_milk_used_L": F.col("raw_milk_used_L").cast("string"),
            }
        )

    RAW_PRODUCTION_ORDER = ("category", "actual_qty")

    # Stock --------------------------------------------------------------------

    @cached_property
    def stock_ledger(self) -> DataFrame:
        """Daily movements per brand with a running opening stock.

        The window sees one row per brand and day, so a brand's partition is bounded by
        the number of days however many order lines it has.  Cleaning and reporting read it
        several times (triggers, averages, last date); ``store_ledger`` saves the repeated
        passes over all order lines.
        """
        parts = self.table("part").select("p_partkey", "p_brand")
        lines = self.table("lineitem").select(
            "l_partkey", F.col("l_shipdate").cast("date").alias("date"), "l_quantity",
            F.col("l_linestatus").alias("status"),
        )
        rows = lines.join(parts, lines.l_partkey == parts.p_partkey)
        moves = rows.withColumn("qty", F.col("l_quantity").cast("decimal(20,4)")).groupBy(
            F.col("p_brand").alias("product_id"), "date"
        ).agg(
            F.sum(F.when(F.col("status") == "O", F.col("qty")).otherwise(0)).alias("received_qty"),
            F.sum(F.when(F.col("status") == "F", F.col("qty")).otherwise(0)).alias("dispatched_qty"),
        )
        before = W.partitionBy("product_id").orderBy("date").rowsBetween(W.unboundedPreceding, -1)
        carried = F.coalesce(F.sum(F.col("received_qty") - F.col("dispatched_qty")).over(before), F.lit(0))
        number = F.replace(F.col("product_id"), F.lit("Brand#"), F.lit("")).cast("int")
        ledger = moves.withColumn("opening_stock", F.greatest(carried, F.lit(0)))
        category = F.element_at(F.array(*[F.lit(t) for t in PART_TYPES]), (number % 6) + 1)
        day = F.col("date")
        out = ledger.select(
            F.concat_ws("|", "product_id", F.col("date").cast("string")).alias("inventory_id"),
            "date",
            F.year(day).alias("year"), F.month(day).alias("month"),
            month_name(day).alias("month_name"), quarter_label(day).alias("quarter"),
            "product_id",
            F.concat(F.lit("Range "), number.cast("string")).alias("product_name"),
            category.alias("category"),
            "opening_stock", "received_qty", "dispatched_qty",
            (F.col("opening_stock") + F.col("received_qty") - F.col("dispatched_qty")).alias("closing_stock"),
            (number * 20).alias("reorder_level"),
        )
        return out

    def store_ledger(self) -> None:
        """Write the ledger once to the shared checkpoint folder; later reads use that."""
        self.stock_ledger = stored(self.stock_ledger)

    def fact_inventory(self) -> DataFrame:
        return clean_inventory(self.stock_ledger, ["date"], INVENTORY_RULES)

    def raw_inventory(self) -> DataFrame:
        """The ledger as an untidy export; an id omits the year, so it repeats yearly."""
        return self.stock_ledger.withColumns(
            {
                "inventory_id": F.concat_ws("|", F.col("product_id"), F.date_format("date", "MM-dd")),
                "date": F.concat(F.lit(" "), F.col("date").cast("string")),
                "received_qty": F.when(F.col("received_qty") == 0, "none").otherwise(
                    F.col("received_qty").cast("string")
                ),
                "closing_stock": F.col("closing_stock").cast("string"),
                "stock_status": F.lit(None).cast("string"),
            }
        )

    RAW_INVENTORY_ORDER = ("date",)

    # Receivables --------------------------------------------------------------

    def order_amounts(self) -> DataFrame:
        """What orders alone tell of an invoice: days, amount, payment and open balance."""
        orders = self.table("orders").select(
            "o_orderkey", "o_orderstatus", "o_orderpriority",
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("invoice_date"),
            _money("o_totalprice").alias("invoice_amount"),
        )
        status, amount = F.col("o_orderstatus"), F.col("invoice_amount")
        paid = (
            F.when(status == "F", amount)
            .when(status == "P", F.round(amount * F.lit("0.60").cast("decimal(3,2)"), 2))
            .otherwise(F.lit(0))
            .cast(MONEY)
        )
        return orders.withColumn("amount_paid", paid).select(
            "o_orderkey", "o_orderpriority", "customer_id", "invoice_date", "invoice_amount", "amount_paid",
            (amount - F.col("amount_paid")).cast(MONEY).alias("outstanding_balance"),
            F.when(status == "F", F.date_add("invoice_date", (F.col("o_orderkey") % 40).cast("int")))
            .alias("payment_date"),
        )

    def invoices(self) -> DataFrame:
        """One invoice per order with due date, payment and open balance."""
        rows = self.order_amounts().join(
            self.dim_customer.select("customer_id", "customer_name", "customer_type", "credit_days"),
            "customer_id",
            "left",
        )
        day = F.col("invoice_date")
        return rows.select(
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            "invoice_date",
            F.year(day).alias("year"), F.month(day).alias("month"),
            month_name(day).alias("month_name"), quarter_label(day).alias("quarter"),
            "customer_id", "customer_name", "customer_type",
            F.col("o_orderkey").alias("invoice_number"),
            F.date_add("invoice_date", F.col("credit_days")).alias("due_date"),
            "invoice_amount", "amount_paid", "outstanding_balance", "payment_date",
            "credit_days",
            F.col("o_orderpriority").alias("priority"),
        )

    def fact_accounts(self, within: Sequence[str] = ()) -> DataFrame:
        # The triggers need amounts and days only, so they are taken before the join.
        amounts = self.order_amounts().select(
            "invoice_date", "invoice_amount", "amount_paid", "outstanding_balance", "payment_date",
            F.col("invoice_date").alias("due_date"), F.lit(0).alias("credit_days"),
        )
        return clean_accounts(self.invoices(), ["invoice_number"], ACCOUNTS_RULES, amounts, within=within)

    def raw_accounts(self) -> DataFrame:
        """The invoices as an untidy export: one id per customer and month (so copies
        occur), unreconciled balances for one priority, overpayment for another."""
        amount, paid = F.col("invoice_amount"), F.col("amount_paid")
        high = F.col("priority") == "2-HIGH"
        return self.invoices().withColumns(
            {
                "transaction_id": F.concat_ws("-", F.col("customer_id"), F.date_format("invoice_date", "yyyy-MM")),
                "invoice_date": F.col("invoice_date").cast("string"),
                "due_date": F.when(F.col("priority") == "5-LOW", "unknown").otherwise(
                    F.col("due_date").cast("string")
                ),
                "outstanding_balance": F.when(F.col("priority") == "1-URGENT", amount)
                .otherwise(F.col("outstanding_balance")).cast("string"),
                "amount_paid": F.when(
                    high & (paid > 0), F.round(paid * F.lit("1.05").cast("decimal(3,2)"), 2)
                ).otherwise(paid).cast("string"),
                "payment_status": F.lit(None).cast("string"),
            }
        )

    RAW_ACCOUNTS_ORDER = ("invoice_date", "invoice_number")
