"""What each raw table must look like."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

@dataclass(frozen=True)
class TableContract:
    """Columns of a raw table with their kind (text, whole, date or number); the first column is
    the business id."""

    name: str
    kinds: dict[str, str]
    required_values: frozenset[str]
    min_rows: int
    date_formats: tuple[str, ...] = ()

    @property
    def id_column(self) -> str:
        return next(iter(self.kinds))

    @property
    def columns(self) -> list[str]:
        return list(self.kinds)

    def of_kind(self, kind: str) -> list[str]:
        return [c for c, k in self.kinds.items() if k == kind]

    def raw_schema(self) -> T.StructType:
        """All-text schema: the file is read without inference and cast explicitly."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.kinds])


# Columns of the four raw tables, those never null, and their least row counts.
SALES = TableContract(
    "fact_sales",
    {
        "sale_id": "text",
        "date": "date",
        "year": "whole",
        "month": "whole",
        "month_name": "text",
        "quarter": "text",
        "customer_id": "text",
        "customer_name": "text",
        "customer_type": "text",
        "route_id": "text",
        "route_name": "text",
        "product_id": "text",
        "product_name": "text",
        "category": "text",
        "unit": "text",
        "quantity": "number",
        "unit_price": "number",
        "gross_amount": "number",
        "discount": "number",
        "net_amount": "number",
        "payment_mode": "text",
        "invoice_number": "text",
    },
    frozenset({"sale_id", "date", "customer_id", "product_id", "net_amount"}),
    10_000,
)
PRODUCTION = TableContract(
    "fact_production",
    {
        "production_id": "text",
        "date": "date",
        "year": "whole",
        "month": "whole",
        "month_name": "text",
        "quarter": "text",
        "category": "text",
        "planned_qty": "number",
        "actual_qty": "number",
        "wastage_qty": "number",
        "net_produced_qty": "number",
        "raw_milk_used_L": "number",
        "production_efficiency_%": "number",
        "wastage_rate_%": "number",
        "shift": "text",
        "batch_number": "text",
    },
    frozenset({"production_id", "date", "category", "planned_qty", "actual_qty"}),
    1_000,
)
INVENTORY = TableContract(
    "fact_inventory",
    {
        "inventory_id": "text",
        "date": "date",
        "year": "whole",
        "month": "whole",
        "month_name": "text",
        "quarter": "text",
        "product_id": "text",
        "product_name": "text",
        "category": "text",
        "opening_stock": "number",
        "received_qty": "number",
        "dispatched_qty": "number",
        "closing_stock": "number",
        "reorder_level": "number",
        "stock_status": "text",
    },
    frozenset({"inventory_id", "date", "product_id", "closing_stock"}),
    2_000,
)
ACCOUNTS = TableContract(
    "fact_accounts",
    {
        "transaction_id": "text",
        "invoice_date": "date",
        "year": "whole",
        "month": "whole",
        "month_name": "text",
        "quarter": "text",
        "customer_id": "text",
        "customer_name": "text",
        "customer_type": "text",
        "invoice_number": "text",
        "due_date": "date",
        "invoice_amount": "number",
        "amount_paid": "number",
        "outstanding_balance": "number",
        "payment_date": "date",
        "days_to_payment": "whole",
        "payment_status": "text",
        "credit_days": "number",
    },
    frozenset({"transaction_id", "invoice_date", "customer_id", "invoice_amount"}),
    500,
)
RAW_TABLES = {c.name: c for c in (SALES, PRODUCTION, INVENTORY, ACCOUNTS)}
DATE_COLUMNS = {c.name: c.of_kind("date") for c in RAW_TABLES.values()}
