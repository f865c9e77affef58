"""Declared table schemas. Types are fixed here and never inferred from files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import types as T


class Schemas(Mapping[str, T.StructType]):
    """Table name -> schema. DDL text is turned into types on first use, which needs a session.

    TIMESTAMP columns carry no zone in any of the retail tables.
    """

    def __init__(self, ddl: dict[str, str]) -> None:
        self._ddl = ddl
        self._types: dict[str, T.StructType] = {}

    def __getitem__(self, name: str) -> T.StructType:
        if name not in self._types:
            ddl = self._ddl[name].replace("TIMESTAMP", "TIMESTAMP_NTZ")
            self._types[name] = T.StructType.fromDDL(ddl)
        return self._types[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._ddl)

    def __len__(self) -> int:
        return len(self._ddl)


# Lab tables (typed DDL).
SCHEMAS = Schemas(
    {
        "customers": """
            customer_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING,
            address STRING, city STRING, state STRING, zip_code STRING, country STRING,
            registration_date DATE, last_purchase_date DATE, total_purchases DECIMAL(10,2),
            customer_status STRING""",
        "orders": """
            order_id BIGINT, customer_id BIGINT, order_date DATE, order_status STRING,
            total_amount DECIMAL(10,2), payment_method STRING, shipping_address STRING,
            shipping_city STRING, shipping_state STRING, shipping_zip STRING,
            order_timestamp TIMESTAMP""",
        "products": """
            product_id BIGINT, product_name STRING, category STRING, subcategory STRING,
            brand STRING, price DECIMAL(10,2), cost DECIMAL(10,2), description STRING,
            specifications MAP<STRING,STRING>, tags ARRAY<STRING>,
            dimensions STRUCT<length: DOUBLE, width: DOUBLE, height: DOUBLE, weight: DOUBLE>,
            in_stock BOOLEAN, stock_quantity INT, created_date DATE, last_updated TIMESTAMP""",
        "order_items": """
            order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT,
            unit_price DECIMAL(10,2), discount_percent DECIMAL(5,2), line_total DECIMAL(10,2),
            created_timestamp TIMESTAMP""",
        "product_categories": """
            category_id INT, category_name STRING, category_description STRING,
            parent_category STRING, is_active BOOLEAN, created_date DATE""",
        "customer_transactions": """
            transaction_id BIGINT, customer_id BIGINT, transaction_date DATE,
            transaction_type STRING, amount DECIMAL(10,2), description STRING""",
        "sales_transactions": """
            transaction_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT,
            unit_price DECIMAL(10,2), total_amount DECIMAL(10,2), transaction_date DATE,
            transaction_year INT, transaction_month INT, transaction_timestamp TIMESTAMP""",
        "demo_rows": "id INT, name STRING, amount DOUBLE, created_ts TIMESTAMP",
        "bulk_rows": "commit_id INT, row_id BIGINT, payload STRING, ts TIMESTAMP",
    }
)

# CSV files (a second retail schema that shares some table names).
CSV_SCHEMAS = Schemas(
    {
        "customers": """
            customer_id INT, name STRING, email STRING, country STRING, city STRING,
            registration_date DATE, total_purchases DECIMAL(10,2), loyalty_tier STRING""",
        "orders": """
            order_id INT, customer_id INT, order_date DATE, product_id STRING,
            product_name STRING, category STRING, quantity INT, unit_price DECIMAL(10,2),
            total_amount DECIMAL(10,2), status STRING, payment_method STRING,
            shipping_country STRING""",
        "products": """
            product_id STRING, product_name STRING, category STRING, subcategory STRING,
            brand STRING, unit_price DECIMAL(10,2), cost_price DECIMAL(10,2),
            stock_quantity INT, reorder_level INT, supplier_id STRING, weight_kg DECIMAL(10,2),
            dimensions_cm STRING, color STRING, warranty_months INT, rating DECIMAL(3,1),
            reviews_count INT""",
        "sales_transactions": """
            transaction_id STRING, order_id INT, customer_id INT, transaction_date DATE,
            transaction_time STRING, amount DECIMAL(12,2), currency STRING,
            payment_method STRING, payment_status STRING, card_type STRING, card_last4 STRING,
            billing_country STRING, tax_amount DECIMAL(12,2), discount_amount DECIMAL(12,2),
            shipping_cost DECIMAL(12,2), total_amount DECIMAL(12,2)""",
        "external_sales": """
            sale_id BIGINT, sale_date DATE, product_id STRING, quantity INT,
            amount DECIMAL(10,2)""",
        "csv_imports": "id BIGINT, name STRING, value DOUBLE, date_field DATE",
    }
)

# Fixed values.
AMOUNT_BANDS = ((100, "LOW"), (500, "MEDIUM"), (1000, "HIGH"))
TOP_AMOUNT_BAND = "PREMIUM"
SEGMENT_FLOORS = ((5000, "VIP"), (2000, "PREMIUM"), (500, "REGULAR"))
BASE_SEGMENT = "NEW"
PURCHASE_FLOORS = ((20000, "High Value"), (10000, "Medium Value"))
BASE_PURCHASE_SEGMENT = "Low Value"
TIER_FLOORS = ((20000, "Platinum"), (15000, "Gold"), (10000, "Silver"))
BASE_TIER = "Bronze"
TIER_ORDER = ("Platinum", "Gold", "Silver", "Bronze")
# tier -> (purchases above which an upgrade is near, purchases the next tier needs, next tier)
UPGRADE_STEPS = {
    "Bronze": (8000, 10000, "Silver"),
    "Silver": (12000, 15000, "Gold"),
    "Gold": (18000, 20000, "Platinum"),
}
MONEY = "decimal(18,2)"
