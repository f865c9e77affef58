"""Business reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.expressions import decode, floor_band, month_label
from tallyhouse.operators.aggregates import group_stats, null_profile, state_summary
from tallyhouse.operators.relational import (
    customer_summary, last_days, mean, order_stats, preview, table_exists, top_k,
)
from tallyhouse.operators.ranking import share_of_total
from tallyhouse.schemas import BASE_TIER, TIER_FLOORS, UPGRADE_STEPS
from tallyhouse.sources.readers import to_json_rows
from tallyhouse.sources.writers import overwrite


def customer_analysis(customers: DataFrame, orders: DataFrame, table: str, k: int = 10) -> dict[str, DataFrame]:
    """Customer summary saved as a table; top customers and state totals read the saved rows."""
    summary = overwrite(customer_summary(customers, orders), table)
    return {
        "summary": summary,
        "top_customers": top_k(summary, "total_spent", k, "customer_id"),
        "by_state": state_summary(summary),
    }


def daily_sales_report(daily: DataFrame, days: int = 10) -> DataFrame:
    """The most recent days that have sales."""
    return top_k(daily, "order_date", days)


def segment_report(segments: DataFrame) -> DataFrame:
    """Per segment: customers, revenue, lifetime value per customer, mean of the customers' mean
    order values, and share of all revenue."""
    grouped = segments.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        F.sum("lifetime_value").alias("total_revenue"),
        mean(
            F.sum(F.col("avg_order_value").cast("decimal(28,6)")), F.count("avg_order_value")
        ).alias("mean_avg_order_value"),
    )
    rated = grouped.withColumn("avg_lifetime_value", mean("total_revenue", "customer_count"))
    return share_of_total(rated, "total_revenue", "revenue_percentage")


def sales_trend(daily: DataFrame, days: int = 30, as_of: date | str | None = None) -> DataFrame:
    return last_days(daily, "order_date", days, as_of).select(
        "order_date",
        F.col("total_orders").alias("order_count"),
        F.col("total_revenue").alias("daily_revenue"),
        "avg_order_value",
    )


def customer_lifetime(customers: DataFrame, orders: DataFrame, summary_date: Column) -> DataFrame:
    """Customer dimension with lifetime figures; no orders means 0 orders and value 0."""
    stats = order_stats(orders)
    zero = F.lit(0).cast(stats.schema["total_spent"].dataType)
    return customers.join(stats, "customer_id", "left").select(
        *customers.columns,
        F.coalesce("order_count", F.lit(0)).alias("total_orders"),
        F.coalesce("total_spent", zero).alias("lifetime_value"),
        "last_order_date",
        summary_date.alias("summary_date"),
    )


def regional_revenue(customers: DataFrame, orders: DataFrame, min_revenue: Any) -> DataFrame:
    """Revenue per state and country above a limit. Orders are folded per customer first, which
    leaves the region totals unchanged and the join with one row per customer."""
    summary = customers.select("customer_id", "state", "country").join(
        order_stats(orders), "customer_id", "left"
    )
    regions = summary.groupBy("state", "country").agg(
        F.count("customer_id").alias("customer_count"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"),
        F.sum("total_spent").alias("total_revenue"),
    )
    return regions.withColumn("avg_order_value", mean("total_revenue", "order_count")).where(
        F.col("total_revenue") > min_revenue
    )


def order_totals(items: DataFrame, k: int = 10) -> DataFrame:
    totals = items.groupBy("order_id").agg(
        F.count("*").alias("items_count"), F.sum("line_total").alias("order_total")
    )
    return top_k(totals, "order_total", k, "order_id")


def daily_in_month(transactions: DataFrame, year: int, month: int) -> DataFrame:
    """Daily figures of one year-month partition."""
    chosen = (F.col("transaction_year") == year) & (F.col("transaction_month") == month)
    return transactions.where(chosen).groupBy("transaction_date").agg(
        F.count("*").alias("transaction_count"), F.sum("total_amount").alias("daily_revenue")
    )


def tx_totals(transactions: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Count and revenue, over all partitions or one year-month."""
    chosen = transactions
    if year is not None:
        chosen = chosen.where(F.col("transaction_year") == year)
    if month is not None:
        chosen = chosen.where(F.col("transaction_month") == month)
    return chosen.agg(
        F.count("*").alias("total_transactions"), F.sum("total_amount").alias("total_revenue")
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return group_stats(orders, [month_label("order_date").alias("month")], "total_amount")


def inventory_status(
    products: DataFrame, stock: str = "stock_quantity", reorder: str = "reorder_level"
) -> DataFrame:
    status = (
        F.when(F.col(stock) == 0, "Out of Stock")
        .when(F.col(stock) < F.col(reorder), "Low Stock")
        .otherwise("In Stock")
    )
    return products.withColumn("status", status)


def upgrade_candidates(
    customers: DataFrame, steps: Mapping[str, tuple[Any, Any, str]] = UPGRADE_STEPS,
    tier: str = "loyalty_tier", value: str = "total_purchases",
) -> DataFrame:
    """Customers near the next tier and what is missing (negative when already past it)."""
    near = F.lit(False)
    for name, (above, _, _) in steps.items():
        near = near | ((F.col(tier) == name) & (F.col(value) > above))
    goal = decode(tier, {name: needed for name, (_, needed, _) in steps.items()})
    return customers.where(near).withColumns(
        {
            "next_tier": decode(tier, {name: up for name, (_, _, up) in steps.items()}, "Max Tier"),
            "amount_needed": F.coalesce(goal - F.col(value), F.lit(0)),
        }
    )


def tier_mismatches(
    customers: DataFrame, floors: Sequence[tuple[Any, str]] = TIER_FLOORS, base: str = BASE_TIER,
    tier: str = "loyalty_tier", value: str = "total_purchases",
) -> DataFrame:
    """Customers whose tier is not the one their purchases call for; a NULL tier is not reported."""
    expected = floor_band(value, floors, base)
    return customers.withColumn("expected_tier", expected).where(
        F.col(tier) != F.col("expected_tier")
    )


def load_summary(customers: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """What was loaded: row count, largest customers, figures per tier and per country."""
    return {
        "count": customers.agg(F.count("*").alias("total_customers")),
        "top_customers": top_k(customers, "total_purchases", k, "customer_id"),
        "by_tier": group_stats(customers, ["loyalty_tier"], "total_purchases"),
        "by_country": group_stats(customers, ["country"], "total_purchases"),
    }


def sample_profile(spark: SparkSession, table: str, n: int, order: Sequence[str] = ()) -> dict[str, Any]:
    """Whether a table exists and, if so, its row count, schema, NULL profile and first rows as JSON.

    Without ``order`` the sample is whatever rows come first."""
    if not table_exists(spark, table):
        return {"exists": False}
    df = spark.table(table)
    return {
        "exists": True,
        "rows": df.count(),
        "schema": df.schema.simpleString(),
        "columns": df.schema.fields,
        "nulls": null_profile(df),
        "sample": to_json_rows(preview(df.orderBy(*order) if order else df, n)),
    }


def customer_orders(orders: DataFrame, customer_id: Any) -> DataFrame:
    """One customer's orders by date; on a sorted layout most row groups are skipped."""
    return orders.where(F.col("customer_id") == customer_id).orderBy("order_date", "order_id")
