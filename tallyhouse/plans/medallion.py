"""Bronze, silver and gold stages of the retail orders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.expressions import (
    amount_category, floor_band, instant, status_clean,
)
from tallyhouse.operators.aggregates import customer_rollup
from tallyhouse.operators.layout import write_partitioned
from tallyhouse.operators.relational import mean
from tallyhouse.schemas import AMOUNT_BANDS, BASE_SEGMENT, SEGMENT_FLOORS


def stamp(df: DataFrame, source: str, at: Column | str | datetime) -> DataFrame:
    """Ingestion time and source system as literal columns."""
    return df.withColumns({"ingestion_timestamp": instant(at), "source_system": F.lit(source)})


def bronze_orders(orders: DataFrame, source: str, at: Column | str | datetime) -> DataFrame:
    return stamp(orders, source, at)


def silver_orders(bronze: DataFrame, bands: Sequence[tuple[Any, str]] = AMOUNT_BANDS) -> DataFrame:
    """Orders with keys and a positive amount, date parts, clean status, amount band. No shuffle."""
    valid = (
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("total_amount") > 0)
    )
    return bronze.where(valid).withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_day": F.dayofmonth("order_date"),
            "order_status_clean": status_clean("order_status"),
            "amount_category": amount_category("total_amount", bands),
        }
    )


def gold_daily_sales(silver: DataFrame) -> DataFrame:
    """Per day: orders, distinct customers, revenue, mean, extremes, revenue per customer.

    The sums fold inside every task, so their shuffle carries one row per day and task. Only the
    exact customer count needs a large shuffle; it is taken on its own, so that shuffle carries
    (day, customer) pairs and no amounts. It is spread over customers: a day holding a third of
    all orders is no hot group. The second scan reads few columns; both run side by side.
    """
    totals = silver.groupBy("order_date").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.min("total_amount").alias("min_order_value"),
        F.max("total_amount").alias("max_order_value"),
    )
    buyers = (
        silver.select(F.col("order_date").alias("_day"), "customer_id")
        .distinct()
        .groupBy("_day")
        .agg(F.count("customer_id").alias("unique_customers"))
    )
    daily = totals.join(buyers, F.col("order_date").eqNullSafe(F.col("_day")))
    return daily.select(
        "order_date",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        "total_orders",
        "unique_customers",
        "total_revenue",
        mean("total_revenue", "total_orders").alias("avg_order_value"),
        "min_order_value",
        "max_order_value",
        mean("total_revenue", "unique_customers").alias("revenue_per_customer"),
    )


def gold_customer_segments(
    silver: DataFrame, floors: Sequence[tuple[Any, str]] = SEGMENT_FLOORS
) -> DataFrame:
    """Lifetime figures per customer and the segment they fall in."""
    segment = floor_band("lifetime_value", floors, BASE_SEGMENT)
    return customer_rollup(silver).withColumn("customer_segment", segment)


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        mean(F.sum("lifetime_value"), F.count("lifetime_value")).alias("avg_lifetime_value"),
    )


def run_layers(
    spark: SparkSession, orders: DataFrame, out: str, source: str, at: str | datetime,
    bands: Sequence[tuple[Any, str]] = AMOUNT_BANDS,
    floors: Sequence[tuple[Any, str]] = SEGMENT_FLOORS,
) -> DataFrame:
    """Run all stages; one row per layer with its row count.

    Gold reads the silver files just written: columnar, column-pruned, and nothing has to stay
    in executor memory. Counts come from Parquet footers, not from a second run of a stage.
    """
    bronze = bronze_orders(orders, source, at)
    paths = {layer: f"{out}/{layer}" for layer in ("silver_orders", "gold_daily_sales", "gold_customer_segments")}
    parts = ["order_year", "order_month"]
    write_partitioned(silver_orders(bronze, bands), paths["silver_orders"], parts)
    silver = spark.read.parquet(paths["silver_orders"])
    write_partitioned(gold_daily_sales(silver), paths["gold_daily_sales"], parts)
    gold_customer_segments(silver, floors).write.mode("overwrite").parquet(
        paths["gold_customer_segments"]
    )
    counted = {"bronze_orders": orders} | {layer: spark.read.parquet(p) for layer, p in paths.items()}
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), "rows")
        for layer, df in counted.items()
    ]
    return reduce(DataFrame.unionByName, counts)
