"""Daily sales on a stream of orders.

``stream_daily_sales`` keeps bounded state and drops rows later than its delay. Where no row may be lost,
the silver rows of ``stream_silver`` are appended and ``daily_sales`` is taken from what is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.relational import mean
from tallyhouse.plans.medallion import gold_daily_sales, silver_orders
from tallyhouse.schemas import AMOUNT_BANDS


def stream_silver(stream: DataFrame, bands: Sequence[tuple[Any, str]] = AMOUNT_BANDS) -> DataFrame:
    """The silver rows that the daily rollup needs. No state: a row is never too late, and the
    sink's commit log records a repeated batch once."""
    return silver_orders(stream, bands).select("order_id", "customer_id", "order_date", "total_amount")


def daily_sales(stored: DataFrame) -> DataFrame:
    """The daily rollup of all silver rows stored so far, the newest day included."""
    return gold_daily_sales(stored).select(
        "order_date", "total_orders", "unique_customers", "total_revenue", "avg_order_value"
    )


def stream_daily_sales(
    stream: DataFrame, delay: str = "1 day", bands: Sequence[tuple[Any, str]] = AMOUNT_BANDS
) -> DataFrame:
    """The silver rules and the daily rollup in append mode.

    Two stateful steps, as in batch: per (day, customer), then per day. The distinct customer
    count is exact, and a busy day is spread over its customers. Rows later than ``delay`` are
    dropped; a day is emitted once the watermark has passed its end.
    """
    silver = silver_orders(stream, bands).withColumn("_at", F.col("order_date").cast("timestamp_ltz"))
    per_customer = (
        silver.withWatermark("_at", delay)
        .groupBy(F.window("_at", "1 day").alias("_day"), "customer_id")
        .agg(F.count("order_id").alias("n"), F.sum("total_amount").alias("revenue"))
    )
    daily = per_customer.groupBy(F.window(F.window_time("_day"), "1 day").alias("_window")).agg(
        F.sum("n").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("revenue").alias("total_revenue"),
    )
    return daily.select(
        F.col("_window.start").cast("date").alias("order_date"),
        "total_orders",
        "unique_customers",
        "total_revenue",
        mean("total_revenue", "total_orders").alias("avg_order_value"),
    )


def write_stream(
    daily: DataFrame, target: str, checkpoint: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Append finished days (or silver rows) to Parquet files, process what is there, then stop.

    The number of state partitions is fixed by the first run of a checkpoint, so it is stated
    here rather than left to whatever the session's batch jobs use.
    """
    writer = (
        daily.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if state_partitions is None:
        return writer.start()
    conf, setting = daily.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(setting)
    conf.set(setting, state_partitions)  # the query takes a copy of the settings when it starts
    try:
        return writer.start()
    finally:
        conf.set(setting, before)
