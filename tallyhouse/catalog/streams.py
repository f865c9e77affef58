"""Streaming forms: the append loop as incremental ingestion, and daily sales on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import query
from tallyhouse.session import fresh_path
from tallyhouse.sources.retail import Retail
from tallyhouse.streaming.daily_fold import DailyFold, fold_stream
from tallyhouse.streaming.daily_sales import daily_sales, stream_silver, write_stream
from tallyhouse.streaming.ingest import ingest, read_files

COLUMNS = ("order_id", "customer_id", "order_date", "order_status", "total_amount")


def landed(r: Retail) -> tuple[str, DataFrame]:
    """Orders as files that arrive one by one."""
    path, rows = fresh_path(r.spark, "landing"), r.orders.select(*COLUMNS)
    rows.repartition(4).write.parquet(path)
    return path, rows


@query(
    "st1_incremental_ingest",
    """select order_id, customer_id, order_date, order_status, cast(total_amount as double)
       as total_amount from ord""",
    "ord",
)
def st1(r: Retail) -> DataFrame:
    source, rows = landed(r)
    target, checkpoint = fresh_path(r.spark, "ingested"), fresh_path(r.spark, "ingest-state")
    for _ in range(2):  # the second run finds nothing new
        ingest(r.spark, source, target, checkpoint, rows.schema, files_per_batch=2).awaitTermination()
    return r.spark.read.parquet(target).select(*COLUMNS)


@query(
    "st2_stream_daily_sales",
    """select order_date, count(*) as total_orders, count(distinct customer_id) as unique_customers,
              cast(sum(total_amount) as double) as total_revenue,
              cast(sum(total_amount) as double) / count(*) as avg_order_value
       from ord group by 1""",
    "ord",
)
def st2(r: Retail) -> DataFrame:
    """One file per micro-batch; all days, the newest, still open one included."""
    source, rows = landed(r)
    target, state = fresh_path(r.spark, "silver-orders"), fresh_path(r.spark, "silver-state")
    stream = read_files(r.spark, source, rows.schema, files_per_batch=1)
    write_stream(stream_silver(stream), target, state).awaitTermination()
    return daily_sales(r.spark.read.parquet(target))


@query(
    "st2_daily_fold",
    """select order_date, count(*) as total_orders, count(distinct customer_id) as unique_customers,
              cast(sum(total_amount) as double) as total_revenue,
              cast(sum(total_amount) as double) / count(*) as avg_order_value
       from ord group by 1""",
    "ord",
)
def st2_fold(r: Retail) -> DataFrame:
    """Orders land two years at a time, every tenth one a landing late; each landing is folded as it comes."""
    rows = r.orders.select(*COLUMNS)
    landing = F.floor(F.year("order_date") / 2) + F.when(F.col("order_id") % 10 == 0, 1).otherwise(0)
    source, state = fresh_path(r.spark, "landing"), fresh_path(r.spark, "fold-state")
    fold = DailyFold(r.spark, fresh_path(r.spark, "daily-sales"), unit="month")
    landed_rows = rows.withColumn("_landing", landing)
    for (number,) in sorted(landed_rows.select("_landing").distinct().collect()):  # one per two years
        landed_rows.where(F.col("_landing") == number).drop("_landing").write.mode("append").parquet(source)
        fold_stream(read_files(r.spark, source, rows.schema), fold, state).awaitTermination()
    return fold.daily().drop("batch_id")
