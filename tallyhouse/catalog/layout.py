"""Partitioned, bucketed and sorted layouts, file inventory, compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import query
from tallyhouse.functions import expressions as X
from tallyhouse.operators import layout, relational as rel
from tallyhouse.session import fresh_path
from tallyhouse.sources.retail import Retail

ORDER_SQL = """select order_id, customer_id, order_date, order_status,
    cast(total_amount as double) as total_amount from ord"""
COLUMNS = ("order_id", "customer_id", "order_date", "order_status", "total_amount")
PARTS = "/order_status=([^/]+)"


def orders(r: Retail) -> DataFrame:
    return r.orders.select(*COLUMNS)


def by_status(r: Retail) -> str:
    """Orders written with one folder per status."""
    path = fresh_path(r.spark, "orders-by-status")
    layout.write_partitioned(orders(r), path, ["order_status"])
    return path


def scattered(r: Retail, tasks: int = 12) -> str:
    """Orders appended by many tasks: a folder per status, each full of small files."""
    path = fresh_path(r.spark, "orders-scattered")
    orders(r).repartition(tasks).write.partitionBy("order_status").parquet(path)
    return path


@query("l01_partitioned", f"{ORDER_SQL} where order_status in ('F', 'O')", "ord")
def l01(r: Retail) -> DataFrame:
    stored = r.spark.read.parquet(by_status(r))
    return stored.where(F.col("order_status").isin("F", "O")).select(*COLUMNS)


@query(
    "l02_year_month_partitions",
    """select order_id, year(order_date) as y, month(order_date) as m from ord
       where order_date >= date '1998-03-01' and order_date < date '1998-04-01'""",
    "ord",
)
def l02(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "orders-by-month")
    layout.write_partitioned(layout.with_year_month(orders(r), "order_date"), path, ["y", "m"])
    stored = r.spark.read.parquet(path)
    return stored.where(X.month_filter("order_date", 1998, 3, "y", "m")).select("order_id", "y", "m")


@query(
    "l03_partition_transforms",
    """select order_id, year(order_date) as date_year,
              year(order_date) * 12 + month(order_date) - 1 as date_month,
              true as bucket_in_range, substring(order_priority, 1, 3) as priority_3,
              order_id - order_id % 100 as order_hundred from ord""",
    "ord",
)
def l03(r: Retail) -> DataFrame:
    derived = layout.transform_columns(
        r.orders,
        {
            "date_year": X.year_of("order_date"),
            "date_month": X.month_of("order_date"),
            "bucket": X.bucket_of("order_id", 16),
            "priority_3": X.truncated_text("order_priority", 3),
            "order_hundred": X.truncated_number("order_id", 100),
        },
    )
    return derived.select(
        "order_id", "date_year", "date_month", F.col("bucket").between(0, 15).alias("bucket_in_range"),
        "priority_3", "order_hundred",
    )


@query("l04_bucketed", ORDER_SQL, "ord")
def l04(r: Retail) -> DataFrame:
    return rel.bucket_table(orders(r), "customer_id", label="orders_bucketed")


@query("l05_sorted", f"{ORDER_SQL} where customer_id between 100 and 200", "ord")
def l05(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "orders-sorted")
    layout.write_sorted(orders(r), path, ["order_status"], ["customer_id", "order_date"])
    stored = r.spark.read.parquet(path)
    return stored.where(F.col("customer_id").between(100, 200)).select(*COLUMNS)


@query(
    "l06_partition_distribution",
    """select year(order_date) as y, month(order_date) as m, count(*) as row_count,
              cast(sum(total_amount) as double) as total_revenue,
              cast(sum(total_amount) as double) / count(*) as avg_value from ord group by 1, 2""",
    "ord",
)
def l06(r: Retail) -> DataFrame:
    dated = layout.with_year_month(r.orders, "order_date")
    return layout.partition_distribution(dated, ["y", "m"], "total_amount")


@query(
    "l07_file_inventory",
    """select order_status, 'PARQUET' as file_format, count(*) as record_count, true as has_bytes
       from ord group by 1""",
    "ord",
)
def l07(r: Retail) -> DataFrame:
    inventory = layout.file_inventory(r.spark, by_status(r))
    status = F.regexp_extract("file_path", PARTS, 1).alias("order_status")
    return inventory.groupBy(status, "file_format").agg(
        F.sum("record_count").alias("record_count"),
        (F.min("file_size_in_bytes") > 0).alias("has_bytes"),
    )


@query("l08_partition_values", "select distinct order_status from ord", "ord")
def l08(r: Retail) -> DataFrame:
    inventory = layout.file_inventory(r.spark, by_status(r))
    return layout.partition_values(inventory, ["order_status"])


@query(
    "l09_file_totals",
    "select count(*) as total_records, true as sizes_agree from ord",
    "ord",
)
def l09(r: Retail) -> DataFrame:
    totals = layout.file_totals(layout.file_inventory(r.spark, by_status(r)))
    return totals.select(
        "total_records",
        (F.col("total_size_mb") == F.floor(F.col("total_size_bytes") / layout.MB)).alias("sizes_agree"),
    )


@query(
    "l10_file_health",
    """select order_status as part, 12::bigint as files, 1.0::double as small_share, 12::bigint as too_small,
              0::bigint as optimal, 0::bigint as too_large, true as advise from ord group by 1""",
    "ord",
)
def l10(r: Retail) -> DataFrame:
    health = layout.file_health(layout.file_inventory(r.spark, scattered(r)))
    return health.withColumn("part", F.regexp_extract("part", PARTS, 1))


def compacted(r: Retail, **options) -> DataFrame:
    """The rows after a compaction, and whether their folder has fewer files than before."""
    path = scattered(r)
    listed = lambda name: layout.file_inventory(r.spark, path).groupBy(
        F.regexp_extract("file_path", PARTS, 1).alias("order_status")
    ).agg(F.count("*").alias(name))
    before = fresh_path(r.spark, "files-before")
    listed("files_before").write.parquet(before)  # counted before the files move
    layout.compact(r.spark, path, **options)
    counts = listed("files_after").join(r.spark.read.parquet(before), "order_status")
    fewer = counts.select("order_status", (F.col("files_after") < F.col("files_before")).alias("fewer_files"))
    return r.spark.read.parquet(path).select(*COLUMNS).join(fewer, "order_status")  # a row per folder


def compacted_sql(fewer: str) -> str:
    return ORDER_SQL.replace(" from ord", f", {fewer} as fewer_files from ord")


@query("l11_compact", compacted_sql("true"), "ord")
def l11(r: Retail) -> DataFrame:
    return compacted(r)


@query("l12_compact_where", compacted_sql("order_status = 'F'"), "ord")
def l12(r: Retail) -> DataFrame:
    return compacted(r, where=F.col("order_status") == "F")


@query("l13_compact_sorted", compacted_sql("true"), "ord")
def l13(r: Retail) -> DataFrame:
    return compacted(r, strategy="sort", sort=["customer_id", "order_date"])


@query(
    "l14_maintain",
    """select 'by_status' as "table", 'SUCCESS' as status, (select count(distinct order_status) from ord)
              as rewritten_folders
       union all select 'missing', 'FAILED', null""",
    "ord",
)
def l14(r: Retail) -> DataFrame:
    tables = {"missing": fresh_path(r.spark, "missing"), "by_status": scattered(r)}
    return layout.maintain(r.spark, tables).select("table", "status", "rewritten_folders")


@query(
    "l15_orphan_files",
    "select order_status, count(*) as records from ord where order_status = 'P' group by 1",
    "ord",
)
def l15(r: Retail) -> DataFrame:
    inventory = layout.file_inventory(r.spark, by_status(r))
    status = F.regexp_extract("file_path", PARTS, 1)
    unreferenced = layout.orphan_files(inventory, inventory.where(status != "P"))
    return unreferenced.groupBy(status.alias("order_status")).agg(F.sum("record_count").alias("records"))
