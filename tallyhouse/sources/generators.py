"""Repeatable synthetic rows. Every value is arithmetic on an id, so a run can be repeated
row for row on any number of executors; nothing depends on task order or a random state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tallyhouse.functions.expressions import day, decode, instant, line_total
from tallyhouse.schemas import SCHEMAS

# Fixed values.
ORDER_STATUSES = {0: "PENDING", 1: "PROCESSING", 2: "SHIPPED"}
LAST_ORDER_STATUS = "DELIVERED"
PAYMENT_METHODS = {0: "CREDIT_CARD", 1: "DEBIT_CARD"}
LAST_PAYMENT_METHOD = "PAYPAL"
SHIPPING = {
    "shipping_address": "123 Shipping St",
    "shipping_city": "Sample City",
    "shipping_state": "ST",
    "shipping_zip": "12345",
}


def sequence(spark: SparkSession, first: int, last: int) -> DataFrame:
    """first..last, both included, spread over the executors."""
    return spark.range(first, last + 1).withColumnRenamed("id", "n")


def scatter(n: Column, seed: int, span: int) -> Column:
    """0..span-1 from an integer key: one multiply and one modulus, exact in any SQL engine."""
    mixed = F.pmod(n, F.lit(1_000_003)) * F.lit(7_919) + F.lit(seed * 104_729)
    return F.pmod(F.pmod(mixed, F.lit(1_000_003)) * F.lit(31) + F.lit(seed), F.lit(span))


def gen_orders(
    numbers: DataFrame, as_of: date | str, seed: int = 1, customers: int = 8, days: int = 91
) -> DataFrame:
    """One synthetic order per number: spread over customers 1..n and the last ``days`` days."""
    n = F.col(numbers.columns[0]).cast("bigint")
    offset = scatter(n, seed + 1, days).cast("int")
    return numbers.select(
        n.alias("order_id"),
        (scatter(n, seed, customers) + 1).alias("customer_id"),
        F.date_sub(day(as_of), offset).alias("order_date"),
        decode(scatter(n, seed + 2, 5), ORDER_STATUSES, LAST_ORDER_STATUS).alias("order_status"),
        (F.lit(5000) + scatter(n, seed + 3, 50_001)).cast("decimal(12,0)").alias("_cents"),
        decode(scatter(n, seed + 4, 4), PAYMENT_METHODS, LAST_PAYMENT_METHOD).alias("payment_method"),
        *[F.lit(value).alias(name) for name, value in SHIPPING.items()],
        F.date_sub(day(as_of), offset).cast("timestamp_ntz").alias("order_timestamp"),
    ).select(
        "order_id", "customer_id", "order_date", "order_status",
        (F.col("_cents") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)").alias("total_amount"),
        "payment_method", *SHIPPING, "order_timestamp",
    )


def first_of_each(df: DataFrame, group: str, by: str, limit: int) -> DataFrame:
    """At least the first ``limit`` rows of every group in the order of ``by``; every task hands on at most so many
    of a group, whatever the limit (Spark's own cut inside tasks ends at 1000). Both columns are integers without NULL."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kept = [], 0, 0

        def cut() -> pa.Table:
            table = pa.Table.from_batches(held).sort_by([(group, "ascending"), (by, "ascending")])
            classes = table[group].to_numpy()
            place = np.arange(len(classes)) - np.searchsorted(classes, classes)
            return table.filter(pa.array(place < limit))

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > max(100_000, 2 * kept):  # twice what is kept at most, so the sorting stays in proportion
                held = cut().to_batches()
                size = kept = sum(b.num_rows for b in held)
        if held:
            yield from cut().to_batches()

    return df.mapInArrow(fold, df.schema)


def gen_order_items(
    orders: DataFrame, products: DataFrame, limit: int = 500, kept: int = 3, of: int = 10, seed: int = 1
) -> DataFrame:
    """Line items from pairing orders with products: the share kept/of of all pairs, the first
    ``limit`` of them by (order_id, product_id). Limit is the feature here (a sized sample).

    The pairs are never all formed. A pair is kept when (order_id * 7 + product_id + seed) mod
    ``of`` is below ``kept``, so each order meets exactly ``kept`` residue classes of products.
    The first ``limit`` pairs can use only the first ``limit`` orders that have any match and,
    per residue class, only the first ``limit`` products. Both sides are cut to that before
    they are joined on the class, so the join sees at most limit * kept * limit rows. The cut per
    class is folded inside each task, before the shuffle.
    """
    residue = F.pmod(F.col("product_id") + F.lit(seed), F.lit(of))
    classed = products.select("product_id", "price", residue.alias("_class"))
    first_products = first_of_each(classed.where(F.col("_class").isNotNull()), "_class", "product_id", limit).withColumn(
        "_place", F.row_number().over(W.partitionBy("_class").orderBy("product_id"))
    ).where(F.col("_place") <= limit).drop("_place")
    wanted = F.transform(
        F.sequence(F.lit(0), F.lit(kept - 1)),
        lambda k: F.pmod(k - F.pmod(F.col("order_id") * 7, F.lit(of)), F.lit(of)),
    )
    filled = F.collect_set("_class")
    present = classed.select("_class").distinct().agg(filled.alias("classes")).scalar()
    first_orders = (
        orders.select("order_id", "order_timestamp", wanted.alias("_wanted"))
        .where(F.arrays_overlap("_wanted", present))
        .orderBy("order_id")
        .limit(limit)
    )
    pairs = (
        first_orders.select("order_id", "order_timestamp", F.explode("_wanted").alias("_class"))
        .join(first_products, "_class")
        .orderBy("order_id", "product_id")
        .limit(limit)
    )
    n = F.col("order_id") * 131 + F.col("product_id")
    quantity = (scatter(n, seed, 5) + 1).cast("int")
    percent = (scatter(n, seed + 1, 2001).cast("decimal(6,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(5,2)"
    )
    place = F.row_number().over(W.orderBy("order_id", "product_id"))  # over at most ``limit`` rows
    return pairs.select(
        place.cast("bigint").alias("order_item_id"),
        "order_id",
        "product_id",
        quantity.alias("quantity"),
        F.col("price").alias("unit_price"),
        percent.alias("discount_percent"),
        line_total("price", quantity, percent).alias("line_total"),
        F.col("order_timestamp").alias("created_timestamp"),
    )


def gen_batch(
    numbers: DataFrame, commit_id: int | Column, payload_bytes: int, stamp: datetime | str
) -> DataFrame:
    """A sized batch: one row per number with a fixed-length payload.

    ``spark.range(0, rows, 1, parts)`` is the usual source of the numbers and sets the number
    of files the batch is written as.
    """
    commit = commit_id if isinstance(commit_id, Column) else F.lit(commit_id)
    return numbers.select(
        commit.cast("int").alias("commit_id"),
        F.col(numbers.columns[0]).cast("bigint").alias("row_id"),
        F.rpad(F.lit("x"), payload_bytes, "x").alias("payload"),
        instant(stamp).alias("ts"),
    )


def append_commits(path: str, batches: Iterable[DataFrame]) -> int:
    """Append batch after batch, one write each; returns how many were written."""
    written = 0
    for batch in batches:
        batch.select(*SCHEMAS["bulk_rows"].names).write.mode("append").parquet(path)
        written += 1
    return written


def commit_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("commit_id").agg(F.count("*").alias("rows"))


def expected_vs_actual(df: DataFrame, expected: int) -> DataFrame:
    actual = F.count("*")
    return df.agg(
        F.lit(expected).cast("bigint").alias("expected_rows"),
        actual.alias("actual_rows"),
        (actual == expected).alias("matches"),
    )
