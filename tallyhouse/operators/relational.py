"""Filters, joins, sorts and limits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.expressions import as_column, day, in_range, rank_of
from tallyhouse.operators.ordering import number_rows
from tallyhouse.session import fresh_name, fresh_path


# --- filters ----------------------------------------------------------------

def between_dates(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Rows with low <= date < high; both bounds reach the Parquet scan."""
    return df.where(in_range(column, day(low), day(high)))


def last_days(df: DataFrame, column: str, days: int, as_of: date | str | None = None) -> DataFrame:
    """Rows of the last ``days`` days. Without ``as_of`` the newest date in the data counts as
    today, so the result can be repeated."""
    today = day(as_of) if as_of is not None else df.agg(F.max(column)).scalar()
    return df.where(F.col(column) >= F.date_sub(today, days))


# --- hot keys ---------------------------------------------------------------

def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list[Any]:
    """Keys holding about ``share`` of the rows or more, NULL among them.

    One pass over one column; tasks send bounded sketches, and at most 1/share keys come back.
    """
    wanted = max(1, math.ceil(1 / share))
    top, total = df.select(F.col(key).alias("k")).agg(
        F.expr(f"approx_top_k(k, {wanted}, {max(10_000, 10 * wanted)})"), F.count("*")
    ).first()
    return [item["item"] for item in top or [] if item["count"] >= share * total]


def split_join(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner", salts: int | None = None,
    share: float = 0.01,
) -> DataFrame:
    """Equi-join whose hot keys are spread over ``salts`` tasks, by default all shuffle partitions.

    Rows of a hot key, NULL included, get a salt from a hash of the row; the matching lookup rows
    (one per key in a lookup table) are repeated once per salt, for at most 1/share keys. All
    other keys keep salt 0, so nothing else is copied. Which keys count as hot changes only the
    routing, never the result. The list of hot keys is fetched first because both sides must see
    the very same list. The salt is repeatable, so a recomputed task sends the same rows to the
    same place; rows equal in every column share it, and adaptive execution may split those.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = hot_keys(facts, key, share)
    if not found:
        return facts.join(lookup, key, how)
    hot = [k for k in found if k is not None]
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    left = facts.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), spread).otherwise(0))
    right = lookup.withColumn(
        "_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


# --- joins ------------------------------------------------------------------

def order_stats(orders: DataFrame) -> DataFrame:
    """Per customer: count, total, last date. Aggregating before the join means a customer with
    a third of all orders is folded to one row per task before anything is shuffled."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("total_amount").alias("total_spent"),
        F.max("order_date").alias("last_order_date"),
    )


def mean(total: Column | str, count: Column | str) -> Column:
    """Total / count as DOUBLE; NULL for a zero count."""
    return F.try_divide(as_column(total).cast("double"), as_column(count))


def customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with order figures; without orders the count is 0 and the rest NULL."""
    joined = customers.join(order_stats(orders), "customer_id", "left")
    count = F.coalesce("order_count", F.lit(0))
    return joined.select(
        *customers.columns,
        count.alias("order_count"),
        "total_spent",
        mean("total_spent", count).alias("avg_order_value"),
        "last_order_date",
    )


def left_join_stats(customers: DataFrame, orders: DataFrame, fill: Any = None) -> DataFrame:
    """Customers joined to an aggregated order table; missing figures stay NULL or become ``fill``."""
    stats = orders.groupBy("customer_id").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("total_spent")
    )
    joined = customers.join(stats, "customer_id", "left")
    if fill is None:
        return joined
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(fill)) for c in ("order_count", "total_spent")}
    )


def top_products(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers by revenue. Products sharing name, category and brand are one line.

    Every line gets its smallest product id as a short key. The sums fold inside every task. The
    exact count of distinct orders is taken on its own: its shuffle carries (line, order) pairs
    of numbers only and spreads a product sold in a third of all items over its orders.
    """
    line = ["product_name", "category", "brand"]
    lines = products.groupBy(*line).agg(F.min("product_id").alias("_line"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"l.{c}")) for c in line]
    line_of = products.alias("p").join(lines.alias("l"), same).select("p.product_id", "l._line")
    columns = ("product_id", "order_id", "quantity", "line_total", "unit_price")
    sold = lookup_join(items.select(*columns), line_of, "product_id")
    sums = sold.groupBy("_line").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("line_total").alias("total_revenue"),
        mean(F.sum("unit_price"), F.count("unit_price")).alias("avg_unit_price"),
    )
    order_counts = (
        sold.select("_line", "order_id").distinct()
        .groupBy("_line")
        .agg(F.count("order_id").alias("order_count"))
    )
    totals = sums.join(order_counts, "_line")
    named = lines.join(totals, "_line").select(
        *line, "order_count", "total_quantity_sold", "total_revenue", "avg_unit_price"
    )
    return named.orderBy(F.desc_nulls_last("total_revenue"), *line).limit(k)


def sales_transactions(
    orders: DataFrame, items: DataFrame, item_order: Sequence[str] = ("order_item_id",)
) -> DataFrame:
    """Every line item with its order's customer and date, numbered by (order, item order).

    ``item_order`` are the columns that put the items of one order into a fixed sequence.

    An order holding a third of all items is split by ``split_join``; the numbering is done by
    range, so no task sees more than its share.
    """
    wanted = ["order_id", "product_id", "quantity", "unit_price", "line_total"]
    joined = split_join(
        items.select(*dict.fromkeys([*wanted, *item_order])),
        orders.select("order_id", "customer_id", "order_date", "order_timestamp"),
        "order_id",
    )
    numbered = number_rows(joined, ["order_id", *item_order], "transaction_id")
    return numbered.select(
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price",
        F.col("line_total").alias("total_amount"),
        F.col("order_date").alias("transaction_date"),
        F.year("order_date").alias("transaction_year"),
        F.month("order_date").alias("transaction_month"),
        F.col("order_timestamp").alias("transaction_timestamp"),
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent. Parent keys are made distinct first."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def small_enough(df: DataFrame, limit_bytes: int = 32 << 20) -> bool:
    """Whether Catalyst's own size estimate of a plan is within a broadcast budget."""
    return plan_bytes(df) <= limit_bytes


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join with a broadcast hint when the lookup is small enough, else with hot keys split."""
    if small_enough(lookup):
        return facts.join(F.broadcast(lookup), key, how)
    return split_join(facts, lookup, key, how)


BUCKET_BYTES = 128 << 20
WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def value_bytes(field: T.StructField) -> Column:
    """Bytes of a column's value: text and binary by length, nested values by their JSON, others by type."""
    value = F.col("`" + field.name.replace("`", "``") + "`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    if isinstance(kind, T.DecimalType):
        return F.lit(8 if kind.precision <= 18 else 16)
    return F.lit(WIDTHS.get(type(kind), 8))


def data_bytes(df: DataFrame) -> int:
    """Bytes of a plan's rows, summed in one pass over them.

    Catalyst's estimate multiplies the sizes of joined tables: a lookup of two kilobytes makes a table
    look two thousand times as large.
    """
    width = F.lit(0).cast("bigint")
    for field in df.schema:
        width = width + value_bytes(field)
    return df.agg(F.sum(width)).first()[0] or 0


def bucket_count(*frames: DataFrame, target_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that will be joined with each other: a power of two, so that the largest
    table's buckets are about ``target_bytes``, and tables with other powers still fit together.
    Every table is read once for it."""
    wanted = max(-(-data_bytes(df) // target_bytes) for df in frames)
    return 1 << max(0, wanted - 1).bit_length()


def bucket_table(df: DataFrame, key: str, buckets: int | None = None, label: str = "bucketed") -> DataFrame:
    """A table hashed into buckets by ``key`` and sorted by it inside each file.

    ``buckets`` comes from the table's size where it is not given; tables to be joined need the same
    number (``bucket_count`` over all of them). Rows are first brought together per bucket, so a bucket is one
    file rather than one file per task; a bucket too large for one task is split into several files.
    """
    spark = df.sparkSession
    name = fresh_name(label)
    buckets = buckets or bucket_count(df)
    (
        df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        .hint("rebalance", F.col("_bucket"))
        .drop("_bucket")
        .write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", fresh_path(spark, name))
        .saveAsTable(name)
    )
    return spark.table(name)


def salt_shape(how: str, cells: int, lefts: int = 1, rights: int = 1) -> tuple[int, int]:
    """Rows and columns of the cells for a key with so many rows on either side: about ``cells`` in all, with the
    fewest copies, ``lefts * columns + rights * rows``. For a left join the right side is only repeated, never
    dealt: otherwise a left row would be unmatched in some of its cells."""
    best = math.sqrt(cells * max(1, rights) / max(1, lefts))
    columns = 1 if how == "left" else min(cells, max(1, round(best)))
    return max(1, cells // columns), columns


def key_counts(left: DataFrame, right: DataFrame, key: str) -> list[tuple[Any, int, int]]:
    """Rows per key on either side; for tables of a few keys."""
    one = left.select(key, F.lit(1).alias("_left"), F.lit(0).alias("_right"))
    other = right.select(key, F.lit(0).alias("_left"), F.lit(1).alias("_right"))
    counted = one.unionByName(other).groupBy(key).agg(F.sum("_left"), F.sum("_right"))
    return [tuple(row) for row in counted.collect()]


def salted_pair(
    left: DataFrame, right: DataFrame, key: str, how: str, cells: int, counts: Sequence[tuple[Any, int, int]] = ()
) -> DataFrame:
    """Join of rows of a few hot keys, where either side may hold many rows of a key.

    Left rows get one of ``rows`` numbers and right rows one of ``columns`` numbers, each from a hash of the
    row; a left row is repeated for all columns and a right row for all rows. Every pair meets in one of
    about ``cells`` cells per key. With ``counts`` (``key_counts``) the cells of a key follow its rows on either
    side: many rows that meet a single one are dealt and not repeated. Without, both sides count alike.
    """
    shapes: dict[tuple[int, int], list[Any]] = {}
    for value, lefts, rights in counts:
        shapes.setdefault(salt_shape(how, cells, lefts, rights), []).append(value)
    rows, columns = map(F.lit, salt_shape(how, cells))
    for (high, wide), values in shapes.items():
        rows = F.when(F.col(key).isin(values), high).otherwise(rows)
        columns = F.when(F.col(key).isin(values), wide).otherwise(columns)
    dealt = lambda df, n: F.pmod(F.xxhash64(*df.columns), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    one = left.withColumn("_salt", dealt(left, rows)).withColumn("_salt2", every(columns))
    other = right.withColumn("_salt2", dealt(right, columns)).withColumn("_salt", every(rows))
    return one.join(other, [key, "_salt", "_salt2"], how).drop("_salt", "_salt2")


def bucket_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot_share: float | None = 0.05
) -> DataFrame:
    """Join of two tables bucketed alike: no shuffle on either side.

    A bucket is read by one task, which is wrong for a key that fills a bucket by itself. Both sides are
    looked at first (one pass over each key column, bounded sketches). Rows of keys that hold
    ``hot_share`` of a side leave their buckets, on both sides, and are joined salted; the keys are sorted in their
    files, so that part reads little else; for an inner join their rows are counted, so that only the fewer ones are
    repeated. All other rows stay in their buckets and are not shuffled.
    ``hot_share=None`` does not look.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    found = [] if hot_share is None else sorted({
        k for side in (left, right) for k in hot_keys(side, key, hot_share) if k is not None
    })
    # A NULL key matches nothing. An inner join drops it; in a left join its rows are kept without a join.
    lost = left.where(F.col(key).isNull()) if how == "left" else None
    cold_left, cold_right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    if found:
        hot = F.col(key).isin(found)  # at most 1 / hot_share keys of each side
        cold_left, cold_right = cold_left.where(~hot), cold_right.where(~hot)
    joined = cold_left.hint("merge").join(cold_right, key, how)
    if found:
        cells = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot_left, hot_right = left.where(hot), right.where(hot)
        counts = key_counts(hot_left, hot_right, key) if how == "inner" else ()
        joined = joined.unionByName(salted_pair(hot_left, hot_right, key, how, cells, counts))
    if lost is not None:
        types = {f.name: f.dataType for f in right.schema}
        joined = joined.unionByName(lost.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in right.columns if c != key]))
    return joined


# --- sorts and limits -------------------------------------------------------

def top_k(df: DataFrame, by: str, k: int, *tie_breakers: str) -> DataFrame:
    """The k largest; every task keeps only its own k before the final merge."""
    return df.orderBy(F.desc_nulls_last(by), *tie_breakers).limit(k)


def order_by_rank(df: DataFrame, column: str, ordered: Sequence[Any], *then: str) -> DataFrame:
    """Sort by the place of a value in a fixed list; values not listed come last."""
    return df.orderBy(rank_of(column, ordered).asc_nulls_last(), *then)


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
