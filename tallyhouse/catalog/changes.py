"""Row-level change: insert, update, delete, merge, merge on read, copy on write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import query
from tallyhouse.operators import changes, layout
from tallyhouse.session import fresh_path
from tallyhouse.sources.retail import Retail

NEW_ID = 1_000_000_000
BASE_SQL = """base as (select customer_id, name, loyalty_tier, total_purchases from cust),
    supp as (select s_suppkey, s_name, cast(s_acctbal as decimal(18,2)) as balance from supplier)"""
RESULT = "customer_id, name, loyalty_tier, cast(total_purchases as double) as total_purchases"


def base(r: Retail) -> DataFrame:
    return r.customers.select("customer_id", "name", "loyalty_tier", "total_purchases")


def newcomers(r: Retail) -> DataFrame:
    """Suppliers as new customers."""
    return r.raw("supplier").select(
        (F.col("s_suppkey") + NEW_ID).alias("customer_id"),
        F.col("s_name").alias("name"),
        F.lit("SUPPLIER").alias("loyalty_tier"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("total_purchases"),
    )


def replacements(r: Retail) -> DataFrame:
    """Customers who also supply (same key in both tables), with the supplier's figures."""
    return r.raw("supplier").select(
        F.col("s_suppkey").alias("customer_id"),
        F.col("s_name").alias("name"),
        F.lit("SUPPLIER").alias("loyalty_tier"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("total_purchases"),
    )


@query(
    "m01_insert",
    f""", {BASE_SQL} select {RESULT} from base
        union all select s_suppkey + {NEW_ID}, s_name, 'SUPPLIER', cast(balance as double) from supp""",
    "cust",
)
def m01(r: Retail) -> DataFrame:
    return changes.insert(base(r), newcomers(r))


@query(
    "m02_update_where",
    """select customer_id, name, case when email <> '' and total_purchases > 5000 then 'PREMIUM'
              else loyalty_tier end as loyalty_tier,
              cast(case when email <> '' and total_purchases > 5000 then total_purchases + 100
                   else total_purchases end as double) as total_purchases, email from cust""",
    "cust",
)
def m02(r: Retail) -> DataFrame:
    rows = r.customers.select("customer_id", "name", "loyalty_tier", "total_purchases", "email")
    chosen = (F.col("email") != "") & (F.col("total_purchases") > 5000)
    return changes.update_where(
        rows, chosen, {"loyalty_tier": "PREMIUM", "total_purchases": F.col("total_purchases") + 100}
    )


@query(
    "m03_update_all",
    """select customer_id, name, 'INACTIVE' as loyalty_tier,
              cast(total_purchases as double) as total_purchases from cust""",
    "cust",
)
def m03(r: Retail) -> DataFrame:
    return changes.update_where(base(r), F.lit(True), {"loyalty_tier": "INACTIVE"})


@query(
    "m04_delete_where",
    """select order_id, order_status, cast(total_amount as double) as total_amount from patchy
       where not coalesce(total_amount > 250000 and order_status = 'F', false)""",
    "patchy",
)
def m04(r: Retail) -> DataFrame:
    rows = r.patchy_orders.select("order_id", "order_status", "total_amount")
    return changes.delete_where(
        rows, (F.col("total_amount") > 250_000) & (F.col("order_status") == "F")
    )


@query(
    "m05_merge",
    f""", {BASE_SQL},
        incoming as (select s_suppkey as k, s_name, balance from supp
                     union all select s_suppkey + {NEW_ID}, s_name, balance from supp)
        select coalesce(customer_id, k) as customer_id, coalesce(s_name, name) as name,
               case when k is not null then 'SUPPLIER' else loyalty_tier end as loyalty_tier,
               cast(coalesce(balance, total_purchases) as double) as total_purchases
        from base full outer join incoming on customer_id = k""",
    "cust",
)
def m05(r: Retail) -> DataFrame:
    return changes.merge(base(r), replacements(r).unionByName(newcomers(r)), ["customer_id"])


MOR_SQL = f""", {BASE_SQL}
    select {RESULT} from base
    where loyalty_tier <> 'BUILDING' and customer_id not in (select s_suppkey from supp)
    union all select s_suppkey, s_name, 'SUPPLIER', cast(balance as double) from supp"""


def deletions(r: Retail) -> DataFrame:
    return base(r).where(F.col("loyalty_tier") == "BUILDING").select("customer_id")


@query("m06_merge_on_read", MOR_SQL, "cust")
def m06(r: Retail) -> DataFrame:
    return changes.mor_read(base(r), deletions(r), replacements(r), ["customer_id"])


@query("m07_copy_on_write", MOR_SQL, "cust")
def m07(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "customers-by-tier")
    base(r).hint("rebalance", F.col("loyalty_tier")).write.partitionBy("loyalty_tier").parquet(path)
    upserts = replacements(r)
    deletes = base(r).join(deletions(r), "customer_id", "left_semi").join(
        upserts.select("customer_id"), "customer_id", "left_anti"
    )
    delta = upserts.withColumn("op", F.lit("U")).unionByName(deletes.withColumn("op", F.lit("D")))
    changes.cow_apply(r.spark, path, delta, ["customer_id"], "loyalty_tier")
    return r.spark.read.schema(base(r).schema).parquet(path)


@query(
    "m07_copy_on_write_nested",
    """select order_id, cast(total_amount as double) as total_amount,
              case when order_id % 40 = 7 then 2030 else year(order_date) end as y,
              case when order_id % 40 = 7 then 1 else month(order_date) end as m
       from (select order_id, order_date, case when month(order_date) = 2 and order_id % 3 = 0 or order_id % 40 = 7
                    then total_amount + 1 else total_amount end as total_amount from ord)
       where not (year(order_date) = 1995 and month(order_date) = 5)""",
    "ord",
)
def m07_nested(r: Retail) -> DataFrame:
    """Folders by year and month: rows change in place, some move to a month without a folder, one month goes."""
    path = fresh_path(r.spark, "orders-by-month")
    orders = layout.with_year_month(r.orders.select("order_id", "order_date", "total_amount"), "order_date")
    layout.write_partitioned(orders, path, ["y", "m"])
    moved = F.col("order_id") % 40 == 7
    gone = (F.col("y") == 1995) & (F.col("m") == 5)
    changed = (F.col("m") == 2) & (F.col("order_id") % 3 == 0)
    delta = orders.where(gone | moved | changed).select(
        "order_id", "order_date", (F.col("total_amount") + 1).cast("decimal(18,2)").alias("total_amount"),
        F.when(moved, 2030).otherwise(F.col("y")).alias("y"), F.when(moved, 1).otherwise(F.col("m")).alias("m"),
        F.when(gone, "D").otherwise("U").alias("op"),
    )
    changes.cow_apply(r.spark, path, delta, ["order_id"], ["y", "m"])
    return r.spark.read.parquet(path).select("order_id", "total_amount", "y", "m")


@query("m08_materialize", MOR_SQL, "cust")
def m08(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "customers")
    stored, deletes, upserts = changes.materialize(
        r.spark, base(r), deletions(r), replacements(r), ["customer_id"], path
    )
    return changes.mor_read(stored, deletes, upserts, ["customer_id"])
