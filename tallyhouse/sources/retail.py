"""The retail tables, named and typed as the operators expect, over star-schema Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.expressions import money
from tallyhouse.sources.readers import read_parquet

FIRST_COMMIT_DAY = "2024-01-01"


class Retail:
    """Lazy views of one data folder. Every property is a plan; nothing is read here."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        """One row per customer with state and country. Some e-mails are NULL, some empty,
        some shared."""
        shared = F.concat(
            F.lit("user"), (F.col("c_custkey") % 997).cast("string"), F.lit("@"),
            F.lower("c_mktsegment"), F.lit(".example"),
        )
        email = F.when(F.col("c_custkey") % 10 != 0, shared).when(F.col("c_custkey") % 20 != 0, "")
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("name"),
                email.alias("email"),
                money("c_acctbal").alias("total_purchases"),
                F.col("c_mktsegment").alias("loyalty_tier"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
            )
        )

    @property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            money("o_totalprice").alias("total_amount"),
            F.col("o_orderpriority").alias("order_priority"),
            F.col("o_orderdate").alias("order_timestamp"),
        )

    @property
    def patchy_orders(self) -> DataFrame:
        """Orders with some keys, amounts and states of NULL, to reach the cleaning branches."""
        return self.orders.withColumns(
            {
                "customer_id": F.when(F.col("customer_id") % 13 != 5, F.col("customer_id")),
                "order_status": F.nullif("order_status", F.lit("P")),
                "total_amount": F.when(F.col("order_id") % 17 != 3, F.col("total_amount")),
            }
        )

    @property
    def items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("unit_price"),
            (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)").alias("discount_percent"),
            money("l_extendedprice").alias("line_total"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            money("p_retailprice").alias("price"),
            F.col("p_size").alias("stock_quantity"),
        )

    @property
    def log(self) -> DataFrame:
        """A change log of the orders: every order inserted in commits 1-5, some updated in 6-8,
        some deleted in 9, some of those inserted again in 10."""
        key = F.col("order_id")
        change = lambda commit, op, amount: F.struct(
            commit.cast("bigint").alias("commit_id"), F.lit(op).alias("op"),
            amount.cast("decimal(18,2)").alias("amount"),
        )
        amount = F.col("total_amount")
        changes = F.array_compact(
            F.array(
                change(key % 5 + 1, "I", amount),
                F.when(key % 7 == 0, change(key % 3 + 6, "U", amount + 10)),
                F.when(key % 11 == 0, change(F.lit(9), "D", amount)),
                F.when(key % 22 == 0, change(F.lit(10), "I", amount + 1)),
            )
        )
        day = F.date_add(F.lit(FIRST_COMMIT_DAY).cast("date"), F.col("_c.commit_id").cast("int"))
        return (
            self.orders.select(key, "customer_id", F.col("order_status").alias("status"),
                               "total_amount", F.explode(changes).alias("_c"))
            .select(
                "order_id", "customer_id", "status", F.col("_c.amount").alias("amount"),
                "_c.commit_id", day.cast("timestamp_ntz").alias("committed_at"), "_c.op",
            )
        )
