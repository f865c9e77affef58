"""Physical plans: what is pruned, pushed down, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import month_filter
from tallyhouse.operators import layout, ranking as rank, relational as rel, versions
from tallyhouse.plans import medallion, reports
from tallyhouse.session import fresh_path
from tests.conftest import final_plan


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_join_has_no_shuffle(spark, retail, no_broadcast):
    left, right = retail.orders.select("customer_id", "order_id"), retail.customers.select("customer_id", "name")
    assert shuffles(final_plan(left.join(right, "customer_id"))) >= 2
    a, b = rel.bucket_table(left, "customer_id", 4), rel.bucket_table(right, "customer_id", 4)
    assert shuffles(final_plan(rel.bucket_join(a, b, "customer_id"))) == 0
    assert shuffles(final_plan(rel.bucket_join(a, b, "customer_id", hot_share=0.5))) == 0


def test_bucketed_join_with_a_hot_key_is_split(spark, no_broadcast):
    hot = spark.range(900).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    names = spark.range(900).select(F.col("id").alias("k"), F.col("id").cast("string").alias("n"))
    a, b = rel.bucket_table(hot, "k", 4), rel.bucket_table(names, "k", 4)
    joined = rel.bucket_join(a, b, "k", hot_share=0.25)
    assert "_salt" in final_plan(joined)
    assert joined.count() == 900


def test_partition_pruning(spark, retail):
    path = fresh_path(spark, "by-month")
    dated = layout.with_year_month(retail.orders, "order_date", "transaction_year", "transaction_month")
    layout.write_partitioned(dated, path, ["transaction_year", "transaction_month"])
    stored = spark.read.parquet(path)
    filters = lambda df: re.search(r"PartitionFilters: \[(.*?)\]", final_plan(df)).group(1)
    assert "transaction_year" in filters(reports.tx_totals(stored, 1998, 3))
    assert filters(reports.tx_totals(stored)) == ""
    both = final_plan(stored.where(month_filter("order_date", 1998, 3, "transaction_year", "transaction_month")))
    assert re.search(r"PartitionFilters: \[.*transaction_month", both)
    assert re.search(r"PushedFilters: \[.*order_date", both)
    by_function = stored.where((F.year("order_date") == 1998) & (F.month("order_date") == 3))
    assert filters(by_function) == ""


def test_month_filter_in_december():
    text = str(month_filter("d", 1998, 12, "y", "m"))
    assert "1999" in text


def test_filters_and_columns_reach_the_scan(retail):
    plan = final_plan(rel.between_dates(retail.raw("orders"), "o_orderdate", "1998-01-01", "1999-01-01").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    viewed = final_plan(rel.between_dates(retail.orders, "order_timestamp", "1998-01-01", "1999-01-01"))
    assert "LessThan(o_orderdate" in viewed
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "o_totalprice" not in schema


def test_daily_sales_shuffles_no_amounts_per_customer(retail):
    silver = medallion.silver_orders(retail.orders.withColumn("order_status", F.lit(None).cast("string")))
    plan = final_plan(medallion.gold_daily_sales(silver))
    assert "Expand" not in plan
    pairs = re.search(r"Exchange hashpartitioning\(_day#\d+, customer_id#\d+L.*\n(.*\n.*)", plan)
    assert "total_amount" not in pairs.group(1).split("Project")[0]


def test_versions_fold_before_the_shuffle(retail):
    plan = final_plan(versions.as_of(retail.log, ["order_id"], version=5))
    assert "Window" not in plan and "partial_max_by" in plan
    assert shuffles(plan) == 1
    assert shuffles(final_plan(versions.diff(retail.log, ["order_id"], 3, 8))) == 1


def test_tops_never_sort_everything(retail):
    assert "TakeOrderedAndProject" in final_plan(rel.top_k(retail.orders, "total_amount", 5, "order_id"))
    ranked = final_plan(rank.rank_top(retail.orders, "total_amount", 5, "order_id"))
    assert "TakeOrderedAndProject" in ranked


def test_top_per_group_has_no_window(retail):
    plan = final_plan(rank.top_per_group(retail.customers, "state", "total_purchases"))
    assert "Window" not in plan


def test_lookup_join_checks_the_size(spark, retail, no_broadcast):
    small = retail.products.select("product_id", "category")
    assert rel.small_enough(small)
    assert "BroadcastHashJoin" in final_plan(rel.lookup_join(retail.items, small, "product_id"))
    assert not rel.small_enough(spark.range(1 << 40))
    large = spark.range(1 << 40).select(F.col("id").alias("product_id"))
    plan = final_plan(rel.lookup_join(retail.items, large, "product_id"))
    assert "BroadcastHashJoin" not in plan


def test_no_python_in_relational_plans(spark, retail):
    import __spark_entry__ as entry_points

    for name in ("e03_gold_daily_sales", "e12_customer_lifetime", "p12_line_total", "m06_merge_on_read"):
        plan = final_plan(entry_points.queries()[name](spark, retail.folder))
        assert "Python" not in plan
