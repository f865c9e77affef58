"""Results on the sample customers and orders that are known beforehand."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import amount_category
from tallyhouse.operators import aggregates as agg
from tallyhouse.operators.relational import duplicates
from tallyhouse.plans import medallion, reports
from tests.conftest import rows


def test_overall_figures(customers):
    r = agg.describe_value(customers, "total_purchases").first()
    assert (r.row_count, r.total) == (30, Decimal("414836.20"))
    assert (r.minimum, r.maximum) == (Decimal("5420.30"), Decimal("31250.75"))
    assert round(r.average, 2) == 13827.87
    assert round(r.std_deviation, 2) == 6923.22
    assert r["median"] == pytest.approx(12170.15)


def test_figures_by_tier(customers):
    got = {r.loyalty_tier: r for r in agg.describe_value(customers, "total_purchases", ["loyalty_tier"]).collect()}
    expected = {
        "Bronze": (4, 6080.36, "5420.30", "6780.50"),
        "Silver": (9, 8755.07, "7230.90", "10560.80"),
        "Gold": (12, 15185.49, "11230.60", "19670.85"),
        "Platinum": (5, 25898.65, "21890.35", "31250.75"),
    }
    for tier, (count, average, low, high) in expected.items():
        r = got[tier]
        assert (r.row_count, r.minimum, r.maximum) == (count, Decimal(low), Decimal(high))
        assert r.average == pytest.approx(average, abs=0.0051)


def test_purchase_segments(customers):
    got = {r.customer_segment: r for r in agg.segment_share(customers, "total_purchases").collect()}
    assert {k: r.row_count for k, r in got.items()} == {
        "High Value": 5, "Medium Value": 13, "Low Value": 12
    }
    assert sum(r.percentage for r in got.values()) == pytest.approx(100)


def test_tier_checks(customers):
    wrong = reports.tier_mismatches(customers).select("customer_id")
    assert [r[0] for r in rows(wrong)] == [
        1002, 1004, 1007, 1009, 1010, 1012, 1014, 1015, 1018, 1019, 1025, 1026, 1027, 1030
    ]
    near = reports.upgrade_candidates(customers).select("customer_id", "next_tier", "amount_needed")
    assert rows(near) == [
        (1006, "Platinum", Decimal("1249.40")),
        (1017, "Platinum", Decimal("549.80")),
        (1028, "Platinum", Decimal("329.15")),
    ]


def test_orders_by_month(orders):
    got = reports.monthly_revenue(orders).select("month", "row_count", "total")
    assert rows(got) == [
        ("2024-01", 16, Decimal("8629.78")),
        ("2024-02", 29, Decimal("6349.65")),
        ("2024-03", 5, Decimal("559.95")),
    ]


def test_amount_bands(orders):
    got = orders.groupBy(amount_category("total_amount").alias("band")).count()
    assert dict(map(tuple, got.collect())) == {"LOW": 24, "MEDIUM": 19, "HIGH": 2, "PREMIUM": 5}


def test_segments_and_gold(orders):
    silver = medallion.silver_orders(medallion.bronze_orders(orders, "samples", "2024-03-06"))
    segments = medallion.gold_customer_segments(silver)
    got = reports.segment_report(segments).select("customer_segment", "customer_count", "total_revenue")
    assert rows(got) == [
        ("NEW", 20, Decimal("4079.67")),
        ("PREMIUM", 1, Decimal("2679.97")),
        ("REGULAR", 9, Decimal("8779.74")),
    ]
    daily = medallion.gold_daily_sales(silver)
    assert daily.agg(F.sum("total_revenue"), F.sum("total_orders")).first()[:2] == (Decimal("15539.38"), 50)


def test_silver_drops_bad_rows(spark):
    data = [
        (1, 1, None, "F", "10.00"), (None, 1, None, "F", "10.00"), (2, None, None, "F", "10.00"),
        (3, 1, None, None, "0.00"), (4, 1, None, None, None), (5, 1, None, None, "1000.00"),
        (6, 1, None, "", "-1.00"), (7, 1, None, "", "100.00"),
    ]
    raw = spark.createDataFrame(
        data, "order_id int, customer_id int, order_date date, order_status string, amount string"
    ).withColumn("total_amount", F.col("amount").cast("decimal(10,2)"))
    got = medallion.silver_orders(raw).select("order_id", "order_status_clean", "amount_category")
    assert rows(got) == [(1, "F", "LOW"), (5, "UNKNOWN", "PREMIUM"), (7, "", "MEDIUM")]


def test_no_duplicates_in_keys(customers, orders):
    assert duplicates(customers, ["customer_id"]).isEmpty()
    assert duplicates(orders, ["order_id"]).isEmpty()


def test_kpis_of_nothing(spark):
    daily = spark.createDataFrame([], "daily_revenue decimal(18,2), order_count bigint")
    segments = spark.createDataFrame([], "customer_count bigint")
    r = agg.kpis(daily, segments).first()
    assert (r.total_revenue, r.avg_daily_revenue, r.avg_order_value) == (None, None, 0.0)


def test_customers_without_orders(spark):
    who = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y")], "customer_id int, state string, country string")
    bought = spark.createDataFrame(
        [(10, 1, "2024-01-01", "5.00"), (11, 1, "2024-01-02", "7.00")],
        "order_id int, customer_id int, d string, a string",
    ).select("order_id", "customer_id", F.col("d").cast("date").alias("order_date"),
             F.col("a").cast("decimal(10,2)").alias("total_amount"))
    from tallyhouse.operators.relational import customer_summary, left_join_stats

    got = {r.customer_id: r for r in customer_summary(who, bought).collect()}
    assert (got[1].order_count, got[1].avg_order_value) == (2, 6.0)
    assert (got[2].order_count, got[2].total_spent, got[2].avg_order_value) == (0, None, None)
    filled = {r.customer_id: r for r in left_join_stats(who, bought, fill=0).collect()}
    assert (filled[2].order_count, filled[2].total_spent) == (0, Decimal("0.00"))
    regions = reports.regional_revenue(who, bought, 0)
    assert [r.country for r in regions.collect()] == ["X"]


def test_customer_analysis_and_profile(spark, orders):
    from tallyhouse.session import fresh_name

    who = orders.select("customer_id").distinct().withColumns({"state": F.lit("S"), "country": F.lit("C")})
    result = reports.customer_analysis(who, orders, fresh_name("summary"), k=3)
    assert result["summary"].count() == 30
    assert [r.customer_id for r in result["top_customers"].collect()] == [1011, 1001, 1020]
    state = result["by_state"].first()
    assert state.customer_count == 30
    assert state.weighted_order_value == pytest.approx(15539.38 / 50)
    assert reports.sample_profile(spark, "no_such_table", 5) == {"exists": False}
    name = fresh_name("profile")
    orders.createOrReplaceTempView(name)
    profile = reports.sample_profile(spark, name, 5)
    assert profile["rows"] == 50 and profile["sample"].count() == 5
    first = reports.sample_profile(spark, name, 2, order=["order_id"])["sample"].collect()
    lowest = [r.order_id for r in orders.orderBy("order_id").limit(2).collect()]
    assert [json.loads(r.json)["order_id"] for r in first] == lowest


def test_layers(spark, orders):
    from tallyhouse.session import fresh_path

    counts = medallion.run_layers(spark, orders, fresh_path(spark, "layers"), "samples", "2024-03-06")
    assert dict(map(tuple, counts.collect())) == {
        "bronze_orders": 50, "silver_orders": 50, "gold_daily_sales": 50, "gold_customer_segments": 30
    }
