"""Global numbering, medians, percentiles and tops, also on heavily skewed values."""

from __future__ import annotations

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import aggregates as agg, ranking as rank, relational as rel
from tallyhouse.operators.ordering import number_rows
from tests.conftest import rows

ONCE = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(spark, n=3000, seed=3):
    """A third of all rows share one group and one value."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        if i % 3 == 0:
            data.append((i, "hot", 50))
        else:
            data.append((i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(1, 40)])))
    return spark.createDataFrame(data, "id int, grp string, v int"), data


def test_number_rows(spark):
    df, data = skewed(spark)
    got = number_rows(df, [F.asc_nulls_last("v"), "id"], "n").select("id", "n").collect()
    expected = sorted(data, key=lambda r: (r[2] is None, r[2] or 0, r[0]))
    assert {r.id: r.n for r in got} == {r[0]: i for i, r in enumerate(expected, 1)}


def test_number_rows_of_nothing(spark):
    empty = spark.createDataFrame([], "id int")
    assert number_rows(empty, ["id"]).count() == 0


@ONCE
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40))
def test_median_of_anything(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    present = [v for v in values if v is not None]
    got = agg.exact_median(df, "v").collect()
    if present:
        assert got[0]["median"] == pytest.approx(statistics.median(present))
    else:
        assert [r["median"] for r in got] in ([], [None])


def test_median_per_group(spark):
    df, data = skewed(spark)
    got = {r.grp: r["median"] for r in agg.exact_median(df, "v", ["grp"]).collect()}
    for group in ("hot", "a", "b", "c", None):
        values = [v for _, g, v in data if g == group and v is not None]
        assert got[group] == statistics.median(values)


def test_describe_groups_with_null_key(spark):
    df, _ = skewed(spark)
    got = agg.describe_value(df.withColumn("v", F.col("v").cast("decimal(18,2)")), "v", ["grp"])
    assert got.count() == 5
    assert got.where(F.col("median").isNull()).isEmpty()


def test_percentiles(spark):
    df, data = skewed(spark, 200)
    got = {r.id: (r.percent_rank, r.quartile) for r in rank.percentiles(df, "v", "id").collect()}
    ordered = sorted(data, key=lambda r: (r[2] is None, r[2] or 0, r[0]))
    first = {}
    for i, r in enumerate(ordered):
        first.setdefault(r[2], i)
    for i, r in enumerate(ordered):
        assert got[r[0]][0] == pytest.approx(first[r[2]] / 199)
        assert got[r[0]][1] == i // 50 + 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 9])
def test_ntile_like_sql(spark, n):
    df = spark.range(1, n + 1)
    df.createOrReplaceTempView("few")
    expected = rows(spark.sql("select id, ntile(4) over (order by id) t from few"))
    got = df.select("id", rank.ntile_of(F.col("id"), F.lit(n), 4).alias("t"))
    assert rows(got) == expected


def test_top_per_group_keeps_ties(spark):
    data = [("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, 1), (None, 5, 9), (None, 6, 9), ("c", 7, None)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    got = rank.top_per_group(df, "g", "v")
    assert sorted(r.id for r in got.collect()) == [1, 2, 4, 5, 6, 7]


def test_rank_top_with_ties_at_the_edge(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 8, 8, 8, 7])], "id int, v int")
    got = rank.rank_top(df, "v", 4, "id").orderBy("row_num").collect()
    assert [(r.id, r.purchase_rank, r.dense_rank, r.row_num) for r in got] == [
        (0, 1, 1, 1), (1, 1, 1, 2), (2, 3, 2, 3), (3, 3, 2, 4)
    ]


def test_running_and_rolling(spark):
    days = spark.createDataFrame([(d, d * 10) for d in range(1, 10)], "day int, daily_value int")
    totals = rank.running_total(days).orderBy("day").collect()
    assert totals[-1].running_total == sum(range(10, 100, 10))
    rolling = rank.rolling_mean(days, 7).orderBy("day").collect()
    assert [r.rolling_mean for r in rolling] == [None] * 6 + [40.0, 50.0, 60.0]
    moving = rank.moving_avg(days, 3).orderBy("day").collect()
    assert [r.moving_avg for r in moving][:3] == [10.0, 15.0, 20.0]


def test_shares_sum_to_hundred(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4)], "g string, v int")
    assert rank.share_of_total(groups, "v").agg(F.sum("percentage")).first()[0] == pytest.approx(100)


def test_split_join_equals_join(spark):
    df, _ = skewed(spark)
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("z", 4)], "grp string, w int")
    assert "hot" in rel.hot_keys(df, "grp") and None in rel.hot_keys(df, "grp")
    assert rel.hot_keys(df, "grp", 0.3) == ["hot"]
    assert rel.hot_keys(df, "id") == []
    for how in ("inner", "left"):
        assert rows(rel.split_join(df, lookup, "grp", how, salts=5)) == rows(df.join(lookup, "grp", how))


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    assert [r.id for r in rel.orphans(child, parent, "k", "pk").collect()] == [3]


def test_order_by_rank_and_top_k(spark):
    df = spark.createDataFrame([("x", 1), ("b", None), ("a", 3), ("b", 3)], "t string, v int")
    assert [r.t for r in rel.order_by_rank(df, "t", ["a", "b"], "v").collect()] == ["a", "b", "b", "x"]
    assert [r.t for r in rel.top_k(df, "v", 2, "t").collect()] == ["a", "b"]


def test_top_products_counts_shared_orders_once(spark):
    items = spark.createDataFrame(
        [(1, 10, 1, 2.0, 2.0), (1, 11, 1, 3.0, 3.0), (2, 10, 2, 4.0, 2.0)],
        "order_id int, product_id int, quantity int, line_total double, unit_price double",
    )
    products = spark.createDataFrame(
        [(10, "p", "c", "b"), (11, "p", "c", "b")],
        "product_id int, product_name string, category string, brand string",
    )
    r = rel.top_products(items, products, 5).first()
    assert (r.order_count, r.total_quantity_sold, r.total_revenue) == (2, 4, 9.0)
