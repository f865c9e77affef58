"""Hot keys: bucketed joins on either side, ranks of a value that many partitions hold."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import Window as W, functions as F

from tallyhouse.operators import ranking, relational as rel
from tests.conftest import final_plan, rows


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def side(spark, name, n=3000, hot=False, unnamed=0):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000) if hot else F.col("id") % 1000
    key = F.when(F.col("id") < unnamed, F.lit(None)).otherwise(key)
    return spark.range(n).select(key.cast("int").alias("k"), F.col("id").alias(name))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("left_hot,right_hot", [(True, False), (False, True), (True, True), (False, False)])
def test_bucket_join_with_hot_keys_on_either_side(spark, no_broadcast, how, left_hot, right_hot):
    left, right = side(spark, "l", 600, left_hot, 20), side(spark, "r", 450, right_hot, 9).where("k <> 11")
    a, b = rel.bucket_table(left, "k", 4), rel.bucket_table(right, "k", 4)
    got = rel.bucket_join(a, b, "k", how)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, left.join(right, "k", how).collect()))
    assert ("_salt" in final_plan(got)) == (left_hot or right_hot)


@pytest.mark.parametrize("hot_side", [0, 1])
def test_only_hot_rows_are_shuffled(spark, no_broadcast, hot_side):
    frames = [side(spark, "l", hot=hot_side == 0), side(spark, "r", 1000, hot=hot_side == 1)]
    joined = rel.bucket_join(*[rel.bucket_table(f, "k", 8) for f in frames], "k")
    plan = final_plan(joined)
    assert len(re.findall("Exchange hashpartitioning", plan)) == 2  # the hot part, once a side
    assert all("_salt" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 4 and sum("Bucketed: true" in line for line in scans) >= 2


@pytest.mark.parametrize("hot_side", [0, 1])
def test_hot_rows_spread_evenly(spark, hot_side):
    """A third of the rows on one key: no cell of the salted join holds much over its share."""
    many = spark.range(8000).select(F.lit(7).alias("k"), F.col("id").alias("x"))
    few = spark.range(4).select(F.lit(7).alias("k"), F.col("id").alias("y"))
    left, right = (many, few) if hot_side == 0 else (few, many)
    seen = rel.salted_pair(left, right, "k", "inner", 64).count()
    assert seen == 32_000
    columns = 1 << (64).bit_length() // 2
    dealt = many.groupBy(F.pmod(F.xxhash64("k", "x"), F.lit(64 // columns))).count().agg(F.max("count")).first()[0]
    assert dealt < 1.5 * 8000 / (64 // columns)


@pytest.mark.parametrize("hot_side", [0, 1])
def test_many_rows_that_meet_one_are_not_repeated(spark, monkeypatch, no_broadcast, hot_side):
    many = spark.range(8000).select(F.when(F.col("id") < 6000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    few = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("y"))
    frames = (many, few) if hot_side == 0 else (few, many)
    seen, shape = [], rel.salt_shape
    monkeypatch.setattr(rel, "salt_shape", lambda *a: seen.append((a[2:], shape(*a))) or shape(*a))
    joined = rel.bucket_join(*[rel.bucket_table(f, "k", 4) for f in frames], "k")
    assert joined.count() == 6000
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, columns = dict(seen)[(6000, 1) if hot_side == 0 else (1, 6000)]
    assert (rows, columns) == ((cells, 1) if hot_side == 0 else (1, cells))


def test_each_hot_key_has_cells_of_its_own(spark):
    """One key is hot on the left, one on the right, one on both, one is on one side alone."""
    sizes = [(1, 300, 1), (2, 2, 500), (3, 60, 50), (4, 40, 0), (5, 0, 30)]
    one, other = (
        spark.createDataFrame([(k, i) for k, *n in sizes for i in range(n[at])], f"k int, {name} int") for at, name in enumerate("xy")
    )
    assert sorted(rel.key_counts(one, other, "k")) == sizes
    for how in ("inner", "left"):
        got = rel.salted_pair(one, other, "k", how, 16, sizes)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, one.join(other, "k", how).collect()))
    assert [rel.salt_shape("inner", 16, *n) for _, *n in sizes] == [(16, 1), (1, 16), (4, 4), (16, 1), (1, 16)]
    assert rel.salt_shape("left", 16, 1, 500) == (16, 1)


def test_bucket_counts_come_from_bytes(spark):
    small, large = spark.range(10), spark.range(100_000)
    assert rel.bucket_count(small) == 1
    assert rel.bucket_count(small, large, target_bytes=100_000) == 8  # 800,000 bytes
    assert rel.bucket_count(large, target_bytes=99_999) == 16


def test_bucket_counts_of_joined_tables_and_long_texts(spark):
    """A lookup adds no bytes of its own; texts and lists count by their length, NULL for nothing."""
    lookup = spark.range(25).select(F.col("id").alias("n"), F.lit("name").alias("name"))
    joined = spark.range(100_000).join(lookup, F.col("id") % 25 == F.col("n")).select("id")
    assert rel.bucket_count(joined, target_bytes=100_000) == 8
    texts = spark.range(1000).select(F.when(F.col("id") < 900, F.lit("\u00e9" * 300)).alias("a.b"))
    assert rel.data_bytes(texts) == 540_000
    assert rel.data_bytes(spark.range(10).select(F.array("id").alias("a"))) == 10 * len('{"a":[1]}')
    assert rel.data_bytes(spark.range(0)) == 0


VALUES = {
    "ties": lambda i: i % 7, "one value": lambda i: 3, "NULLs": lambda i: None if i % 3 else i % 5,
    "all NULL": lambda i: None, "distinct": lambda i: i, "a run over many partitions": lambda i: 50 if 20 < i < 380 else i,
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("n", [0, 1, 400])
def test_percentiles_equal_the_window(spark, kind, n):
    frame = spark.createDataFrame([(i, VALUES[kind](i)) for i in range(n)], "id int, v int").repartition(5)
    order = W.orderBy(F.asc_nulls_last("v"))
    expected = frame.select(
        "id", "v", F.percent_rank().over(order).alias("percent_rank"),
        F.ntile(4).over(W.orderBy(F.asc_nulls_last("v"), "id")).alias("quartile"),
    )
    assert rows(ranking.percentiles(frame, "v", "id")) == rows(expected)


def test_percentiles_join_nothing_on_the_value(spark, no_broadcast):
    frame = spark.range(1000).select("id", F.lit(5).alias("v"))
    plan = final_plan(ranking.percentiles(frame, "v", "id"))
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("Join [_part" in line for line in joins)
    assert not re.search(r"hashpartitioning\(v#", plan)
