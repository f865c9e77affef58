"""DML operators: NULL rules, equality of merge-on-read, merge and copy-on-write."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import changes
from tallyhouse.operators.constraints import Rules, add_column, check_constraints, with_defaults
from tallyhouse.session import fresh_path
from tests.conftest import SPARK_ERRORS, final_plan, rows

BASE = "k int, p string, v int"
ONCE = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = st.sets(st.integers(0, 12), max_size=8)


def base(spark):
    return spark.createDataFrame([(k, "abc"[k % 3], k * 10) for k in range(9)], BASE)


def test_null_predicates(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id int, v int")
    assert rows(changes.update_where(df, F.col("v") > 2, {"v": 0})) == [(1, 0), (2, None), (3, 1)]
    assert rows(changes.delete_where(df, F.col("v") > 2)) == [(2, None), (3, 1)]
    assert rows(changes.update_where(df, F.lit(True), {"v": 7})) == [(1, 7), (2, 7), (3, 7)]
    assert changes.update_where(df, F.lit(True), {"v": "7"}).schema == df.schema


def test_stamp_only_on_updated_rows(spark):
    df = spark.createDataFrame([(1, 5, "old"), (2, 1, "old")], "id int, v int, updated_at string")
    got = changes.update_where(df, F.col("v") > 2, {"v": 0}, ("updated_at", "new"))
    assert rows(got) == [(1, 0, "new"), (2, 1, "old")]


def test_merge_rules(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], BASE)
    new = spark.createDataFrame([(2, 20), (4, 40), (None, 50)], "k int, v int")
    assert rows(changes.merge(df, new, ["k"])) == sorted(
        [(1, "a", 1), (2, "b", 20), (None, "n", 3), (4, None, 40), (None, None, 50)], key=repr
    )
    twice = spark.createDataFrame([(2, 20), (2, 21)], "k int, v int")
    with pytest.raises(SPARK_ERRORS, match="more than one change"):
        changes.merge(df, twice, ["k"]).collect()


def test_merge_updates_every_base_row_of_a_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], BASE)
    new = spark.createDataFrame([(1, 9)], "k int, v int")
    assert rows(changes.merge(df, new, ["k"])) == [(1, "a", 9), (1, "b", 9)]


@ONCE
@given(KEYS, KEYS)
def test_three_ways_agree(spark, upserted, deleted):
    deleted = deleted - upserted
    ups = spark.createDataFrame([(k, "abd"[k % 3], k * 100) for k in upserted], BASE)
    dels = spark.createDataFrame([(k, None, None) for k in deleted], BASE)
    mor = rows(changes.mor_read(base(spark), dels, ups, ["k"]))
    merged = changes.merge(base(spark), ups, ["k"])
    gone = list(deleted) or [-1]
    assert rows(changes.delete_where(merged, F.col("k").isin(gone))) == mor
    path = fresh_path(spark, "cow")
    base(spark).write.partitionBy("p").parquet(path)
    delta = ups.withColumn("op", F.lit("U")).unionByName(dels.withColumn("op", F.lit("D")))
    changes.cow_apply(spark, path, delta, ["k"], "p")
    assert rows(spark.read.schema(BASE).parquet(path).select("k", "p", "v")) == mor
    stored, no_deletes, no_upserts = changes.materialize(
        spark, base(spark), dels, ups, ["k"], fresh_path(spark, "plain")
    )
    assert rows(stored) == mor and no_deletes.isEmpty() and no_upserts.isEmpty()


def test_cow_leaves_other_partitions_alone(spark):
    path = fresh_path(spark, "cow")
    base(spark).write.partitionBy("p").parquet(path)
    before = {r[0] for r in spark.read.parquet(path).where("p = 'c'").select("_metadata.file_path").collect()}
    delta = spark.createDataFrame([(0, "b", 1, "U"), (3, None, None, "D"), (6, None, None, "D")], BASE + ", op string")
    assert changes.cow_apply(spark, path, delta, ["k"], "p") == ["a", "b"]
    table = spark.read.schema(BASE).parquet(path)
    after = {r[0] for r in table.where("p = 'c'").select("_metadata.file_path").collect()}
    assert before == after
    assert rows(table.select("k", "p", "v")) == [
        (0, "b", 1), (1, "b", 10), (2, "c", 20), (4, "b", 40), (5, "c", 50), (7, "b", 70), (8, "c", 80)
    ]


def test_constraints(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, None, -1), (None, "c", None), (None, "c", 2)], "id int, t string, v int"
    )
    rules = Rules(
        not_null=["id"],
        checks={"positive": F.col("v") > 0, "listed": F.col("t").isin("a", "b")},
        unique={"id": ["id"], "t": ["t"]},
    )
    assert dict(map(tuple, check_constraints(df, rules).collect())) == {
        "not_null(id)": 2, "check(positive)": 1, "check(listed)": 2, "unique(id)": 1, "unique(t)": 1
    }


def test_defaults_and_new_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert rows(with_defaults(df, {"id": 9, "country": "USA"})) == [(1, "USA")]
    assert add_column(df, "flag", "boolean").schema["flag"].dataType.simpleString() == "boolean"
    assert rows(changes.insert(df, df)) == [(1,), (1,)]


def test_merge_inserts_every_change_with_a_null_key(spark):
    base = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(None, "x"), (None, "y"), (1, "b")], "id int, v string")
    got = changes.merge(base, new, ["id"])
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "b"), (None, "x"), (None, "y")]


def test_cow_apply_empties_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, 1, 5), (2, None, 6)], "id int, p int, v int").write.partitionBy("p").parquet(path)
    gone = spark.createDataFrame([(2, None, 6, "D")], "id int, p int, v int, op string")
    changes.cow_apply(spark, path, gone, ["id"], "p")
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]


@pytest.mark.parametrize("stamp", [None, ("updated_at", "now")])
def test_large_and_small_merges_agree(spark, monkeypatch, stamp):
    table = spark.createDataFrame(
        [(1, "a", 1, "old"), (1, "b", 2, "old"), (2, "c", 3, "old"), (None, "n", 4, "old")], "k int, p string, v int, updated_at string"
    )
    new = spark.createDataFrame([(1, 10), (3, None), (None, 5), (None, 6)], "k int, v int")
    small = rows(changes.merge(table, new, ["k"], stamp))
    monkeypatch.setattr(changes, "small_enough", lambda df: False)
    assert rows(changes.merge(table, new, ["k"], stamp)) == small and len(small) == 7
    twice = spark.createDataFrame([(2, 20), (2, 21)], "k int, v int")
    with pytest.raises(SPARK_ERRORS, match="more than one change"):
        changes.merge(table, twice, ["k"]).collect()


def test_a_large_merge_reads_the_base_once(spark):
    path = fresh_path(spark, "base")
    spark.range(100).selectExpr("id as k", "id as v").write.parquet(path)
    many = spark.range(1 << 40).selectExpr("id as k", "id + 1 as v")
    plan = final_plan(changes.merge(spark.read.parquet(path), many, ["k"]))
    assert plan.count("FileScan") == 1 and "FullOuter" in plan
    few = final_plan(changes.merge(spark.read.parquet(path), many.limit(3), ["k"]))
    assert "FullOuter" not in few
