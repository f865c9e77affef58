"""Versions read with the columns of their time."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import schema_log as sl
from tests.conftest import rows

START = datetime(2024, 1, 1)


def evolved(spark):
    log = sl.first_schema(spark, 1, {"amount": "int", "status": "string"})
    log = sl.alter(log, 3, add={"note": "string"})
    log = sl.alter(log, 4, rename={"status": "state"}, widen={"amount": "bigint"})
    return sl.alter(log, 6, drop=["note"], add={"status": "int"})


def changes(spark, schema):
    """One commit a day; each names its columns as they were then."""
    commits = [
        (1, "k int, amount int, status string", [(1, 10, "new"), (2, 20, "new")], "I"),
        (2, "k int, amount int, status string", [(1, 11, "paid")], "U"),
        (3, "k int, amount int, status string, note string", [(3, 30, "new", "gift")], "I"),
        (4, "k int, amount bigint, state string, note string", [(2, 1 << 40, "paid", None)], "U"),
        (5, "k int, amount bigint, state string, note string", [(1, 0, None, None)], "D"),
        (6, "k int, amount bigint, state string, status int", [(4, 7, "new", 99)], "I"),
    ]
    out = None
    for commit, columns, data, op in commits:
        frame = spark.createDataFrame(data, columns).withColumns({
            "commit_id": F.lit(commit).cast("bigint"), "committed_at": F.lit(START + timedelta(days=commit)).cast("timestamp_ntz"),
            "op": F.lit(op),
        })
        part = sl.to_stored(frame, schema, commit, ["k"])
        out = part if out is None else out.unionByName(part)
    return out


def test_every_version_has_its_names_types_and_values(spark):
    schema = evolved(spark)
    log = changes(spark, schema)
    expected = {
        1: ("k int, amount int, status string", [(1, 10, "new"), (2, 20, "new")]),
        2: ("k int, amount int, status string", [(1, 11, "paid"), (2, 20, "new")]),
        3: ("k int, amount int, status string, note string", [(1, 11, "paid", None), (2, 20, "new", None), (3, 30, "new", "gift")]),
        4: ("k int, amount bigint, state string, note string", [(1, 11, "paid", None), (2, 1 << 40, "paid", None), (3, 30, "new", "gift")]),
        5: ("k int, amount bigint, state string, note string", [(2, 1 << 40, "paid", None), (3, 30, "new", "gift")]),
        6: ("k int, amount bigint, state string, status int", [(2, 1 << 40, "paid", None), (3, 30, "new", None), (4, 7, "new", 99)]),
    }
    for version, (columns, data) in expected.items():
        got = sl.read_version(log, schema, ["k"], version)
        assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == columns
        assert rows(got) == data
    assert rows(sl.read_version(log, schema, ["k"])) == expected[6][1]
    assert sl.read_version(log, schema, ["k"], ts="2024-01-04 12:00:00").columns == ["k", "amount", "status", "note"]


def test_a_name_used_again_is_another_column(spark):
    schema = evolved(spark)
    assert [f.name for f in sl.schema_at(schema)] == ["amount", "state", "status"]
    ids = {f.name: f.column_id for f in sl.schema_at(schema)}
    assert ids["status"] != ids["state"] == {f.name: f.column_id for f in sl.schema_at(schema, 1)}["status"]


def test_swapped_names(spark):
    log = sl.first_schema(spark, 1, {"a": "int", "b": "int"})
    swapped = sl.alter(log, 2, rename={"a": "b", "b": "a"})
    assert [(f.column_id, f.name) for f in sl.schema_at(swapped)] == [(1, "b"), (2, "a")]


@pytest.mark.parametrize("change,message", [
    ({"commit_id": 1, "add": {"x": "int"}}, "not later"),
    ({"commit_id": 2, "rename": {"x": "y"}}, "no column x"),
    ({"commit_id": 2, "widen": {"b": "int"}}, "cannot hold"),
    ({"commit_id": 2, "widen": {"d": "decimal(10,4)"}}, "cannot hold"),
    ({"commit_id": 2, "rename": {"a": "b"}}, "same name"),
    ({"commit_id": 2, "add": {"a": "int"}}, "same name"),
    ({"commit_id": 2, "drop": ["a"], "widen": {"a": "bigint"}}, "dropped column"),
])
def test_changes_that_are_refused(spark, change, message):
    log = sl.first_schema(spark, 1, {"a": "int", "b": "string", "d": "decimal(10,2)"})
    with pytest.raises(ValueError, match=message):
        sl.alter(log, **change)


def test_wider_decimals_and_unknown_columns(spark):
    log = sl.alter(sl.first_schema(spark, 1, {"d": "decimal(5,2)"}), 2, widen={"d": "decimal(12,3)"})
    rows_ = spark.createDataFrame([(1, Decimal("123.45"))], "k int, d decimal(5,2)")
    assert sl.to_stored(rows_, log, 1, ["k"]).dtypes == [("k", "int"), ("c1", "decimal(12,3)")]
    with pytest.raises(ValueError, match="not a column at commit 1: x"):
        sl.to_stored(rows_.withColumn("x", F.lit(1)), log, 1, ["k"])
