"""Time travel, rollback, expiry and recovery against a plain replay of the log."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallyhouse.operators import versions as v
from tests.conftest import SPARK_ERRORS, rows

SCHEMA = "k int, a string, b int, commit_id bigint, committed_at timestamp_ntz, op string"
START = datetime(2024, 1, 1)
ONCE = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def make_log(seed, commits=8, keys=6):
    """Random legal history, with deletes, re-inserts and one key changed in every commit."""
    rnd, alive, log = random.Random(seed), {}, []
    for c in range(1, commits + 1):
        for k in range(keys):
            if k and rnd.random() < 0.5:
                continue
            op = rnd.choice("UD") if k in alive else "I"
            row = (rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]))
            if op == "D":
                row = alive.pop(k)
            else:
                alive[k] = row
            log.append((k, *row, c, START + timedelta(days=c), op))
    return log


def replay(log, version):
    state = {}
    for k, a, b, c, _, op in sorted(log, key=lambda r: r[3]):
        if c <= version:
            if op == "D":
                state.pop(k, None)
            else:
                state[k] = (k, a, b)
    return sorted(state.values(), key=repr)


@ONCE
@given(st.integers(0, 10_000))
def test_as_of_rollback_and_expiry(spark, seed):
    data = make_log(seed)
    log = spark.createDataFrame(data, SCHEMA)
    for version in (1, 4, 8):
        assert rows(v.as_of(log, ["k"], version=version)) == replay(data, version)
    back = v.rollback(log, ["k"], "2024-03-01", version=3)
    assert rows(v.as_of(back, ["k"])) == replay(data, 3)
    assert rows(v.as_of(back, ["k"], version=8)) == replay(data, 8)
    short = v.expire(log, ["k"], START + timedelta(days=7), retain_last=4)
    for version in (5, 6, 7, 8):
        assert rows(v.as_of(short, ["k"], version=version)) == replay(data, version)
    assert short.agg({"commit_id": "min"}).first()[0] >= 5


def test_time_lookup(spark):
    data = make_log(1)
    log = spark.createDataFrame(data, SCHEMA)
    assert rows(v.as_of(log, ["k"], ts="2024-01-05 23:00:00")) == replay(data, 4)
    assert rows(v.as_of(log, ["k"], ts="2024-01-06 00:00:00")) == replay(data, 5)
    with pytest.raises(SPARK_ERRORS, match="no commit at or before"):
        v.as_of(log, ["k"], ts="2023-12-31 00:00:00").collect()


def test_diff_undelete_audit(spark):
    data = [
        (1, "x", 1, 1, START, "I"), (2, "x", 1, 1, START, "I"), (3, None, 1, 1, START, "I"),
        (1, "y", 1, 2, START, "U"), (2, "x", 1, 2, START, "D"), (3, None, 1, 2, START, "U"),
        (4, "n", 1, 2, START, "I"),
    ]
    log = spark.createDataFrame(data, SCHEMA)
    assert rows(v.diff(log, ["k"], 1, 2).select("k", "change")) == [(1, "U"), (2, "D"), (4, "I")]
    assert rows(v.undelete(log, ["k"], 1)) == [(2, "x", 1)]
    assert rows(v.audit(log, ["k"], log.k == 1, [1])) == [
        ("CURRENT", 1, "y", 1), ("SNAPSHOT_1", 1, "x", 1)
    ]
    assert v.count_drift(log, ["k"], 1).first()[:] == (3, 3)


def test_snapshots(spark):
    log = spark.createDataFrame(make_log(2), SCHEMA)
    listed = v.snapshots(log).orderBy("snapshot_id").collect()
    assert [s.parent_id for s in listed] == [None, 1, 2, 3, 4, 5, 6, 7]
    assert listed[0].operation == "append" and listed[0].summary["deleted"] == "0"


def test_history_after_the_pointer_moved_back(spark):
    snaps = spark.createDataFrame(
        [(1, None), (2, 1), (3, 2), (4, 2), (5, 4)], "snapshot_id bigint, parent_id bigint"
    )
    moves = spark.createDataFrame(
        [(1, 1), (2, 2), (3, 3), (4, 2), (5, 4), (6, 5)], "made_current_at int, snapshot_id bigint"
    )
    got = v.history(snaps, moves).orderBy("made_current_at").collect()
    assert [r.is_current_ancestor for r in got] == [True, True, False, True, True, True]


def test_history_of_a_long_line(spark):
    n = 150
    snaps = spark.createDataFrame(
        [(i, i - 1 if i else None) for i in range(n)], "snapshot_id bigint, parent_id bigint"
    )
    start = snaps.where("snapshot_id = 149")
    assert v.lineage(snaps, start).count() == n


def test_old_schema_and_age_expiry(spark):
    data = make_log(5)
    log = spark.createDataFrame(data, SCHEMA)
    columns = {1: ["k", "a"], 5: ["k", "a", "b"]}
    assert v.as_of(log, ["k"], version=4, schema_log=columns).columns == ["k", "a"]
    assert v.as_of(log, ["k"], schema_log=columns).columns == ["k", "a", "b"]
    week = v.expire_by_age(log, ["k"], 604_800_000, datetime(2024, 1, 14), retain_last=1)
    assert week.agg({"commit_id": "min"}).first()[0] >= 6
    assert rows(v.as_of(week, ["k"])) == replay(data, 8)


def test_restore_and_backup(spark):
    from tallyhouse.session import fresh_name

    data = make_log(6)
    log = spark.createDataFrame(data, SCHEMA)
    assert rows(v.restore(log, ["k"], 3, fresh_name("restored"))) == replay(data, 3)
