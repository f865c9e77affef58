"""The daily fold: late rows, repeated batches, crashes, and work for touched days only."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.session import fresh_path
from tallyhouse.streaming.daily_fold import DailyFold, fold_stream
from tallyhouse.streaming.ingest import read_files
from tests.conftest import final_plan, rows

SCHEMA = "order_id int, customer_id int, order_date date, order_status string, total_amount decimal(10,2)"


def orders(spark, data):
    return spark.createDataFrame(data, "o int, c int, d string, s string, a string").selectExpr(
        "o order_id", "c customer_id", "cast(d as date) order_date", "s order_status", "cast(a as decimal(10,2)) total_amount",
    )


def expected(df):
    got = df.where("order_id is not null and customer_id is not null and total_amount > 0").groupBy("order_date").agg(
        F.count("*"), F.countDistinct("customer_id"), F.sum("total_amount")
    )
    return sorted(map(tuple, got.collect()), key=repr)


def shown(fold):
    got = fold.daily().select("order_date", "total_orders", "unique_customers", "total_revenue")
    return sorted(map(tuple, got.collect()), key=repr)


def many(spark, n=120):
    return orders(spark, [
        (k, k % 7, f"2024-0{1 + k % 3}-{1 + k % 28:02d}" if k % 11 else None, "F", str(k % 5)) for k in range(n)
    ])


@pytest.mark.parametrize("unit", ["day", "month"])
def test_any_order_of_batches_and_repeats(spark, unit):
    every = many(spark)
    fold = DailyFold(spark, fresh_path(spark, "fold"), unit)
    for batch_id in (0, 1, 2, 1, 0):
        fold.fold(every.where(F.col("order_id") % 3 == batch_id), batch_id)
    assert shown(fold) == expected(every)


def test_one_file_per_batch_with_restart_and_late_file(spark, retail):
    rows_ = retail.orders.select("order_id", "customer_id", "order_date", "order_status", "total_amount")
    source, state = fresh_path(spark, "in"), fresh_path(spark, "state")
    fold = DailyFold(spark, fresh_path(spark, "fold"), "month")
    late = F.col("order_id") % 5 == 0
    for part in (rows_.where(~late).repartition(2), rows_.where(late).coalesce(1)):
        part.write.mode("append").parquet(source)
        fold_stream(read_files(spark, source, rows_.schema, files_per_batch=1), fold, state).awaitTermination()
    assert shown(fold) == expected(rows_)
    newest = rows_.agg(F.max("order_date")).first()[0]
    assert max(r[0] for r in shown(fold)) == newest


def test_a_batch_that_died_half_way_is_repeated_whole(spark, monkeypatch):
    every = many(spark)
    fold = DailyFold(spark, fresh_path(spark, "fold"))
    fold.fold(every.where("order_id < 60"), 0)
    from tallyhouse.streaming import daily_fold

    real, calls = daily_fold._replace, []

    def dies(df, path, *by):
        real(df, path, *by)
        calls.append(path)
        if len(calls) == step:
            raise RuntimeError("killed")

    for step in (1, 2):  # after the rows were written, after the rollup was
        calls.clear()
        monkeypatch.setattr(daily_fold, "_replace", dies)
        with pytest.raises(RuntimeError):
            fold.fold(every.where("order_id >= 60"), 1)
        assert not fold.done(1)
        monkeypatch.setattr(daily_fold, "_replace", real)
    fold.fold(every.where("order_id >= 60"), 1)
    assert fold.done(1) and shown(fold) == expected(every)


def test_only_touched_days_are_read_and_replaced(spark):
    fold = DailyFold(spark, fresh_path(spark, "fold"))
    first = orders(spark, [(k, k, f"2024-01-{k:02d}", "F", "1") for k in range(1, 21)])
    assert len(fold.fold(first, 0)) == 20
    before = {r[0]: r[1] for r in spark.read.parquet(fold.daily_path).select("order_date", "_metadata.file_path").collect()}
    assert fold.fold(orders(spark, [(99, 1, "2024-01-05", "F", "4"), (100, 1, "2024-02-01", "F", "4")]), 1) == ["2024-01-05", "2024-02-01"]
    after = {r[0]: r[1] for r in spark.read.parquet(fold.daily_path).select("order_date", "_metadata.file_path").collect()}
    assert {d for d in before if before[d] != after[d]} == {date(2024, 1, 5)}
    last = {r.order_date.isoformat(): r.batch_id for r in fold.daily().collect()}
    assert last["2024-01-05"] == last["2024-02-01"] == 1 and last["2024-01-06"] == 0
    plan = final_plan(fold.stored(spark.read.parquet(fold.rows_path).schema).where(F.col("period").isin(["2024-01-05"])))
    assert "PartitionFilters: [period" in plan or "period#" in plan.split("PartitionFilters")[1][:60]


def test_empty_batches_and_bad_units(spark):
    fold = DailyFold(spark, fresh_path(spark, "fold"))
    none = orders(spark, [(1, 1, "2024-01-01", "F", "0")])  # no amount: no silver row
    assert fold.fold(none, 0) == [] and fold.done(0)
    assert fold.fold(orders(spark, [(1, 1, None, "F", "2")]), 1) == ["none"]
    assert rows(fold.daily().select("order_date", "total_orders")) == [(None, 1)]
    with pytest.raises(ValueError, match="day, month"):
        DailyFold(spark, "x", "week")
