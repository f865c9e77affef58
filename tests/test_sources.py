"""Readers, writers, generators and streams."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import Window as W, functions as F

from tallyhouse import schemas, session
from tallyhouse.functions import expressions as X
from tallyhouse.sources import generators, readers, writers
from tallyhouse.sources.storage import Storage
from tallyhouse.streaming.daily_sales import daily_sales, stream_daily_sales, stream_silver, write_stream
from tallyhouse.streaming.ingest import ingest, read_files
from tests.conftest import SPARK_ERRORS, rows


def test_schemas(spark):
    orders = schemas.SCHEMAS["orders"]
    assert orders["total_amount"].dataType.simpleString() == "decimal(10,2)"
    assert orders["order_timestamp"].dataType.simpleString() == "timestamp_ntz"
    assert schemas.SCHEMAS["products"]["tags"].dataType.simpleString() == "array<string>"
    assert len(schemas.SCHEMAS) == 9 and set(schemas.CSV_SCHEMAS) >= {"customers", "external_sales"}
    assert all(schemas.CSV_SCHEMAS[name].names for name in schemas.CSV_SCHEMAS)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert named is None or folder == named.rstrip("/")
    assert session.fresh_path(spark, "a") != session.fresh_path(spark, "a")


def test_scratch_can_be_released(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", {})
    kept, unused = session.fresh_path(spark, "kept"), session.fresh_path(spark, "unused")
    spark.range(3).write.parquet(kept)
    assert session.release_scratch(spark) == 1
    assert not Storage(spark, kept).exists(kept)
    assert session.release_scratch(spark) == 0


def test_csv_that_does_not_fit_is_an_error(spark):
    path = session.fresh_path(spark, "csv")
    spark.createDataFrame([("1", "x"), ("oops", "y")], "id string, name string").write.option(
        "header", True
    ).csv(path)
    with pytest.raises(SPARK_ERRORS):
        readers.read_csv(spark, path, "id int, name string").collect()


def test_conversion_reports_failures(spark):
    source, target = session.fresh_path(spark, "csv"), session.fresh_path(spark, "parquet")
    good = spark.createDataFrame([(1, "a")], "id int, name string")
    good.write.option("header", True).csv(f"{source}/good.csv")
    report = writers.csv_to_parquet(spark, source, target, {"good": good.schema, "missing": good.schema})
    assert rows(report) == [("good", "SUCCESS", 1, 2), ("missing", "FAILED", None, None)]
    assert rows(spark.read.parquet(f"{target}/good.parquet")) == [(1, "a")]


def test_partial_append(spark):
    target = spark.createDataFrame([(1, "a", 2.0)], "id int, name string, v double")
    more = spark.createDataFrame([(2, 3.0)], "id int, v double")
    assert rows(writers.append_partial(target, more)) == [(1, "a", 2.0), (2, None, 3.0)]
    with pytest.raises(ValueError):
        writers.append_partial(target, more.withColumnRenamed("v", "w"))
    with pytest.raises(ValueError):
        writers.write(target, "nowhere", "avro")


def test_ctas_refuses_an_existing_table(spark):
    df, name = spark.range(3), session.fresh_name("once")
    assert writers.ctas(df, name).count() == 3
    with pytest.raises(SPARK_ERRORS):
        writers.ctas(df, name)
    assert writers.append(spark.range(2), name).count() == 5
    assert writers.overwrite(df, name).count() == 3


def test_jdbc_needs_a_range(spark):
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "jdbc:none:x", "customers", key="id")


def test_generated_orders_repeat(spark):
    numbers = generators.sequence(spark, 1, 500)
    one = generators.gen_orders(numbers, "2024-06-30")
    assert rows(one) == rows(generators.gen_orders(numbers.repartition(7), date(2024, 6, 30)))
    assert one.columns == schemas.SCHEMAS["orders"].names or set(one.columns) == set(schemas.SCHEMAS["orders"].names)
    spread = one.agg(
        F.min("customer_id"), F.max("customer_id"), F.min("total_amount"), F.max("total_amount"),
        F.min("order_date"), F.max("order_date"), F.countDistinct("order_status"),
    ).first()
    assert spread[0] == 1 and spread[1] == 8 and spread[6] == 4
    assert 50 <= spread[2] <= spread[3] <= 550
    assert spread[4] >= date(2024, 3, 31) and spread[5] <= date(2024, 6, 30)


@pytest.mark.parametrize("limit", [1, 7, 60, 500, 100_000])
def test_generated_items_equal_all_pairs_cut(spark, limit):
    orders = generators.gen_orders(generators.sequence(spark, 1, 40), "2024-06-30")
    products = spark.range(1, 26).select(F.col("id").alias("product_id"), F.lit(2).cast("decimal(10,2)").alias("price"))
    got = generators.gen_order_items(orders, products, limit=limit).select("order_item_id", "order_id", "product_id")
    pairs = [(o, p) for o in range(1, 41) for p in range(1, 26) if (o * 7 + p + 1) % 10 < 3]
    assert rows(got.orderBy("order_item_id")) == sorted(
        [(i, *pair) for i, pair in enumerate(pairs[:limit], 1)], key=repr
    )


@pytest.mark.parametrize("limit", [3, 5000])
def test_every_task_hands_on_a_limited_number_of_each_group(spark, limit):
    """200,000 rows in two tasks, one group with most of them: a task keeps the first ones alone, also above 1000."""
    df = spark.range(0, 200_000, 1, 2).selectExpr(
        "(id * 7919) % 200003 as product_id", "case when id % 10 < 8 then 0 else id % 5 end as _class", "'x' as more"
    )
    cut = generators.first_of_each(df, "_class", "product_id", limit).withColumn("_task", F.spark_partition_id())
    assert cut.groupBy("_task", "_class").count().agg(F.max("count")).first()[0] <= limit
    place = F.row_number().over(W.partitionBy("_class").orderBy("product_id"))
    first = lambda frame: rows(frame.withColumn("_p", place).where(F.col("_p") <= limit).select(df.columns))
    assert first(cut) == first(df)


def test_generated_items_with_missing_classes(spark):
    orders = generators.gen_orders(generators.sequence(spark, 1, 30), "2024-06-30")
    products = spark.createDataFrame([(10,), (20,), (30,)], "product_id int").withColumn(
        "price", F.lit(1).cast("decimal(10,2)")
    )
    got = generators.gen_order_items(orders, products, limit=5).select("order_id", "product_id")
    pairs = [(o, p) for o in range(1, 31) for p in (10, 20, 30) if (o * 7 + p + 1) % 10 < 3]
    assert rows(got) == sorted(pairs[:5], key=repr)


def test_commits(spark):
    path = session.fresh_path(spark, "commits")
    batches = (generators.gen_batch(spark.range(0, 50, 1, 2), c, 8, "2024-01-01") for c in (1, 2, 3))
    assert generators.append_commits(path, batches) == 3
    stored = spark.read.parquet(path)
    assert rows(generators.commit_counts(stored)) == [(1, 50), (2, 50), (3, 50)]
    assert generators.expected_vs_actual(stored, 150).first().matches


def test_scalar_helpers(spark):
    df = spark.createDataFrame(
        [("1.5", "2024-02-30", "a@b@c"), ("x", "2024-02-29", "none"), (None, None, None)],
        "n string, d string, e string",
    )
    got = df.select(X.to_number("n"), X.to_day("d"), X.email_domain("e")).collect()
    assert [tuple(r) for r in got] == [
        (1.5, None, "b@c"), (None, date(2024, 2, 29), None), (None, None, None)
    ]
    r = spark.range(1).select(
        X.line_total(F.lit("10.05"), F.lit(3), F.lit("12.50")), X.rounded_long(F.lit(2.5)),
        X.rounded_long(F.lit(-2.5)), X.truncated_number(F.lit(-7), 5), X.truncated_text(F.lit("abcd"), 2),
    ).first()
    assert [str(x) for x in r] == ["26.38", "3", "-3", "-10", "ab"]


def test_stream_restart_adds_nothing(spark):
    source, target, state = (session.fresh_path(spark, n) for n in ("in", "out", "state"))
    spark.range(100).repartition(5).write.parquet(source)
    schema = spark.range(1).schema
    for expected in (100, 100):
        ingest(spark, source, target, state, schema, files_per_batch=2).awaitTermination()
        assert spark.read.parquet(target).count() == expected
    spark.range(100, 130).write.mode("append").parquet(source)
    ingest(spark, source, target, state, schema).awaitTermination()
    stored = spark.read.parquet(target)
    assert stored.count() == 130 and stored.select("id").distinct().count() == 130


def test_stream_late_rows(spark):
    source, target, state = (session.fresh_path(spark, n) for n in ("in", "out", "state"))
    schema = "order_id int, customer_id int, order_date date, order_status string, total_amount decimal(10,2)"

    def land(data):
        spark.createDataFrame(data, "o int, c int, d string, s string, a string").selectExpr(
            "o order_id", "c customer_id", "cast(d as date) order_date", "s order_status",
            "cast(a as decimal(10,2)) total_amount",
        ).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = read_files(spark, source, schema)
        write_stream(stream_daily_sales(stream, delay="1 day"), target, state).awaitTermination()

    land([(1, 1, "2024-01-01", "F", "5"), (2, 1, "2024-01-01", "F", "6"), (3, 2, "2024-01-01", None, "7"),
          (4, 2, "2024-01-02", "F", "0"), (5, 2, "2024-01-02", "F", "8")])
    run()
    land([(6, 3, "2024-01-01", "F", "9"), (7, 3, "2024-01-10", "F", "1")])  # the first is in time
    run()
    land([(8, 3, "2024-01-01", "F", "100"), (9, 3, "2024-01-20", "F", "1")])  # the first is too late
    run()
    got = spark.read.parquet(target).select("order_date", "total_orders", "unique_customers", "total_revenue")
    assert sorted((str(d), n, c, float(v)) for d, n, c, v in rows(got)) == [
        ("2024-01-01", 4, 3, 27.0), ("2024-01-02", 1, 1, 8.0), ("2024-01-10", 1, 1, 1.0)
    ]


def test_daily_sales_lose_no_order_over_batches(spark, retail):
    """Unsorted orders, one file per batch, a late file after a restart: every order and the newest day count."""
    source, target, state = (session.fresh_path(spark, n) for n in ("in", "out", "state"))
    orders = retail.orders.select("order_id", "customer_id", "order_date", "order_status", "total_amount")
    late = F.col("order_id") % 5 == 0
    for part in (orders.where(~late).repartition(4), orders.where(late).coalesce(1)):
        part.write.mode("append").parquet(source)
        stream = read_files(spark, source, orders.schema, files_per_batch=1)
        write_stream(stream_silver(stream), target, state).awaitTermination()
    orders.createOrReplaceTempView("all_orders")
    want = spark.sql("""select order_date, count(*), count(distinct customer_id), sum(total_amount),
                               cast(sum(total_amount) as double) / count(*) from all_orders group by 1""")
    got = rows(daily_sales(spark.read.parquet(target)).withColumn("avg_order_value", F.col("avg_order_value").cast("double")))
    assert [r[:4] for r in got] == [r[:4] for r in rows(want)]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in rows(want)], rel=1e-6)
    assert sum(r[1] for r in got) == orders.count() and max(r[0] for r in got) == orders.agg(F.max("order_date")).first()[0]


def test_stream_query_takes_all_orders(retail, monkeypatch):
    """The query itself, one file per batch: orders of older days in later files are not dropped, nor is the newest day."""
    from tallyhouse.catalog import streams

    given = streams.read_files
    monkeypatch.setattr(streams, "read_files", lambda s, p, t, files_per_batch=1: given(s, p, t, 1))
    orders = retail.orders
    got = streams.st2(retail).agg(F.sum("total_orders"), F.max("order_date")).first()
    assert tuple(got) == (orders.count(), orders.agg(F.max("order_date")).first()[0])
