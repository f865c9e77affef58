"""Written layouts, inventories and compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import layout
from tallyhouse.session import fresh_path
from tallyhouse.sources.storage import Storage
from tests.conftest import rows

PARTS = ["x y", "a+b", "50%", "2024-01-01 10:00:00", "[b]", "plain"]


def scattered(spark, tasks=8, n=600):
    """A third of all rows are equal and sit in one partition."""
    path = fresh_path(spark, "scattered")
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, PARTS[0])
        .otherwise(F.element_at(F.array(*map(F.lit, PARTS)), (F.floor(F.col("id") / 3) % len(PARTS) + 1).cast("int")))
        .alias("p"),
    )
    df.repartition(tasks).write.partitionBy("p").parquet(path)
    return path, df


def test_inventory(spark):
    path, df = scattered(spark)
    inventory = layout.file_inventory(spark, path)
    assert inventory.agg(F.sum("record_count")).first()[0] == df.count()
    assert inventory.where("record_count = 0").isEmpty()
    totals = layout.file_totals(inventory).first()
    assert totals.total_files == inventory.count() and totals.total_size_mb == 0
    health = layout.file_health(inventory)
    assert health.count() == len(PARTS)
    assert {(r.small_share, r.advise) for r in health.collect()} == {(1.0, True)}
    orphans = layout.orphan_files(inventory, inventory.where(~F.col("file_path").contains("plain")))
    assert not orphans.isEmpty()
    assert orphans.where(~F.col("file_path").contains("plain")).isEmpty()


def test_compaction_keeps_every_row(spark):
    path, df = scattered(spark)
    before = layout.file_inventory(spark, path).count()
    report = layout.compact(spark, path, min_input_files=2).collect()
    after = layout.file_inventory(spark, path)
    assert len(report) == len(PARTS)
    assert after.count() == len(PARTS) < before
    assert rows(spark.read.schema(df.schema).parquet(path).select("id", "p")) == rows(df)
    assert layout.compact(spark, path, min_input_files=2).isEmpty()
    left = [s.getPath().getName() for s in Storage(spark, path)._fs.listStatus(Storage(spark, path)._path_class(path))]
    assert not [name for name in left if name.startswith(("_staging", "_retired"))]


def test_compaction_to_a_target_size(spark):
    path = fresh_path(spark, "sized")
    df = spark.range(200_000).select(F.lit(7).alias("same"), F.hash("id").alias("h"))
    df.repartition(12).write.parquet(path)
    size = layout.file_totals(layout.file_inventory(spark, path)).first().total_size_bytes
    layout.compact(spark, path, target_bytes=size // 4 + 1, min_input_files=2)
    files = layout.file_inventory(spark, path).collect()
    assert 3 <= len(files) <= 6
    assert max(f.record_count for f in files) < 200_000 / len(files) * 1.2
    assert layout.content_check(spark.read.parquet(path)) == layout.content_check(df)


def test_compaction_of_chosen_partitions(spark):
    path, df = scattered(spark)
    report = layout.compact(spark, path, min_input_files=2, where=F.col("p") == "a+b").collect()
    assert [r.part for r in report] == ["p=a+b"]
    assert rows(spark.read.schema(df.schema).parquet(path).select("id", "p")) == rows(df)


def test_sorted_compaction(spark):
    path, df = scattered(spark)
    layout.compact(spark, path, min_input_files=2, strategy="sort", sort=["id"])
    assert rows(spark.read.schema(df.schema).parquet(path).select("id", "p")) == rows(df)
    stored = spark.read.schema(df.schema).parquet(path)
    ids = [r[0] for r in stored.where("p = 'plain'").coalesce(1).select("id").collect()]
    assert ids == sorted(ids)
    with pytest.raises(ValueError):
        layout.compact(spark, path, strategy="sort")


def test_few_files_are_left_alone(spark):
    path, _ = scattered(spark, tasks=2)
    assert layout.compact(spark, path, min_input_files=5).isEmpty()


def test_moves_are_undone_on_failure(spark):
    path = fresh_path(spark, "moves")
    spark.range(10).repartition(2).write.parquet(path)
    store = Storage(spark, path)
    old = store.data_files(path)
    with pytest.raises(Exception):
        layout.replace_files(store, path, old, [f"{path}/missing.parquet"], f"{path}/_retired")
    assert sorted(store.data_files(path)) == sorted(old)


def test_maintenance_goes_on_after_a_failure(spark):
    path, _ = scattered(spark)
    report = layout.maintain(spark, {"gone": path + "-gone", "there": path}, min_input_files=2).collect()
    assert [(r.table, r.status) for r in report] == [("gone", "FAILED"), ("there", "SUCCESS")]
    assert report[0].error


def test_sorted_layout(spark):
    path = fresh_path(spark, "sorted")
    df = spark.range(1000).select((F.col("id") % 2).alias("p"), F.pmod(F.hash("id"), F.lit(97)).alias("s"))
    layout.write_sorted(df, path, ["p"], ["s"])
    files = [f.file_path for f in layout.file_inventory(spark, path).collect()]
    for file in files:
        values = [r[0] for r in spark.read.parquet(file).coalesce(1).select("s").collect()]
        assert values == sorted(values)
    assert spark.read.parquet(path).count() == 1000


@pytest.mark.parametrize("names", [("01", "02"), ("1.0", "1"), ("a b", "__HIVE_DEFAULT_PARTITION__")])
def test_compaction_keeps_rows_of_any_folder_name(spark, tmp_path, names):
    path = str(tmp_path / "table")
    for name in names:
        folder = f"{path}/p={name}"
        spark.range(100).repartition(6).write.parquet(folder)
    before = sorted(map(tuple, spark.read.parquet(path).collect()), key=repr)
    report = layout.compact(spark, path, min_input_files=2).collect()
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == before
    assert {(r.files_before, r.files_after) for r in report} == {(6, 1)} and len(report) == 2


def test_compaction_leaves_files_that_arrive_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    spark.range(100).repartition(6).write.parquet(f"{path}/p=1")
    check, calls = layout.content_check, []

    def append_first(df):
        if not calls:
            calls.append(spark.range(100, 150).coalesce(1).write.mode("append").parquet(f"{path}/p=1"))
        return check(df)

    monkeypatch.setattr(layout, "content_check", append_first)
    layout.compact(spark, path, min_input_files=2)
    assert spark.read.parquet(path).count() == 150
