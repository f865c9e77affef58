"""Copy-on-write and compaction through crashes, over folders of any name and depth."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import changes, layout
from tallyhouse.operators.swaps import Journal, Swap
from tallyhouse.session import fresh_path
from tallyhouse.sources.storage import Storage
from tests.conftest import rows


class Killed(BaseException):
    """Ends a run without any handler, as the loss of the driver would."""


def kill_at(monkeypatch, step):
    """The run dies at its n-th move; the moves before it have happened."""
    moves, real = [], Storage.move

    def move(self, source, target):
        moves.append(source)
        if len(moves) == step:
            raise Killed
        real(self, source, target)

    monkeypatch.setattr(Storage, "move", move)


def folder(spark, path, name, data):
    spark.createDataFrame(data, "id int, v string").coalesce(1).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"  # partition folders hold no such file
    ).parquet(f"{path}/{name}")


def read(spark, path):
    return rows(spark.read.schema("id int, v string").option("recursiveFileLookup", True).parquet(path))


def names(spark, path):
    return sorted(n for n in Storage(spark, path).names(path) if n.startswith("p="))


def delta(spark, data, parts="p int"):
    return spark.createDataFrame(data, f"id int, v string, {parts}, op string")


def test_folder_names_are_kept_as_written(spark):
    path = fresh_path(spark, "cow")
    folder(spark, path, "p=01", [(1, "A"), (2, "B")])
    folder(spark, path, "p=02", [(3, "C")])
    assert changes.cow_apply(spark, path, delta(spark, [(1, "a", 1, "U")]), ["id"], "p") == [1]
    assert read(spark, path) == [(1, "a"), (2, "B"), (3, "C")] and names(spark, path) == ["p=01", "p=02"]
    changes.cow_apply(spark, path, delta(spark, [(3, "c", 1, "U"), (9, "n", 7, "U")]), ["id"], "p")
    assert read(spark, path) == [(1, "a"), (2, "B"), (3, "c"), (9, "n")] and names(spark, path) == ["p=01", "p=7"]


def test_folders_of_equal_value_stay_apart(spark):
    path = fresh_path(spark, "cow")
    folder(spark, path, "p=1.0", [(1, "A")])
    folder(spark, path, "p=1", [(2, "B")])
    folder(spark, path, "p=__HIVE_DEFAULT_PARTITION__", [(3, "C")])
    changed = delta(spark, [(2, "b", 1.0, "U"), (3, None, None, "D"), (4, "d", 1.0, "U")], "p double")
    changes.cow_apply(spark, path, changed, ["id"], "p")
    assert read(spark, path) == [(1, "A"), (2, "b"), (4, "d")] and names(spark, path) == ["p=1", "p=1.0"]
    changes.cow_apply(spark, path, delta(spark, [(5, "e", None, "U")], "p double"), ["id"], "p")
    assert names(spark, path) == ["p=1", "p=1.0", "p=__HIVE_DEFAULT_PARTITION__"]


def test_several_partition_columns_and_odd_values(spark):
    path = fresh_path(spark, "cow")
    values = ["x y", "a+b", "50%", "2024-01-01 10:00:00", "[b]", "a=b/c", "", None]
    table = spark.createDataFrame(
        [(k, f"v{k}", 2023 + k % 2, k % 3 or None, values[k % 8]) for k in range(48)], "id int, v string, y int, m int, t string"
    )
    table.write.partitionBy("y", "m", "t").parquet(path)
    up = table.where("id % 5 = 0").withColumns({"v": F.lit("new"), "op": F.lit("U"), "m": F.lit(2)})
    gone = table.where("id in (7, 8)").withColumn("op", F.lit("D"))
    new = table.where("id < 8").withColumns({"id": F.col("id") + 100, "y": F.lit(2030), "op": F.lit("U")})
    before = {r[0]: r[1] for r in spark.read.parquet(path).select("id", "_metadata.file_path").collect()}
    got = changes.cow_apply(spark, path, up.unionByName(gone).unionByName(new), ["id"], ["y", "m", "t"])
    assert all(isinstance(value, tuple) and len(value) == 3 for value in got)
    plain = F.when(F.col("t") != "", F.col("t"))  # a folder cannot tell "" from NULL
    expected = table.where("id % 5 <> 0 and id not in (7, 8)").unionByName(up.drop("op")).unionByName(new.drop("op"))
    stored = spark.read.schema(table.schema).parquet(path)
    assert rows(stored.select(table.columns)) == rows(expected.withColumn("t", plain))
    after = {r[0]: r[1] for r in stored.select("id", "_metadata.file_path").collect()}
    assert any(before[k] == after.get(k) for k in before)  # folders without changes keep their files


def test_an_unpartitioned_table(spark):
    path = fresh_path(spark, "cow")
    spark.createDataFrame([(1, "A"), (2, "B")], "id int, v string").write.parquet(path)
    changed = spark.createDataFrame([(1, "a", "U"), (2, None, "D"), (3, "c", "U")], "id int, v string, op string")
    assert changes.cow_apply(spark, path, changed, ["id"], []) == [()]
    assert read(spark, path) == [(1, "a"), (3, "c")]


@pytest.mark.parametrize("step", range(1, 7))
def test_a_crash_leaves_every_row_once(spark, monkeypatch, step):
    """Rows move between folders; the run dies at its n-th move (the first one commits)."""
    path = fresh_path(spark, "cow")
    old = [(1, "A"), (2, "B"), (3, "C"), (4, "D")]
    for k, name in enumerate(["p=01", "p=2", "p=3"]):
        folder(spark, path, name, old[k : k + 1] if k < 2 else old[2:])
    changed = delta(spark, [(1, "a", 3, "U"), (2, None, None, "D"), (3, "c", 1, "U")])
    with monkeypatch.context() as patch:
        kill_at(patch, step)
        with pytest.raises(Killed):
            changes.cow_apply(spark, path, changed, ["id"], "p")
    assert Journal(spark, path).recover() == (step > 1)
    expected = old if step == 1 else [(1, "a"), (3, "c"), (4, "D")]
    assert read(spark, path) == expected
    assert not [n for n in Storage(spark, path).names(path) if n.startswith("_") and n != "_SUCCESS"]
    assert Journal(spark, path).recover() == 0
    changes.cow_apply(spark, path, changed, ["id"], "p")
    assert read(spark, path) == [(1, "a"), (3, "c"), (4, "D")]


def test_a_failing_move_undoes_all_folders(spark, monkeypatch):
    path = fresh_path(spark, "swap")
    folder(spark, path, "p=1", [(1, "A")])
    folder(spark, path, "p=2", [(2, "B")])
    journal = Journal(spark, path)
    staging = journal.staging()
    folder(spark, staging, "new", [(1, "a")])
    new = journal.store.data_files(f"{staging}/new")
    old = [journal.store.data_files(f"{journal.root}/p={n}") for n in (1, 2)]
    with pytest.raises(OSError, match="neither staged"):
        journal.commit([Swap(f"{journal.root}/p=1", old[0], new), Swap(f"{journal.root}/p=2", old[1], [f"{staging}/lost.parquet"])])
    assert journal.recover() == 0
    assert read(spark, path) == [(1, "A"), (2, "B")]


def fragments(spark, tasks=9, n=900):
    path = fresh_path(spark, "fragments")
    df = spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("p"))
    df.repartition(tasks).write.partitionBy("p").parquet(path)
    return path, df


def stored(spark, path):
    return rows(spark.read.parquet(path).select("id", "p"))


def test_groups_and_batches(spark):
    path, df = fragments(spark)
    sizes = {r.file_path: r.file_size_in_bytes for r in layout.file_inventory(spark, path).collect()}
    each = max(sizes.values())
    report = layout.compact(
        spark, path, target_bytes=3 * each, min_input_files=2, group_bytes=3 * each, batch_bytes=4 * each
    ).collect()
    assert {r.part for r in report} == {"p=0", "p=1", "p=2"} and len(report) > 3
    assert sum(r.files_before for r in report) <= 27 and all(r.files_after < r.files_before for r in report)
    after = layout.file_inventory(spark, path).collect()
    assert len(after) == 27 - sum(r.files_before - r.files_after for r in report)
    assert sum(r.bytes_after for r in report) <= sum(r.file_size_in_bytes for r in after)
    assert stored(spark, path) == rows(df)


def test_files_near_the_target_are_left_alone(spark):
    path = fresh_path(spark, "mixed")
    spark.range(0, 50_000).select(F.col("id"), F.hash("id").alias("h")).coalesce(1).write.parquet(path)
    large = {r.file_path: r.file_size_in_bytes for r in layout.file_inventory(spark, path).collect()}
    spark.range(50_000, 50_600).select("id", F.hash("id").alias("h")).repartition(6).write.mode("append").parquet(path)
    report = layout.compact(spark, path, target_bytes=max(large.values()), min_input_files=2).collect()
    assert [(r.files_before, r.files_after) for r in report] == [(6, 1)]
    assert set(large) < {r.file_path for r in layout.file_inventory(spark, path).collect()}
    assert spark.read.parquet(path).count() == 50_600


@pytest.mark.parametrize("step", [1, 2, 5, 11, 14, 25, 31])
def test_a_killed_compaction_resumes(spark, monkeypatch, step):
    path, df = fragments(spark)
    with monkeypatch.context() as patch:
        kill_at(patch, step)
        with pytest.raises(Killed):
            layout.compact(spark, path, min_input_files=2, batch_bytes=1)  # a batch per group
    Journal(spark, path).recover()
    assert stored(spark, path) == rows(df)
    done = {r.part for r in layout.file_health(layout.file_inventory(spark, path)).where("files = 1").collect()}
    report = layout.compact(spark, path, min_input_files=2).collect()
    assert len(report) == 3 - len(done)  # what was committed is not done again
    assert stored(spark, path) == rows(df)
    assert layout.file_inventory(spark, path).count() == 3


def test_columns_that_only_some_files_have_survive(spark):
    path = fresh_path(spark, "evolved")
    spark.range(10).repartition(3).write.parquet(path)
    spark.range(10, 20).withColumn("later", F.lit("x")).repartition(3).write.mode("append").parquet(path)
    layout.compact(spark, path, min_input_files=2)
    got = spark.read.option("mergeSchema", True).parquet(path)
    assert got.where("later = 'x'").count() == 10 and got.count() == 20
