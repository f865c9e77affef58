"""Physical layout of Parquet tables: partitioned, sorted, bucketed writes; file inventory,
file health and compaction.

Sizes come from bytes on disk. What the driver holds is metadata only: one row per partition
folder, never per data row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window as W, functions as F

from tallyhouse.operators.swaps import Journal, Swap, in_parallel, replace_files  # noqa: F401  (replace_files: used by callers)
from tallyhouse.session import fresh_path

MB = 1 << 20
# File-size guidance.
SMALL_FILE = 10 * MB
GOOD_FILE = (128 * MB, 512 * MB)
LARGE_FILE = 1024 * MB
SMALL_SHARE_ALARM = 0.3


# --- writes -----------------------------------------------------------------

def with_year_month(df: DataFrame, date_column: str, year: str = "y", month: str = "m") -> DataFrame:
    return df.withColumns({year: F.year(date_column), month: F.month(date_column)})


def transform_columns(df: DataFrame, transforms: Mapping[str, Column]) -> DataFrame:
    """Add derived partition columns, for example ``{"y": year_of("d"), "b": bucket_of("id", 16)}``."""
    return df.withColumns(dict(transforms))


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """One folder per value. ``REBALANCE`` brings the rows of a value together, so a value is
    written by few tasks, and splits a value too large for one task."""
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def write_sorted(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str]) -> None:
    """Files sorted inside their partition folder, so row-group statistics can skip. Ranges run
    over partition and sort columns together: a large partition value spans several tasks."""
    ordered = df.repartitionByRange(*by, *sort).sortWithinPartitions(*by, *sort)
    ordered.write.mode("overwrite").partitionBy(*by).parquet(path)


# --- inventory --------------------------------------------------------------

def plain_path(c: Column) -> Column:
    # A plus sign is a plain character in a path, but would be read as a blank.
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path, format, bytes and record count of every data file.

    Counting reads no column, only file footers; a file without rows is kept with count 0.
    """
    sizes = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_size_in_bytes"))
    )
    counts = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("_path"))
        .agg(F.count("*").alias("_rows"))
        .select(plain_path(F.col("_path")).alias("file_path"), "_rows")  # once per file
    )
    return sizes.join(counts, "file_path", "left").select(
        "file_path",
        F.lit("PARQUET").alias("file_format"),
        F.coalesce("_rows", F.lit(0)).alias("record_count"),
        "file_size_in_bytes",
    )


def partition_values(inventory: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct partition values, read off the file paths."""
    return inventory.select(
        *[F.regexp_extract("file_path", rf"/{c}=([^/]+)/", 1).alias(c) for c in columns]
    ).distinct()


def file_totals(inventory: DataFrame) -> DataFrame:
    """Files, bytes, whole megabytes (integer division) and records."""
    size = F.sum("file_size_in_bytes")
    return inventory.agg(
        F.count("*").alias("total_files"),
        size.alias("total_size_bytes"),
        F.floor(size / MB).cast("bigint").alias("total_size_mb"),
        F.sum("record_count").alias("total_records"),
    )


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]+$", "")


def file_health(inventory: DataFrame) -> DataFrame:
    """Per partition folder: files, share of small ones, files per size band, compaction advice."""
    size = F.col("file_size_in_bytes")
    share = F.count_if(size < SMALL_FILE) / F.count("*")
    return inventory.groupBy(_folder(F.col("file_path")).alias("part")).agg(
        F.count("*").alias("files"),
        share.alias("small_share"),
        F.count_if(size < SMALL_FILE).alias("too_small"),
        F.count_if(size.between(*GOOD_FILE)).alias("optimal"),
        F.count_if(size > LARGE_FILE).alias("too_large"),
        (share > SMALL_SHARE_ALARM).alias("advise"),
    )


def partition_distribution(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*columns).agg(
        F.count("*").alias("row_count"),
        F.sum(value).alias("total_revenue"),
        (F.sum(value).cast("double") / F.count(value)).alias("avg_value"),
    )


def orphan_files(inventory: DataFrame, tracked: DataFrame) -> DataFrame:
    """Files on disk that no table refers to. Reported only, never deleted."""
    return inventory.join(tracked.select("file_path"), "file_path", "left_anti")


# --- compaction -------------------------------------------------------------

def content_check(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum of the rows; equal for equal multisets."""
    total = F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")), F.lit(0))
    count, checksum = df.agg(F.count("*"), total).first()
    return count, int(checksum)


LISTING = ("path", "modificationTime", "length", "content")
# A rewritten batch: one Spark job and what the driver holds of the plan, file names only.
BATCH_BYTES = 64 << 30
BATCH_GROUPS = 1000
BATCH_FILES = 20_000


def listed_files(spark: SparkSession, path: str, where: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Every data file with its folder and size, and the names of the partition columns. A file
    listing only; ``where`` restricts by partition columns."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    parts = [c for c in listing.columns if c not in LISTING]
    if where is not None:
        listing = listing.where(where)
    return listing.select("path", _folder(F.col("path")).alias("folder"), "length"), parts


def written_value(folder: str, name: str) -> Column:
    """A partition value as its folder's name writes it, so that ``01`` and ``1`` stay apart."""
    raw = F.regexp_extract(folder, f"/{re.escape(name)}=([^/]*)", 1)
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", plain_path(raw))


def literal_path(path: str) -> str:
    """A path whose signs are not taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_groups(files: DataFrame, target_bytes: int, min_input_files: int, group_bytes: int, whole: bool) -> DataFrame:
    """Files to be rewritten together: ``folder, number, files, n_files, bytes``.

    Files near the target are left alone, the others are packed in order of size into groups of
    about ``group_bytes``. A group counts if it has enough files and will become fewer. ``whole`` takes every
    file of a folder as one group. Windows run over the file names of one folder.
    """
    if whole:
        numbered = files.withColumn("number", F.lit(0))
    else:
        small = files.where(F.col("length") < 0.75 * target_bytes)
        through = F.sum("length").over(
            W.partitionBy("folder").orderBy("length", "path").rowsBetween(W.unboundedPreceding, W.currentRow)
        )
        numbered = small.withColumn("number", F.floor((through - F.col("length")) / group_bytes).cast("int"))
    groups = numbered.groupBy("folder", "number").agg(
        F.collect_list("path").alias("files"), F.count("*").alias("n_files"), F.sum("length").alias("bytes")
    ).where(F.col("n_files") >= min_input_files)
    return groups if whole else groups.where(F.col("n_files") > F.ceil(F.col("bytes") / target_bytes))


def _batches(groups: Iterator[Row], most_bytes: int) -> Iterator[list[Row]]:
    batch: list[Row] = []
    size = files = 0
    for group in groups:
        full = size + group["bytes"] > most_bytes or files + group["n_files"] > BATCH_FILES or len(batch) >= BATCH_GROUPS
        if batch and full:
            yield batch
            batch, size, files = [], 0, 0
        batch.append(group)
        size, files = size + group["bytes"], files + group["n_files"]
    if batch:
        yield batch


def compact(
    spark: SparkSession,
    path: str,
    target_bytes: int = 128 * MB,
    min_input_files: int = 5,
    where: Column | None = None,
    strategy: str = "binpack",
    sort: Sequence[str] = (),
    group_bytes: int | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Rewrite groups of small files of a Parquet table into files near the target size.

    ``where`` restricts by partition columns. ``strategy="sort"`` rewrites whole folders and orders
    the rows by ``sort``. Groups are planned from the file listing and rewritten a batch at a time: one Spark job
    stages the files of a batch in a hidden folder, count and checksum of old and new rows are compared, then every
    group is swapped in with a commit record of its own. Finished groups stay finished: a run
    that is killed leaves all rows in place, and the next one first carries out what was committed, then goes
    on with the groups that are left. Rows are dealt over ceil(bytes/target) slots per group by
    a hash of their position in the old file, so equal rows do not pile up. Returns one row per group.
    """
    if strategy not in ("binpack", "sort") or (strategy == "sort") != bool(sort):
        raise ValueError("strategy is binpack, or sort with at least one sort column")
    journal = Journal(spark, path)
    journal.recover()
    files, _ = listed_files(spark, path, where)
    groups = file_groups(files, target_bytes, min_input_files, group_bytes or 16 * target_bytes, whole=bool(sort))
    plan = fresh_path(spark, "compaction-plan")  # fixed before the first file moves
    groups.write.parquet(plan)
    report = []
    for batch in _batches(spark.read.schema(groups.schema).parquet(plan).toLocalIterator(), batch_bytes):
        report += _rewrite(spark, journal, batch, target_bytes, sort)
    return spark.createDataFrame(
        report, "part string, file_group int, files_before int, files_after int, bytes bigint, bytes_after bigint"
    )


def _rewrite(
    spark: SparkSession, journal: Journal, batch: Sequence[Row], target_bytes: int, sort: Sequence[str]
) -> list[tuple]:
    """Stage, compare and swap one batch of groups; one report row per group."""
    slots, dealing = 0, []
    for number, group in enumerate(batch):
        wanted = max(1, math.ceil(group["bytes"] / target_bytes))
        dealing += [(file, number, slots, wanted) for file in group["files"]]
        slots += wanted
    # Read by name: files that arrive later are left alone, partition values stay in the folders' names.
    chosen = spark.read.option("mergeSchema", True).parquet(*[literal_path(file) for file, *_ in dealing])
    columns = chosen.columns
    lookup = spark.createDataFrame(dealing, "_file string, _group int, _first int, _wanted int")  # BATCH_FILES rows at most
    opened = chosen.select(
        *columns, plain_path(F.col("_metadata.file_path")).alias("_path"), F.col("_metadata.row_index").alias("_row")
    ).join(F.broadcast(lookup), F.col("_path") == F.col("_file"))
    place = F.pmod(F.xxhash64("_path", "_row"), F.col("_wanted"))
    dealt = opened.select(*columns, "_group", (F.col("_first") + place).cast("int").alias("_slot"))
    if not sort:
        packed = dealt.repartitionById(slots, F.col("_slot"))
    elif slots == len(batch):  # a file per group: ranges from a sample of the rows would cut some groups in two
        packed = dealt.repartitionById(slots, F.col("_slot")).sortWithinPartitions("_group", *sort)
    else:
        # The slot comes last: it only breaks up runs of equal sort values.
        packed = dealt.repartitionByRange(slots, "_group", *sort, "_slot").sortWithinPartitions("_group", *sort)
    staging = journal.staging()
    packed.drop("_slot").write.partitionBy("_group").parquet(staging)
    tagged = dealt.drop("_slot")  # the group is part of the compared row: none may end in another folder
    if content_check(tagged) != content_check(spark.read.schema(tagged.schema).parquet(staging)):
        journal.store.remove(staging)
        raise RuntimeError("the rewritten rows differ from the old ones; nothing was changed")

    def swap(numbered: tuple[int, Row]) -> tuple | None:
        number, group = numbered
        new = journal.store.data_files(f"{staging}/_group={number}")
        if not new:  # files without rows
            return None
        size = sum(journal.store.size(file) for file in new)
        journal.commit([Swap(group["folder"], group["files"], new)])
        part = group["folder"][len(journal.root):].lstrip("/")
        return part, group["number"], group["n_files"], len(new), group["bytes"], size

    results = in_parallel(swap, list(enumerate(batch)))
    for _, error in results:
        if error is not None:
            raise error
    journal.store.remove(staging)
    return [row for row, _ in results if row]


def maintain(spark: SparkSession, tables: Mapping[str, str], **options: Any) -> DataFrame:
    """Compact table after table; a failure is reported and does not stop the rest."""
    report = []
    for name, path in tables.items():
        try:
            rewritten = compact(spark, path, **options).select("part").distinct().count()
            report.append((name, "SUCCESS", rewritten, None))
        except Exception as error:
            report.append((name, "FAILED", None, str(error).splitlines()[0]))
    return spark.createDataFrame(
        report, "table string, status string, rewritten_folders int, error string"
    )
