"""Row-level change as DataFrame operators: each returns the new state of the table.

NULL follows SQL: a row whose predicate is NULL is neither updated nor deleted, and NULL keys
match nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.operators.layout import listed_files, literal_path, plain_path, written_value
from tallyhouse.operators.relational import small_enough
from tallyhouse.operators.swaps import Journal, Swap
from tallyhouse.session import fresh_path


def insert(base: DataFrame, new_rows: DataFrame) -> DataFrame:
    return base.unionByName(new_rows)


def update_where(
    base: DataFrame, predicate: Column, changes: Mapping[str, Any], stamp: tuple[str, Any] | None = None
) -> DataFrame:
    """SET columns where the predicate holds. ``stamp`` = (column, time) marks updated rows."""
    assigned = dict(changes) | ({stamp[0]: stamp[1]} if stamp else {})
    hit = F.coalesce(predicate, F.lit(False))
    types = {f.name: f.dataType for f in base.schema}

    def value(c: str) -> Column:
        v = assigned[c]
        return (v if isinstance(v, Column) else F.lit(v)).cast(types[c])

    return base.select(
        *[F.when(hit, value(c)).otherwise(F.col(c)).alias(c) if c in assigned else F.col(c)
          for c in base.columns]
    )


def delete_where(base: DataFrame, predicate: Column) -> DataFrame:
    return base.where(~F.coalesce(predicate, F.lit(False)))


def _distinct_or_error(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; a second change for the same key is an error when the plan runs.

    A NULL key equals no other, so changes with one stay as they are."""
    rest = [c for c in changes.columns if c not in keys]
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    folded = changes.where(whole).groupBy(*keys).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*rest)).alias("_row")
    )
    message = F.lit("more than one change for the same key")
    once = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    single = folded.where(once).select(*keys, "_row.*").select(*changes.columns)
    return single.unionByName(changes.where(~whole))


def merge(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], stamp: tuple[str, Any] | None = None
) -> DataFrame:
    """MERGE: matched rows take the change's columns, unmatched changes are inserted.

    Columns the changes do not have keep their old value (NULL on insert). Duplicate change keys
    are rejected. A NULL key matches nothing, so a change with one is inserted.

    Changes small enough to be broadcast meet the base twice, once by its keys alone, and the base is never
    shuffled; a hot base key sits on the streamed side, where adaptive execution may split it. Beyond that size
    one full outer join reads the base once, and every row says itself whether it is kept, updated or inserted.
    """
    keys = list(keys)
    if not small_enough(changes):
        return _merge_once(base, _distinct_or_error(changes, keys), keys, stamp)
    unique = _distinct_or_error(changes, keys)
    values = [c for c in changes.columns if c not in keys]
    marked = unique.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(c).alias(f"_c_{c}") for c in values],
        F.lit(True).alias("_hit"),
    )
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    hit = F.col("_hit").isNotNull()

    def merged(c: str) -> Column:
        if c in values:
            return F.when(hit, F.col(f"_c_{c}")).otherwise(F.col(c)).alias(c)
        if stamp and c == stamp[0]:
            return F.when(hit, F.lit(stamp[1])).otherwise(F.col(c)).alias(c)
        return F.col(c)

    updated = base.join(marked, on, "left").select(*[merged(c) for c in base.columns])
    taken = base.select(*keys).join(unique.select(*keys), keys, "left_semi").distinct()
    inserted = unique.join(taken, keys, "left_anti")
    if stamp and stamp[0] not in changes.columns:
        inserted = inserted.withColumn(stamp[0], F.lit(stamp[1]))
    return updated.unionByName(inserted, allowMissingColumns=True)


def _merge_once(
    base: DataFrame, unique: DataFrame, keys: Sequence[str], stamp: tuple[str, Any] | None
) -> DataFrame:
    """MERGE as one full outer join with an action column."""
    values = [c for c in unique.columns if c not in keys]
    there = base.withColumn("_there", F.lit(True))
    coming = unique.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_c_{c}") for c in values], F.lit(True).alias("_hit")
    )
    action = F.when(F.col("_hit").isNull(), "keep").when(F.col("_there").isNull(), "insert").otherwise("update")
    joined = there.join(coming, [F.col(k) == F.col(f"_k_{k}") for k in keys], "full_outer").withColumn("_action", action)
    new, changed = F.col("_action") == "insert", F.col("_action") != "keep"

    def merged(c: str) -> Column:
        if c in keys:
            return F.when(new, F.col(f"_k_{c}")).otherwise(F.col(c)).alias(c)
        if c in values:
            return F.when(changed, F.col(f"_c_{c}")).otherwise(F.col(c)).alias(c)
        if stamp and c == stamp[0]:
            return F.when(changed, F.lit(stamp[1])).otherwise(F.col(c)).alias(c)
        return F.col(c)

    extra = [F.when(new, F.col(f"_c_{c}")).alias(c) for c in values if c not in base.columns]
    return joined.select(*[merged(c) for c in base.columns], *extra)


def mor_read(
    base: DataFrame, deletes: DataFrame, upserts: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Merge on read: base rows that are neither deleted nor replaced, plus the new rows."""
    keys = list(keys)
    gone = deletes.select(*keys).unionByName(upserts.select(*keys)).distinct()
    return base.join(gone, keys, "left_anti").unionByName(upserts)


def materialize(
    spark: SparkSession, base: DataFrame, deletes: DataFrame, upserts: DataFrame,
    keys: Sequence[str], path: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turn a merge-on-read table into a plain one: write the merged rows as the new base and
    return it with empty deltas."""
    mor_read(base, deletes, upserts, keys).write.mode("error").parquet(path)
    return spark.read.parquet(path), deletes.limit(0), upserts.limit(0)


def _arrival_names(spark: SparkSession, parts: Sequence[str]) -> Column:
    """The folder name Spark's own writer gives to text values of the partition columns."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    special = sorted({chr(c) for c in range(1, 128) if escape.needsEscaping(chr(c))})
    name = None
    for part in parts:
        value = F.col(part)
        for sign in ["%", *[c for c in special if c != "%"]]:  # the escape sign itself first
            value = F.replace(value, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
        value = F.when(F.coalesce(F.col(part), F.lit("")) == "", "__HIVE_DEFAULT_PARTITION__").otherwise(value)
        piece = F.concat(F.lit(f"/{part}="), value)
        name = piece if name is None else F.concat(name, piece)
    return name if name is not None else F.lit("")


def cow_apply(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], part: str | Sequence[str],
    op: str = "op",
) -> list[Any]:
    """Copy on write: rewrite only the partition folders that hold changed keys.

    ``changes`` holds full rows with ``op`` U (insert or replace) or D (delete); ``part`` is the
    partition column or columns, from the outermost on. A row may move to another partition. A folder is what
    its name says, not what the value is read as: rows that are not replaced stay in ``p=01`` even if ``p=1`` exists
    too, and a new row goes to the first folder whose value equals its own, or to a new one. Files are staged,
    compared by count, and swapped in for all folders under one commit record: a crash leaves
    the table as before, or as after once ``Journal.recover`` (which every call starts with) has run. Folders left
    without files are removed. Returns the rewritten partition values, tuples for several columns.
    """
    keys, parts = list(keys), [part] if isinstance(part, str) else list(part)
    journal = Journal(spark, path)
    journal.recover()
    base = spark.read.parquet(path)
    types = {f.name: f.dataType for f in base.schema}
    data = [c for c in base.columns if c not in parts]
    delta = fresh_path(spark, "changes")  # several steps read the changes: compute them once
    _distinct_or_error(changes, keys).write.parquet(delta)
    unique = spark.read.parquet(delta)
    arriving = unique.where(F.col(op) != "D").select(*[F.col(c).cast(types[c]) for c in base.columns])

    # Folders: one row each, from the file listing.
    files, _ = listed_files(spark, path)
    known = files.select("folder").distinct().select(
        "folder", *[written_value("folder", p).cast(types[p]).alias(f"_f_{p}") for p in parts]
    )
    # With `01` and `1` the smaller name takes what arrives; one row per value.
    homes = known.groupBy(*[f"_f_{p}" for p in parts]).agg(F.min("folder").alias("home"))
    values = arriving.select(*parts).distinct()
    same = F.lit(True)
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"_f_{p}"))
    texts = F.struct(*[F.col(p).cast("string").alias(p) for p in parts])
    if parts:
        valued = values.join(homes, same, "left").select(
            *[F.col(p).alias(f"_a_{p}") for p in parts], "home", texts.alias("_text")
        ).select(*[f"_a_{p}" for p in parts], "home", "_text.*")
        fresh = F.concat(F.lit(journal.root), _arrival_names(spark, parts))
        to_folder = valued.select(*[f"_a_{p}" for p in parts], F.coalesce("home", fresh).alias("folder"))
    else:
        to_folder = arriving.limit(1).select(F.lit(journal.root).alias("folder"))
    place = F.regexp_replace(plain_path(F.col("_metadata.file_path")), "/[^/]+$", "")
    holding = base.select(*keys, place.alias("folder")).join(unique.select(*keys), keys, "left_semi").select("folder")
    touched = [  # one row per folder to rewrite
        r["folder"] for r in holding.unionByName(to_folder.select("folder")).distinct().orderBy("folder").collect()
    ]
    if not touched:
        return []
    number = spark.createDataFrame(list(enumerate(touched)), "_group int, _folder string")
    old = {folder: [] for folder in touched}
    for file in files.join(number, F.col("folder") == F.col("_folder"), "left_semi").toLocalIterator():
        old[file["folder"]].append(file["path"])
    read = [file for folder in touched for file in old[folder]]

    upserts = arriving.withColumn("_op", F.lit("U"))
    if parts:
        same_value = F.lit(True)
        for p in parts:
            same_value = same_value & F.col(p).eqNullSafe(F.col(f"_a_{p}"))
        located = upserts.join(to_folder, same_value)
    else:
        located = upserts.withColumn("folder", F.lit(journal.root))
    result = located.join(number, F.col("folder") == F.col("_folder")).select(*data, "_group")
    if read:
        schema = T.StructType([f for f in base.schema if f.name in data])
        opened = spark.read.schema(schema).parquet(*[literal_path(file) for file in read])
        opened = opened.select(*data, place.alias("_at")).join(number, F.col("_at") == F.col("_folder"))
        keyed = opened.withColumns({p: written_value("_at", p).cast(types[p]) for p in parts if p in keys})
        result = keyed.join(unique.select(*keys), keys, "left_anti").select(*data, "_group").unionByName(result)
    staging = journal.staging()
    result.hint("rebalance", F.col("_group")).write.partitionBy("_group").parquet(staging)
    # The merge is repeated for this check with its key columns only; one row per folder.
    staged = spark.read.schema(result.schema).parquet(staging)
    counts = [{r["_group"]: r["count"] for r in df.groupBy("_group").count().collect()} for df in (result, staged)]
    if counts[0] != counts[1]:
        journal.store.remove(staging)
        raise RuntimeError("the staged rows differ from the merged ones; nothing was changed")
    journal.commit([
        Swap(folder, old[folder], journal.store.data_files(f"{staging}/_group={n}")) for n, folder in enumerate(touched)
    ])
    journal.store.remove(staging)
    shown = number.select(*[written_value("_folder", p).cast(types[p]).alias(p) for p in parts])
    found = [tuple(r) if len(parts) != 1 else r[0] for r in shown.collect()]
    return sorted(found, key=str)
