"""Table versions over a change log.

A log row is a key, its payload, ``commit_id``, ``committed_at`` and ``op`` (I, U or D); one key
changes at most once per commit, and commit ids grow with time. The state of a version is the
newest log row of every key up to that commit, unless it is a delete.

States are folded with ``max_by``: every task keeps one row per key before the shuffle, so a key
with a very long history costs no more than any other, and several versions are folded in the
same pass over the log. A window would move the whole history of a key into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.functions.expressions import instant
from tallyhouse.session import fresh_path
from tallyhouse.sources.writers import ctas

LOG_COLUMNS = ("commit_id", "committed_at", "op")


def payload(log: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in log.columns if c not in LOG_COLUMNS and c not in keys]


def _newest(log: DataFrame, keys: Sequence[str], upto: Mapping[str, Any]) -> DataFrame:
    """Per key, one struct (op, payload) per named version; NULL where the key does not exist."""
    row = F.struct("op", *payload(log, keys))
    folds = []
    for name, version in upto.items():
        order = F.col("commit_id")
        if version is not None:
            order = F.when(F.col("commit_id") <= version, order)
        folds.append(F.max_by(row, order).alias(name))  # rows with a NULL order are left out
    newest = log.groupBy(*keys).agg(*folds)
    return newest.select(
        *keys, *[F.when(F.col(f"{n}.op") != "D", F.col(n)).alias(n) for n in upto]
    )


def version_at(log: DataFrame, moment: str | datetime | Column) -> Column:
    """The last commit at or before a moment, as a scalar; an error if there is none."""
    last = log.where(F.col("committed_at") <= instant(moment)).agg(F.max("commit_id").alias("v"))
    missing = F.raise_error(F.lit("no commit at or before the given time")).cast("bigint")
    return last.select(F.when(F.col("v").isNull(), missing).otherwise(F.col("v"))).scalar()


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    version: int | Column | None = None,
    ts: str | datetime | Column | None = None,
    schema_log: Mapping[int, Sequence[str]] | None = None,
) -> DataFrame:
    """The table at a version, at a time, or now.

    ``schema_log`` maps the commit that changed the columns to the columns from then on; with it
    the result has the columns of that version rather than today's.
    """
    if ts is not None:
        version = version_at(log, ts)
    part = log if version is None else log.where(F.col("commit_id") <= version)
    state = _newest(part, keys, {"_row": None}).where(F.col("_row").isNotNull())
    columns = payload(log, keys)
    if schema_log is not None:
        limit = version
        if isinstance(version, Column):  # one number: the columns must be known to build the plan
            limit = part.agg(F.max("commit_id")).first()[0]
        newest = max(c for c in schema_log if limit is None or c <= limit)
        columns = [c for c in schema_log[newest] if c not in keys]
    return state.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def snapshots(log: DataFrame) -> DataFrame:
    """One row per commit: id, parent, time, operation and counts per op.

    The parent is found with a window over one row per commit.
    """
    per_commit = log.groupBy("commit_id").agg(
        F.min("committed_at").alias("committed_at"),
        *[F.count_if(F.col("op") == op).alias(name)
          for op, name in (("I", "added"), ("U", "updated"), ("D", "deleted"))],
    )
    added, updated, deleted = F.col("added") > 0, F.col("updated") > 0, F.col("deleted") > 0
    operation = (
        F.when(added & ~updated & ~deleted, "append")
        .when(deleted & ~added & ~updated, "delete")
        .otherwise("overwrite")
    )
    summary = F.create_map(
        F.lit("added"), F.col("added").cast("string"),
        F.lit("updated"), F.col("updated").cast("string"),
        F.lit("deleted"), F.col("deleted").cast("string"),
    )
    return per_commit.select(
        F.col("commit_id").alias("snapshot_id"),
        F.lag("commit_id").over(W.orderBy("commit_id")).alias("parent_id"),
        "committed_at",
        operation.alias("operation"),
        summary.alias("summary"),
    )


def lineage(snapshot_list: DataFrame, start: DataFrame) -> DataFrame:
    """The start snapshots and all their ancestors.

    Every round follows a jump table once and joins it with itself, so jumps double in length
    and n generations take log2(n) rounds. Rounds are written to the shared folder: the plan
    stays short, and a lost executor costs one round.
    """
    spark = snapshot_list.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = fresh_path(spark, "lineage")
        df.write.parquet(path)
        return spark.read.parquet(path)

    reached = start.select("snapshot_id")
    jump = written(
        snapshot_list.where(F.col("parent_id").isNotNull()).select("snapshot_id", "parent_id")
    )
    rounds = jump.count().bit_length() + 1
    while not jump.isEmpty():
        if not rounds:
            raise ValueError("the parents of the snapshots form a cycle")
        rounds -= 1
        up = reached.join(jump, "snapshot_id").select(F.col("parent_id").alias("snapshot_id"))
        reached = written(reached.unionByName(up).distinct())
        onward = jump.select(F.col("snapshot_id").alias("parent_id"), F.col("parent_id").alias("_far"))
        jump = written(
            jump.join(onward, "parent_id").select("snapshot_id", F.col("_far").alias("parent_id"))
        )
    return reached


def history(snapshot_list: DataFrame, pointers: DataFrame) -> DataFrame:
    """When each snapshot became current, and whether it is an ancestor of the current one.

    ``pointers`` has (made_current_at, snapshot_id), one row per move of the table's pointer.
    Only commit lists are joined here, one row per commit, never data.
    """
    current = pointers.agg(F.max_by("snapshot_id", "made_current_at").alias("snapshot_id"))
    marked = lineage(snapshot_list, current).withColumn("_line", F.lit(True))
    return (
        pointers.join(snapshot_list.select("snapshot_id", "parent_id"), "snapshot_id", "left")
        .join(marked, "snapshot_id", "left")
        .select(
            "made_current_at", "snapshot_id", "parent_id",
            F.col("_line").isNotNull().alias("is_current_ancestor"),
        )
    )


def count_drift(log: DataFrame, keys: Sequence[str], version: int | Column) -> DataFrame:
    """Rows now and rows at a version, in one row, from one pass."""
    newest = _newest(log, keys, {"_now": None, "_then": version})
    return newest.agg(
        F.count("_now").alias("current_count"), F.count("_then").alias("historical_count")
    )


def audit(log: DataFrame, keys: Sequence[str], which: Column, versions: Sequence[int]) -> DataFrame:
    """The chosen keys now and at each version, one labelled row per state that exists.

    The key filter reaches the scan; all versions are folded in the same pass.
    """
    upto = {"CURRENT": None} | {f"SNAPSHOT_{v}": v for v in versions}
    newest = _newest(log.where(which), keys, upto)
    labelled = F.array(
        *[F.struct(F.lit(name).alias("version"), F.col(name).alias("row")) for name in upto]
    )
    return (
        newest.select(*keys, F.explode(labelled).alias("_state"))
        .where(F.col("_state.row").isNotNull())
        .select(
            F.col("_state.version").alias("version"), *keys,
            *[F.col(f"_state.row.{c}").alias(c) for c in payload(log, keys)],
        )
    )


def _changed(log: DataFrame, keys: Sequence[str]) -> Column:
    """Whether the payload of _old and _new differs; NULL equals NULL."""
    same = F.lit(True)
    for c in payload(log, keys):
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    return ~same


def diff(
    log: DataFrame, keys: Sequence[str], old: int | Column | None, new: int | Column | None
) -> DataFrame:
    """Keys that differ between two versions: change I, U or D, with old and new payload."""
    pair = _newest(log, keys, {"_old": old, "_new": new})
    before, after = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    change = (
        F.when(~before & after, "I").when(before & ~after, "D")
        .when(before & after & _changed(log, keys), "U")
    )
    return (
        pair.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(
            *keys, "change",
            *[F.col(f"_old.{c}").alias(f"old_{c}") for c in payload(log, keys)],
            *[F.col(f"_new.{c}").alias(f"new_{c}") for c in payload(log, keys)],
        )
    )


def rollback_commit(
    log: DataFrame, keys: Sequence[str], at: str | datetime | Column,
    version: int | None = None, ts: str | datetime | None = None,
) -> DataFrame:
    """The rows of one new commit that brings the table back to a version or time."""
    target = version_at(log, ts) if ts is not None else version
    wanted = diff(log, keys, None, target)
    next_id = log.agg(F.max("commit_id") + 1).scalar()
    return wanted.select(
        *keys,
        *[F.when(F.col("change") == "D", F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c)
          for c in payload(log, keys)],
        next_id.alias("commit_id"),
        instant(at).alias("committed_at"),
        F.col("change").alias("op"),
    )


def rollback(
    log: DataFrame, keys: Sequence[str], at: str | datetime | Column,
    version: int | None = None, ts: str | datetime | None = None,
) -> DataFrame:
    """The log with a rollback commit appended; earlier history stays readable."""
    return log.unionByName(rollback_commit(log, keys, at, version, ts))


def expire(
    log: DataFrame, keys: Sequence[str], older_than: str | datetime | Column, retain_last: int = 1
) -> DataFrame:
    """Drop snapshots before a time, but keep the newest ``retain_last`` in any case.

    Everything up to the oldest kept commit is folded into that commit as inserts; every kept
    version reads as before.
    """
    commits = log.groupBy("commit_id").agg(F.min("committed_at").alias("at"))
    place = F.row_number().over(W.orderBy(F.desc("commit_id")))  # over one row per commit
    kept = commits.withColumn("_place", place).where(
        (F.col("_place") <= max(retain_last, 1)) | (F.col("at") >= instant(older_than))
    )
    first = kept.agg(F.min(F.struct("commit_id", "at"))).scalar()
    oldest = first["commit_id"]
    folded = as_of(log, keys, version=oldest).select(
        "*",
        oldest.alias("commit_id"),
        first["at"].alias("committed_at"),
        F.lit("I").alias("op"),
    )
    return log.where(F.col("commit_id") > oldest).unionByName(folded)


def expire_by_age(
    log: DataFrame, keys: Sequence[str], max_age_ms: int, as_of_time: datetime, retain_last: int = 1
) -> DataFrame:
    return expire(log, keys, as_of_time - timedelta(milliseconds=max_age_ms), retain_last)


def undelete(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Rows that existed at a version and are gone now."""
    pair = _newest(log, keys, {"_then": version, "_now": None})
    return pair.where(F.col("_then").isNotNull() & F.col("_now").isNull()).select(
        *keys, *[F.col(f"_then.{c}").alias(c) for c in payload(log, keys)]
    )


def restore(log: DataFrame, keys: Sequence[str], version: int, name: str) -> DataFrame:
    """The table of an older version, written as a table of its own."""
    return ctas(as_of(log, keys, version=version), name)
