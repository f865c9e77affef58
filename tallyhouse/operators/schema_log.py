"""Columns of a versioned table as data: what every commit added, renamed, widened or dropped.

The schema log has one row per column and change: ``commit_id, column_id, name, type, position, dropped``. A
column keeps its ``column_id`` for life. The change log stores payload columns under that id (``c1``, ``c2``, ...),
so a rename touches no stored row, a name can be used again for another column, and a column that
is widened keeps its old values. A version is read with the names and types that held then.

A schema log is as small as the number of columns and changes; finding the schema of a version folds it,
and its rows (one per column of that version) are fetched to build the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.operators.versions import LOG_COLUMNS, as_of, version_at

SCHEMA = "commit_id bigint, column_id int, name string, type string, position int, dropped boolean"
#: Types a column may be widened to without changing a value. Fixed values.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


class Field(NamedTuple):
    column_id: int
    name: str
    type: str
    position: int


def physical(column_id: int) -> str:
    return f"c{column_id}"


def is_wider(old: str, new: str) -> bool:
    if old == new or new in WIDER.get(old, ()):
        return True
    one, other = T._parse_datatype_string(old), T._parse_datatype_string(new)
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        return other.scale >= one.scale and other.precision - other.scale >= one.precision - one.scale
    return False


def first_schema(spark: SparkSession, commit_id: int, columns: Mapping[str, str]) -> DataFrame:
    """The log of a table made by a commit with these columns (name: type)."""
    rows = [(commit_id, n, name, kind, n, False) for n, (name, kind) in enumerate(columns.items(), 1)]
    return spark.createDataFrame(rows, SCHEMA)


def schema_at(schema_log: DataFrame, version: int | None = None) -> list[Field]:
    """The columns after a commit, in order: the newest row of each column that is not dropped."""
    part = schema_log if version is None else schema_log.where(F.col("commit_id") <= version)
    newest = part.groupBy("column_id").agg(F.max_by(F.struct("name", "type", "position", "dropped"), "commit_id").alias("r"))
    rows = newest.where(~F.col("r.dropped")).select("column_id", "r.name", "r.type", "r.position").collect()
    return sorted((Field(*row) for row in rows), key=lambda f: f.position)


def alter(
    schema_log: DataFrame, commit_id: int, add: Mapping[str, str] | None = None, rename: Mapping[str, str] | None = None,
    widen: Mapping[str, str] | None = None, drop: Sequence[str] = (),
) -> DataFrame:
    """The log with one more commit: columns dropped, renamed (old: new), widened (name before the commit: type) and added."""
    last, highest = schema_log.agg(F.max("commit_id"), F.max("column_id")).first()
    if last is not None and commit_id <= last:
        raise ValueError(f"commit {commit_id} is not later than {last}")
    fields = {f.name: f for f in schema_at(schema_log)}
    rename, widen, add = dict(rename or {}), dict(widen or {}), dict(add or {})
    for name in (*rename, *widen, *drop):
        if name not in fields:
            raise ValueError(f"there is no column {name}")
    if {*rename, *widen} & {*drop}:
        raise ValueError("a dropped column cannot change")
    changed: list[tuple] = []
    names = []
    for f in fields.values():
        if f.name in drop:
            changed.append((commit_id, f.column_id, f.name, f.type, f.position, True))
            continue
        name, kind = rename.get(f.name, f.name), widen.get(f.name, f.type)
        if not is_wider(f.type, kind):
            raise ValueError(f"{f.name}: {kind} cannot hold every {f.type}")
        names.append(name)
        if (name, kind) != (f.name, f.type):
            changed.append((commit_id, f.column_id, name, kind, f.position, False))
    for n, (name, kind) in enumerate(add.items(), (highest or 0) + 1):
        names.append(name)
        changed.append((commit_id, n, name, kind, n, False))
    if len(set(names)) < len(names):
        raise ValueError("two columns would have the same name")
    return schema_log.unionByName(schema_log.sparkSession.createDataFrame(changed, SCHEMA))


def stored_types(schema_log: DataFrame) -> dict[int, str]:
    """Every column that ever was, with its newest and so widest type."""
    newest = schema_log.groupBy("column_id").agg(F.max_by("type", "commit_id").alias("type"))
    return {r["column_id"]: r["type"] for r in newest.orderBy("column_id").collect()}


def to_stored(rows: DataFrame, schema_log: DataFrame, commit_id: int, keys: Sequence[str]) -> DataFrame:
    """Rows of a commit, named as the table was then, under their column ids. Columns the commit does not know are NULL."""
    then = {f.column_id: f for f in schema_at(schema_log, commit_id)}
    unknown = set(rows.columns) - {f.name for f in then.values()} - {*keys, *LOG_COLUMNS}
    if unknown:
        raise ValueError(f"not a column at commit {commit_id}: {', '.join(sorted(unknown))}")
    columns: list[Column] = []
    for column_id, kind in stored_types(schema_log).items():
        known = column_id in then and then[column_id].name in rows.columns
        value = F.col(then[column_id].name).cast(then[column_id].type) if known else F.lit(None)
        columns.append(value.cast(kind).alias(physical(column_id)))
    return rows.select(*keys, *columns, *[c for c in LOG_COLUMNS if c in rows.columns])


def read_version(
    log: DataFrame, schema_log: DataFrame, keys: Sequence[str], version: int | None = None,
    ts: str | datetime | Column | None = None,
) -> DataFrame:
    """The table at a version, at a time, or now, with the names and types of that version.

    ``log`` holds payload columns under their ids, stored with the newest types."""
    if ts is not None:
        version = log.select(version_at(log, ts).alias("v")).first()["v"]
    state = as_of(log, keys, version=version)
    # A value written before a column was widened fits its old type; later ones are not in this version.
    return state.select(*keys, *[F.col(physical(f.column_id)).cast(f.type).alias(f.name) for f in schema_at(schema_log, version)])
