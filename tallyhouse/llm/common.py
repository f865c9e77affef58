"""Registration, scratch tables and small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.session import fresh_path
from tallyhouse.sources.readers import read_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``function(spark, folder)`` as a query, with the SQL that must give the same rows."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql.strip()
        return function

    return register


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: lineage ends there, and what
    non-deterministic expressions gave is fixed. A lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)


def typed(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns alone, cast; other columns and their names never matter to an operator."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()])


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0. NULL ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def integer(df: DataFrame, expression) -> int:
    """One number of a table, 0 for an empty one."""
    return int(df.agg(expression.alias("x")).first()["x"] or 0)


#: SQL for the 256 cells of a crc32 table as one list, from the polynomial.
CRC_CELLS = """
    select list(list_reduce(list_prepend(n, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as cells
    from range(256) as r(n)"""


def crc32_sql(digits: str) -> str:
    """SQL for the crc32 of bytes given as hexadecimal digits; needs ``cells`` of CRC_CELLS in scope."""
    return f"""xor(4294967295, list_reduce(
            list_prepend(cast(4294967295 as bigint),
                list_transform(regexp_extract_all({digits}, '..'), lambda pair: cast('0x' || pair as bigint))),
            lambda c, b: xor(c >> 8, cells[xor(c & 255, b) + 1])))"""
