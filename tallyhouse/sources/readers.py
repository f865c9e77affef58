"""Scans: catalog tables, Parquet, ORC, CSV, JSON, JDBC, inline rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and a declared schema; a row that does not fit is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def register_views(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> None:
    """Expose ``folder/<name>.parquet`` as session views, so that tables are read by name."""
    for name in names:
        read_parquet(spark, f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def rows(spark: SparkSession, data: Sequence[Any], schema: T.StructType | str) -> DataFrame:
    """Inline rows with a declared schema (the VALUES form)."""
    return spark.createDataFrame(list(data), schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_name: str,
    key: str | None = None,
    low: int | None = None,
    high: int | None = None,
    parts: int = 1,
    **options: str,
) -> DataFrame:
    """A database table; with a numeric key and its range it is read by ``parts`` tasks.

    Rows outside the range are read too (the first and last slice are open).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table_name)
    reader = reader.options(**options)
    if key is not None:
        if low is None or high is None:
            raise ValueError("a partition key needs low and high")
        reader = reader.options(
            partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts
        )
    return reader.load()


def to_json_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON string, made on the executors."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
