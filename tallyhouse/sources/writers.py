"""Sinks: files, managed tables, views, CSV to Parquet conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyhouse.session import fresh_path
from tallyhouse.sources.readers import read_csv, read_json


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    if fmt not in ("parquet", "orc", "json", "csv"):
        raise ValueError(f"unknown file format {fmt}")
    df.write.mode(mode).format(fmt).save(path)


def json_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Write as JSON lines and read the same rows back with the same schema."""
    write(df, path, "json")
    return read_json(df.sparkSession, path, df.schema)


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, schemas: Mapping[str, T.StructType]
) -> DataFrame:
    """Convert ``source/<name>.csv`` to ``target/<name>.parquet`` (Snappy); report per file.

    A file that fails is reported and does not stop the others. Row counts come from the
    Parquet footers of what was written, not from a second pass over the CSV.
    """
    report = []
    for name, schema in schemas.items():
        out = f"{target}/{name}.parquet"
        try:
            read_csv(spark, f"{source}/{name}.csv", schema).write.mode("overwrite").option(
                "compression", "snappy"
            ).parquet(out)
            report.append((name, "SUCCESS", spark.read.parquet(out).count(), len(schema)))
        except Exception:
            report.append((name, "FAILED", None, None))
    return spark.createDataFrame(report, "file string, status string, rows bigint, cols int")


def register_external(
    spark: SparkSession, name: str, path: str, fmt: str, schema: T.StructType | None = None
) -> DataFrame:
    """A catalog table over files that already exist."""
    options = {"header": "true"} if fmt == "csv" else {}
    return spark.catalog.createTable(name, path=path, source=fmt, schema=schema, **options)


def overwrite(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Replace a table by the rows of a DataFrame; data lives in the shared folder."""
    target = path or fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").format("parquet").partitionBy(*partition_by).option(
        "path", target
    ).saveAsTable(name)
    return df.sparkSession.table(name)


def ctas(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Create a table from a query; an existing table is an error."""
    target = path or fresh_path(df.sparkSession, name)
    df.write.mode("error").format("parquet").partitionBy(*partition_by).option(
        "path", target
    ).saveAsTable(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, name: str) -> DataFrame:
    """INSERT .. SELECT: columns are matched by name."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.mode("append").insertInto(name)
    return spark.table(name)


def append_partial(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    """INSERT with a column list: columns that are not named become NULL."""
    unknown = set(new_rows.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return target.unionByName(new_rows, allowMissingColumns=True)


def create_view(name: str, df: DataFrame) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def backup(df: DataFrame, name: str) -> DataFrame:
    """A full copy under another name, taken before a risky change."""
    return ctas(df, name)
