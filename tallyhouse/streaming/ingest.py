"""New files appended to a table, micro-batch after micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def read_files(
    spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def ingest(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append every file that is new since the last run, then stop.

    The file sink keeps a commit log next to the data, so a batch that is repeated after a
    failure is recorded once, and a restart adds no rows. Each row keeps its batch number's
    place in time through ``ingested_at``.
    """
    stream = read_files(spark, source, schema, files_per_batch)
    return (
        stream.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
