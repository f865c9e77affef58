"""Daily sales kept up to date batch by batch, in proportion to the days that a batch touches.

Silver rows are stored by period and batch, the daily rollup by period (a day, or a month of days where days
are small). A batch writes its own rows, then recomputes the periods it touched from their
stored rows and replaces just those. Both writes replace what an earlier attempt of the same batch left, and
a finished batch leaves a mark, so a repeated one changes nothing. No row is too late and the newest
day is there at once. There is no state but the stored rows: a lost executor costs a task, a
lost driver the unfinished batch, which the checkpoint hands out again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.schemas import AMOUNT_BANDS
from tallyhouse.sources.storage import Storage
from tallyhouse.streaming.daily_sales import daily_sales, stream_silver

PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
UNDATED = "none"


def period_of(day: str, unit: str) -> Column:
    return F.coalesce(F.date_format(day, PERIODS[unit]), F.lit(UNDATED)).alias("period")


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that the rows fall into, and no others."""
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*by).parquet(path)


class DailyFold:
    """The stored silver rows (``rows``) and the rollup (``daily``) under one folder."""

    def __init__(
        self, spark: SparkSession, target: str, unit: str = "day", bands: Sequence[tuple[Any, str]] = AMOUNT_BANDS
    ) -> None:
        if unit not in PERIODS:
            raise ValueError(f"unit is one of {', '.join(PERIODS)}")
        self.spark, self.unit, self.bands = spark, unit, bands
        self.rows_path, self.daily_path = f"{target}/rows", f"{target}/daily"
        self.marks, self.store = f"{target}/batches", Storage(spark, target)

    def done(self, batch_id: int) -> bool:
        return self.store.exists(f"{self.marks}/{batch_id}")

    def fold(self, batch: DataFrame, batch_id: int) -> list[str]:
        """Take one batch in; returns the periods it touched (one name per calendar day at most)."""
        if self.done(batch_id):
            return []
        silver = stream_silver(batch, self.bands).withColumns(
            {"period": period_of("order_date", self.unit), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        _replace(silver, self.rows_path, "period", "batch_id")
        touched: list[str] = []
        if self.store.exists(self.rows_path) and self._has_rows():
            stored = self.stored(silver.schema)
            touched = [r[0] for r in stored.where(F.col("batch_id") == batch_id).select("period").distinct().collect()]
        if touched:
            # A filter on the partition column: other periods are not even listed for reading.
            again = stored.where(F.col("period").isin(touched))
            daily = daily_sales(again).withColumns(
                {"batch_id": F.lit(batch_id).cast("bigint"), "period": period_of("order_date", self.unit)}
            )
            _replace(daily, self.daily_path, "period")
        self.store.make_folder(f"{self.marks}/{batch_id}")
        return sorted(touched)

    def _has_rows(self) -> bool:
        return any(name.startswith("period=") for name in self.store.names(self.rows_path))

    def stored(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.rows_path)

    def daily(self) -> DataFrame:
        """The rollup, with the last batch that touched each period."""
        return self.spark.read.parquet(self.daily_path).drop("period")


def fold_stream(stream: DataFrame, fold: DailyFold, checkpoint: str) -> StreamingQuery:
    """Fold every batch that is there, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: fold.fold(batch, batch_id) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
